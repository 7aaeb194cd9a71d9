"""Small files that are replaced in one step, on any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole text of a small file; None where there is none."""
    files, target = file_system(spark, path)
    try:
        stream = files.open(target)
    except Py4JJavaError as error:
        if "FileNotFound" not in error.java_exception.getClass().getName():
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, draft: str, text: str) -> None:
    """Write ``draft`` and rename it to ``path``: readers find the old text or the new one."""
    files, target = file_system(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(draft)
    out = files.create(source, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    renames = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(renames, 1)
    options[0] = renames.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    files, target = file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []
