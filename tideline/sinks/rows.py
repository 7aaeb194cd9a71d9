"""Row sinks: JSON lines for inserts, key deletes on JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import model as m
from tideline.functions.temporal import sql_text


def encode_rows(rows: DataFrame) -> DataFrame:
    """``line``: each ``+I``/``+U`` row as one JSON object, nulls written out.

    Timestamps are written as SQL text, which JSON-row tables take.
    """
    fields = [sql_text(F.col(c), kind).alias(c) for c, kind in rows.dtypes if c != "row_kind"]
    written = rows.filter(F.col("row_kind").isin(m.INSERT, m.UPDATE_AFTER))
    return written.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))


def write_rows(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Append the encoded rows to a folder of JSON-lines files."""
    encode_rows(rows).write.mode(mode).text(path)


def insert_rows_jdbc(rows: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    """Append ``+I``/``+U`` rows to a JDBC table, in batches per partition."""
    written = rows.filter(F.col("row_kind").isin(m.INSERT, m.UPDATE_AFTER)).drop("row_kind")
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}
    written.write.format("jdbc").options(**options).mode("append").save()


def delete_statement(table: str, keys: list[str], staging: str, mutation: bool = False) -> str:
    """One set-based delete of the keys in ``staging``; ``mutation`` for ALTER … DELETE."""
    columns = ", ".join(keys)
    matched = columns if len(keys) == 1 else f"({columns})"
    where = f"{matched} IN (SELECT {columns} FROM {staging})"
    return f"ALTER TABLE {table} DELETE WHERE {where}" if mutation else f"DELETE FROM {table} WHERE {where}"


def delete_rows_jdbc(
    keys: DataFrame, url: str, table: str, staging: str, mutation: bool = False, **options: str
) -> None:
    """Delete the rows whose key columns match ``keys``.

    Executors write the keys to ``staging`` and the database matches them. No key
    passes through the driver, which only sends the one statement.
    """
    keys.write.format("jdbc").options(url=url, dbtable=staging, **options).mode("overwrite").save()
    run_statements(keys.sparkSession, url, [delete_statement(table, keys.columns, staging, mutation)], **options)


def run_statements(spark: SparkSession, url: str, statements: list[str], **options: str) -> None:
    """Send statements to a database, from the driver, over one connection."""
    jvm = spark._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            properties.setProperty(name, options[name])
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


#: Columns that a versioned table has beside its own.
VERSION, REMOVED = "row_version", "row_removed"


def versioned_rows(folded: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of (keys…, _image, _version): the image's columns, its version, and whether the key was removed.

    A removed key keeps its key columns; the others are null.
    """
    fields = folded.schema["_image"].dataType.names
    columns = [F.col(c) if c in keys else F.col("_image")[c].alias(c) for c in fields]
    return folded.select(*columns, F.col("_version").cast("bigint").alias(VERSION), F.col("_image").isNull().alias(REMOVED))


def merge_statements(table: str, columns: list[str], keys: list[str], staging: str) -> list[str]:
    """What brings the rows of ``staging`` into a versioned table: older rows go, then newer ones come.

    A row that the table holds in the same or a later version stays, so a late or repeated batch changes nothing. Removed keys stay
    as rows, marked as such, and keep late changes from bringing them back.
    """
    same = " AND ".join(f"{staging}.{k} = {table}.{k}" for k in keys)
    listed = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same} AND {staging}.{VERSION} > {table}.{VERSION})",
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {same})",
    ]


def current_rows(table: str, columns: list[str]) -> str:
    """The query that shows a versioned table as its readers want it."""
    return f"SELECT {', '.join(columns)} FROM {table} WHERE NOT {REMOVED}"


def merge_rows_jdbc(rows: DataFrame, url: str, table: str, staging: str, keys: list[str], **options: str) -> None:
    """Bring versioned rows into a table. Executors write them to ``staging``, which is dropped at the end; the database compares."""
    rows.write.format("jdbc").options(url=url, dbtable=staging, **options).mode("overwrite").save()
    run_statements(rows.sparkSession, url, [*merge_statements(table, rows.columns, keys, staging), f"DROP TABLE {staging}"], **options)
