"""Bounded scans of JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table_name: str,
    username: str,
    password: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Reader options; a partition column splits the scan into parallel ranges."""
    options = {
        "url": url,
        "dbtable": table_name,
        "user": username,
        "password": password,
        "fetchsize": str(fetch_size),
        **more,
    }
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partitioned scan needs bounds and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc_table(
    spark: SparkSession, url: str, table_name: str, username: str, password: str, columns: list[str], **scan
) -> DataFrame:
    """The declared columns of a table; Spark pushes later filters to the database."""
    options = jdbc_options(url, table_name, username, password, **scan)
    return spark.read.format("jdbc").options(**options).load().select(*columns)
