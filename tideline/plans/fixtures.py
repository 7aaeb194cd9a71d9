"""Inputs derived from the test tables, row by row wherever possible.

A change record carries its own before image, as log records do, so building
the change frame needs no shuffle and no window over a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.temporal import epoch_micros
from tideline.model import REGISTRY_SCHEMA

DB = "shop"
TOPIC = "changes"
IMAGE = "user_id BIGINT, event_id BIGINT, event_type STRING, value DOUBLE, ts BIGINT, props STRING"
SOURCE = "db STRING, table STRING, ts_ms BIGINT, pos BIGINT"
SNAPSHOT_TS = 1_700_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(events: DataFrame) -> DataFrame:
    """Events with ``ts`` as epoch microseconds."""
    return events.withColumn("ts", epoch_micros(F.col("ts")))


def changes_of(rows: DataFrame, with_nulls: bool = False) -> DataFrame:
    """The change frame of event rows; key ``user_id``, position ``event_id``.

    ``with_nulls`` blanks ``value`` in every seventh row.
    """
    value = F.col("value")
    if with_nulls:
        value = F.when(F.col("event_id") % 7 != 0, value)

    def image(event_id: Column, event_type: Column) -> Column:
        return F.struct(
            "user_id",
            event_id.alias("event_id"),
            event_type.alias("event_type"),
            value.alias("value"),
            "ts",
            "props",
        )

    kind = F.col("event_type")
    removed = kind == "error"
    row = image(F.col("event_id"), kind)
    # an update replaces an earlier image, a delete removes the row itself
    earlier = image(
        F.when(removed, F.col("event_id")).otherwise(F.col("event_id") - 1),
        F.when(removed, kind).otherwise(F.lit("signup")),
    )
    op = F.when(kind == "signup", "c").when(removed, "d").otherwise("u")
    ts_ms = F.call_function("div", F.col("ts"), F.lit(1000))
    return rows.select(
        F.when(kind != "signup", earlier).alias("before"),
        F.when(~removed, row).alias("after"),
        F.struct(
            F.lit(DB).alias("db"),
            F.concat(F.lit("events_"), (F.col("user_id") % 5).cast("string")).alias("table"),
            ts_ms.alias("ts_ms"),
            F.col("event_id").alias("pos"),
        ).alias("source"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
        F.col("ts").alias("order_ts"),
        F.col("event_id").alias("pos"),
    )


def cdc_events(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    return changes_of(event_rows(table(spark, sf_dir, "events")), with_nulls)


def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A current table to apply changes to: one row per customer, in event form."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
        F.lit(SNAPSHOT_TS * 1000).cast("bigint").alias("ts"),
        F.col("c_name").alias("props"),
    )


def topic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records in six partitions; offsets grow, with gaps."""
    return table(spark, sf_dir, "events").select(
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("value"),
    )


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def event_tables(env: DataFrame) -> DataFrame:
    """Table names of a change frame in the order of their first change."""
    name = F.concat("source.db", F.lit("."), "source.table")
    return env.groupBy(name.alias("db_table_name")).agg(F.min("pos").alias("ord"))


def supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An uneven registry: one table per supplier, on partitions 0, 1 and 2 of 12."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("erp.supplier_"), key.cast("string")).alias("db_table_name"),
        F.when(key % 10 == 0, "2").when(key % 3 == 0, "1").otherwise("0").alias("kafka_partition"),
        F.when(key % 4 == 3, "audit").otherwise(TOPIC).alias("kafka_topic"),
    )


def wide_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per order, on partitions of which the higher ones have more and more tables."""
    key = F.col("o_orderkey").cast("double")
    partition = F.floor(F.sqrt(key * 100.0)).cast("bigint") % 5_000
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("shop.order_"), F.col("o_orderkey").cast("string")).alias("db_table_name"),
        partition.cast("string").alias("kafka_partition"),
        F.lit(TOPIC).alias("kafka_topic"),
    )


def customer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to allocate: one table per customer, then every supplier's again."""
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" crm.customer_"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("db_table_name"),
        F.col("c_custkey").alias("ord"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("erp.supplier_"), F.col("s_suppkey").cast("string")).alias("db_table_name"),
        (F.col("s_suppkey") + 1_000_000_000_000).alias("ord"),
    )
    return customers.unionByName(suppliers)


def part_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts read as table descriptions: a brand is a table, a part one of its columns."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("table"),
        F.col("p_partkey").alias("ordinal"),
        F.concat(F.lit("col_"), F.col("p_partkey").cast("string")).alias("Field"),
        F.when(size % 5 == 0, " pri ").when(size % 5 == 1, "UNI").otherwise("").alias("Key"),
    )
