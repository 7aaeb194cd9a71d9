"""Topic partitions: by key hash, by registry, and balanced allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.hashing import fold_hash, signed32
from tideline.operators.changelog import _with_key_value, key_map_frame, qualified_table
from tideline.operators.positions import with_position
from tideline.operators.sizing import BROADCAST_ROWS, checked_broadcast


def hash_partition(env: DataFrame, key_map: DataFrame | dict[str, str], n: int) -> DataFrame:
    """Add ``key_value`` and ``partition`` = |hash(table + db + key) mod n|.

    The hash of table + db is computed once per table in the key map; a row only
    continues it over its key.
    """
    name = F.col("db_table")
    keys, known = key_map_frame(env, key_map)
    keys = keys.select(
        name.alias("_db_table"),
        "pk_column",
        F.concat(F.substring_index(name, ".", -1), F.substring_index(name, ".", 1)).alias("_prefix"),
    )
    keys = keys.withColumn("_prefix_hash", fold_hash(F.col("_prefix"), F.lit(0)))
    keys = checked_broadcast(keys, known_rows=known)
    joined = _with_key_value(
        env.withColumn("_db_table", qualified_table())
        .withColumn("_raw", F.concat("source.table", "source.db"))
        .join(keys, "_db_table", "left")
    )
    start = F.when(F.col("_prefix") == F.col("_raw"), F.col("_prefix_hash")).otherwise(
        fold_hash(F.col("_raw"), F.lit(0))
    )
    hashed = signed32(fold_hash(F.col("key_value"), start))
    return joined.withColumn("partition", F.abs(hashed % n).cast("int")).drop(
        "_db_table", "_raw", "pk_column", "_prefix", "_prefix_hash"
    )


def registry_for(registry: DataFrame, topic: str) -> DataFrame:
    """``(db_table_name, partition)`` of one topic, partition as a number.

    A table that is registered more than once counts once, with its lowest partition.
    """
    return (
        registry.filter((F.col("kafka_topic") == topic) & F.col("db_table_name").isNotNull())
        .filter(F.col("kafka_partition").isNotNull())
        .groupBy("db_table_name")
        .agg(F.min(F.col("kafka_partition").cast("int")).alias("partition"))
    )


def registry_partition(env: DataFrame, routes: DataFrame, on_missing: str = "error") -> DataFrame:
    """Add the ``partition`` registered for each change's table.

    ``routes`` comes from :func:`registry_for`. A table that is not in it fails
    the job, or gets null with ``on_missing='null'``.
    """
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    routes = checked_broadcast(routes.select(F.col("db_table_name").alias("_db_table"), "partition"))
    joined = env.withColumn("_db_table", qualified_table()).join(routes, "_db_table", "left")
    if on_missing == "error":
        failure = F.raise_error(F.concat(F.lit("no partition registered for "), F.col("_db_table")))
        joined = joined.withColumn("partition", F.coalesce("partition", failure.cast("int")))
    return joined.drop("_db_table")


def partition_load(routes: DataFrame, n: int) -> DataFrame:
    """Registered tables per partition ``0..n-1``, empty partitions included."""
    spark = routes.sparkSession
    used = routes.filter(F.col("partition").between(0, n - 1)).select("partition", F.lit(1).alias("one"))
    every = spark.range(n).select(F.col("id").cast("int").alias("partition"), F.lit(0).alias("one"))
    return used.unionByName(every).groupBy("partition").agg(F.sum("one").alias("tables"))


def water_level(loads: list[int], tables: int) -> int:
    """The load up to which partitions are filled, the least loaded first, when ``tables`` more are dealt out."""
    level, before = 0, 0
    for members, load in enumerate(sorted(loads) + [None]):
        # the first ``members`` partitions are level with each other, up to the load of the next one
        if load is not None and before + members * (load - level) < tables:
            before += members * (load - level)
            level = load
        elif members:
            return level + -(-(tables - before) // members)
    return level


def _ranked(rows: DataFrame, order_by: list[str], count: int) -> DataFrame:
    """``rank`` in a total order. Few rows, which are local, are ranked as they are; many by a range-partitioned sort."""
    if count > BROADCAST_ROWS:
        return with_position(rows, order_by, "rank")
    return rows.coalesce(1).withColumn("rank", F.row_number().over(Window.orderBy(*order_by)).cast("bigint") - 1)


def _local(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows and their number; at most as many as may be broadcast are fetched, and then not computed again."""
    head = rows.limit(BROADCAST_ROWS + 1).toArrow()
    if head.num_rows > BROADCAST_ROWS:
        return rows, rows.count()
    return rows.sparkSession.createDataFrame(head, schema=rows.schema), head.num_rows


def allocate_partitions(registry: DataFrame, tables: DataFrame, topic: str, n: int) -> DataFrame:
    """The registry extended by one partition for every new table of ``tables``.

    ``tables`` has ``db_table_name`` and ``ord``, the input order. New tables
    take, one after the other, the least-loaded partition, the lowest one on
    ties. Registered tables keep theirs.

    The places that tables take are rows: each partition has one per load between its own and the level that all
    are filled to, ordered by load and partition. So there are at most ``n`` more than new tables, whatever the loads, and
    the rank of a place is the rank of its table.
    """
    known = registry_for(registry, topic)
    fresh = (
        tables.select(F.trim("db_table_name").alias("db_table_name"), "ord")
        .groupBy("db_table_name")
        .agg(F.min("ord").alias("ord"))
        .join(known.select("db_table_name"), "db_table_name", "left_anti")
    )
    if n > 1:
        fresh, count = _local(fresh)
        used = known.filter(F.col("partition").between(0, n - 1)).groupBy("partition").agg(F.count(F.lit(1)).alias("tables"))
        loads = [0] * n
        for row in used.collect():  # at most one per partition of the topic
            loads[row.partition] = row.tables
        level = water_level(loads, count)
        low = [(p, load) for p, load in enumerate(loads) if load < level]
        places = registry.sparkSession.createDataFrame(low, "partition INT, load BIGINT")
        places = places.select("partition", F.explode(F.sequence(F.col("load"), F.lit(level - 1).cast("bigint"))).alias("load"))
        ranked = _ranked(fresh, ["ord", "db_table_name"], count)
        placed = ranked.join(_ranked(places, ["load", "partition"], count + n), "rank")
        placed = placed.select("db_table_name", F.col("partition").cast("string").alias("kafka_partition"))
    else:
        placed = fresh.select("db_table_name", F.lit("0").alias("kafka_partition"))
    added = placed.withColumn("kafka_topic", F.lit(topic))
    return registry.select("db_table_name", "kafka_partition", "kafka_topic").unionByName(added)
