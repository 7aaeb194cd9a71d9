"""Which batches of a continuous fan-out are whole.

``_commits.json`` beside the ``batch_id=…`` folders names, for every table, the runs of batches that have changes
of it. A batch is added once all its tables are written, in one step. Readers take the folders it names,
so they see whole batches only, also while the next batch is being written or after one was cut off.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.streaming.files import folder_names, read_text, replace_text

FILE = "_commits.json"


@dataclass(frozen=True)
class Commits:
    """``runs`` maps a table's folder below a batch to the first and last batch of each run."""

    last: int = -1
    schema: str = ""
    runs: dict[str, list[list[int]]] = field(default_factory=dict)

    def adding(self, batch: int, schema: str, folders: list[str]) -> Commits:
        runs = {name: [list(run) for run in found] for name, found in self.runs.items()}
        for name in folders:
            own = runs.setdefault(name, [])
            if own and own[-1][1] == batch - 1:
                own[-1][1] = batch
            else:
                own.append([batch, batch])
        return Commits(batch, schema, runs)


def read_commits(spark: SparkSession, path: str) -> Commits:
    text = read_text(spark, f"{path}/{FILE}")
    return Commits() if text is None else Commits(**json.loads(text))


def commit(spark: SparkSession, path: str, batch: int, schema: T.StructType) -> None:
    """Let readers see a batch, all of whose folders are written."""
    root = f"{path}/batch_id={batch}"
    folders = [
        f"{db}/{table}"
        for db in folder_names(spark, root) if db.startswith("db=")
        for table in folder_names(spark, f"{root}/{db}") if table.startswith("table=")
    ]
    state = read_commits(spark, path).adding(batch, schema.json(), sorted(folders))
    replace_text(spark, f"{path}/{FILE}", f"{path}/_commits-{batch}.draft", json.dumps(asdict(state)))


def _table_of(folder: str) -> str:
    return ".".join(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def read_fan_out(spark: SparkSession, path: str, tables: list[str] | None = None, since: int = -1) -> DataFrame:
    """The changes of whole batches after batch ``since``, with ``batch_id``, ``db`` and ``table``; ``tables`` as ``db.table``.

    Only the folders of these tables and batches are listed. Without any there are no rows.
    """
    state = read_commits(spark, path)
    if not state.schema:
        raise ValueError(f"{path} holds no whole batch")
    folders = [
        f"{path}/batch_id={batch}/{name}"
        for name, runs in state.runs.items()
        if tables is None or _table_of(name) in tables
        for first, last in runs
        for batch in range(max(first, since + 1), last + 1)
    ]
    places = [T.StructField("batch_id", T.LongType()), T.StructField("db", T.StringType()), T.StructField("table", T.StringType())]
    schema = T.StructType([*T.StructType.fromJson(json.loads(state.schema)).fields, *places])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).withColumn("batch_id", F.col("batch_id").cast("long"))
