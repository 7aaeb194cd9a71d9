"""SQL script jobs: files of Spark SQL statements, over tables and over streams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_INSERT = re.compile(r"insert\s+into\s+(?:table\s+)?([^\s(]+)", re.IGNORECASE)
#: A list of columns after an insert's table, but no query in parentheses.
_COLUMNS = re.compile(r"\s*\((?!\s*(?:select|with|values|from|table)\b)([^()]*)\)", re.IGNORECASE)


def split_statements(text: str, delimiter: str = ";") -> list[str]:
    """Statements between delimiters; quoted text is kept whole, comments go."""
    token = re.compile(
        r"(?P<comment>--[^\n]*|/\*(?!\+).*?\*/)"
        r"|(?P<quoted>'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\"|`[^`]*`)"
        rf"|(?P<end>{re.escape(delimiter)})",
        re.DOTALL,
    )
    statements, current, at = [], [], 0
    for found in token.finditer(text):
        current.append(text[at : found.start()])
        at = found.end()
        if found["quoted"]:
            current.append(found["quoted"])
        elif found["comment"]:
            current.append(" ")
        else:
            statements.append("".join(current).strip())
            current = []
    statements.append(("".join(current) + text[at:]).strip())
    return [s for s in statements if s]


def read_script(spark: SparkSession, path: str) -> str:
    """The text of a script in any file system Spark can read."""
    return spark.read.text(path, wholetext=True).first()[0]


def run_script(
    spark: SparkSession,
    text: str,
    delimiter: str = ";",
    mode: str = "batch",
    args: dict | None = None,
    parallel: int = 1,
    share: bool = False,
) -> int:
    """Run every statement and return how many there were.

    ``immediate`` runs them in order. ``batch`` runs ``INSERT INTO`` statements
    after all others; with ``parallel`` > 1 inserts into different tables run
    side by side, those into one table stay in order. ``args`` fill the named
    parameter markers of queries and inserts. With ``share`` a source that several of the inserts of a batch read is
    scanned once: the columns they need are kept in memory and on the executors' disks until all inserts are done.
    That pays where a source is costly to compute or to reach, less where a scan of it is pruned to little.
    """
    if mode not in ("batch", "immediate"):
        raise ValueError("mode must be 'batch' or 'immediate'")
    statements = split_statements(text, delimiter)
    inserts: dict[str, list[str]] = {}
    for statement in statements:
        target = _INSERT.match(statement)
        if mode == "batch" and target:
            inserts.setdefault(target[1].replace("`", "").lower(), []).append(statement)
        else:
            _run(spark, statement, args)
    deferred = [s for s in statements if mode == "batch" and _INSERT.match(s)]
    with shared_sources(spark, deferred, args) if share else _nothing():
        if parallel > 1 and len(inserts) > 1:
            with ThreadPoolExecutor(parallel) as pool:
                list(pool.map(lambda group: [_run(spark, s, args) for s in group], inserts.values()))
        else:
            for statement in deferred:
                _run(spark, statement, args)
    return len(statements)


@contextmanager
def _nothing() -> Iterator[None]:
    yield


def _sources(spark: SparkSession, statement: str) -> set[str]:
    """The tables and views of one name that a statement reads outside of subqueries."""
    leaves = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement).collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    names = [leaf.multipartIdentifier() for leaf in found if leaf.nodeName() == "UnresolvedRelation"]
    return {parts.apply(0) for parts in names if parts.size() == 1}


def _query(statement: str) -> str:
    """The query of an insert, without its table and columns."""
    rest = statement[_INSERT.match(statement).end() :]
    columns = _COLUMNS.match(rest)
    return rest[columns.end() :] if columns else rest


def _scanned(df: DataFrame) -> set[str]:
    """Columns that the scans of a query read."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    outputs = [leaves.apply(i).output() for i in range(leaves.size())]
    return {out.apply(k).name().lower() for out in outputs for k in range(out.size())}


@contextmanager
def shared_sources(spark: SparkSession, inserts: list[str], args: dict | None = None) -> Iterator[list[str]]:
    """While it is open, sources that several inserts read are views of one kept scan; gives their names."""
    read = [_sources(spark, s) for s in inserts]
    targets = {_INSERT.match(s)[1].replace("`", "").lower() for s in inserts}
    often = [name for name, n in Counter(x for names in read for x in names).items() if n > 1 and name.lower() not in targets]
    views = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    kept: list[tuple[str, DataFrame, DataFrame]] = []
    try:
        for name in often:
            whole = spark.table(name)
            if whole.isStreaming:
                continue
            readers = [_query(s) for s, names in zip(inserts, read) if name in names]
            wanted = set().union(*[_scanned(_sql(spark, q, args)) for q in readers])
            columns = [c for c in whole.columns if c.lower() in wanted] or whole.columns[:1]
            narrow = whole.select(*[F.col(f"`{c.replace('`', '``')}`") for c in columns])
            narrow.createOrReplaceTempView(name)
            kept.append((name, whole, narrow))
            try:
                for q in readers:
                    _sql(spark, q, args)
            except AnalysisException:  # a subquery needs other columns
                kept[-1] = (name, whole, whole)
                whole.createOrReplaceTempView(name)
            kept[-1][2].persist(StorageLevel.MEMORY_AND_DISK)
        yield [name for name, _, _ in kept]
    finally:
        for name, whole, held in kept:
            held.unpersist()
            if name.lower() in views:
                whole.createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def start_script(
    spark: SparkSession,
    text: str,
    checkpoint: str,
    delimiter: str = ";",
    args: dict | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Run a script whose inserts may read streams, and return the started queries.

    All statements but inserts run at once, in order. A source is a stream where a query says ``FROM STREAM table``, or
    reads a view of such a query or of a ``readStream``. Inserts over tables run next. Then each table that inserts fill from
    streams gets one query, with a checkpoint of its own under ``checkpoint``, which adds their rows exactly once. Run
    the script again with the same checkpoint to go on; tables it creates should say ``IF NOT EXISTS``. A table that is
    filled from streams and from tables in one script is refused, as its readers would see the streams' rows only.
    """
    batch: list[tuple[str, str]] = []
    streams: dict[str, list[DataFrame]] = {}
    inserts = []
    for statement in split_statements(text, delimiter):
        target = _INSERT.match(statement)
        if target:
            inserts.append((target[1].replace("`", ""), statement))
        else:
            _run(spark, statement, args)
    for target, statement in inserts:
        rows = _sql(spark, _query(statement), args)
        if rows.isStreaming:
            streams.setdefault(target, []).append(_as_table(spark, rows, target, statement))
        else:
            batch.append((target, statement))
    if mixed := sorted({t.lower() for t, _ in batch} & {t.lower() for t in streams}):
        raise ValueError(f"tables are filled from streams and from tables: {', '.join(mixed)}")
    for _, statement in batch:
        _run(spark, statement, args)
    started = []
    for target, parts in streams.items():
        writer = reduce(DataFrame.unionByName, parts).writeStream.queryName(target).option("checkpointLocation", f"{checkpoint}/{target.lower()}")
        partitions = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
        writer = writer.partitionBy(*partitions) if partitions else writer
        started.append(writer.trigger(**(trigger or {"availableNow": True})).toTable(target))
    return started


def _as_table(spark: SparkSession, rows: DataFrame, target: str, statement: str) -> DataFrame:
    """The rows of an insert with the columns of its table: by place, or as its list of columns says."""
    fields = spark.table(target).schema.fields
    listed = _COLUMNS.match(statement[_INSERT.match(statement).end() :])
    names = [c.strip().strip("`").lower() for c in listed[1].split(",")] if listed else [f.name.lower() for f in fields]
    if len(names) != len(rows.columns):
        raise ValueError(f"an insert into {target} has {len(rows.columns)} columns, not {len(names)}")
    placed = rows.toDF(*[f"c{i}" for i in range(len(names))])
    cols = [(F.col(f"c{names.index(f.name.lower())}") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    return placed.select(*cols)


def _run(spark: SparkSession, statement: str, args: dict | None) -> None:
    _sql(spark, statement, args)


def _sql(spark: SparkSession, statement: str, args: dict | None) -> DataFrame:
    used = {k: v for k, v in (args or {}).items() if re.search(rf":{re.escape(k)}\b", statement)}
    return spark.sql(statement, args=used) if used else spark.sql(statement)
