"""Mixing sources to target weights, by hierarchical budgets.

The tree is domain, language, source. Each node's weight counts against its siblings. A
token budget goes down from the root: siblings share their parent's budget by weight,
and none gets more than its documents can fill in ``max_epochs`` passes. What a node
cannot fill goes to its siblings first; as a parent's capacity is the sum of its children's,
only what a whole family cannot fill reaches the relatives above.

A leaf reads its documents in epochs, each in the order of a hash of seed, epoch and id.
It takes whole epochs, then the shortest prefix of the next one that reaches its budget.
The end of that prefix is found by sums per hash bucket, so only the bucket in which it falls
is ordered row by row, and no window holds a leaf.

Everything is DataFrame operations. Shares are rounded down to whole tokens. Tokens times weights
must stay below 2**63.

Defined cases: a null domain, language or source is a node of its own, ``''``. A null or empty
text has no tokens; a leaf of only such texts is taken once if it has weight. Nodes of
weight 0 give nothing. Repeated rows are read as rows of one id. A null id is ordered as ``''``.
An empty table gives no rows. Extra columns are kept, but for those
named like the added ones. Names that start with an underscore are the operator's own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import WORD, stash, text_of

LEAF = ["_domain", "_lang", "_source"]
ROWS_PER_BUCKET = 1000
DOMAIN_SQL = (
    "CASE WHEN right(source, 1) IN ('0', '3', '6', '9') THEN 'web' "
    "WHEN right(source, 1) IN ('1', '4', '7') THEN 'books' ELSE 'forums' END"
)
WEIGHTS = {("web",): 5, ("books",): 3, ("forums",): 2}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def _weight(level: int, weights: dict[tuple[str, ...], int], langs: dict[str, int]) -> Column:
    """The weight of the node that a row's first ``level`` path columns name; 1 if unnamed."""
    path = F.concat_ws("\x1f", *LEAF[:level])
    named = {"\x1f".join(k): v for k, v in weights.items() if len(k) == level}
    other = F.lit(1)
    if level == 2 and langs:
        other = F.coalesce(F.create_map(*[F.lit(x) for kv in langs.items() for x in kv])[F.col("_lang")], other)
    if named:
        other = F.coalesce(F.create_map(*[F.lit(x) for kv in named.items() for x in kv])[path], other)
    return other.cast("long")


def _share(nodes: DataFrame, parent: list[str], own: str) -> DataFrame:
    """Split ``budget`` of each parent among its children by weight, up to their ``cap``."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("cap") / F.col("weight"), own)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.col("cap") * F.sum("weight").over(rest) <= (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) * F.col("weight")
    marked = nodes.withColumn("full", full)
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)
    weight_left = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family)
    split = marked.withColumn("_left", left).withColumn("_weight_left", weight_left)
    return split.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(_left * weight) div _weight_left"))).drop("full", "_left", "_weight_left")


def leaf_budgets(leaves: DataFrame, budget: int, weights: dict, langs: dict, max_epochs: int) -> DataFrame:
    """Leaf rows (domain, lang, source, supply) with their ``weight`` and ``budget``."""
    usable = leaves.filter(F.least(*[_weight(k, weights, langs) for k in (1, 2, 3)]) > 0)
    caps = usable.withColumn("cap", F.col("supply") * max_epochs)
    levels = [caps.groupBy(*LEAF[:k]).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(k, weights, langs)) for k in (1, 2)]
    levels.append(caps.withColumn("weight", _weight(3, weights, langs)))
    total = F.least(F.lit(budget), F.sum("cap").over(Window.partitionBy(F.lit(0))))
    shared = _share(levels[0].withColumn("budget", total), [], LEAF[0])
    for k in (1, 2):
        above = shared.select(*LEAF[:k], "budget")
        shared = _share(levels[k].join(above, LEAF[:k]), LEAF[:k], LEAF[k])
    return shared


def mix(docs: DataFrame, budget: float, weights: dict[tuple[str, ...], int] = WEIGHTS, langs: dict[str, int] = LANG_WEIGHTS,
        domain: Column | None = None, seed: int = 17, max_epochs: int = 4) -> DataFrame:
    """Documents taken, once per epoch, with ``domain``, ``n_tokens``, ``epoch`` and ``leaf_budget``.

    ``budget`` up to 1.0 as a float is a part of all tokens, an int is tokens. ``weights`` names nodes
    by path, ``langs`` languages under any domain; unnamed nodes weigh 1.
    """
    domain = F.expr(DOMAIN_SQL) if domain is None else domain
    keyed = docs.withColumns({
        "_domain": F.coalesce(domain, F.lit("")),
        "_lang": F.coalesce(F.col("lang"), F.lit("")),
        "_source": F.coalesce(F.col("source"), F.lit("")),
        "_tokens": F.regexp_count(text_of(), F.lit(WORD)).cast("long"),
    })
    rows = stash(keyed.select("doc_id", *LEAF, "_tokens"), "mix-rows")
    leaves = stash(rows.groupBy(*LEAF).agg(F.sum("_tokens").alias("supply"), F.count("*").alias("n")), "mix-leaves")
    total = leaves.agg(F.sum("supply"), F.sum("n")).first()
    tokens = int(budget) if isinstance(budget, int) else int((total[0] or 0) * budget)
    plan = leaf_budgets(leaves, tokens, weights, langs, max_epochs)
    plan = plan.withColumn("_epochs", F.expr("if(supply = 0, 1, budget div supply)")).withColumn("_rest", F.expr("if(supply = 0, 0, budget % supply)"))
    plan = stash(plan.select(*LEAF, "supply", "budget", "_epochs", "_rest"), "mix-plan")

    order_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    digits = max(1, math.ceil(math.log((total[1] or 0) / ROWS_PER_BUCKET + 1, 16)))
    partly = rows.join(plan.filter("_rest > 0").select(*LEAF, "_epochs", "_rest"), LEAF).withColumn("_key", order_key)
    partly = partly.withColumn("_bucket", F.substring("_key", 1, digits))
    sums = partly.groupBy(*LEAF, "_bucket").agg(F.sum("_tokens").alias("tokens"), F.first("_rest").alias("_rest"))
    run = Window.partitionBy(*LEAF).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("end", F.sum("tokens").over(run)).withColumn("start", F.col("end") - F.col("tokens"))
    last = sums.filter("start < _rest and end >= _rest").select(*LEAF, "_bucket", "start")
    inside = Window.partitionBy(*LEAF).orderBy("_key", "doc_id", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = partly.join(last, [*LEAF, "_bucket"]).withColumn("at", F.col("start") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    place = F.struct(F.col("_key").alias("k"), F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("d"), F.col("_tokens").alias("t"))
    ends = edge.filter("at < _rest").groupBy(*LEAF).agg(F.max(place).alias("_end"))
    plan = stash(plan.join(ends, LEAF, "left"), "mix-ends")

    joined = keyed.join(plan, LEAF).withColumn("_key", order_key)
    copies = F.col("_epochs") + F.when(F.col("_end").isNotNull() & (place <= F.col("_end")), 1).otherwise(0)
    taken = joined.withColumn("_copies", copies.cast("int")).filter("_copies > 0")
    out = taken.withColumn("epoch", F.explode(F.expr("sequence(0, _copies - 1)")))
    kept = [f"`{c}`" for c in docs.columns if c not in ("domain", "n_tokens", "epoch", "leaf_budget")]
    return out.select(*kept, F.col("_domain").alias("domain"), F.col("_tokens").alias("n_tokens"), "epoch", F.col("budget").alias("leaf_budget"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed to six tenths of their tokens by the target weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs, 0.6).select("doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "n_tokens", "epoch", "leaf_budget")


def _share_sql(name: str, nodes: str, parent: str, own: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    keys = f"{parent}, {own}" if parent else own
    return f"""
{name}_m AS (SELECT *, cap * sum(weight) OVER ({by} ORDER BY cap / weight, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (budget - coalesce(sum(cap) OVER ({by} ORDER BY cap / weight, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full
  FROM ({nodes})),
{name} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE
    (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({by})) * weight // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}), 1) END AS budget
  FROM {name}_m)"""


ORACLE = (
    rf"""
WITH d AS (SELECT doc_id, {DOMAIN_SQL} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS supply FROM d GROUP BY ALL),
cap AS (SELECT *, supply * 4 AS cap FROM leaf),
dom AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END AS weight FROM cap GROUP BY domain),
lan AS (SELECT domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight FROM cap GROUP BY domain, lang),"""
    + _share_sql("b1", "SELECT *, least((SELECT floor(sum(supply)::DOUBLE * 0.6)::HUGEINT FROM leaf), (SELECT sum(cap) FROM cap)) AS budget FROM dom", "", "domain")
    + ","
    + _share_sql("b2", "SELECT lan.*, b1.budget FROM lan JOIN b1 USING (domain)", "domain", "lang")
    + ","
    + _share_sql("b3", "SELECT cap.*, 1 AS weight, b2.budget FROM cap JOIN b2 USING (domain, lang)", "domain, lang", "source")
    + """,
p AS (SELECT b3.*, supply, CASE WHEN supply = 0 THEN 1 ELSE budget // supply END AS full_epochs,
    CASE WHEN supply = 0 THEN 0 ELSE budget % supply END AS rest FROM b3 JOIN leaf USING (domain, lang, source)),
o AS (SELECT d.*, budget, full_epochs, rest, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('17:' || full_epochs || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p USING (domain, lang, source)),
c AS (SELECT *, full_epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS copies FROM o)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, unnest(range(0, copies::BIGINT))::INTEGER AS epoch, budget::BIGINT AS leaf_budget FROM c WHERE copies > 0"""
)
