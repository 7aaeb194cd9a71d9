"""The stages of the corpus pipeline: operators with their decisions put into effect.

A stage takes and returns the columns of ``documents`` (the last one returns pieces). Extra columns stay as they
are, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import jaccard, mixing, packing, repeats, rules
from tideline.llm.common import IdFilter, stash

#: The part of all tokens that the mix takes.
MIX_PART = 0.8
OWN = ["doc_id", "text", "lang", "source", "n_chars"]


def keeps_columns(stage: Callable) -> Callable:
    """Gives the stage extra columns under names that clash with none of an operator's."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = docs.toDF(*[c if c in OWN else f"_extra{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, inner, sf_dir).toDF(*docs.columns)

    return run


@keeps_columns
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the quality classifier predicts as label 0."""
    model = rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.score_documents(docs, model).filter("predicted = 1").select(*docs.columns)


@keeps_columns
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies, and one of its repeated rows.

    Rows of one id with different texts are decided each by its own text. Rows with a null id stay: nothing tells which of a group they would be. Only rows that a filter of
    bounded size can't clear are moved for the decision.
    """
    links = stash(jaccard.linked_classes(docs).filter("doc_id is not null"), "links")
    gone = stash(links.filter("component_id <> doc_id").select("doc_id", F.col("cls").alias("_class")).distinct(), "gone")
    several = links.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    wanted = IdFilter(gone.select("doc_id").union(several))
    in_doubt = F.coalesce(F.col("doc_id").isNotNull() & wanted.column(), F.lit(False))
    doubtful = jaccard.with_class(docs, wanted).join(gone, ["doc_id", "_class"], "left_anti")
    return docs.filter(~in_doubt).unionByName(doubtful.dropDuplicates(["doc_id", "text"]).drop("_class")).select(*docs.columns)


@keeps_columns
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages; a character of which only some bytes went goes whole. ``n_chars`` follows the text.

    Documents of which nothing is left go; those that were empty before stay.
    """
    cut = repeats.remove_repeats(docs).filter("n_removed < n_bytes or n_bytes = 0 or n_bytes is null")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = cut.withColumn("_text", text).withColumn("text", F.col("_text"))
    return changed.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


@keeps_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes ``MIX_PART`` of the tokens by the target weights, in one epoch, so ids stay unique."""
    return mixing.mix(docs, MIX_PART, max_epochs=1).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack_documents(docs)
