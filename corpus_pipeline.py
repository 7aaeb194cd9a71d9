"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes all rows that its predecessor kept, and all but the last return the columns of
documents. Between stages rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import stages
from tideline.llm.common import stash

STAGES = [
    ("quality", stages.keep_good),
    ("near_duplicates", stages.keep_one_of_each),
    ("repeats", stages.cut_repeats),
    ("mix", stages.mix_sources),
    ("pack", stages.pack),
]

#: Trained scores, byte-level cuts and tokenization are not SQL; tests check the effects of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
