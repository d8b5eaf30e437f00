"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, suffix-array dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopledger.llm import stages
from shopledger.llm.common import written

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line dedup", stages.drop_repeated_lines),
    ("SimHash near-dedup", stages.drop_near_copies),
    ("suffix-array dedup", stages.drop_repeated_passages),
    ("packing", stages.pack),
]

# A learned score decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
