"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> documents that are kept, with their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from shopledger.llm import golay, lines, packing, suffixes, toxicity
from shopledger.llm.common import table
from shopledger.session import tune


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; a document without an id is scored as itself."""
    tune(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(toxicity.remainder(F.col("doc_id"), 5) != 0))
    return toxicity.keep_clean(docs, model)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more characters stay in the document with the smallest id only."""
    tune(spark)
    return _counted(lines.without_repeated_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return golay.without_near_copies(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words, and passages of 400 bytes, that occur twice go at every place."""
    tune(spark)
    return _counted(suffixes.without_repeated_passages(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4,096 tokens, with their token ids."""
    tune(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), ids=True)
