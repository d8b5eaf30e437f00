"""Reading tables, scratch tables in the shared folder, and Arrow helpers of the operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.session import written  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def on_own_columns(work: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
    """work on (doc_id, text, others): all other columns lie in one struct meanwhile, so no name of theirs can clash."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(others)]) if others else F.lit(None).cast("string")
    done = work(docs.select("doc_id", "text", held.alias("others")))
    back = {c: F.col(f"others.c{i}").alias(c) for i, c in enumerate(others)}
    return done.select(*[back.get(c, F.col(c)) for c in docs.columns])


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as decimal text, modulo by; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def crc(key) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode())


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts, null as the empty text."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def arrow_rows(columns: dict[str, tuple[pa.DataType, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for kind, values in columns.values()], names=list(columns)
    )
