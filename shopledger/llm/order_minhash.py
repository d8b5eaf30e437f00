"""Order MinHash: signatures sensitive to edit distance.

A text's k-mers (k code points) are numbered by occurrence, so that the second time a k-mer comes
it is another element. Each of the COMPONENTS hash functions picks the TUPLE elements with the
smallest values, puts them back in text order and hashes the tuple. Two texts agree in a component
if the same elements are smallest in both and stand in the same order. The fingerprint is the
tuple hashes in hexadecimal; likeness is the share of equal components.

Defined results: a null text is an empty text; the empty text has a fingerprint of zeros and
likeness 1 to itself; a text shorter than k is one k-mer; equal texts have equal fingerprints.
`with_next` puts rows in the order (doc_id, text), nulls first; the row after the last is the
first, so a single row is next to itself; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, texts

K = 10
COMPONENTS = 64
TUPLE = 2
COLUMNS = 4_096  # elements handled at a time, so that the work stays in the cache
BLOCK_ROWS = 1_024
MOST_BLOCKS = 100_000

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 32, COMPONENTS, dtype=np.uint32) | np.uint32(1)
_ROWS = np.arange(COMPONENTS)
_MOST = np.uint32(0xFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def elements(text: str) -> np.ndarray:
    """A 64-bit hash of (k-mer, occurrence number) at every position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(points) - K + 1, 1)
    hashes = np.zeros(n, np.uint64)
    for i in range(min(K, len(points))):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + points[i : i + n] + np.uint64(1)
    hashes = mixed(hashes)
    # sort (high hash bits, position): equal k-mers stand together, in text order
    bits = np.uint64(max(int(n - 1).bit_length(), 1))
    places = (np.uint64(1) << bits) - np.uint64(1)
    order = np.sort((hashes & ~places) | np.arange(n, dtype=np.uint64))
    kmer, place = order >> bits, (order & places).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = kmer[1:] != kmer[:-1]
    index = np.arange(n)
    times = np.empty(n, np.uint64)
    times[place] = (index - np.maximum.accumulate(np.where(new, index, 0))).astype(np.uint64)
    return mixed(hashes + times * np.uint64(0xD1B54A32D192ED03))


def signature(text: str) -> np.ndarray:
    """COMPONENTS tuple hashes (32 bits)."""
    if not text:
        return np.zeros(COMPONENTS, np.uint32)
    base = elements(text)
    short = (base >> np.uint64(32)).astype(np.uint32)
    values, places = [], []
    for i in range(0, len(short), COLUMNS):
        x = short[i : i + COLUMNS][None, :] * _FACTORS[:, None]
        for _ in range(min(TUPLE, x.shape[1])):
            at = x.argmin(1)
            values.append(x[_ROWS, at])
            places.append(at + i)
            x[_ROWS, at] = _MOST
    v, p = np.array(values, np.uint64), np.array(places, np.uint64)
    # smallest values first, and the earlier place of equal values
    first = np.sort((v << np.uint64(32)) | p, axis=0)[:TUPLE] & np.uint64(0xFFFFFFFF)
    out = np.full(COMPONENTS, len(first), np.uint64)
    for row in np.sort(first, axis=0):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + base[row.astype(np.int64)])
    return (out >> np.uint64(32)).astype(np.uint32)


def as_text(signature_: np.ndarray) -> str:
    return signature_.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""

    def sign(batches):
        for batch in batches:
            out = [as_text(signature(t)) for t in texts(batch)]
            yield arrow_rows({"doc_id": (pa.int64(), batch.column("doc_id").to_pylist()), "fingerprint": (pa.string(), out)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, "doc_id long, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """block, last, doc_id, text: consecutive blocks of the documents in order, sorted in their partitions.

    Each block ends with a copy of the row that follows it (last = 1); of several the first counts.
    Texts are shuffled once.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = kept.count()
    blocks = max(1, min(math.ceil(n / BLOCK_ROWS), MOST_BLOCKS))
    marks = [i / blocks for i in range(1, blocks)] or [0.5]
    found = kept.agg(
        F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls"),
        F.percentile_approx("doc_id", marks, max(10_000, 4 * blocks)).alias("marks"),
    ).collect()[0]
    low = found["low"] if found["low"] is not None else 0
    # these are ids that occur, so the first row of a block is one with the block's mark
    starts = np.array(sorted({low, *(found["marks"] or [])} if blocks > 1 else {low}), np.int64)
    nulls, last = bool(found["nulls"]), len(starts) - 1
    shared = docs.sparkSession.sparkContext.broadcast(starts)

    @F.pandas_udf("long")
    def where(ids: pd.Series) -> pd.Series:  # 2 * block + (1 if its first row can have this id)
        known = ids.notna()
        values = ids.fillna(low).to_numpy(np.int64)
        block = np.maximum(np.searchsorted(shared.value, values, side="right") - 1, 0)
        first = (shared.value[block] == values) & known
        if nulls:  # rows without an id come first of all
            first = np.where(known, first & (block > 0), True)
        return pd.Series(2 * block + first)

    code = F.col("code")
    before = F.when(code < 2, F.lit(last)).otherwise(F.floor(code / 2) - 1)
    own = F.struct(F.floor(code / 2).alias("block"), F.lit(0).alias("last"))
    copy = F.struct(before.alias("block"), F.lit(1).alias("last"))
    return (
        kept.withColumn("code", where("doc_id"))
        .select(F.explode(F.when(code % 2 == 1, F.array(own, copy)).otherwise(F.array(own))).alias("at"), "doc_id", "text")
        .select("at.block", "at.last", "doc_id", "text")
        .repartition("block")
        .sortWithinPartitions("block", "last", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    In the edited text the last half (rounded down) is replaced by the start of the next document.
    """

    def pairs(rows):
        held = None  # block, id, text, signature: one row waits for the one after it
        for batch in rows:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("block", "last", "doc_id"))
            for block, last, doc_id, text in zip(*columns, texts(batch)):
                here = None
                if held and held[0] == block:
                    here = signature(text)
                    _, own_id, own, sign = held
                    n = len(own)
                    edited = own[: n - n // 2] + text[: n // 2]
                    other = signature(edited)
                    out.append((own_id, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(sign), as_text(other), likeness(sign, other), likeness(sign, here)))
                if last:
                    held = None
                else:
                    held = (block, doc_id, text, signature(text) if here is None else here)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [c.split()[0] for c in COMPARED.split(", ")]
            yield arrow_rows({c: (k, [o[i] for o in out]) for i, (c, k) in enumerate(zip(names, kinds))})

    return in_order(docs).select("block", "last", "doc_id", "text").mapInArrow(pairs, COMPARED)
