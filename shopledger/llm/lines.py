"""Repeated lines dropped by probing a sharded minimal perfect hash.

A line's key is hashed to 128 bits. The distinct hashes are dealt to shards of about SHARD_KEYS
keys, and every shard gets a minimal perfect hash, built level by level (a key that is alone on its
bit of a level stays there, the others go on to the next level; the rank of its bit is its place),
with an array of 64-bit fingerprints. Documents never join with lines: their key hashes go to the
shard and stream past it twice. The first time they fill an array of document counts and one of
owners, the smallest doc_id of each key; the second time these arrays say which lines are lost.
A shard with many probes, such as those of one very common line, is copied to several tasks by the
measured counts, and what the copies counted is added up in two steps.

Defined results: a null or empty text is one empty line; rows with the same doc_id are one document,
null ids together the one after all others; a repeated row is treated like its twin; an empty
table gives no rows; other columns are not looked at (in the query) or kept (in the pipeline).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.common import arrow_rows, on_own_columns, texts, written

BLANK = b" \t\n\x0b\x0c\r"
LEAST = 10  # code points of a key that counts
SHARD_KEYS = 1 << 16
SHARD_PROBES = 1 << 18  # probes of a shard before it is copied
MOST_COPIED = 10_000  # shards that can be copied, at most (those with the most probes)
COPIES_ADDED = 128  # copies of a shard whose counts are added up in the first step
NO_ID = (1 << 63) - 1


def keys_of(text: str) -> dict[bytes, list[int]]:
    """Line numbers by 16-byte key hash, of the keys that are long enough."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate(text.encode().split(b"\n")):
        key = line.strip(BLANK).lower()  # bytes: only A-Z change
        if len(key) >= LEAST and (len(key) >= 4 * LEAST or len(key.decode()) >= LEAST):
            found.setdefault(xxhash.xxh3_128_digest(key), []).append(number)
    return found


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    x = (x + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """Places 0..n-1 for n distinct (high, low) keys; any other key gets some place or none."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # one bit array a level, as bools
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits) - 1 + before)
            before += int(bits.sum())

    @staticmethod
    def _at(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(high ^ _mixed(low, level), level) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> "PerfectHash":
        levels = []
        while len(high):
            size = max(2 * len(high), 2)
            at = cls._at(high, low, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            stay = ~alone[at]
            high, low = high[stay], low[stay]
        return cls(levels)

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each key; -1 where no level has it."""
        out = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, bits in enumerate(self.levels):
            at = self._at(high[left], low[left], level, len(bits))
            here = bits[at]
            out[left[here]] = self.ranks[level][at[here]]
            left = left[~here]
            if not len(left):
                break
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(b) for b in self.levels], "<i8").tobytes()
        return len(self.levels).to_bytes(4, "little") + sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        n = int.from_bytes(data[:4], "little")
        sizes, at, levels = np.frombuffer(data, "<i8", n, 4), 4 + 8 * n, []
        for size in sizes.tolist():
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def _identified(docs: DataFrame) -> DataFrame:
    """docs with the number and the row hash by which decisions find back to a row."""
    return docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("__row", F.xxhash64("doc_id", "text"))


def _keys(docs: DataFrame) -> DataFrame:
    """id, row, high, low, lines: a row for each key of each document."""

    def split(batches):
        for batch in batches:
            rows = []
            for i, row, text in zip(batch.column("__id").to_pylist(), batch.column("__row").to_pylist(), texts(batch)):
                rows += [(i, row, key, numbers) for key, numbers in keys_of(text).items()]
            halves = np.frombuffer(b"".join(r[2] for r in rows), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                names=["id", "row", "high", "low", "lines"],
            )

    return docs.select("__id", "__row", "text").mapInArrow(split, "id long, row long, high long, low long, lines array<int>")


def _index(distinct: DataFrame, shard: Column) -> DataFrame:
    """shard, hash, prints of the distinct keys: one row a shard."""

    def build(batches):
        parts, now = [], None

        def row():
            high, low = (np.concatenate(c).view(np.uint64) for c in zip(*parts))
            made = PerfectHash.build(high, low)
            prints = np.empty(len(high), "<u8")
            prints[made.places(high, low)] = low
            return arrow_rows({
                "shard": (pa.int64(), [now]), "hash": (pa.binary(), [made.to_bytes()]), "prints": (pa.binary(), [prints.tobytes()]),
            })

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("high", "low")]
            for number, a, b in _stretches(batch.column("shard").to_numpy()):
                if now is not None and number != now:
                    yield row()
                    parts = []
                now = number
                parts.append([c[a:b] for c in columns])
        if parts:
            yield row()

    return (
        distinct.repartition(shard).select(shard.alias("shard"), "high", "low").sortWithinPartitions("shard")
        .mapInArrow(build, "shard long, hash binary, prints binary")
    )


def _stretches(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of every stretch of equal values."""
    bounds = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])).tolist() if len(values) else []
    return [(int(values[a]), a, b) for a, b in zip(bounds[:-1], bounds[1:])]


ARRAYS = {"hash": "binary", "prints": "binary", "counts": "binary", "owners": "binary"}
PROBE = {"high": "long", "low": "long", "id": "long", "row": "long", "lines": "array<int>"}


def _past(arrays: DataFrame, keys: DataFrame, shard: Column, copies: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of both kinds by shard and copy, the arrays of each (kind 0) before its probes."""
    nulls = lambda kinds: [F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    held = {c: t for c, t in ARRAYS.items() if c in arrays.columns}
    asked = {c: t for c, t in PROBE.items() if c in columns}
    copied = (
        arrays.join(copies, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
        .select("shard", "copy", F.lit(0).alias("kind"), *held, *nulls(asked))
    )
    probes = (
        keys.withColumn("shard", shard).join(copies, "shard", "left")
        .select("shard", F.pmod(F.col("row"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy"), F.lit(1).alias("kind"), *nulls(held), *asked)
    )
    return copied.union(probes).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")


def _cells(batches):
    """(shard, copy, arrays, probes): a stretch of probes with the arrays of its cell, which come with probes None first."""
    now = None
    for batch in batches:
        copy, kind = batch.column("copy").to_numpy(), batch.column("kind").to_numpy()
        for shard, a, b in _stretches(batch.column("shard").to_numpy()):
            for number, c, d in _stretches(copy[a:b]):
                first = a + c + int((kind[a + c : a + d] == 0).sum())
                if first > a + c:
                    get = {n: batch.column(n)[a + c].as_py() for n in ARRAYS if n in batch.schema.names}
                    now = PerfectHash.from_bytes(get["hash"]), np.frombuffer(get["prints"], "<u8"), get
                    yield shard, number, now, None
                if first < a + d:
                    yield shard, number, now, batch.slice(first, a + d - first)


def _placed(arrays, probes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the probes, and whether the fingerprint there is theirs."""
    made, prints, _ = arrays
    high, low = (probes.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
    at = made.places(high, low)
    return at, (at >= 0) & (prints[at] == low)


def _count_row(shard: int, copy: int, counts: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
    return arrow_rows({
        "shard": (pa.int64(), [shard]), "copy": (pa.int32(), [copy]),
        "counts": (pa.binary(), [counts.tobytes()]), "owners": (pa.binary(), [owners.tobytes()]),
    })


COUNTED = "shard long, copy int, counts binary, owners binary"


def _count(batches):
    """Counts and owners of one copy's probes."""
    cell = counts = owners = None
    for shard, copy, arrays, probes in _cells(batches):
        if probes is None:
            if cell is not None:
                yield _count_row(*cell, counts, owners)
            n = len(arrays[1])
            cell, counts, owners = (shard, copy), np.zeros(n, "<u4"), np.full(n, NO_ID, "<i8")
            continue
        at, member = _placed(arrays, probes)
        np.minimum.at(owners, at[member], probes.column("id").to_numpy()[member])
        more = np.bincount(at[member], minlength=len(counts)) + counts
        counts = np.minimum(more, 0xFFFFFFFF).astype("<u4")
    if cell is not None:
        yield _count_row(*cell, counts, owners)


def _added_up(counted: DataFrame, copy: Column) -> DataFrame:
    """Counts added and owners compared over the rows of a shard with one value of copy; two rows are held at a time."""

    def add(batches):
        cell = counts = owners = None
        for batch in batches:
            for i, key in enumerate(zip(batch.column("shard").to_pylist(), batch.column("copy").to_pylist())):
                more = np.frombuffer(batch.column("counts")[i].as_py(), "<u4")
                other = np.frombuffer(batch.column("owners")[i].as_py(), "<i8")
                if key != cell:
                    if cell is not None:
                        yield _count_row(*cell, counts, owners)
                    cell, counts, owners = key, more, other
                else:
                    counts = np.minimum(counts.astype("<u8") + more, 0xFFFFFFFF).astype("<u4")
                    owners = np.minimum(owners, other)
        if cell is not None:
            yield _count_row(*cell, counts, owners)

    return counted.withColumn("copy", copy.cast("int")).repartition("shard", "copy").sortWithinPartitions("shard", "copy").mapInArrow(add, COUNTED)


def _lose(batches):
    """Probes whose key two documents have and whose document is not its owner."""
    for _, _, arrays, probes in _cells(batches):
        if probes is None:
            counts, owners = np.frombuffer(arrays[2]["counts"], "<u4"), np.frombuffer(arrays[2]["owners"], "<i8")
            continue
        at, member = _placed(arrays, probes)
        # Rows of one doc_id count apart, but then the owner is that document itself.
        lost = member & (counts[at] > 1) & (owners[at] != probes.column("id").to_numpy())
        if lost.any():
            kept = [probes.column(c) for c in ("id", "row", "lines")]
            yield pa.RecordBatch.from_arrays(kept, names=["__id", "__row", "lines"]).filter(pa.array(lost))


def _drops(docs: DataFrame, shard_keys: int, shard_probes: int) -> DataFrame:
    """__id, __row, __drop: the line numbers each document loses."""
    spark = docs.sparkSession
    keys = written(_keys(docs), "line-keys")
    distinct = written(keys.select("high", "low").distinct(), "line-distinct")
    shard = F.pmod(F.col("high"), F.lit(max(1, math.ceil(distinct.count() / shard_keys))))
    index = written(_index(distinct, shard), "line-index")
    loads = keys.groupBy(shard.alias("shard")).agg(F.count("*").alias("load"))
    # at most MOST_COPIED rows: their loads are above that share of the total
    most = max(shard_probes, keys.count() // MOST_COPIED)
    busy = loads.filter(F.col("load") > most).select("shard", F.ceil(F.col("load") / most).cast("int").alias("copies")).collect()
    copies = F.broadcast(spark.createDataFrame([tuple(r) for r in busy], T.StructType([T.StructField("shard", T.LongType()), T.StructField("copies", T.IntegerType())])))
    counted = _past(index, keys, shard, copies, ["high", "low", "id"]).mapInArrow(_count, COUNTED)
    counted = _added_up(_added_up(counted, F.floor(F.col("copy") / COPIES_ADDED)), F.lit(0)).drop("copy")
    filled = written(index.join(counted, "shard"), "line-counts")
    return (
        _past(filled, keys, shard, copies, list(PROBE)).mapInArrow(_lose, "__id long, __row long, lines array<int>")
        .groupBy("__id", "__row").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("__drop"))
    )


def _decided(docs: DataFrame, shard_keys: int, shard_probes: int) -> DataFrame:
    own = _identified(docs)
    return own.join(_drops(own, shard_keys, shard_probes), ["__id", "__row"], "left")


def kept_lines(text: str, drop) -> tuple[list[str], int]:
    lines = text.split("\n")
    if drop is None or not len(drop):
        return lines, 0
    lost = set(drop)
    return [x for i, x in enumerate(lines) if i not in lost], len(lost)


def line_digests(docs: DataFrame, *, shard_keys: int = SHARD_KEYS, shard_probes: int = SHARD_PROBES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""

    def digest(batches):
        for batch in batches:
            lines, dropped, sums = [], [], []
            for text, drop in zip(texts(batch), batch.column("__drop").to_pylist()):
                kept, n = kept_lines(text, drop)
                lines.append(len(kept) + n)
                dropped.append(n)
                sums.append(hashlib.sha256("\n".join(kept).encode()).hexdigest())
            yield arrow_rows({
                "doc_id": (pa.int64(), batch.column("doc_id").to_pylist()), "n_lines": (pa.int64(), lines),
                "n_dropped": (pa.int64(), dropped), "kept_sha256": (pa.string(), sums),
            })

    return (
        _decided(docs.select("doc_id", "text"), shard_keys, shard_probes).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "__drop")
        .mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
    )


def without_repeated_lines(docs: DataFrame, *, shard_keys: int = SHARD_KEYS, shard_probes: int = SHARD_PROBES) -> DataFrame:
    """docs with the lines taken out of `text`; all other columns stay."""
    return on_own_columns(lambda own: _repeated_lines_out(own, shard_keys, shard_probes), docs)


def _repeated_lines_out(docs: DataFrame, shard_keys: int, shard_probes: int) -> DataFrame:
    @F.pandas_udf("string")
    def kept(text: pd.Series, drop: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(kept_lines(t, d)[0]) for t, d in zip(text, drop)], dtype=object)

    decided = _decided(docs, shard_keys, shard_probes)
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(kept(F.coalesce("text", F.lit("")), F.coalesce("__drop", F.array().cast("array<int>"))))
    return decided.withColumn("text", text).select(*docs.columns)
