"""Repeated passages found by a run-length compressed Burrows-Wheeler index.

A string of WIDTH bytes is repeated if it starts at two places anywhere, and every byte of a repeated
string is marked. Documents are never compared with documents:

1. Every window of WIDTH bytes has an anchor: the K bytes in it with the smallest hash. Equal
   windows have equal anchors at equal distance, so windows only need to be compared within an anchor.
   A run of windows with one anchor place is a snippet. Anchors that occur once in all texts have
   nothing repeated and go.
2. Equal snippets (same anchor, same bytes, a class) are stored once; a class with two members is
   repeated all over. Only one member of each class goes on, and only if its anchor has other classes.
3. Classes are dealt out by anchor to buckets of bounded size. A bucket's snippets are joined,
   sorted into a suffix array and turned into a Burrows-Wheeler transform of runs. At the ends of runs
   the text place and the match length to the neighbouring suffix are sampled, and from these samples
   the matching statistics of all places are streamed: one place further, a match is one byte
   shorter, unless a sample says otherwise. Windows whose statistic is WIDTH or more are marked.
4. An anchor with very many classes is not gathered: its snippets are cut into shorter runs of
   windows, whose common bytes become the new, finer anchor, down to single windows, where all
   members of an anchor are equal and step 2 decides.

The text is a string of units: bytes for op8, and in the pipeline's stage once bytes and once words (8 bytes of
hash each), so that passages of more than 50 words count whatever their length in bytes is. Words are
what ASCII white space separates; which white space it is does not matter.

Defined results: a null text is an empty text; texts shorter than WIDTH keep all; a row and its exact
twin (same id and text) are two documents; what remains of a split code point is left out of a cut
text (the digests are of the bytes); an empty table gives no rows; extra columns are kept by
`without_repeated_passages` and not looked at otherwise.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, on_own_columns, texts, written

WIDTH = 400
K = 128
BUCKET_BYTES = 1 << 19
HOT_BYTES = 1 << 20  # snippets of one anchor beyond which it is cut up
RUNS = (32, 4, 1)  # windows of the finer runs
NO_ID = (1 << 63) - 1
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


@dataclass(frozen=True)
class Units:
    """What a text is a string of: units of `size` bytes, the repeated width and the anchor's width in units."""

    size: int
    width: int
    k: int

    def encode(self, text: str) -> bytes:
        data = text.encode()
        if self.size == 1:
            return data
        return np.array([xxhash.xxh3_64_intdigest(w) for w in data.split()], np.uint64).tobytes()

    def codes(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.uint8 if self.size == 1 else np.uint64)

    def cut(self, data: bytes, start: int, stop: int) -> bytes:
        return data[start * self.size : stop * self.size]


BYTES, WORDS = Units(1, WIDTH, K), Units(8, 51, 16)


class Powers:
    """Powers of the rolling hash's factor and of its inverse, as far as asked."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _FACTOR, np.uint64))])
            self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _INVERSE, np.uint64))])
        return self.up[:n], self.down[:n]


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values: of a block's rest and the next block's start."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    starts = np.minimum.accumulate(grid, axis=1).ravel()
    rests = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rests[: n - width + 1], starts[width - 1 : n])


def snippets(data: bytes, powers: Powers, units: Units = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor hash, anchor place, first window, last window of every snippet."""
    codes, k = units.codes(data), units.k
    n = len(codes)
    up, down = powers.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    # smallest upper half first, then the leftmost place: only the window's own bytes decide
    ordered = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - k + 1, dtype=np.uint64)
    places = (window_minima(ordered, units.width - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    last = np.append(first[1:], len(places)) - 1
    at = places[first]
    return hashes[at].view(np.int64), at, first, last


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("__row", F.xxhash64("doc_id", "text"))


OCCURRENCE = "anchor long, class long, id long, row long, first long, last long, at long"


def _occurrences(own: DataFrame, units: Units) -> DataFrame:
    """A row for every snippet of every document."""

    def find(batches):
        powers = Powers()
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for i, row, text in zip(batch.column("__id").to_pylist(), batch.column("__row").to_pylist(), texts(batch)):
                data = units.encode(text)
                if len(data) < units.width * units.size:
                    continue
                anchors, at, first, last = snippets(data, powers, units)
                lows, highs = first.tolist(), last.tolist()
                classes = [xxhash.xxh3_64_intdigest(units.cut(data, a, b + units.width), p - a) for p, a, b in zip(at.tolist(), lows, highs)]
                for column, values in zip(columns, (anchors, np.array(classes, np.uint64).view(np.int64), np.full(len(at), i), np.full(len(at), row), first, last, at - first)):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in columns], names=["anchor", "class", "id", "row", "first", "last", "at"]
            )

    return own.select("__id", "__row", "text").mapInArrow(find, OCCURRENCE)


def packed_symbols(text: np.ndarray) -> tuple[int, int]:
    """Bits of a symbol, and how many symbols one key holds: seven for bytes."""
    bits = max(int(text.max()).bit_length(), 9)
    return bits, 63 // bits


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, by doubling from the symbols of one key on, and the ranks of each doubling."""
    n, (bits, step) = len(text), packed_symbols(text)
    wide = np.zeros(n + step, np.int64)
    wide[:n] = text
    keys = np.zeros(n, np.int64)
    for i in range(step):
        keys = (keys << bits) | wide[i : i + n]
    ranks = []
    while True:
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.concatenate([[0], (sorted_keys[1:] != sorted_keys[:-1]).cumsum()])
        rank = np.empty(n, np.int64)
        rank[order] = new + 1
        ranks.append(rank)
        if new[-1] == n - 1:
            return order, ranks
        follow = np.zeros(n, np.int64)
        follow[: max(n - step, 0)] = rank[step:]
        keys = rank * (n + 1) + follow
        step *= 2


def match_lengths(a: np.ndarray, b: np.ndarray, text: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Common symbols of the suffixes at a and b: whole doublings first, single symbols at the end."""
    n, packed = len(text), packed_symbols(text)[1]
    a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in reversed(range(len(ranks))):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        step = np.where(same, packed << level, 0)
        a, b, length = a + step, b + step, length + step
    for _ in range(packed - 1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = text[a[inside]] == text[b[inside]]
        a, b, length = a + same, b + same, length + same
    return length


class RunIndex:
    """Runs of the transform (symbol, length) with the text place and match length sampled at their ends."""

    def __init__(self, text: np.ndarray):
        order, ranks = suffix_array(text)
        before = text[order - 1]  # the symbol before each suffix; the first suffix's is the last symbol
        before[order == 0] = -1
        edge = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.size = len(text)
        self.symbols, self.lengths = before[edge], np.diff(np.append(edge, len(text)))
        ends = np.append(edge[1:], len(text)) - 1
        # a run's first suffix against the one above it, its last against the one below it
        self.first, self.last = order[edge], order[ends]
        self.first_match, self.last_match = np.zeros(len(edge), np.int64), np.zeros(len(edge), np.int64)
        self.first_match[1:] = match_lengths(order[edge[1:]], order[edge[1:] - 1], text, ranks)
        self.last_match[:-1] = match_lengths(order[ends[:-1]], order[ends[:-1] + 1], text, ranks)

    def statistics(self) -> np.ndarray:
        """At every place the longest match that starts elsewhere, streamed from the samples."""
        reach = np.zeros(self.size, np.int64)  # place + match: stays the same inside a run
        np.maximum.at(reach, self.first, self.first + self.first_match)
        np.maximum.at(reach, self.last, self.last + self.last_match)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.size), 0)


def repeated_windows(parts: list[bytes], units: Units = BYTES) -> list[np.ndarray]:
    """For each snippet, the numbers of its windows that occur elsewhere in the snippets."""
    lengths = np.array([len(p) // units.size for p in parts])
    codes = units.codes(b"".join(parts))
    if units.size > 1:
        codes = np.unique(codes, return_inverse=True)[1]
    starts = np.cumsum(lengths + 1) - lengths - 1
    inside = np.ones(len(codes) + len(parts), bool)
    inside[starts + lengths] = False
    joined = np.zeros(len(inside), np.int64)  # 0 is a symbol of its own between snippets
    joined[inside] = codes.astype(np.int64) + 1
    statistics = RunIndex(joined).statistics()
    return [np.flatnonzero(statistics[s : s + n - units.width + 1] >= units.width) for s, n in zip(starts, lengths)]


def ranges(numbers: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each stretch of consecutive numbers."""
    if not len(numbers):
        return []
    breaks = np.flatnonzero(np.diff(numbers) > 1)
    return list(zip(numbers[np.concatenate([[0], breaks + 1])].tolist(), numbers[np.append(breaks, len(numbers) - 1)].tolist()))


SNIPPET = "anchor long, class long, members long, id long, row long, first long, at long, data binary"
SPAN = "__id long, __row long, start long, stop long"


def _snippet_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array([r[i] for r in rows], pa.int64()) for i in range(7)), pa.array([r[7] for r in rows], pa.binary())],
        names=[c.split()[0] for c in SNIPPET.split(", ")],
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer(data: bytes, at: int, anchor: int, run: int, units: Units = BYTES) -> list[tuple[int, int, int, bytes]]:
    """anchor, class, first window and bytes of the runs of a snippet whose anchor is at place `at`.

    A run holds windows whose distance to the anchor is in the same multiple of `run`. Its own
    anchor is what all windows of that multiple share, also those the snippet lacks, so that
    equal windows get equal anchors.
    """
    windows, start, out = len(data) // units.size - units.width + 1, 0, []
    while start < windows:
        multiple = (at - start) // run
        latest = at - multiple * run
        stop = min(latest, windows - 1)
        common = units.cut(data, latest, latest - run + 1 + units.width)
        part = units.cut(data, start, stop + units.width)
        seed = (anchor ^ multiple) & (1 << 63) - 1
        out.append((_signed(xxhash.xxh3_64_intdigest(common, seed)), _signed(xxhash.xxh3_64_intdigest(part, at - start)), start, part))
        start = stop + 1
    return out


def _cut_finer(rows: DataFrame, run: int, units: Units) -> DataFrame:
    def cut(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for anchor, kind, start, part in finer(r["data"], r["at"], r["anchor"], run, units):
                    out.append((anchor, kind, r["members"], r["id"], r["row"], r["first"] + start, r["at"] - start, part))
            yield _snippet_batch(out)

    return rows.mapInArrow(cut, SNIPPET)


def _classes(rows: DataFrame, hot_bytes: int, units: Units) -> tuple[DataFrame, DataFrame]:
    """Spans of rows whose class has several members, and a member of each class whose anchor has other classes.

    rows: anchor, class, members, id, row, first, last, at. A class of one row keeps the row's
    members; rows that are known to be repeated (members > 1) give no span again.
    """
    kinds = rows.groupBy("anchor", "class").agg(
        F.count("*").alias("rows"), F.max("members").alias("members"), F.min(F.struct("id", "row", "first")).alias("place"),
        F.max(F.col("last") - F.col("first")).alias("more"), F.max("at").alias("at"),
    )
    kinds = written(kinds, "passage-classes")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("classes"), F.sum((F.col("more") + units.width) * units.size).alias("bytes"))
    # written, so that Spark can split the join on an anchor with very many classes
    groups = written(groups.filter("classes > 1"), "passage-groups")
    several = kinds.filter("rows > 1").select("anchor", "class")
    spans = (
        rows.filter("members = 1").join(several, ["anchor", "class"], "left_semi")
        .select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("first").alias("start"), (F.col("last") + units.width).alias("stop"))
    )
    chosen = (
        kinds.join(groups, "anchor")
        .select("anchor", "class", F.when(F.col("rows") > 1, 2).otherwise(F.col("members")).cast("long").alias("members"), "place.*", "more", "at", (F.col("bytes") > hot_bytes).alias("hot"))
    )
    return spans, chosen


def _fetched(own: DataFrame, chosen: DataFrame, units: Units) -> DataFrame:
    """The chosen snippets with their bytes, and hot."""
    wanted = chosen.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_list(F.struct("anchor", "class", "members", "first", "more", "at", "hot")).alias("wanted")
    )  # no more than the snippets of one document

    def fetch(batches):
        for batch in batches:
            out, hot = [], []
            for i, row, text, wanted in zip(batch.column("__id").to_pylist(), batch.column("__row").to_pylist(), texts(batch), batch.column("wanted").to_pylist()):
                data = units.encode(text)
                for w in wanted:
                    out.append((w["anchor"], w["class"], w["members"], i, row, w["first"], w["at"], units.cut(data, w["first"], w["first"] + w["more"] + units.width)))
                    hot.append(w["hot"])
            yield _snippet_batch(out).append_column("hot", pa.array(hot, pa.bool_()))

    return own.select("__id", "__row", "text").join(wanted, ["__id", "__row"]).mapInArrow(fetch, SNIPPET + ", hot boolean")


def _indexed(rows: DataFrame, bucket_bytes: int, units: Units) -> DataFrame:
    """Spans of repeated windows, by an index for each bucket of anchors."""
    size = rows.agg(F.sum(F.octet_length("data"))).collect()[0][0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))

    def index(batches):
        held, now = [], None

        def spans():
            out = [
                (r["id"], r["row"], r["first"] + a, r["first"] + b + units.width)
                for r, found in zip(held, repeated_windows([r["data"] for r in held], units)) if r["members"] == 1
                for a, b in ranges(found)
            ]
            return arrow_rows({c.split()[0]: (pa.int64(), [o[i] for o in out]) for i, c in enumerate(SPAN.split(", "))})

        for batch in batches:
            for r in batch.to_pylist():
                if held and r["bucket"] != now:
                    yield spans()
                    held = []
                now = r["bucket"]
                held.append(r)
        if held:
            yield spans()

    return (
        rows.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .select("bucket", "members", "id", "row", "first", "data")
        .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(index, SPAN)
    )


def _spans(own: DataFrame, bucket_bytes: int, hot_bytes: int, units: Units) -> DataFrame:
    """__id, __row, start, stop: ranges of units to remove, overlapping."""
    found = written(_occurrences(own, units), "passage-snippets")
    again = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    again = written(again, "passage-anchors")  # a plain table: the join can be split where an anchor is hot
    rows = written(found.join(again, "anchor").withColumn("members", F.lit(1).cast("long")), "passage-repeated")
    spans, chosen = _classes(rows, hot_bytes, units)
    rows = written(_fetched(own, chosen, units), "passage-chosen")
    out = [spans]
    for run in RUNS:
        hot = rows.filter("hot")
        out.append(_indexed(rows.filter("not hot"), bucket_bytes, units))
        if hot.isEmpty():
            return _union(out)
        pieces = written(_cut_finer(hot.drop("hot"), run, units), "passage-finer")
        narrow = pieces.withColumn("last", F.col("first") + F.floor(F.octet_length("data") / units.size) - units.width).drop("data")
        spans, chosen = _classes(narrow, hot_bytes, units)
        out.append(spans)
        picked = chosen.select("anchor", "class", "id", "row", "first", F.col("members").alias("in_all"), "hot")
        rows = written(
            pieces.join(picked, ["anchor", "class", "id", "row", "first"]).withColumn("members", F.col("in_all")).drop("in_all"), "passage-chosen",
        )
    out.append(_indexed(rows, bucket_bytes, units))  # single windows: equal anchors are equal windows
    return _union(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    return union


def merged_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _marked(docs: DataFrame, bucket_bytes: int, hot_bytes: int, kinds: tuple[Units, ...] = (BYTES,)) -> DataFrame:
    """docs with __id, __row and __spans: (start, stop, size), in units of that size."""
    own = _identified(docs)
    spans = (
        _union([_spans(own, bucket_bytes, hot_bytes, units).withColumn("size", F.lit(units.size)) for units in kinds])
        .groupBy("__id", "__row").agg(F.collect_list(F.struct("start", "stop", "size")).alias("__spans"))
    )
    return own.join(spans, ["__id", "__row"], "left")


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(data[at:start])
        at = stop
    return b"".join(parts) + data[at:]


def passage_digests(docs: DataFrame, *, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def digest(batches):
        for batch in batches:
            out = []
            for text, spans in zip(texts(batch), batch.column("__spans").to_pylist()):
                data, spans = text.encode(), merged_spans(spans)
                out.append((len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(without(data, spans)).hexdigest()))
            kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
            ids = {"doc_id": (pa.int64(), batch.column("doc_id").to_pylist())}
            yield arrow_rows(ids | {c: (k, [o[i] for o in out]) for i, (c, k) in enumerate(kinds.items())})

    return (
        _marked(docs.select("doc_id", "text"), bucket_bytes, hot_bytes).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "__spans")
        .mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def byte_spans(data: bytes, spans) -> list[dict]:
    """The spans in bytes: those of words from the first word's start to the last one's end."""
    if all(s["size"] == 1 for s in spans):
        return spans
    words = [m.span() for m in re.finditer(rb"\S+", data)]
    return [s if s["size"] == 1 else {"start": words[s["start"]][0], "stop": words[s["stop"] - 1][1]} for s in spans]


def without_repeated_passages(docs: DataFrame, *, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """docs with the repeated passages of WIDTH bytes, and those of more than 50 words, taken out of `text`; all other columns stay."""
    return on_own_columns(lambda own: _repeated_passages_out(own, bucket_bytes, hot_bytes), docs)


def _repeated_passages_out(docs: DataFrame, bucket_bytes: int, hot_bytes: int) -> DataFrame:
    @F.pandas_udf("string")
    def kept(text: pd.Series, starts: pd.Series, stops: pd.Series, sizes: pd.Series) -> pd.Series:
        out = []
        for t, *columns in zip(text, starts, stops, sizes):
            data = t.encode()
            spans = merged_spans(byte_spans(data, [dict(zip(("start", "stop", "size"), s)) for s in zip(*columns)]))
            out.append(without(data, spans).decode("utf-8", "ignore") if spans else t)
        return pd.Series(out, dtype=object)

    marked = _marked(docs, bucket_bytes, hot_bytes, (BYTES, WORDS))
    parts = [F.coalesce(f"__spans.{c}", F.array().cast(f"array<{kind}>")) for c, kind in (("start", "long"), ("stop", "long"), ("size", "int"))]
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(kept(F.coalesce("text", F.lit("")), *parts))
    return marked.withColumn("text", text).select(*docs.columns)
