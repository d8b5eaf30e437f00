"""Packing documents into sequences by Karmarkar-Karp multiway differencing.

Differencing keeps partial partitions into k windows. It takes the two with the largest
imbalance (largest window less smallest) and merges them with opposing imbalances: the fullest
window of one goes with the emptiest of the other. What is left at the end is one partition with
near-equal windows. The number of windows starts at the least possible one and rises whenever a
window would exceed the capacity.

Documents are hashed into groups of about GROUP_TOKENS tokens; every group is packed by itself, so
memory is bounded and groups are packed in parallel. With cutting, a document longer than a
sequence first fills whole sequences; its rest is differenced with the others; then the tokens of
the emptiest windows top up the fuller ones, so that all sequences of a group are full but for one
remainder, which is cut at powers of two (such sequences are not padded).

Defined results: a null text is an empty text, which has its end id only; repeated rows and null
ids are packed as documents of their own; a text of any length is one document; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import array
import heapq
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, texts

CAPACITY = 4_096
END = 2
GROUP_TOKENS = 1 << 19
FLUSH_TOKENS = 1 << 22  # a group with more (equal ids put all in one) is packed in parts
TOKENS_A_BYTE = 0.4  # only sets the number of groups
WORDS = 900_000  # words kept with their ids in a worker
TAIL = ".,;:!?"
SPACE = re.compile(r"[ \t-\r]+")


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the positions of `sizes` in each of `windows` windows, fullest first.

    A partial partition lists its windows that hold something, fullest first; the others hold 0.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    if windows == 1:
        return [list(range(len(sizes)))]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = max(len(a) + len(b) - windows, 0)  # as many of b's windows must share one of a's
        # b's fullest go to a's empty windows; b's emptiest join a's emptiest, crosswise
        merged = a[: len(a) - both] + b[: len(b) - both]
        for (size_a, held_a), (size_b, held_b) in zip(a[len(a) - both :], reversed(b[len(b) - both :])):
            merged.append((size_a + size_b, held_a + held_b))
        merged.sort(key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], number, merged))
        number += 1
    found = [held for _, held in heap[0][2]]
    return found + [[] for _ in range(windows - len(found))]


def whole(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of whole items, none above the capacity; no item may be larger."""
    if any(s > capacity for s in sizes):
        raise ValueError("an item is larger than a window")
    windows = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        found = difference(sizes, windows)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return [w for w in found if w]
        windows += 1


def cut(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length): all full, but a remainder cut at powers of two."""
    sequences, rest = [], []
    for i, size in enumerate(sizes):
        full = size // capacity
        sequences += [[(i, j * capacity, capacity)] for j in range(full)]
        if size % capacity:
            rest.append((i, full * capacity, size % capacity))
    total = sum(r[2] for r in rest)
    windows = [[rest[i] for i in w] for w in difference([r[2] for r in rest], max(1, math.ceil(total / capacity)))]
    windows.sort(key=lambda w: -sum(p[2] for p in w))
    full = total // capacity
    spare: list[tuple[int, int, int]] = [p for w in windows[full:] for p in w]  # to be cut up
    kept = []
    for window in windows[:full]:  # above the capacity: what is too much is cut off the last pieces
        over = sum(p[2] for p in window) - capacity
        while over > 0:
            item, start, length = window.pop()
            off = min(over, length)
            if length > off:
                window.append((item, start, length - off))
            spare.append((item, start + length - off, off))
            over -= off
        kept.append(window)
    spare.sort(key=lambda p: -p[2])

    def take(amount: int) -> list[tuple[int, int, int]]:
        out = []
        while amount:
            item, start, length = spare.pop()
            out.append((item, start, min(length, amount)))
            if length > amount:
                spare.append((item, start + amount, length - amount))
            amount -= out[-1][2]
        return out

    for window in kept:
        sequences.append(window + take(capacity - sum(p[2] for p in window)))
    left = total - full * capacity
    for bit in reversed(range(capacity.bit_length())):
        if left >> bit & 1:
            sequences.append(take(1 << bit))
    return sequences


class Tokens:
    """Ids of texts; words between ASCII white space are independent for this tokenizer and kept."""

    made: dict[str, "Tokens"] = {}  # by file, for all tasks of a worker

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Tokens":
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def _new(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not known; by their parts, where those are.

        Case does not count for this tokenizer, and punctuation after a letter or digit is a
        token of its own, so the word without either may be known.
        """
        parts, asked = {}, {}
        for w in words:
            core = w.rstrip(TAIL)
            tail = w[len(core) :]
            if tail and not (core and core[-1].isalnum()):
                core, tail = w, ""
            parts[w] = core, tail = core.lower() if core.isascii() else core, tail
            for p in parts[w]:
                if p not in self.known:
                    asked[p] = b""
        new = list(asked)
        for i in range(0, len(new), 4_096):
            part = new[i : i + 4_096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                asked[p] = array.array("H", e.ids).tobytes()
        get = lambda p: asked[p] if p in asked else self.known[p]
        return asked | {w: get(core) + get(tail) for w, (core, tail) in parts.items()}

    def ids(self, text: str) -> np.ndarray:
        words = SPACE.split(text)
        found = list(map(self.known.get, words))
        if None in found:
            fresh = self._new({w for w, f in zip(words, found) if f is None})
            found = [fresh[w] if f is None else f for w, f in zip(words, found)]
            if len(self.known) < WORDS:
                self.known.update(fresh)
        return np.frombuffer(b"".join(found), np.uint16)


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """The pieces of all sequences; with `ids` also the ids of each piece."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = kept.agg(F.sum(F.octet_length("text") + 3)).collect()[0][0] or 0
    groups = max(1, math.ceil(size * TOKENS_A_BYTE / GROUP_TOKENS))
    dealt = (
        kept.withColumn("group", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(groups)))
        .repartition("group").sortWithinPartitions("group", "doc_id", "text")
    )

    def pack(rows):
        tokens = Tokens.of(tokenizer)
        held: list[tuple[int | None, np.ndarray]] = []
        state = {"group": None, "tokens": 0, "next": 0}

        def sequences():
            out = []
            for sequence in cut([len(i) for _, i in held], capacity):
                offset = 0
                for item, start, length in sequence:
                    doc_id, own = held[item]
                    part = own[start : start + length].astype("<u4").tobytes()
                    out.append((doc_id, start, length, zlib.crc32(part), len(own), (state["group"] << 24) + state["next"], offset) + ((part,) if ids else ()))
                    offset += length
                state["next"] += 1
            held.clear()
            state["tokens"] = 0
            names = [c.split()[0] for c in PACKED.split(", ")] + ["ids"] * ids
            kinds = [pa.int64()] * 7 + [pa.binary()] * ids
            return arrow_rows({c: (k, [o[i] for o in out]) for i, (c, k) in enumerate(zip(names, kinds))})

        for batch in rows:
            for group, doc_id, t in zip(batch.column("group").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch)):
                if held and (group != state["group"] or state["tokens"] >= FLUSH_TOKENS):
                    yield sequences()
                if group != state["group"]:
                    state["group"], state["next"] = group, 0
                own = np.append(tokens.ids(t), np.uint16(end))
                held.append((doc_id, own))
                state["tokens"] += len(own)
        if held:
            yield sequences()

    return dealt.select("group", "doc_id", "text").mapInArrow(pack, PACKED + ", ids binary" * ids)
