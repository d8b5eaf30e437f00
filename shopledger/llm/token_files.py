"""Token ids in binary files: frequency-ranked ids, byte-aligned codes of variable length, control bytes apart.

Documents are encoded once by the tokenizer; all ids of the corpus are counted, and an id is written as
its rank by falling count (equal counts: smaller id first), so that the ids met most often take one byte. A
rank takes 1 to 4 bytes, little-endian; two bits of a control byte give the length, four ranks a control
byte, and control and data bytes lie in separate streams. Decoding looks the lengths of four
ranks up by their control byte and lays the bytes out at the width of the longest; no step looks at single ids.

A file set is a folder that holds
    blocks  control and data bytes of about BLOCK_IDS ids of whole documents a row, with the documents' ids and lengths,
            sorted by document id: a file (`part`) holds a range of ids, blocks count on in it
    ranks   id of every rank
    parts   number of ids before each file
as Parquet with uncompressed binary columns, so that Spark's commit writes whole files to any store and
lost executors' files are written again.

Defined results: null and empty texts have the end id only; a null document id comes first; rows
of one id follow each other in the order they were read in; the tokenizer's special strings in a text
are what the tokenizer's file makes of them; a text of any length is one document of one block; an empty table
gives empty files and no rows; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm.byte_bpe import CHUNK, SPACES
from shopledger.llm.common import texts, written
from shopledger.session import scratch_path

END = 0
BLOCK_IDS = 1 << 18
BATCH_ROWS = 256  # documents encoded at a time
CACHED = 700_000  # chunks of each of two generations kept in a worker
LONGEST = 48  # characters of a chunk that is kept
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
WORD = re.compile(f" ?{LETTERS.pattern}")
START = re.compile(f" (?=[^{SPACES}])")  # here a chunk starts whatever is in front
BLANK = re.compile(f"(?![^{SPACES}])")
#: How byte-level vocabularies write a byte: as itself where it can be seen, else by the next code point from 256 on.
SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(SEEN)))}
SPACE = chr(BYTES[32])
#: What a word may hold, by code point: its bytes as byte-level vocabularies write them.
WRITTEN = {c: "".join(chr(BYTES.get(b, b)) for b in chr(c).encode()) for c in range(0x250) if chr(c).isalpha() or c == 32}
TAIL = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")  # a contraction starts with '


class Unsplit(Exception):
    """A space that starts no chunk by itself: more white space or the end of the text follows."""


class Spaced(dict):
    """Ids of texts with a space in front, by the text alone: what a split at single spaces gives, without the regular expression.

    A space and what is no white space after it are the start of a chunk (see CHUNK), so what lies between two such
    starts has ids of its own; white space inside or at the end of it is left to the chunks.
    """

    def __init__(self, chunks: "Chunks"):
        self.chunks = chunks
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            chunks = self.chunks
            core = piece.rstrip(TAIL)
            if not core.isalnum():
                return self._other(piece)
            if len(core) < len(piece):
                ids = self[core] + chunks[piece[len(core) :]]
            elif piece.isascii() and piece.isalpha():
                ids = chunks.word(SPACE + piece)
            elif LETTERS.fullmatch(piece):
                ids = chunks.word(SPACE + piece.translate(WRITTEN))
            else:
                ids = chunks.each([f" {piece}"])[0]
        if len(piece) < LONGEST:
            self[piece] = ids
        return ids

    def _other(self, piece: str) -> bytes:
        """Ids of a piece that is not just letters and digits before punctuation; it is kept if it has no white space."""
        chunks = self.chunks
        last, _, line = piece.partition("\n")
        if piece.split() == [last, line]:
            return self[last] + chunks["\n"] + chunks[line]
        if BLANK.match(piece):
            raise Unsplit
        first, *others = CHUNK.findall(f" {piece}")
        if others:
            return self[first[1:]] + b"".join(map(chunks.__getitem__, others))
        core = piece.rstrip(TAIL)
        if core and len(core) < len(piece) and core[-1].isalnum():
            ids = self[core] + chunks[piece[len(core) :]]
        else:
            ids = chunks.each([first])[0]
        if len(piece) < LONGEST:
            self[piece] = ids
        return ids


class Chunks(dict):
    """Ids of texts by a byte-level tokenizer, as bytes (`width`: unsigned, little-endian, 16 bits where the vocabulary allows).

    A match of the tokenizer's pattern never crosses the start of a chunk, so a chunk's ids don't
    depend on its neighbours, and those met before are kept by chunk (those with a space in front in `spaced`, without
    it): in two generations, of which the older is dropped when the younger is full; what is met again moves to the younger.
    """

    made: dict[str, "Chunks"] = {}  # by file, for all tasks of a worker

    def __init__(self, path: str, kept: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.old: dict[str, bytes] = {}
        self.spaced = Spaced(self)
        self.kept = kept
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        code = "H" if self.width == "<u2" else "I"
        self.packs = [struct.Struct(f"<{n}{code}").pack for n in range(LONGEST)]
        self.merges = self.tokenizer.model.tokenize

    @classmethod
    def of(cls, path: str) -> "Chunks":
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def each(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in found]

    def word(self, seen: str) -> bytes:
        """Ids of one match of the pattern, its bytes as the vocabulary writes them, so that the merges see it whole."""
        ids = [t.id for t in self.merges(seen)]
        return self.packs[len(ids)](*ids) if len(ids) < LONGEST else np.array(ids, self.width).tobytes()

    def _new(self, piece: str) -> bytes:
        """Ids of a piece that is not known; a word of Latin letters is a match by itself."""
        if not WORD.fullmatch(piece):
            return self.each([piece])[0]
        return self.word(piece.translate(WRITTEN))

    def __missing__(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the younger generation; with punctuation cut off, where it follows a letter or digit."""
        ids = self.old.get(chunk)
        if ids is None:
            core = chunk.rstrip(TAIL)
            if core and len(core) < len(chunk) and core[-1].isalnum():
                ids = self[core] + self[chunk[len(core) :]]
            else:
                ids = self._new(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids

    def _text(self, text: str) -> bytes:
        try:
            first, *pieces = text.split(" ")
            spaced = b"".join(map(self.spaced.__getitem__, pieces))
        except Unsplit:
            first, *pieces = START.split(text)
            spaced = b"".join(map(self.spaced.__getitem__, pieces))
        return b"".join(map(self.__getitem__, CHUNK.findall(first))) + spaced

    def encode(self, batch: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(batch) if any(s in t for s in self.special)]
        out = [b""] * len(batch)
        for i in sorted({*range(len(batch))}.difference(whole)):
            out[i] = self._text(batch[i])
            if len(self) + len(self.spaced) >= self.kept:
                for young in (self, self.spaced):
                    young.old = dict(young)
                    young.clear()
        # special strings are cut out before the pattern is looked for
        for i, ids in zip(whole, self.each([batch[i] for i in whole])):
            out[i] = ids
        return out


# control byte -> lengths of its four ranks, as one number
LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.uint8) + 1).view("<u4").reshape(-1)


def _width(longest: int) -> int:
    """Bytes of the narrowest unsigned type for ranks of at most that many bytes."""
    return longest if longest < 3 else 4


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks; the last control byte may have room for ranks that aren't there."""
    width = _width(max(1, -(-int(ranks.max(initial=0)).bit_length() // 8)))
    ranks = ranks.astype(f"<u{width}")
    taken = np.ones((len(ranks), width), bool)
    long = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)  # length less one
    for more in range(1, width):
        np.greater(ranks, (1 << 8 * more) - 1, out=taken[:, more])
        long[: len(ranks)] += taken[:, more]
    control = long[0::4] | long[1::4] << 2 | long[2::4] << 4 | long[3::4] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, width)[taken].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].view(np.uint8)[:count]
    width = _width(int(lengths.max(initial=1)))
    taken = np.ones((count, width), bool)
    for more in range(1, width):
        np.greater(lengths, more, out=taken[:, more])
    out = np.zeros((count, width), np.uint8)
    out[taken] = np.frombuffer(data, np.uint8)
    return out.view(f"<u{width}").reshape(-1)


MET = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))


def encoded(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """doc_id, ids (bytes of the tokenizer's width, with the end id) of every row.

    `met` is null there; a last row of each task has no ids, but in `met` how often the task gave each id.
    """
    kinds = {"doc_id": pa.int64(), "ids": pa.binary(), "met": MET}

    def encode(batches):
        chunks = Chunks.of(tokenizer)
        last = np.array([end], chunks.width).tobytes()
        total = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                ids = [found + last for found in chunks.encode(texts(part))]
                new = np.bincount(np.frombuffer(b"".join(ids), chunks.width), minlength=len(total))
                new[: len(total)] += total
                total = new
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, kinds["ids"]), pa.nulls(len(ids), MET)], names=list(kinds))
        at = np.flatnonzero(total)
        met = pa.StructArray.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], fields=list(MET.value_type))
        row = [pa.nulls(1, kinds["doc_id"]), pa.nulls(1, kinds["ids"]), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), met, type=MET)]
        yield pa.RecordBatch.from_arrays(row, names=list(kinds))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids binary, met array<struct<id: long, n: long>>")


def counted(ids: DataFrame) -> DataFrame:
    """id, n: how often every id occurs; a task has given an entry for each id it met."""
    return ids.select(F.inline("met")).groupBy("id").agg(F.sum("n").alias("n"))


BLOCKS = "part int, block int, ids_before long, ids long, doc_ids array<long>, lengths array<long>, control binary, data binary"


def write(docs: DataFrame, tokenizer: str, path: str, *, end: int = END, block_ids: int = BLOCK_IDS) -> str:
    """Write the file set of the documents to the folder and return it."""
    spark = docs.sparkSession
    ids = written(encoded(docs, tokenizer, end), "token-ids", compression="zstd")
    width = Chunks.of(tokenizer).width
    ranked = [r["id"] for r in counted(ids).orderBy(F.desc("n"), "id").collect()]  # a row for each id of the vocabulary at most
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint16 if len(ranked) <= 1 << 16 else np.uint32)
    rank_of[ranked] = np.arange(len(ranked))

    def blocks(batches) -> Iterator[pa.RecordBatch]:
        part, number, before, size = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            names, own = zip(*held)
            control, data = pack(rank_of[np.concatenate(own)])
            row = [part, number, before, size, list(names), [len(ids) for ids in own], control, data]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                own = np.frombuffer(ids.as_buffer(), width)
                held.append((doc_id, own))
                size += len(own)
                if size >= block_ids:
                    yield block()
                    number, before, size = number + 1, before + size, 0
                    held = []
        if held:
            yield block()

    by = [F.col("doc_id").asc_nulls_first(), F.col("_read")]
    dealt = ids.filter("ids IS NOT NULL").withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    dealt.select("doc_id", "ids").mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    sums = [tuple(r) for r in read_blocks(spark, path).groupBy("part").agg(F.sum("ids")).orderBy("part").collect()]  # a row a file
    starts = [0, *itertools.accumulate(n for _, n in sums)]
    spark.createDataFrame([(p, s) for (p, _), s in zip(sums, starts)], "part int, start long").coalesce(1).write.parquet(f"{path}/parts")
    return path


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (bytes, unsigned 32-bit little-endian) of every document of the file set."""
    ranks = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").orderBy("rank").collect()
    starts = {r["part"]: r["start"] for r in spark.read.schema("part int, start long").parquet(f"{path}/parts").collect()}
    id_of = np.array([r["id"] for r in ranks], "<u4")

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack(row["control"], row["data"], row["ids"])].tobytes()
                at = np.cumsum([0, *row["lengths"]])
                ends = pa.array(4 * at, pa.int32())  # refused if beyond what a column of a batch can hold
                own = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, ends.buffers()[1], pa.py_buffer(ids)])
                first = starts[row["part"]] + row["ids_before"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at[:-1] + first, pa.int64()), own], names=["doc_id", "start", "ids"]
                )

    return read_blocks(spark, path).mapInArrow(documents, "doc_id long, start long, ids binary")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files written in the shared folder."""
    spark = docs.sparkSession
    rows = read(spark, write(docs, tokenizer, scratch_path(spark, "token-files")))
    return rows.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
