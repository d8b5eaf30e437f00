"""Token files: codes, encoding and file sets against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopledger.llm import token_files
from shopledger.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, part int, block int, ids string, start string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_codes():
    rng = np.random.default_rng(1)
    for size in (0, 1, 3, 4, 5, 1_000):
        for top in (2, 256, 70_000, 1 << 24, 1 << 32):
            ranks = rng.integers(0, top, size, dtype=np.uint64).astype(np.uint32)
            control, data = token_files.pack(ranks)
            assert (token_files.unpack(control, data, size) == ranks).all()
            assert len(control) == -(-size // 4) and len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
    control, data = token_files.pack(np.array([1, 0x100, 0x10000, 0x1000000, 5]))
    assert control == bytes([0b11100100, 0]) and data == bytes([1, 0, 1, 0, 0, 1, 0, 0, 0, 1, 5])


@pytest.mark.parametrize("kept", [5, 700_000])
def test_chunks_equal_the_library(tokenizer, kept):
    chunks = token_files.Chunks(PATH, kept)
    rng = random.Random(3)
    alphabet = list(" \t\n\r\x0b\x0c\x00\x1c\x1d\x7f\x85\xa0​ 　﻿sdtrevml0189abcABCéßñÀÿĀɏªºµ×÷한漢²Ⅷ́🙂!?.,'-_|&$") + ["'ll", "'s,", " the", "  ", "word, ", "<|endoftext|>", " señor", " Übergröße", "çà"]
    batches = [["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(50)] for _ in range(60)]
    batches += [["a" * 5_000, " " * 3_000, "\n" * 999 + "x", "=-" * 800, "é" * 500, "🙂" * 300, "", "x\n\n<|endoftext|> y"]]
    for batch in batches:
        for text, found in zip(batch, chunks.encode(batch)):
            assert np.frombuffer(found, chunks.width).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_files(spark, tokenizer):
    rng = random.Random(5)
    words = "the of red, blue. kettle 12 7b über straße niño 漢字 don't we'll <|endoftext|>".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 80)))) for i in rng.sample(range(10_000), 300)]
    rows += [(20_000, None), (20_001, ""), (20_002, " \n\t"), (20_003, "long text of words " * 20_000)]
    docs = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA).repartition(5)
    path = token_files.write(docs, PATH, scratch_path(spark, "test-files"), block_ids=700)
    want, start = {}, 0
    for i, text in sorted(rows):
        ids = ids_of(tokenizer, text)
        want[i] = (start, ids)
        start += len(ids)
    got = token_files.read(spark, path).collect()
    assert {r.doc_id: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got} == want and len(got) == len(rows)
    # blocks are in id order over files and inside them
    blocks = sorted(token_files.read_blocks(spark, path).collect(), key=lambda r: (r.part, r.block))
    assert [i for b in blocks for i in b.doc_ids] == sorted(i for i, _ in rows) and len(blocks) > 20
    # ranks by falling count, equal counts by id
    flat = np.concatenate([ids for _, ids in want.values()])
    counts = np.bincount(flat)
    ranks = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    assert ranks == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))
    # the file holds what the code says, an id met often in one byte
    assert sum(len(b.data) for b in blocks) < 1.1 * len(flat)
    digests = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(docs, PATH).collect()}
    assert digests == {i: (s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, (s, ids) in want.items()}


def test_odd_tables(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, 1, 2, "x", "y") for i, t in [(None, "a b")] * 40 + [(None, None), (7, "twin"), (7, "twin"), (7, "other"), (8, "")]], SCHEMA)
    got = sorted(token_files.digests(docs, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 41 + [7] * 3 + [8]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert token_files.digests(docs.limit(0), PATH).collect() == []
    assert dict(token_files.digests(docs.filter(F.lit(False)), PATH).dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}


def test_kept_chunks_stay_bounded_within_a_batch(tokenizer):
    """Generations change between the texts of a batch; a chunk found again moves to the younger."""
    chunks = token_files.Chunks(PATH, 20)
    batch = [" ".join(f"w{i}x{j}," for j in range(5)) for i in range(40)] + ["again"] * 3
    for text, found in zip(batch, chunks.encode(batch)):
        assert np.frombuffer(found, chunks.width).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(found) == len(b"".join(chunks[c] for c in token_files.CHUNK.findall(text)))
    chunks.clear()
    chunks.old = {}
    chunks.encode(batch)
    assert len(chunks) < 20 + 15 and len(chunks.old) < 20 + 15 and "again" in chunks


SPACED = ["a  b", "a   b", " a", "  a", "a ", "a  ", "a \nb", "a  \nb", "a\n b", "a\n\n b", "a\n\nb", "a \n \n b", "\n a", " \n", "\n", " ", "   ", "a\tb c", "a \tb", "a  b", "a  b", "a \x1cb", "a\x1c b",
          "one.\nTwo, three\nfour  five", "x.\r\ny z", "señor, niño's\nÜber 漢字 한 12,3", "a   b c", "ḱo lé, 7b", "word\x85 word", "a\u00a0 b", "a \u00a0b", " \u2003a", "a \u2003 b"]


@pytest.mark.parametrize("kept", [3, 700_000])
def test_spaces_equal_the_library(tokenizer, kept):
    """Texts are split at single spaces; where a space starts no chunk, at those only that do."""
    chunks = token_files.Chunks(PATH, kept)
    for text in [*SPACED, *[a + glue + b for a in SPACED for b in SPACED for glue in ("", " ", "\n")]] * 2:
        assert np.frombuffer(chunks.encode([text])[0], chunks.width).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert max(len(chunks) + len(chunks.spaced), len(chunks.old) + len(chunks.spaced.old)) < kept + 20 or kept > 20


def test_plain_words_need_no_pattern(monkeypatch):
    """Words between single spaces are looked up without the regular expression, the costly part of known text."""
    seen = []

    class Pattern:
        def findall(self, text, real=token_files.CHUNK):
            seen.append(len(text))
            return real.findall(text)

    monkeypatch.setattr(token_files, "CHUNK", Pattern())
    text = "\n".join(["the kettle is red, and the lamp isn't blue; señor, ring 12 (or so)."] * 200)
    token_files.Chunks(PATH).encode([text] * 5)
    assert 0 < sum(seen) < len(text)


def test_tasks_count_their_ids(spark, tokenizer):
    """The tasks that encode also count: a last row of each has an entry for each id it gave."""
    texts = ["red red kettle", None, "", "niño the the"] * 30
    docs = spark.createDataFrame([(None if i == 5 else i, t, 1, 2, "x", "y") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    rows = token_files.encoded(docs, PATH).collect()
    assert sum(r.ids is not None for r in rows) == len(texts) and all((r.ids is None) != (r.met is None) for r in rows)
    want = np.bincount(np.concatenate([ids_of(tokenizer, t) for t in texts]))
    got = {r.id: r.n for r in token_files.counted(token_files.encoded(docs, PATH)).collect()}
    assert got == {i: want[i] for i in np.flatnonzero(want)}
