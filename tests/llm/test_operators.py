"""Operators against brute force on small tables with nulls, ties, repeats, long texts and odd columns."""

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import byte_bpe, components, golay, language, lines, neighbours, order_minhash, packing, queries, sharding, suffixes, toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block string, shard string, fp string, kind string"
WORDS = "the of and red blue kettle tea tin lamp oak ring über straße ça été niño año 12 7b x".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared lines and passages, a long text, blanks, nulls and empty texts."""
    rng = random.Random(4)
    passage, line = sentence(rng, 120), "A Common Line of some length"
    long = "\n".join(" ".join(f"{rng.choice(WORDS)}{rng.randint(0, 999)}" for _ in range(40)) for _ in range(400))
    out = [sentence(rng, rng.randint(1, 60)) for _ in range(40)]
    out += [out[3]] * 4 + [out[5] + " tin"] + [out[3].upper()]
    out += [f"{sentence(rng, 8)}\n{line}\n{sentence(rng, 9)}" for _ in range(8)] + ["  a common line OF some length\t\nshort\nshort\n"]
    out += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 25) for _ in range(6)]
    out += [long, long[:20_000] + "zz" + long[20_000:], "ab" * 900, "", None, "\n\n", " \t\x0b ", "é" * 500, "🙂 " * 120]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "b", "s", "f", "k") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, exact twins."""
    text = "one two three four five six\nand a second line here"
    rows = [(None, text), (None, text), (None, None), (7, text), (7, text), (7, "another text of the same id"), (8, "")]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None, None) for i, t in rows], SCHEMA)


def test_line_counts_of_many_copies(docs, rows, monkeypatch):
    """One shard, a task per probe or so, counts added up two by two and then together."""
    monkeypatch.setattr(lines, "COPIES_ADDED", 2)
    got = lines.line_digests(docs, shard_keys=1 << 20, shard_probes=3).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == brute.line_digests(rows)


def test_line_arrays(spark):
    """The arrays hold, at each key's place, its fingerprint, how many rows have it and the smallest doc_id."""
    keys = [(i % 7 * 1000 + 1, i % 7 + 50, 30 - i) for i in range(30)]
    low = spark.createDataFrame(keys, "high long, low long, id long").withColumn("row", F.xxhash64("id"))
    shard, copies = F.lit(0).cast("long"), spark.createDataFrame([(0, 4)], "shard long, copies int")
    index = lines._index(low.select("high", "low").distinct(), shard)
    counted = lines._past(index, low, shard, copies, ["high", "low", "id"]).mapInArrow(lines._count, lines.COUNTED)
    assert counted.count() == 4
    (row,) = lines._added_up(counted, F.lit(0)).collect()
    made = lines.PerfectHash.from_bytes(index.collect()[0]["hash"])
    for n in range(7):
        mine = [i for high, _, i in keys if high == n * 1000 + 1]
        (at,) = made.places(np.array([n * 1000 + 1], np.uint64), np.array([n + 50], np.uint64))
        assert np.frombuffer(row.counts, "<u4")[at] == len(mine) and np.frombuffer(row.owners, "<i8")[at] == min(mine)


def test_lines(docs, rows, empty, odd):
    want = brute.line_digests(rows)
    for shard_keys, probes in ((1 << 16, 1 << 18), (3, 2)):
        got = lines.line_digests(docs, shard_keys=shard_keys, shard_probes=probes).collect()
        assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == want and len(got) == len(rows)
    assert lines.line_digests(empty).count() == 0
    got = lines.line_digests(odd).collect()
    # rows with one id are one document; those without an id come after all others
    assert sorted((r.doc_id or 99, r.n_dropped) for r in got) == [(7, 0), (7, 0), (7, 0), (8, 0), (99, 0), (99, 2), (99, 2)]
    kept = lines.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    sums = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in kept.collect()}
    assert sums == {i: w[2] for i, w in want.items()}


def test_perfect_hash():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 1 << 64, (2, 5000), dtype=np.uint64)
    high[:50] = high[0]  # half the hash in common
    made = lines.PerfectHash.from_bytes(lines.PerfectHash.build(high, low).to_bytes())
    assert sorted(made.places(high, low)) == list(range(5000))
    assert lines.PerfectHash.build(high[:0], low[:0]).places(high[:2], low[:2]).tolist() == [-1, -1]


def test_sharding(docs, rows, empty, odd):
    got = sharding.shard_documents(docs, 8, block_rows=7).collect()
    assert len(got) == len(rows)
    text = {i: (t or "").encode() for i, t in rows}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id]) and r.size == len(text[r.doc_id]) + 1 for r in got)
    by_shard = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert sharding.shard_documents(empty).count() == 0
    assert sharding.shard_documents(odd).count() == 7
    again = {tuple(r) for r in sharding.shard_documents(docs.repartition(5), 8, block_rows=7).collect()}
    assert again == {tuple(r) for r in got}


def test_hypergeometric_law():
    rng = np.random.default_rng(3)
    draws = [sharding.draw_hypergeometric(rng, 30, 20, 12) for _ in range(20_000)]
    want = [math.comb(30, k) * math.comb(20, 12 - k) / math.comb(50, 12) for k in range(13)]
    assert np.abs(np.bincount(draws, minlength=13) / 20_000 - want).max() < 0.015
    assert 0 <= sharding.draw_hypergeometric(rng, 10**12, 7 * 10**12, 10**6) <= 10**6
    blocks, shards = [5, 0, 9, 17], [8, 8, 8, 7]
    matrix = sharding.communication_matrix(blocks, shards, 1)
    assert [sum(r) for r in matrix] == blocks and [sum(c) for c in zip(*matrix)] == shards


def test_passages(docs, rows, empty, odd):
    masks, text = brute.repeated_bytes(rows), {i: (t or "").encode() for i, t in rows}
    want = {}
    for i, m in masks.items():
        spans = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        want[i] = (len(m), int(m.sum()), spans, hashlib.sha256(np.frombuffer(text[i], np.uint8)[~m].tobytes()).hexdigest())
    for hot, bucket in ((1 << 20, 1 << 19), (900, 3000)):  # also with anchors cut up to single windows
        got = suffixes.passage_digests(docs, hot_bytes=hot, bucket_bytes=bucket).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) > 8
    assert suffixes.passage_digests(empty).count() == 0
    assert suffixes.passage_digests(odd).count() == 7
    assert suffixes.without_repeated_passages(docs).columns == docs.columns


def test_passages_of_few_bytes(spark):
    """Repeated stretches of 51 to 60 words go, whatever their bytes and white space; those of 50 words stay."""
    rng = random.Random(9)
    word = lambda: f"{rng.randint(0, 10**5)}"
    rows, want = [], []
    for n in (20, 50, 51, 52, 55, 60):
        passage = [word() for _ in range(n)]
        assert len(" ".join(passage)) < 400
        for glue in (" ", "\n", "  "):
            head, tail = " ".join(word() for _ in range(30)), " ".join(word() for _ in range(20))
            rows.append((len(rows), f"{head} {glue.join(passage)} {tail}"))
            want.append(f"{head}  {tail}" if n > 50 else rows[-1][1])
    rows.append((len(rows), None))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot, bucket in ((1 << 20, 1 << 19), (900, 3000)):
        got = {r.doc_id: r.text for r in suffixes.without_repeated_passages(df, hot_bytes=hot, bucket_bytes=bucket).collect()}
        assert [got[i] for i in range(len(want))] == want and got[len(want)] is None


def test_twins_are_two_documents(spark):
    text = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(1, text), (1, text), (None, "x" + text[:300])], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffixes.passage_digests(df).collect()) == [0, len(text), len(text)]


def test_run_index():
    rng = random.Random(2)
    for _ in range(30):
        data = bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 120)))
        got = suffixes.RunIndex(np.frombuffer(data, np.uint8).astype(np.int64)).statistics()
        for i in range(len(data)):
            best = max((sum(1 for _ in iter_common(data, i, j)) for j in range(len(data)) if j != i), default=0)
            assert got[i] == best


def iter_common(data, i, j):
    while i < len(data) and j < len(data) and data[i] == data[j]:
        yield i
        i, j = i + 1, j + 1


def test_simhash(spark, docs, rows, empty, odd):
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in golay.near_duplicates(docs).collect()}
    want = brute.components({i: brute.simhash(t) for i, t in rows})
    assert {i: (f"{fp:016x}", c) for i, (fp, c) in got.items()} == want
    assert golay.near_duplicates(empty).count() == 0
    assert {(r.doc_id, r.component_id) for r in golay.near_duplicates(odd).collect()} >= {(7, 7), (None, 7), (8, 8)}


def test_golay_keys_meet():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 64, 4_000, dtype=np.uint64)
    b = a.copy()
    for i in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    keys = [golay.keys_of(x.view(np.int64)) for x in (a, b)]
    met = {(k, p) for k, (_, p) in zip(keys[0][0].tolist(), keys[0][1].tolist())} & {(k, p) for k, (_, p) in zip(keys[1][0].tolist(), keys[1][1].tolist())}
    assert {p for _, p in met} == set(range(len(a)))


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}


def test_near_copies(docs, rows):
    kept = {r.doc_id for r in golay.without_near_copies(docs).collect()}
    sets = {i: frozenset(golay.shingles(t or "", 5)) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert kept == {find(i) for i in sets}


def linked(texts, similar=0.8):
    """Smallest number of each text's group by all pairs of shingle sets."""
    sets = [frozenset(golay.shingles(t, 5)) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common >= similar * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def test_near_copies_of_a_template(spark):
    """Texts of one frame with parts of their own: each is like few of the others."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    frame, texts = [word() for _ in range(150)], []
    for _ in range(60):
        at, own = rng.randrange(100), [word() for _ in range(30)]
        family = frame[:at] + own + frame[at + 20 :]
        for _ in range(5):
            member = list(family)
            for _ in range(rng.randint(0, 3)):
                member[rng.randrange(len(member))] = word()
            texts.append(" ".join(member))
    for _ in range(40):  # the same words in other orders: near in words, far in shingles, but for the copy of each
        rng.shuffle(frame)
        texts += [" ".join(frame), " ".join(frame + [word() for _ in range(30)])]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = set(linked(texts))
    assert 50 < len(want) < 240
    for block in (512, 7):
        assert {r.doc_id for r in golay.without_near_copies(df, block=block).collect()} == want


def test_near_copies_of_every_edit(spark):
    """Pairs just above the limit, by kind of edit."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    texts = []
    for kind in ("append", "cut", "block", "scattered"):
        for _ in range(100):
            a = [word() for _ in range(200)]
            b = list(a)
            if kind == "append":
                b += [word() for _ in range(48)]
            elif kind == "cut":
                b = b[:162]
            elif kind == "block":
                b[80:97] = [word() for _ in range(17)]
            else:
                for i in rng.sample(range(2, 40), 4):
                    b[5 * i] = word()
            texts += [" ".join(a), " ".join(b)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert linked(texts) == [i - i % 2 for i in range(len(texts))]
    assert {r.doc_id for r in golay.without_near_copies(df).collect()} == set(range(0, len(texts), 2))


def test_order_minhash(docs, rows, empty, odd):
    got = {r.doc_id: r for r in order_minhash.compared(docs).collect()}
    text = {i: t or "" for i, t in rows}
    for i, t in text.items():
        after, r = text[(i + 1) % len(text)], got[i]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        own, other, following = (order_minhash.signature(x) for x in (t, edited, after))
        assert (r.fingerprint, r.edited_fingerprint) == (order_minhash.as_text(own), order_minhash.as_text(other))
        assert r.near_next == order_minhash.likeness(own, following) and r.near_edited == order_minhash.likeness(own, other)
    by_text = {}
    for i, t in text.items():
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    assert len(set(by_text.values())) >= len(by_text) - 2  # a few edits in a long text may stay unseen
    assert order_minhash.compared(empty).count() == 0
    assert order_minhash.compared(odd).count() == 7
    assert [r.near_next for r in order_minhash.compared(docs.filter("doc_id = 3")).collect()] == [1.0]


def test_order_minhash_by_definition():
    """The numpy signature picks the same elements as a plain sort, in text order."""
    text = "the red kettle and the red kettle and the blue tin " * 3
    base = order_minhash.elements(text)
    grams = [text[i : i + order_minhash.K] for i in range(len(text) - order_minhash.K + 1)]
    numbered = [(g, grams[:i].count(g)) for i, g in enumerate(grams)]
    assert len(set(base.tolist())) == len(set(numbered))
    first = {n: b for n, b in zip(numbered, base.tolist())}
    assert [first[n] for n in numbered] == base.tolist()
    moved = text[60:] + text[:60]
    assert order_minhash.likeness(order_minhash.signature(text), order_minhash.signature(moved)) < 1


def test_order_matters_and_edits_count():
    rng = random.Random(9)
    text = " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 99)}" for _ in range(300))
    small = text[:700] + "QQQ" + text[703:]
    far = "".join(rng.sample(text, len(text)))
    sign = [order_minhash.signature(t) for t in (text, small, text[: len(text) // 2], far)]
    near = [order_minhash.likeness(sign[0], s) for s in sign]
    assert near[0] == 1 and near[1] > 0.8 > near[2] > near[3]


def test_language(spark, empty, odd):
    rng = random.Random(8)
    words = {"aa": "the and with from this that house water".split(), "bb": "und mit aus dies haus wasser nicht über".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30)), k) for i in range(400) for k in [("aa", "bb")[i % 2]]]
    rows += [(500, None, "aa"), (501, "12 34 !?", "bb"), (502, "", None), (503, "und " * 30_000, None)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:400])
    assert [got[i].lang_pred for i in (500, 501, 502, 503)] == ["und", "und", "und", "bb"]
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(odd).collect()} == {"und"}


def test_toxicity(spark, empty, odd):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(WORDS) for _ in range(40)]
        if i % 6 == 0:
            words[10:10] = rng.sample(["foul1", "foul2", "foul3", "foul4"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 6 == 0), "clash"))
    rows += [(900, None), (901, ""), (902, "tea " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels + [(None, 1, ""), (3, None, "")], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.toxic_documents(docs, labels).collect()}
    assert all(got[i].predicted == int(i % 6 == 0) for i in range(500) if got[i].held_out)
    assert [got[i].predicted for i in (900, 901, 902)] == [0, 0, 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert {r.score for r in toxicity.toxic_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxic_documents(empty, labels).count() == 0
    assert toxicity.toxic_documents(odd, labels).count() == 7
    kept = toxicity.keep_clean(docs, toxicity.learn(docs, labels))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if not got[i].predicted}


def test_maximal_segments():
    """Against the recursive definition: the best segment, then the same on either side of it."""
    rng = random.Random(3)

    def best(scores, low, high):
        found = [(sum(scores[a:b]), -(b - a), -a) for a in range(low, high) for b in range(a + 1, high + 1)]
        if not found or max(found)[0] <= 1e-9:
            return []
        total, width, start = max(found)
        a, b = -start, -start - width
        return best(scores, low, a) + [(a, b)] + best(scores, b, high)

    for _ in range(60):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 8 for _ in range(rng.randint(0, 14))]
        assert [s[:2] for s in toxicity.maximal_segments(np.array(scores))] == best(scores, 0, len(scores))


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(tiktoken_encoding):
    codec = byte_bpe.Codec.of(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(3)
    alphabet = list(" \t\n\r\x0b\x0c\x1c\x1d\x85\xa0　​sdtrevml0189abcABCéßñ한漢🙂!?.,'-_|") + ["'ll", " the", "  ", "ing"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2_000)]
    texts += ["a" * 5_000, " " * 3_000, "\n" * 999 + "x", "=-" * 800, "0" * 777, "é" * 500, "🙂" * 300, ""]
    for t in texts:
        ids = codec.encode(t)
        assert ids == tiktoken_encoding.encode_ordinary(t)
        assert "".join(byte_bpe.decode_stream(codec.decode_bytes(ids))) == t


def test_pairs_fit_as_the_merges_say():
    t = byte_bpe.Codec.of(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).transducer
    rng = random.Random(1)
    for _ in range(4_000):
        a, b = (rng.choice([rng.randrange(50_256), rng.randrange(2_000)]) for _ in "ab")
        parts = t.merged(t.tokens[a] + t.tokens[b])[0]
        assert t._ends(a)[0] is False or t.fits(a, b) == (parts == [t.tokens[a], t.tokens[b]])


def test_utf8_stream():
    data = "aé漢🙂".encode() + b"\xff\xf0\x9f" + "z".encode() + b"\xe2\x82"
    for size in range(1, 8):
        chunks = [data[i : i + size] for i in range(0, len(data), size)]
        assert "".join(byte_bpe.decode_stream(chunks)) == data.decode("utf-8", "replace")


def test_bpe_tables(docs, rows, empty, odd, tiktoken_encoding):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    got = {r.doc_id: r for r in byte_bpe.digests(docs, ranks, pattern).collect()}
    for i, t in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].same
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decoded(byte_bpe.encoded(docs, ranks, pattern), ranks, pattern)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in rows}
    assert byte_bpe.digests(empty, ranks, pattern).count() == 0 and byte_bpe.digests(odd, ranks, pattern).count() == 7


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1_500, 24)).astype(np.float32)
    x[700:720] = x[3]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(5_000, None), (5_001, [0.0] * 24), (5_002, [None] + [1.0] * 23), (5_003, [float("nan")] * 24), (None, [1.0] * 24), (5_100, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad + rows[:1], "vec_id long, embedding array<float>").withColumn("cell", F.lit("x"))
    want = brute.nearest(np.arange(1_500), x.astype(np.float64), list(range(0, 1_500, 100)))
    for sizes in ({}, {"cell_vectors": 20, "cell_queries": 2}):
        got = {}
        for r in sorted(neighbours.nearest(df, F.col("vec_id") % 100 == 0, **sizes).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert set(got) == set(want)
        hits = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want])
        assert hits >= 0.9
        assert all(abs(s - np.sqrt(((x[q].astype(float) - x[v].astype(float)) ** 2).sum())) < 1e-12 for q in got for v, s in got[q])
    exact = neighbours.nearest(df, F.col("vec_id") == 3, tables=1, probes=64).collect()
    assert [r.vec_id for r in sorted(exact, key=lambda r: r["rank"])] == list(range(700, 710))
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_packing(docs, rows, empty, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.packed(docs, path, capacity=256).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]]
        assert ends[-1] == 256 or (ends[-1] < 256 and ends[-1] & (ends[-1] - 1) == 0)
    assert packing.packed(empty, path).count() == 0
    assert {r.doc_id for r in packing.packed(odd, path).collect()} == {None, 7, 8}


def test_differencing():
    rng = random.Random(1)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    windows = packing.difference(sizes, 40)
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert sorted(i for w in windows for i in w) == list(range(400)) and max(sums) - min(sums) <= 10
    whole = packing.whole(sizes, 100)
    assert max(sum(sizes[i] for i in w) for w in whole) <= 100 and len(whole) >= sum(sizes) / 100
    assert packing.difference([], 3) == [[], [], []]


def test_stages_judge_all_rows(spark, docs):
    """Every stage keeps columns and clean documents, and the last packs what is left."""
    now = docs
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        now = stage(spark, now, "")
        assert now.columns == docs.columns, name
    kept = now.collect()
    assert kept and all(r.n_chars == len(r.text or "") for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept}


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5


def test_sharding_numbers_equal_rows_in_pieces(spark, monkeypatch):
    """Many equal rows lie in all shards, alike however the rows are read, and are numbered some at a time."""
    monkeypatch.setattr(sharding, "EQUAL_ROWS", 16)
    rows = [(None, "same")] * 300 + [(1, "same")] * 16 + [(2, None), (2, None), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got, again = (sorted(map(str, sharding.shard_documents(d, 8, block_rows=20).collect())) for d in (docs.repartition(3), docs.coalesce(1)))
    assert got == again and len(got) == len(rows)
    counts = [sum(f"shard={s}," in r for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert all(any("doc_id=None" in r and f"shard={s}," in r for r in got) for s in range(8))


def test_latin_words_need_no_pattern_and_last_tokens_no_check():
    """A word of Latin letters is encoded as one match; where one token can end, no pair is looked up."""
    codec = byte_bpe.Codec(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    words = [" straße", "Ñandú", " çàéïõ", " ɏɏɏ", "ÀÖØöø"]
    wanted = [[i for piece in codec.pattern.findall(w) for i in codec.transducer.encode(piece.encode())] for w in words]
    codec.pattern = None
    assert [codec.encode(w) for w in words] == wanted
    plain = byte_bpe.Transducer({bytes([b]): b for b in range(256)})
    assert plain.encode(b"abc" * 1_000) == list(b"abc" * 1_000) and not plain.pairs
