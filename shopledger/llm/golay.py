"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last filled up with zeros).
The perfect Golay code (23, 12, 7) has exactly one codeword within 3 bits of any segment; a segment
that is 3 bits away has five more at 4 bits. The indices of these codewords, one or six, are the
segment's keys: two segments that differ in at most 2 bits have a key in common. If two
fingerprints differ in 4 bits at most, some two of the three segments differ in 2 bits at most
together; so a key of one segment with a key of another finds every such pair. Pairs with a
common key are verified by counting their different bits.

Fingerprints, not documents, are hashed: equal ones are one class from the start. Inside a key
nothing is paired off: a search from fingerprint to fingerprint removes whatever it reaches, so a
dense group costs about its size, and only links that hold a group together leave the task.

Defined results: null and empty texts have fingerprint 0 and are linked like any other; fewer than
four words are one shingle; a class is named by its smallest doc_id, null ids are named only where
no other is in the class; repeated rows stay; other columns are not looked at.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, on_own_columns, texts, written
from shopledger.llm.components import components

WORDS = 4
SEED = 42
BITS = 4  # fingerprints link at so many different bits, at most
SHIFTS = (0, 23, 46)
GENERATOR = 0b110001110101  # of the Golay code
CLOSE = 8  # keys with so many fingerprints are compared in one sweep over the batch


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the 64-bit hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def shingles(text: str, words: int) -> list[int]:
    """Hashes of the word shingles, repeats included, ASCII letters lower-cased; none without words."""
    parts = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not parts:
        return []
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths + 1) - lengths - 1
    n = max(len(parts) - words + 1, 1)
    ends = (starts + lengths)[min(words, len(parts)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())]


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the word shingles; 0 without words."""
    hashes = shingles(text, words)
    return majority(np.array(hashes, np.uint64)) if hashes else 0


def fingerprinted(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of every document."""

    def sign(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, "doc_id long, fp long")


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of every upper half, error pattern by syndrome, and key changes by syndrome.

    The changes are the index differences to the codewords at 4 bits, 0 where there are none.
    """
    def syndromes(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint32).copy()
        for bit in range(22, 10, -1):
            x ^= np.where(x >> np.uint32(bit) & np.uint32(1), np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
        return x

    high = syndromes(np.arange(1 << 12, dtype=np.uint32) << np.uint32(11))
    errors = np.zeros(1 << 11, np.uint32)
    patterns = [0]
    ones = [1 << i for i in range(23)]
    patterns += ones + [a | b for i, a in enumerate(ones) for b in ones[:i]]
    triples = [a | b | c for i, a in enumerate(ones) for j, b in enumerate(ones[:i]) for c in ones[:j]]
    for p in patterns + triples:
        errors[high[p >> 11] ^ (p & 0x7FF)] = p
    codewords = (np.arange(1 << 12, dtype=np.uint32) << np.uint32(11)) | high
    sevens = codewords[np.bitwise_count(codewords) == 7]
    changes = np.zeros((1 << 11, 5), np.uint32)
    for p in triples:
        changes[high[p >> 11] ^ (p & 0x7FF)] = sevens[(sevens & np.uint32(p)) == p] >> np.uint32(11)
    return high, errors, changes


def segment_keys(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six codeword indices of each 23-bit segment, and which of them count."""
    high, errors, changes = tables()
    x = segments.astype(np.uint32)
    syndrome = high[x >> np.uint32(11)] ^ (x & np.uint32(0x7FF))
    index = (x ^ errors[syndrome]) >> np.uint32(11)
    keys = np.concatenate([index[:, None], index[:, None] ^ changes[syndrome]], axis=1)
    used = np.concatenate([np.ones((len(x), 1), bool), changes[syndrome] > 0], axis=1)
    return keys, used


PAIRS = ((0, 1), (0, 2), (1, 2))


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All combined keys of the fingerprints, and beside each (fingerprint, its place)."""
    x = fps.view(np.uint64)
    parts = [segment_keys((x >> np.uint64(s)) & np.uint64((1 << 23) - 1)) for s in SHIFTS]
    keys, owners = [], []
    for pair, (i, j) in enumerate(PAIRS):
        used = parts[i][1][:, :, None] & parts[j][1][:, None, :]
        both = (parts[i][0].astype(np.int64)[:, :, None] << 12) | parts[j][0].astype(np.int64)[:, None, :] | (pair << 24)
        keys.append(both[used])
        owners.append(np.nonzero(used)[0])
    places = np.concatenate(owners)
    return np.concatenate(keys), np.stack([fps[places], places], axis=1)


def grown(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (places) that connect the fingerprints of one key as all links of at most `bits` would.

    The search starts at the fingerprint nearest to the majority of all.
    """
    values = fps.view(np.uint64)
    start = int(np.bitwise_count(values ^ np.uint64(majority(values))).argmin())
    left = np.delete(np.arange(len(values)), start)
    ahead, links = [start], []
    while len(left):
        if not ahead:
            ahead, left = [int(left[-1])], left[:-1]
            continue
        here = ahead.pop()
        near = np.bitwise_count(values[left] ^ values[here]) <= bits
        if near.any():
            reached = left[near].tolist()
            links += [(here, r) for r in reached]
            ahead += reached
            left = left[~near]
    return links


def links_of(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """u, v: links among rows of (node, fp) that join the same classes as all links would."""

    def explode(batches):
        for batch in batches:
            values, names = batch.column("fp").to_numpy(), batch.column("node").to_numpy()
            for i in range(0, len(values), 4_096):
                keys, owners = keys_of(values[i : i + 4_096])
                columns = [keys, owners[:, 0]]
                if named:
                    columns.append(names[i : i + 4_096][owners[:, 1]])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "fp", "node"][: len(columns)])

    def compare(batches):
        waiting = None

        def found(keys: np.ndarray, own: np.ndarray, names: np.ndarray):
            bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
            sizes = np.diff(bounds)
            u, v = [], []
            small = np.repeat(sizes <= CLOSE, sizes)
            for ahead in range(1, min(CLOSE, len(keys))):
                same = np.flatnonzero((keys[ahead:] == keys[:-ahead]) & small[ahead:])
                if not len(same):
                    break
                near = same[np.bitwise_count((own[same] ^ own[same + ahead]).view(np.uint64)) <= bits]
                u.append(near)
                v.append(near + ahead)
            for k in np.flatnonzero(sizes > CLOSE):
                part = own[bounds[k] : bounds[k + 1]]
                more = grown(part, bits)
                if more:
                    pairs = np.array(more, np.int64) + bounds[k]
                    u.append(pairs[:, 0])
                    v.append(pairs[:, 1])
            if not u:
                return None
            a, b = names[np.concatenate(u)], names[np.concatenate(v)]
            both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("key", "fp", "node" if named else "fp")]
            if waiting:
                columns = [np.concatenate(c) for c in zip(waiting, columns)]
            if not len(columns[0]):
                continue
            whole = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on in the next batch
            waiting = [c[whole:] for c in columns]
            if whole and (out := found(*(c[:whole] for c in columns))) is not None:
                yield out
        if waiting and (out := found(*waiting)) is not None:
            yield out

    named = "node" in fps.columns
    if not named:
        fps = fps.select("fp", F.col("fp").alias("node"))
    return (
        fps.select("fp", "node").mapInArrow(explode, "key long, fp long" + ", node long" * named)
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(compare, "u long, v long").distinct()
    )


def near_duplicates(docs: DataFrame, *, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    own = written(fingerprinted(docs, words), "simhash")
    classes = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links_of(classes, bits), "simhash-links")
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = written(named, "simhash-classes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(named.join(least, "root").select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def as_hex(fp):
    """16 hexadecimal digits of the 64 bits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


SIMILAR = 0.8  # share of common five-word shingles from which documents are near copies
SIMILAR_WORDS = 5
BANDS, BAND_ROWS = 32, 4  # of two sets that share 0.8 of their shingles 5 in 10^8 pairs have no band in common
BLOCK = 512  # documents of one side of a cell, on average


@functools.cache
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return tuple(rng.integers(0, 1 << 64, BANDS * BAND_ROWS, dtype=np.uint64) for _ in range(2))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key of each band: the smallest values of BAND_ROWS random orders of the hashes, which must not be empty."""
    flips, factors = _mixers()
    least = np.full(len(flips), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4_096):
        mixed = (hashes[i : i + 4_096, None] ^ flips) * (factors | np.uint64(1))
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, mixed.min(axis=0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64).view(np.int64)


def _texts(own: DataFrame) -> DataFrame:
    """__id, __row, node, fp, keys: the digest of a document's words, its SimHash, the band keys of its five-word shingles."""

    def sign(batches):
        for batch in batches:
            nodes, fps, keys = [], [], []
            for text in texts(batch):
                nodes.append(xxhash.xxh3_64_intdigest(b" ".join(text.encode().lower().split())))
                fps.append(fingerprint(text))
                found = shingles(text, SIMILAR_WORDS)
                keys.append(band_keys(np.unique(np.array(found, np.uint64))) if found else np.empty(0, np.int64))
            columns = [np.array(c, np.uint64).view(np.int64) for c in (nodes, fps)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__row"), *map(pa.array, columns), pa.array(keys, pa.list_(pa.int64()))],
                names=["__id", "__row", "node", "fp", "keys"],
            )

    return own.select("__id", "__row", "text").mapInArrow(sign, "__id long, __row long, node long, fp long, keys array<long>")


def _shared(classes: DataFrame) -> DataFrame:
    """key, node, leader, n: the band keys that several nodes have; of keys with the same nodes one."""
    keyed = classes.select(F.explode("keys").alias("key"), "node")
    several = (
        keyed.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"))
        .filter("n > 1").groupBy("leader", "n", "mark").agg(F.min("key").alias("key")).drop("mark")
    )
    return keyed.join(written(several, "near-copy-bands"), "key")


def walked(sets: list[np.ndarray], parts: list[int], held: list[bool], similar: float) -> list[tuple[int, int]]:
    """Links (places) of sets that share `similar` or more, as many as join what all such links would join.

    Sets of one part are known to be joined; between two that are `held` nothing is tested.
    """
    sizes = np.array([len(s) for s in sets])
    names, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    part, held = np.unique(parts, return_inverse=True)[1], np.array(held)
    flags, links = np.zeros(len(names), np.int64), []
    for i in np.flatnonzero(~held).tolist():
        at = numbers[starts[i] : starts[i] + sizes[i]]
        flags[at] = 1
        common = np.add.reduceat(flags[numbers], starts)
        flags[at] = 0
        for j in np.flatnonzero((common >= similar * (sizes + sizes[i] - common)) & (part != part[i])).tolist():
            if part[j] != part[i]:
                links.append((i, j))
                part[part == part[j]] = part[i]
    return links


def _walks(shared: DataFrame, roots: DataFrame, sets: DataFrame, similar: float, block: int) -> DataFrame:
    """u, v: links between nodes of one key that the links found so far do not join.

    The nodes of a key fall into parts that are joined. Those outside the largest part (loose) are tested against all
    others, and so each pair of nodes from two parts once or more: a grid of cells (blocks of loose nodes by blocks
    of the largest part, and blocks of loose nodes by one another), of bounded size each.
    """
    placed = written(
        shared.filter("n > 2").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("part")), "near-copy-parts"
    )
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("n"))
    parts = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("most"))
    many = parts.filter("parts > 1").select(
        "key", F.col("most.part").alias("held"), F.ceil(F.col("most.n") / block).cast("int").alias("hs"),
        F.ceil((F.col("n") - F.col("most.n")) / block).cast("int").alias("ls"),
    )
    held = F.col("part") == F.col("held")
    dealt = lambda by: F.pmod(F.xxhash64("node"), F.col(by)).cast("int")
    numbers = lambda by: F.sequence(F.lit(0), F.col(by) - 1)
    own = dealt("ls")
    # a cell is (block of loose nodes, block of the largest part) or (block of loose nodes, -1 - block of loose nodes)
    with_held = F.transform(numbers("hs"), lambda h: F.struct(own.alias("a"), h.alias("b")))
    with_loose = F.transform(numbers("ls"), lambda x: F.struct(F.least(own, x).alias("a"), (-1 - F.greatest(own, x)).alias("b")))
    of_held = F.transform(numbers("ls"), lambda x: F.struct(x.alias("a"), dealt("hs").alias("b")))
    cells = (
        placed.join(written(many, "near-copy-open"), "key")
        .select("key", "node", "part", held.alias("held"), F.explode(F.when(held, of_held).otherwise(F.concat(with_held, with_loose))).alias("cell"))
        .select("key", "cell.a", "cell.b", "node", "part", "held")
    )

    def walk(batches):
        now, rows = None, []

        def found():
            if len(rows) < 2:
                return None
            links = walked([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], similar)
            return arrow_rows({"u": (pa.int64(), [rows[i][0] for i, _ in links]), "v": (pa.int64(), [rows[j][0] for _, j in links])})

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("key", "a", "b")))
            column = batch.column("shingles")
            flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy()
            bounds = bounds - bounds[0]
            sides = zip(*(batch.column(c).to_pylist() for c in ("node", "part", "held")))
            for i, (key, (node, part, side)) in enumerate(zip(keys, sides)):
                if key != now:
                    if (out := found()) is not None:
                        yield out
                    now, rows = key, []
                rows.append((node, flat[bounds[i] : bounds[i + 1]].copy(), part, side))
        if (out := found()) is not None:
            yield out

    return (
        cells.join(sets, "node").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
        .select("key", "a", "b", "node", "part", "held", "shingles").mapInArrow(walk, "u long, v long")
    )


def without_near_copies(docs: DataFrame, *, similar: float = SIMILAR, block: int = BLOCK) -> DataFrame:
    """docs with one document, that with the smallest id, of each group of near copies; all columns stay.

    Documents link if `similar` or more of their five-word shingles (as sets) are common;
    equal word sequences, and so all documents without words, are one from the start. Candidates are the links of
    near SimHashes and the documents that share a band key: the smallest values of the shingles in
    random orders, so that only the share of common shingles counts and not the kind of edit. Every candidate is
    decided on the shingle sets: first the SimHash links and those of each document with the first of its key,
    then, in keys whose documents these do not join, all pairs of documents that are still apart.
    """
    return on_own_columns(lambda own: _near_copies_out(own, similar, block), docs)


def _near_copies_out(docs: DataFrame, similar: float, block: int) -> DataFrame:
    own = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).withColumn("__row", F.xxhash64("doc_id", "text"))
    signed = written(_texts(own), "near-copies")
    classes = signed.groupBy("node").agg(
        F.max("fp").alias("fp"), F.max("keys").alias("keys"), F.min(F.struct("__id", "__row")).alias("least")
    )
    classes = written(classes, "near-copy-classes")
    shared = written(_shared(classes), "near-copy-keys")
    first = shared.filter("node != leader").select(F.col("node").alias("u"), F.col("leader").alias("v"))
    links = written(first.union(links_of(classes.select("node", "fp"))).distinct(), "near-copy-candidates")
    nodes = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = classes.join(nodes, "node").select("node", "least.*")

    def sets(batches):
        for batch in batches:
            out = [np.unique(np.array(shingles(t, SIMILAR_WORDS), np.uint64)).view(np.int64) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.int64()))], names=["node", "shingles"])

    gathered = (
        own.select("__id", "__row", "text").join(wanted, ["__id", "__row"]).dropDuplicates(["node"]).select("node", "text")
        .mapInArrow(sets, "node long, shingles array<long>")
    )
    gathered = written(gathered, "near-copy-shingles")
    both = (
        links.join(gathered.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        .join(gathered.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    )
    common = F.size(F.array_intersect("a", "b"))
    decided = both.filter(common >= F.lit(similar) * (F.size("a") + F.size("b") - common)).select("u", "v")
    decided = written(decided, "near-copy-decided")
    more = written(_walks(shared, components(decided, "near-copy-links"), gathered, similar, block), "near-copy-walks")
    roots = components(decided.union(more), "near-copy-links")
    named = classes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "least")
    kept = written(named.groupBy("root").agg(F.min("least").alias("least")).select("least.*"), "near-copy-kept")
    return own.join(kept, ["__id", "__row"], "left_semi").dropDuplicates(["__id", "__row"]).select(*docs.columns)
