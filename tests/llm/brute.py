"""Plain single-machine versions of what the operators return."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import xxhash

BLANK = " \t\n\x0b\x0c\r"
UPPER = {i: i + 32 for i in range(65, 91)}


def line_digests(rows):
    """{(doc_id, text): (n_lines, n_dropped, sha)}; ids must be distinct."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANK).translate(UPPER)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(BLANK).translate(UPPER)
            if len(key) < 10 or len(holders[key]) < 2 or i == min(holders[key]):
                kept.append(line)
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def simhash(text):
    words = [w for w in "".join(" " if c in BLANK else c for c in (text or "")).translate(UPPER).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """{doc_id: (hex, component)} by comparing all pairs of distinct fingerprints."""
    values = sorted(set(fps.values()))
    array = np.array(values, np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    at = {v: find(i) for i, v in enumerate(values)}
    for doc, fp in fps.items():
        least[at[fp]] = min(least.get(at[fp], doc), doc)
    return {doc: (f"{fp:016x}", least[at[fp]]) for doc, fp in fps.items()}


def repeated_bytes(rows, width=400):
    """{doc_id: mask}: bytes covered by a string of `width` bytes that starts at two places."""
    count = defaultdict(int)
    data = {i: (t or "").encode() for i, t in rows}
    for d in data.values():
        for s in range(len(d) - width + 1):
            count[d[s : s + width]] += 1
    out = {}
    for i, d in data.items():
        mask = np.zeros(len(d), bool)
        for s in range(len(d) - width + 1):
            if count[d[s : s + width]] > 1:
                mask[s : s + width] = True
        out[i] = mask
    return out


def nearest(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        order = np.lexsort((ids, d))
        out[q] = [(int(ids[i]), float(d[i])) for i in order if ids[i] != q][:k]
    return out


def manifest(rows, arity=8):
    """[(doc_id, leaf, subroot, root, proof_sha, folded, verified)] of (doc_id, source, lang, n_chars, text) rows."""

    def h(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def leaf(row):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def grow(nodes):
        """The top node, and each node's siblings as (left, right) by level."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for way, i in zip(ways, range(len(ways))):
                run = at[i] // arity * arity
                way.append(("".join(nodes[run : at[i]]), "".join(nodes[at[i] + 1 : run + arity])))
            nodes = [h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
            at = [a // arity for a in at]
        return nodes[0], ways

    by = defaultdict(list)
    for row in rows:
        by[row[2]].append(row)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {lang: grow([leaf(r) for r in by[lang]]) for lang in langs}
    if not langs:
        return []
    root, tops = grow([trees[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, ways = trees[lang]
        for row, way in zip(by[lang], ways):
            hit = zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0 and row[4] is not None
            now = leaf((*row[:4], row[4].translate(UPPER))) if hit else leaf(row)
            for a, b in way + top:
                now = h(a + now + b)
            out.append((row[0], leaf(row), subroot, root, h("".join(a + b for a, b in way + top)), now, now == root))
    return out
