"""Language by compression: the language whose dictionary makes a text smallest.

Each language gets a raw-content zstandard dictionary of slices from a bounded, hash-chosen sample
of its training documents. Slices that dictionaries of the other half of the sample take for
another language (foreign passages, wrong labels) are left out. A text is lower-cased, cut into pieces of PIECE bytes, and every piece
is compressed with every dictionary; the sizes of the pieces are added up, so that a long text is
judged by all of its parts. The smallest total wins; ties go to the first name. A margin below
`margin` between the two best (share of the best) marks the answer as rejected.

Bounds: about SAMPLE_DOCS documents a language, SLICES slices of SLICE code points each, and
DICTIONARY bytes a dictionary.

Defined results: a null text and a text without a letter get `und`, score 0 and no dictionary is
asked; training rows with a null language or an empty text are left out; without training rows
everything is `und`; with one language it has score 1; repeated rows are predicted each; other
columns are not looked at.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, crc, remainder, texts

SAMPLE_DOCS = 1_200
SLICES, SLICE = 4, 80  # short, so that a passage copied between documents gives no long match
DICTIONARY = 96 << 10
LEVEL = 6
PIECE = 4 << 10
MARGIN = 0.01
UNKNOWN = "und"


def slices(doc_id, text: str) -> list[str]:
    """Up to SLICES slices of a text, spread over all of it from a start that the id decides."""
    room = max(len(text) - SLICE, 0)
    start = zlib.crc32(str(doc_id).encode())
    places = sorted({(start + i * (room // SLICES + 1)) % (room + 1) for i in range(SLICES)})
    return [text[p : p + SLICE] for p in places if text[p : p + SLICE].strip()]


def learn(training: DataFrame, *, sample: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Dictionary content by language, from the columns doc_id, text, lang."""
    rows = training.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, sample / n) * (1 << 30)))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < share[F.col("lang")])

    def cut(batches):
        for batch in batches:
            ids, langs = batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist()
            out = [(lang, crc(i), i, j, s) for i, lang, t in zip(ids, langs, texts(batch)) for j, s in enumerate(slices(i, t.lower()))]
            yield arrow_rows({
                "lang": (pa.string(), [o[0] for o in out]), "turn": (pa.int64(), [o[1] * 8 + o[3] for o in out]),
                "slice": (pa.string(), [o[4] for o in out]),
            })

    found: dict[str, list] = {}
    for r in chosen.mapInArrow(cut, "lang string, turn long, slice string").collect():
        found.setdefault(r["lang"], []).append((r["turn"], r["slice"]))
    halves = [{lang: joined(sorted(set(p))[i::2]) for lang, p in sorted(found.items())} for i in (0, 1)]
    if len(found) > 1 and all(len(c) >= 8 for half in halves for c in half.values()):
        # a slice stays if the other half's dictionaries give it its label: foreign passages go
        judges = [Classifier(halves[1]), Classifier(halves[0])]
        for lang, p in found.items():
            p = sorted(set(p))
            kept = [x for i, x in enumerate(p) if judges[i % 2].predict(x[1])[0] in (lang, UNKNOWN)]
            found[lang] = kept if 2 * len(kept) > len(p) else p
    out = {lang: joined(sorted(set(p))) for lang, p in sorted(found.items())}
    return {lang: content for lang, content in out.items() if len(content) >= 8}


def joined(pieces: list[tuple[int, str]]) -> bytes:
    """The slices in turn, as many as a dictionary holds."""
    content, size = [], 0
    for _, piece in pieces:
        data = piece.encode()
        if size + len(data) <= DICTIONARY:
            content.append(data)
            size += len(data) + 1
    return b"\n".join(content)


class Classifier:
    """One compressor a language, each with its digested dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names, self.compressors = list(dictionaries), []
        for content in dictionaries.values():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def predict(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        """Language, score, rejected."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[best], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        # two bits of difference halve a rival's weight
        total = sum(2.0 ** (-4.0 * min(s - sizes[best], 250)) for s in sizes)
        return self.names[best], 1 / total, (second - sizes[best]) < margin * sizes[best]


def predict(docs: DataFrame, dictionaries: dict[str, bytes], *, folds: int = 4, held: int = 2, margin: float = MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def classified(batches):
        classifier = Classifier(shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = [classifier.predict(t, margin) for t in texts(batch)]
            yield arrow_rows({
                "doc_id": (pa.int64(), ids), "held_out": (pa.bool_(), [crc(i) % folds == held for i in ids]),
                "lang_pred": (pa.string(), [o[0] for o in out]), "score": (pa.float64(), [o[1] for o in out]),
                "rejected": (pa.bool_(), [o[2] for o in out]),
            })

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(classified, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, *, folds: int = 4, held: int = 2) -> DataFrame:
    """Languages of all documents by dictionaries from the documents outside the held-out fold."""
    return predict(docs, learn(docs.filter(remainder(F.col("doc_id"), folds) != held)), folds=folds, held=held)
