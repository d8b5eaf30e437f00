"""Toxic passages by maximal scoring segments of token log-odds.

A token's score is the log-odds of a toxic against a clean labelled document, under a chain of
Dirichlet priors: the counts of a word are smoothed by those of its five-letter beginning, these
by its four-letter beginning, and these by the share of toxic documents. The k-th occurrence of a
word in a document has a k-th of its positive score. Units are counted in
2^20 hash buckets, so the model has a fixed size whatever the vocabulary.

One pass over a document's tokens finds all maximal scoring segments. Segment scores
are compared with what clean text gives by chance: the largest score of n clean tokens follows an
extreme-value law with P(S >= x) = 1 - exp(-K n exp(-lambda x)), whose lambda and K are fitted on
labelled clean documents that gave no counts. A segment is significant if its expected number
K n exp(-lambda x) is below `SIGNIFICANT`. The document's evidence is the evidence of its best
segment plus that of all other significant ones; a logistic curve makes a score of it.

Labels are learned from at most LABELLED_ROWS labelled rows (by hash; all rows below that number).
Three quarters give counts and a quarter calibrates.

Defined results: null and empty texts have no token and get the score of no evidence; a label row
with a null in it is left out; of several labels of one document the largest holds; repeated
documents are scored each; other columns are not looked at. Labels of documents that are not in the table
count for nothing, but where the labelled documents are not of both kinds: then every score is a share of
all labels (see `learn`; 0 without labels). Without calibration rows no evidence means the toxic share.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, crc, remainder, texts

LABELLED_ROWS = 200_000  # labelled rows to learn from, at most (expected number)
BUCKETS = 1 << 20
PRIOR = 16.0  # weight of the shorter unit's share, in documents
DRIFT = 0.7  # taken off every token, so that clean text loses score
SIGNIFICANT = 0.05
CACHED_WORDS = 300_000
BINS, BIN = 600, 0.25  # evidence bins of the logistic fit

WORD = re.compile(r"\w+")


def units(word: str) -> tuple[int, int, int]:
    """Buckets of the word, its five-letter and its four-letter beginning."""
    return tuple(zlib.crc32(u.encode()) % BUCKETS for u in ("w" + word, "5" + word[:5], "4" + word[:4]))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score), left to right, in linear time.

    Each segment on the list keeps the total before it and at its end. A new positive token
    joins the nearest earlier segment with a smaller start total, if that one's end total is
    smaller too, and swallows what lies between.
    """
    ends = np.cumsum(scores)
    found: list[list] = []  # first, last + 1, total before, total at the end, link to the nearest smaller start
    for i in np.flatnonzero(scores > 0).tolist():
        first, before, after = i, float(ends[i] - scores[i]), float(ends[i])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append([first, i + 1, before, after, j])
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
    return [(f, e, after - before) for f, e, before, after, _ in found]


@dataclass
class Model:
    """Fixed-size arrays of counts and the two calibrations."""

    toxic: np.ndarray
    clean: np.ndarray
    share: float
    gumbel: tuple[float, float] = (1.0, 1.0)  # lambda, K
    curve: tuple[float, float] = (1.0, 0.0)  # slope, offset

    def word_score(self, word: str) -> float:
        share, most_a, most_b = self.share, math.inf, math.inf
        for u in reversed(units(word)):
            # a word is in no more documents than its beginning: bounds what other units add to its bucket
            a, b = min(float(self.toxic[u]), most_a), min(float(self.clean[u]), most_b)
            most_a, most_b = a, b
            share = (a + PRIOR * share) / (a + b + PRIOR)
        return math.log(share / (1 - share)) - math.log(self.share / (1 - self.share))

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, list[tuple[int, int, float]]]:
        """Evidence of a document of n tokens, and its significant segments."""
        rate, k = self.gumbel
        chance = math.log(k * max(n, 1))
        strengths = sorted((rate * s - chance for _, _, s in segments), reverse=True)
        best = strengths[0] if strengths else -chance
        threshold = -math.log(SIGNIFICANT)
        more = sum(x for x in strengths[1:] if x >= threshold)
        return best + more, [s for s in segments if rate * s[2] - chance >= threshold]

    def probability(self, evidence: float) -> float:
        slope, offset = self.curve
        return 1 / (1 + math.exp(-min(max(slope * evidence + offset, -60.0), 60.0)))


class Scorer:
    """Scores texts with a bounded cache of word scores."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def segments(self, text: str) -> tuple[list[tuple[int, int, float]], list[str]]:
        words = WORD.findall(text.lower())
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        scores = np.empty(len(words))
        times: dict[str, int] = {}
        for i, w in enumerate(words):
            s = known.get(w)
            if s is None:
                s = known[w] = self.model.word_score(w)
            if s > 0:  # the same word again is not new evidence
                times[w] = k = times.get(w, 0) + 1
                s /= k
            scores[i] = s
        scores -= DRIFT
        return maximal_segments(scores), words


def labelled_rows(labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, y: a bounded, hash-chosen set of labelled rows; one per document."""
    rows = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    n = max(rows.count(), 1)
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    return rows.filter(part < int(min(1.0, most / n) * (1 << 30)))


def learn(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", most: int = LABELLED_ROWS) -> Model | float:
    """The model from all rows of `labels` (at most about `most`) whose documents are there.

    Where these are not of both kinds, a plain share: of toxic rows among all labels and two clean ones more,
    so that few labels call no text toxic.
    """
    chosen = labelled_rows(labels, label, most)

    def kinds(rows: DataFrame) -> dict[bool, int]:
        return {r["y"] > 0: r["n"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}

    # at most about `most` rows of two numbers: a bounded broadcast, and no text is shuffled
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    totals = kinds(marked)
    if len(totals) < 2:
        told = kinds(chosen)
        return told.get(True, 0) / (sum(told.values()) + 2)
    quarter = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4)) == 0

    def count(batches):
        for batch in batches:
            sums = np.zeros((2, BUCKETS), np.int64)
            for text, y in zip(texts(batch), batch.column("y").to_pylist()):
                seen = {u for w in set(WORD.findall(text.lower())) for u in units(w)}
                if seen:
                    sums[int(y > 0), np.fromiter(seen, np.int64, len(seen))] += 1
            used = np.flatnonzero(sums.sum(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(sums[1, used]), pa.array(sums[0, used])], names=["bucket", "toxic", "clean"]
            )

    counted = (
        marked.filter(~quarter).select("text", "y").mapInArrow(count, "bucket long, toxic long, clean long")
        .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    )  # at most BUCKETS rows
    model = Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), totals[True] / (totals[True] + totals[False]))
    model.toxic[counted["bucket"].to_numpy()] = counted["toxic"].to_numpy()
    model.clean[counted["bucket"].to_numpy()] = counted["clean"].to_numpy()

    # the largest segment score of clean documents, less the logarithm of their length
    held = marked.filter(quarter).select("text", "y")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def largest(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            best, lengths = [], []
            for text in texts(batch):
                segments, words = scorer.segments(text)
                best.append(max((s for _, _, s in segments), default=0.0))
                lengths.append(math.log(max(len(words), 1)))
            yield arrow_rows({"s": (pa.float64(), best), "ln": (pa.float64(), lengths)})

    m = (
        held.filter("y <= 0").mapInArrow(largest, "s double, ln double")
        .agg(F.percentile("s", [0.5, 0.9]).alias("s"), F.avg("ln").alias("ln")).collect()[0]
    )
    if m["s"]:
        # S = (ln(K n) + G) / lambda; two quantiles of G, as the mean and variance give way to a few wrong labels
        middle, high = math.log(-math.log(0.5)), math.log(-math.log(0.9))
        rate = (middle - high) / max(m["s"][1] - m["s"][0], 1e-2)
        model.gumbel = (rate, max(math.exp(min(rate * m["s"][0] - m["ln"] + middle, 50.0)), 1e-9))
    shared.unpersist()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def bins(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            out = []
            for text in texts(batch):
                segments, words = scorer.segments(text)
                evidence, _ = scorer.model.evidence(segments, len(words))
                out.append(int(min(max(round(evidence / BIN), -BINS), BINS)))
            yield arrow_rows({"bin": (pa.int32(), out), "y": (pa.int32(), batch.column("y").to_pylist())})

    held_bins = (
        held.mapInArrow(bins, "bin int, y int").groupBy("bin")
        .agg(F.sum((F.col("y") > 0).cast("int")).alias("t"), F.count("*").alias("n")).collect()
    )
    model.curve = logistic([(r["bin"] * BIN, r["t"], r["n"]) for r in held_bins], totals[True] / (totals[True] + totals[False]))
    return model


def logistic(points: list[tuple[float, int, int]], share: float) -> tuple[float, float]:
    """Slope and offset of the likeliest curve through (x, hits, trials), slope held above zero.

    A small quadratic penalty keeps the slope finite where the classes do not overlap. Without points the
    curve gives `share` where there is no evidence.
    """
    if not points:
        return 1.0, math.log(share / (1 - share))
    x, hits, n = (np.array(c, float) for c in zip(*points))
    x = np.clip(x, -20, 20)
    beta = np.array([0.5, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta[0] * x + beta[1], -40, 40)))
        gradient = np.array([((hits - n * p) * x).sum() - beta[0] + 0.5, (hits - n * p).sum() - 0.01 * beta[1]])
        w = n * p * (1 - p)
        hessian = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.05), float(beta[1])


SCORED = "doc_id long, held_out boolean, score double, predicted int, n_tokens long, n_passages int, passages array<struct<first:int,last:int,score:double>>"


def score(docs: DataFrame, model: Model | float, *, folds: int = 5) -> DataFrame:
    """Score and significant passages (token positions) of every document."""
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not isinstance(model, Model):
        return kept.select(
            "doc_id", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"), F.lit(model).alias("score"),
            F.lit(int(model >= 0.5)).alias("predicted"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).alias("n_passages"),
            F.expr("cast(array() as array<struct<first:int,last:int,score:double>>)").alias("passages"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            values, lengths, found = [], [], []
            for text in texts(batch):
                segments, words = scorer.segments(text)
                evidence, significant = scorer.model.evidence(segments, len(words))
                values.append(scorer.model.probability(evidence))
                lengths.append(len(words))
                found.append([{"first": a, "last": b - 1, "score": s} for a, b, s in significant])
            yield arrow_rows({
                "doc_id": (pa.int64(), ids),
                "held_out": (pa.bool_(), [crc(i) % folds == 0 for i in ids]),
                "score": (pa.float64(), values),
                "predicted": (pa.int32(), [int(v >= 0.5) for v in values]),
                "n_tokens": (pa.int64(), lengths),
                "n_passages": (pa.int32(), [len(f) for f in found]),
                "passages": (pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])), found),
            })

    return kept.mapInArrow(scored, SCORED)


def toxic_documents(docs: DataFrame, labels: DataFrame, *, folds: int = 5) -> DataFrame:
    """Scores of all documents by a model that never sees the labels of fold 0."""
    training = labels.filter(remainder(F.col("doc_id"), folds) != 0)
    return score(docs, learn(docs, training), folds=folds)


def keep_clean(docs: DataFrame, model: Model | float) -> DataFrame:
    """The rows of docs, all columns unchanged, whose text scores below one half."""
    if not isinstance(model, Model):
        return docs if model < 0.5 else docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        scorer, out = Scorer(shared.value), []
        for t in text:
            segments, words = scorer.segments(t or "")
            out.append(scorer.model.probability(scorer.model.evidence(segments, len(words))[0]) < 0.5)
        return pd.Series(out, dtype=bool)

    return docs.filter(clean(F.coalesce(F.col("text"), F.lit(""))))
