"""Small tables, equal rows, clashing columns and missing labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import neighbours, sharding, stages, toxicity
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, __id string, __row string, __drop string, __spans string, others string, node string, `c.0` string"


@pytest.mark.parametrize("sizes", [(1,), (5,), (12,), (8, 1), (3, 30)])
def test_few_vectors_come_back_whole(spark, sizes):
    rng = np.random.default_rng(sum(sizes))
    rows, at = [], 0
    for length, n in zip((6, 17), sizes):
        rows += [(at + i, rng.normal(size=length)) for i in range(n)]
        at += n
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(neighbours.nearest(df, F.lit(True)).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    for length in {len(v) for _, v in rows}:
        ids = np.array([i for i, v in rows if len(v) == length])
        want = brute.nearest(ids, np.array([v for _, v in rows if len(v) == length]), ids.tolist())
        for q, near in want.items():
            if len(ids) <= 11:
                assert got.get(q, []) == [i for i, _ in near]
            else:
                assert len(got[q]) == 10


def test_equal_rows_are_shuffled_like_any_others(spark):
    rows = [(i, f"text {i}") for i in range(2_000)] + [(7, "the same")] * 1_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard_documents(docs).collect()
    sizes = np.bincount([r["shard"] for r in got], minlength=8)
    assert sizes.max() - sizes.min() <= 1
    copies = np.bincount([r["shard"] for r in got if r.size == 9 and r.doc_id == 7], minlength=8)
    # hypergeometric: 125 expected, standard deviation 8.5
    assert copies.sum() == 1_000 and abs(copies - 125).max() < 45
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
        half = [r["slot"] < len(slots) / 2 for r in got if r["shard"] == s and r.size == 9 and r.doc_id == 7]
        assert abs(sum(half) - len(half) / 2) < 35


def test_stages_keep_columns_of_any_name(spark):
    text = "one two three four five six seven eight\nand a second line here\n" + "words of a passage that comes back " * 30
    rows = [(i, t, f"a{i}", f"b{i}", f"c{i}", f"d{i}", f"e{i}", f"f{i}", f"g{i}") for i, t in enumerate([text, text, "an own text of its own", "", None, text + " x"])]
    docs = spark.createDataFrame(rows, CLASH)
    for stage in (stages.drop_repeated_lines, stages.drop_near_copies, stages.drop_repeated_passages):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        kept = got.collect()
        assert kept and all(tuple(r)[2:] == rows[r.doc_id][2:] for r in kept)


ODD = [(None, "Some words of one text"), (None, None), (7, "twin text"), (7, "twin text"), (8, ""), (9, "another text here")]


@pytest.mark.parametrize("rows", [[], ODD])
def test_every_stage_on_odd_tables(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns and got.count() <= len(rows), name
    clean = stages.drop_toxic(spark, docs, FOLDER)
    assert clean.count() == len(rows)  # no labelled document is there: nothing is called toxic
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= len(rows)


def test_the_pipeline_runs(spark):
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    ids = {r.doc_id for r in packed}
    docs = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert ids <= docs and len(ids) > len(docs) / 2
    assert all(len(r.ids) == 4 * r.length for r in packed)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_labels_without_documents(spark):
    docs = spark.createDataFrame([(None, "two words"), (1, None), (2, "twin"), (2, "twin")], "doc_id long, text string")
    others = labels_of(spark, [(100 + i, int(i < 3)) for i in range(30)])
    assert {(r.score, r.predicted) for r in toxicity.score(docs, toxicity.learn(docs, others)).collect()} == {(3 / 32, 0)}
    one = labels_of(spark, [(2, 1)])
    assert {r.predicted for r in toxicity.score(docs, toxicity.learn(docs, one)).collect()} == {0}
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels_of(spark, []))).collect()} == {0.0}


def test_without_calibration_no_evidence_means_the_base_rate(spark):
    slope, offset = toxicity.logistic([], 0.2)
    assert slope > 0 and 1 / (1 + np.exp(-offset)) == pytest.approx(0.2)
    # documents that all lie in the three quarters that give counts
    ids = [r.id for r in spark.range(200).filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)) != 0).collect()][:100]
    docs = spark.createDataFrame([(i, "awful vile words" if i == ids[0] else f"plain text {i}") for i in ids] + [(900, ""), (901, None)], "doc_id long, text string")
    got = toxicity.score(docs, toxicity.learn(docs, labels_of(spark, [(i, int(i in ids[:10])) for i in ids]))).collect()
    assert all(r.predicted == 0 for r in got if r.doc_id >= 900)
