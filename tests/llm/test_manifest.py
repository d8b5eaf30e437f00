"""The Merkle manifest against a plain tree."""

import random

import duckdb
import pytest

from shopledger.llm import manifest, queries
from tests.llm import brute

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, level int, held string, _part int, total int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA).repartition(3)


def check(spark, rows):
    got = manifest.manifest(frame(spark, rows)).drop("proof").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.manifest(rows)))
    return got


def make(n, langs, rng):
    """Rows of the languages with these shares."""
    out = []
    for i in rng.sample(range(10 * n), n):
        lang = rng.choices([x for x, _ in langs], [w for _, w in langs])[0]
        text = rng.choice([None, "", "Some Text", "lower only", "É und Ü", "Tin " * rng.randint(1, 40)])
        out.append((i, rng.choice(["a", None, "-"]), lang, rng.choice([None, 0, 12345]), text))
    return out


def test_trees_of_many_heights(spark):
    rng = random.Random(2)
    # from one node to four levels, a third of all rows in one language, a null and an empty one
    rows = make(1_300, [("en", 60), ("es", 12), (None, 5), ("", 3), ("zß", 1), *[(f"x{i}", 0.7) for i in range(20)]], rng)
    rows += [(10**6, "s", "lone", 1, "One Row")]
    got = check(spark, rows)
    assert not all(r.verified for r in got) and any(r.verified for r in got)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_language(spark, n):
    check(spark, make(n, [("en", 1)], random.Random(n)))


def test_lone_leaves(spark):
    check(spark, [(i, "s", f"lang{i:02}", 1, f"Text {i}") for i in range(11)])


def test_odd_rows(spark):
    row = (5, "s", "en", 3, "Twin")
    check(spark, [row] * 30 + [(None, "s", "en", 3, "No Id")] * 25 + [(None, None, None, None, None), (None, "s", None, 1, "x"), (5, "s", "en", 3, "other"), (6, "s", "de", 1, "A" * 200_000)])
    assert manifest.manifest(frame(spark, [])).collect() == []


def test_sql_says_the_same(spark, tmp_path):
    rows = make(700, [("en", 60), ("es", 12), (None, 5), ("", 3)], random.Random(4))
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    said = con.execute(queries.STATEMENTS["op11_merkle_manifest"])
    names = [d[0] for d in said.description]
    want = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = [tuple(dict(zip(names, r))[c] for c in want) for r in said.fetchall()]
    assert sorted(map(str, found)) == sorted(map(str, brute.manifest(rows)))


def test_plan_has_no_single_task(spark):
    got = manifest.manifest(frame(spark, make(300, [("en", 1), ("es", 1)], random.Random(1))))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan and "Cartesian" not in plan
