"""Sequential replays against a plain loop, with keys cut over several partitions."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from shopledger.operators import replay

SECOND = 1_000_000
CALLS = "key bigint, at_us bigint, call_id bigint, failed boolean"


def calls(seed, n=3000, pause=0.02):
    """Key 0 makes a third of all calls without a break."""
    rng, now, out = random.Random(seed), {}, []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randint(1, 40)
        now[key] = now.get(key, 0) + (rng.randint(0, 3) if rng.random() > pause else 90) * SECOND
        out.append((key, now[key], i, rng.random() < 0.5))
    return out


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups.values()


def limited(rows, window, limit):
    out = {}
    for group in by_key(rows):
        kept = deque()
        for _, at, call, _ in group:
            while kept and at - kept[0] > window * SECOND:
                kept.popleft()
            out[call] = len(kept) < limit
            if out[call]:
                kept.append(at)
    return out


def broken(rows, threshold, reset):
    out = {}
    for group in by_key(rows):
        failures, until = 0, 0
        for _, at, call, failed in group:
            if at < until:
                out[call] = "blocked"
                continue
            failures = failures + 1 if failed else 0
            until = until if failed else 0
            out[call] = "allowed"
            if failed and failures >= threshold:
                until, out[call] = at + reset * SECOND, "opened"
    return out


def started(rows, lifetime):
    out = {}
    for group in by_key(rows):
        start = None
        for _, at, call, _ in group:
            if start is None or at >= start + lifetime * SECOND:
                start = at
            out[call] = start
    return out


@pytest.fixture()
def many_partitions(spark):
    """No coalescing, so that key 0 really lies in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("pause", [0.0, 0.02])
def test_against_plain_loop(spark, many_partitions, pause):
    rows = calls(5, pause=pause)
    df = spark.createDataFrame(rows, CALLS)
    got = replay.rate_limited(df, 60, 5).collect()
    assert {r.call_id: r.allowed for r in got} == limited(rows, 60, 5)
    got = replay.breaker_log(df, 3, 20).collect()
    assert {r.call_id: r.verdict for r in got} == broken(rows, 3, 20)
    got = replay.session_log(df, 45).collect()
    assert {r.call_id: int(r.session_start_us) for r in got} == started(rows, 45)


def test_hot_key_is_cut(spark, many_partitions):
    df = spark.createDataFrame(calls(5, pause=0.0), CALLS)
    labelled = replay.rate_limited(df, 60, 5).withColumn("pid", F.spark_partition_id())
    assert labelled.filter("key = 0").select("pid").distinct().count() > 1


@pytest.mark.parametrize("pause", [0.0, 0.02])
def test_labels_do_not_depend_on_the_task(spark, many_partitions, pause):
    rows = calls(7, pause=pause)
    df = spark.createDataFrame(rows, CALLS)
    limits, lifetimes = replay.rate_limited(df, 60, 5), replay.session_log(df, 45)
    want, starts = limited(rows, 60, 5), started(rows, 45)
    for moved in (lambda d: d.coalesce(1), lambda d: d.repartition(3), lambda d: d.limit(0).unionByName(d).coalesce(2)):
        assert {r.call_id: r.allowed for r in moved(limits).collect()} == want
        assert {r.call_id: int(r.session_start_us) for r in moved(lifetimes).collect()} == starts


def test_jobs_grow_with_the_logarithm_of_the_parts(spark, many_partitions):
    """Twice the parts are one round of links more, of at most eight jobs with its pass."""
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for parts in ("16", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.sparkContext.setJobGroup(f"replay-{parts}", "")
        replay.session_log(spark.createDataFrame(calls(5, pause=0.0), CALLS), 45).collect()
        jobs.append(len(tracker.getJobIdsForGroup(f"replay-{parts}")))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert jobs[1] <= jobs[0] + 2 * 8


def never(*_):
    raise AssertionError("read in sequence")


def in_step(n=4000):
    """Key 0 calls every second and makes a third of the log; key 1 calls in bursts; others pause."""
    rows = [(0, i * SECOND, i, False) for i in range(n // 3)]
    rows += [(1, (i // 50) * 20 * SECOND + i % 3, n + i, False) for i in range(n // 3)]
    return rows + [(2 + i % 9, i * 7 * SECOND, 2 * n + i, False) for i in range(n // 3)]


@pytest.mark.parametrize("lifetime", [1, 7, 45, 400, 3000])
def test_sessions_of_keys_in_step_are_not_read_in_sequence(spark, many_partitions, monkeypatch, lifetime):
    """Also lifetimes of several parts, and ones so short that every call starts a session."""
    monkeypatch.setattr(replay, "_in_sequence", lambda advance: never)
    for rows in (in_step(), calls(3, pause=0.0)):
        got = replay.session_log(spark.createDataFrame(rows, CALLS), lifetime).collect()
        assert {r.call_id: int(r.session_start_us) for r in got} == started(rows, lifetime)


def test_links_settle_many_parts(spark, many_partitions, monkeypatch):
    """A key in step lies in a dozen parts, which the passes leave open."""
    rows, settled, by_links = in_step(), [], replay._by_links

    def watched(lifetime):
        finish = by_links(lifetime)
        return lambda ordered, parts, heads, ends: settled.extend(parts) or finish(ordered, parts, heads, ends)

    monkeypatch.setattr(replay, "_by_links", watched)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    got = replay.session_log(spark.createDataFrame(rows, CALLS), 45).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.call_id: int(r.session_start_us) for r in got} == started(rows, 45)
    assert len(settled) > 8


def test_limiter_of_irregular_calls_is_not_read_in_sequence(spark, many_partitions, monkeypatch):
    """A key with a third of the log and no pause: its parts settle side by side."""
    monkeypatch.setattr(replay, "_in_sequence", lambda advance: never)
    rng, at, rows = random.Random(4), 0, []
    for i in range(12000):
        at += rng.randint(0, 3 * SECOND)
        rows.append((0, at, i, False) if i % 3 == 0 else (rng.randint(1, 500), at, i, False))
    got = replay.rate_limited(spark.createDataFrame(rows, CALLS), 60, 5).collect()
    assert {r.call_id: r.allowed for r in got} == limited(rows, 60, 5)


def test_limiter_of_keys_in_step(spark, many_partitions):
    rows = in_step()
    got = replay.rate_limited(spark.createDataFrame(rows, CALLS), 45, 7).collect()
    assert {r.call_id: r.allowed for r in got} == limited(rows, 45, 7)


def test_limiter_edges():
    stamps = [t * SECOND for t in (0, 1, 2, 61, 62)]
    assert replay.limiter(60, 2)((), stamps, [])[0] == [True, True, False, True, True]
    assert replay.limiter(60, 1)((), [0, 1], [])[0] == [True, False]
    assert replay.limiter(60, 1)((), [0, 60 * SECOND, 60 * SECOND + 1], [])[0] == [True, False, True]


def test_never_more_than_the_limit_in_a_window(spark):
    rows = calls(9)
    accepted = replay.rate_limited(spark.createDataFrame(rows, CALLS), 60, 5).filter("allowed")
    at = {r[2]: (r[0], r[1]) for r in rows}
    kept = sorted(at[r.call_id] for r in accepted.collect())
    for (k1, t1), (k2, t2) in zip(kept, kept[5:]):
        assert k1 != k2 or t2 - t1 > 60 * SECOND
