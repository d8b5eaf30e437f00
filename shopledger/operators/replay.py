"""Sequential replays: rate limiter, circuit breaker, fixed-lifetime sessions.

Each call's outcome depends on the calls of the same key before it, so a key has to be
read in order. It does not have to be labelled by one task: the log is range-partitioned on
(key, time, id), which cuts a busy key over many parts, and a part needs only the state its
predecessor ended with. A first job runs every part from an empty state; its end state is right if
the part begins a key or holds a pause after which the state is forgotten. Other parts are run
again, all at once, from the state their predecessor ended with, until that state is the one they
ran from: calls that come at irregular times lead to the same state soon, whatever it was before.
A pass has to leave at most half of its parts open. What is open after that (calls in step with the
window, where every part depends on all before) is settled by links for sessions: each call points
to the first call after its lifetime, and pointer doubling finds the starts of all parts in
log2(parts) rounds. The limiter and the breaker have no such links, their state is more than one
call; they read those parts in sequence, one stream per key. Rows carry the number of their part,
so that labels do not depend on the task that makes them. Parts are read as Arrow batches, so
memory does not grow with the calls of a key; links hold one part's times, eight bytes a call.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.session import checkpoint_root, written

MICROS = 1_000_000
# (state, times, flags) -> (one label per time, state after the last time).
Advance = Callable[[tuple, list, list], tuple[list, tuple]]


class Part(NamedTuple):
    """A part as run from an empty state."""

    first: object  # its first key
    last: object  # its last key
    state: tuple  # after its last call
    forgets: bool  # no state from before it matters after it
    until: int  # time of its last call


# (ordered log, parts in order, state before the first part of each chain, all parts) -> state after each part.
Finish = Callable[[DataFrame, list[int], dict[int, tuple], dict[int, Part]], dict[int, tuple]]


def limiter(window_seconds: int, max_requests: int) -> Advance:
    """Accept a call when fewer than the limit were accepted within the window before it.

    A call exactly one window old still counts; rejected calls do not.
    """
    window = window_seconds * MICROS

    def advance(state: tuple, times: list, _flags: list) -> tuple[list, tuple]:
        accepted, labels = deque(state), []
        for now in times:
            while accepted and now - accepted[0] > window:
                accepted.popleft()
            allowed = len(accepted) < max_requests
            if allowed:
                accepted.append(now)
            labels.append(allowed)
        return labels, tuple(accepted)

    return advance


def breaker(threshold: int, reset_seconds: int) -> Advance:
    """Label calls allowed, opened (the failure that opens) or blocked. Flags mark failures.

    Failures stay counted while open, so after expiry the next failure opens at once.
    """
    reset = reset_seconds * MICROS

    def advance(state: tuple, times: list, flags: list) -> tuple[list, tuple]:
        failures, open_until = state or (0, 0)
        labels = []
        for now, failed in zip(times, flags):
            if now < open_until:
                labels.append("blocked")
            elif not failed:
                failures, open_until = 0, 0
                labels.append("allowed")
            else:
                failures = min(failures + 1, threshold)
                opened = failures >= threshold
                open_until = now + reset if opened else open_until
                labels.append("opened" if opened else "allowed")
        # An expired opening acts like none; one value for both lets boundaries agree sooner.
        return labels, (failures, open_until if open_until > times[-1] else 0)

    return advance


def sessions(lifetime_seconds: int) -> Advance:
    """Label calls with the start of their session; a session is not extended by use."""
    lifetime = lifetime_seconds * MICROS

    def advance(state: tuple, times: list, _flags: list) -> tuple[list, tuple]:
        start, labels = (state[0] if state else None), []
        for now in times:
            if start is None or now >= start + lifetime:
                start = now
            labels.append(start)
        return labels, (start,)

    return advance


def replay(
    calls: DataFrame, advance: Advance, label_type: str, pause_us: int | None = None, finish: Finish | None = None
) -> DataFrame:
    """calls(key, at_us, call_id, flag) with ``label`` added. A call without a key is an error.

    After a pause of more than ``pause_us`` the state must not matter any more; None where it
    always does. ``finish`` settles parts that depend on all before; None reads them in sequence. Runs jobs while the plan is built: the ordered log is checkpointed, because
    the parts must be the same ones in every pass. The checkpoint goes with the result where
    spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    checkpoint_root(calls.sparkSession)
    order = ["key", "at_us", "call_id"]
    keyed = calls.withColumn("key", F.coalesce("key", F.raise_error(F.lit("a call has no key"))))
    ordered = (
        keyed.select(*order, "flag").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).checkpoint()
    )
    entries = _entry_states(ordered, advance, pause_us, finish or _in_sequence(advance))
    kept = ordered.drop("part").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + f", label {label_type}"

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, ()
        for batch in batches:
            labels = []
            for (part, key), rows in batch.groupby(["part", "key"], sort=False):
                if (part, key) != now:
                    held = entries.get(part, (None, ()))
                    # Only a part's first key can go on from the part before.
                    state = held[1] if held[0] == key else ()
                    now = (part, key)
                got, state = advance(state, rows["at_us"].tolist(), rows["flag"].tolist())
                labels += got
            yield batch.drop(columns="part").assign(label=labels)

    return ordered.mapInPandas(label, schema)


def _entry_states(ordered: DataFrame, advance: Advance, pause_us: int | None, finish: Finish) -> dict[int, tuple]:
    """Per part the (key, state) it goes on from. One small row per part and pass is collected."""
    ends = _ends(ordered, advance, pause_us)
    before = {b: a for a, b in pairwise(sorted(ends)) if ends[a].last == ends[b].first}
    carried = [p for p in before if ends[p].first == ends[p].last and not ends[p].forgets]
    after = {p: end.state for p, end in ends.items()}
    ran = dict.fromkeys(carried, ())  # the state each was last run from
    most = len(carried)
    while (stale := [p for p in carried if ran[p] != after[before[p]]]) and len(stale) <= most:
        most = len(stale) // 2
        ran |= {p: after[before[p]] for p in stale}
        after |= _after(ordered.filter(F.col("part").isin(stale)), advance, ran)
    if stale:
        # Up to its first stale part a chain is settled, since its first part has the right state before it.
        behind = set(stale)
        for part in carried:
            if before[part] in behind:
                behind.add(part)
        heads = {p: after[before[p]] for p in sorted(behind) if before[p] not in behind}
        after |= finish(ordered, sorted(behind), heads, ends)
    return {p: (ends[p].first, after[before[p]]) for p in before}


def _ends(ordered: DataFrame, advance: Advance, pause_us: int | None) -> dict[int, Part]:

    def last_state(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, first, key, state, at, forgets = None, None, None, (), None, False

        def row() -> pd.DataFrame:
            return pd.DataFrame(
                {"part": [part], "first_key": [first], "last_key": [key], "state": [list(state)], "forgets": [forgets], "until": [at]}
            )

        for batch in batches:
            for number, held in batch.groupby("part", sort=False):
                if number != part:
                    if part is not None:
                        yield row()
                    part, first, key, state, at, forgets = number, held["key"].iloc[0], None, (), None, False
                last = held["key"].iloc[-1]
                rows = held[held["key"] == last]  # only the last key's state leaves the part
                times = rows["at_us"].tolist()
                if last != key:
                    forgets, state, at = first != last, (), None
                if pause_us is not None and not forgets:
                    steps = zip([at] * (at is not None) + times, times[at is None :])
                    forgets = any(b - a > pause_us for a, b in steps)
                _, state = advance(state, times, rows["flag"].tolist())
                key, at = last, times[-1]
        if part is not None:
            yield row()

    key_type = ordered.schema["key"].dataType.simpleString()
    rows = ordered.mapInPandas(
        last_state, f"part int, first_key {key_type}, last_key {key_type}, state array<bigint>, forgets boolean, until bigint"
    ).collect()
    return {r["part"]: Part(r["first_key"], r["last_key"], tuple(r["state"]), r["forgets"], r["until"]) for r in rows}


def _after(parts: DataFrame, advance: Advance, entries: dict[int, tuple]) -> dict[int, tuple]:
    """State after each of the given parts, each held by one key; a part that is no entry goes on from the one before."""

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, ()
        for batch in batches:
            ends = []
            for (key, part), rows in batch.groupby(["key", "part"], sort=False):
                if (key, part) != now:
                    if now is not None:
                        ends.append((now[1], list(state)))
                    state = entries.get(part, state)
                    now = (key, part)
                _, state = advance(state, rows["at_us"].tolist(), rows["flag"].tolist())
            yield pd.DataFrame(ends, columns=["part", "state"])
        if now is not None:
            yield pd.DataFrame([(now[1], list(state))], columns=["part", "state"])

    return {r["part"]: tuple(r["state"]) for r in parts.mapInPandas(carry, "part int, state array<bigint>").collect()}


def _in_sequence(advance: Advance) -> Finish:
    """A key's open parts are read in order by one task."""

    def finish(ordered: DataFrame, parts: list[int], heads: dict[int, tuple], ends: dict[int, Part]) -> dict[int, tuple]:
        open_parts = ordered.filter(F.col("part").isin(parts))
        return _after(
            open_parts.repartition("key").sortWithinPartitions("key", "at_us", "call_id"), advance, heads
        )

    return finish


def _by_links(lifetime: int) -> Finish:
    """Sessions: the start before a part decides the first start in it, which decides the last.

    Every call that can be a part's first start (those within a lifetime of its first call) is a
    node with the last start it leads to, and points to the first start in a later part. Doubling
    the pointers marks the starts that the chain's first state leads to, at most one a part.
    """

    def finish(ordered: DataFrame, parts: list[int], heads: dict[int, tuple], ends: dict[int, Part]) -> dict[int, tuple]:
        chains: dict[int, tuple[list, list]] = {}
        chain_of = {}
        for part in parts:
            head = part if part in heads else head
            chain_of[part] = head
            numbers, untils = chains.setdefault(head, ([], []))
            numbers.append(part)
            untils.append(ends[part].until)

        def holder(head: int, at: int) -> int | None:
            """The chain's first part with a call at that time or later."""
            numbers, untils = chains[head]
            i = bisect_left(untils, at)
            return numbers[i] if i < len(numbers) else None

        def nodes_of(part: int, times: np.ndarray) -> pd.DataFrame:
            at = np.unique(times)
            n = np.searchsorted(at, at + lifetime)
            last = np.where(n < len(at), n, np.arange(len(at)))
            while not np.array_equal(further := last[last], last):
                last = further
            firsts = np.searchsorted(at, at[0] + lifetime) + 1
            ended = at[last[:firsts]]
            wanted = ended + lifetime
            to = [holder(chain_of[part], int(w)) for w in wanted]
            return pd.DataFrame({
                "part": part, "at": at[:firsts], "last": ended, "to_part": pd.array(to, "Int32"), "wanted": wanted,
            })

        def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now, held = None, []
            for batch in batches:
                for part, rows in batch.groupby("part", sort=False):
                    if part != now:
                        if held:
                            yield nodes_of(now, np.concatenate(held))
                        now, held = int(part), []
                    held.append(rows["at_us"].to_numpy())
            if held:
                yield nodes_of(now, np.concatenate(held))

        spark = ordered.sparkSession
        found = written(
            ordered.filter(F.col("part").isin(parts))
            .mapInPandas(nodes, "part int, at bigint, last bigint, to_part int, wanted bigint"), "session-nodes"
        )
        # Where a part's last start leads to: the smallest node of that part at the wanted time or later.
        seeds = [(holder(head, start + lifetime), start + lifetime, None, None) for head, (start,) in heads.items()]
        asked = found.select("to_part", "wanted", "part", "last").distinct().union(
            spark.createDataFrame(seeds, "to_part int, wanted bigint, part int, last bigint")
        ).filter("to_part IS NOT NULL")
        places = asked.select("to_part", "wanted", "part", "last", F.lit(1).alias("kind")).union(
            found.select("part", "at", F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(0))
        )
        later = Window.partitionBy("to_part").orderBy(F.desc("wanted"), "kind")
        node = F.last(F.when(F.col("kind") == 0, F.col("wanted")), ignorenulls=True).over(later)
        links = written(places.withColumn("to_at", node).filter("kind = 1").select("part", "last", "to_part", "to_at"), "session-links")
        marked = links.filter("part IS NULL").select(F.col("to_part").alias("part"), F.col("to_at").alias("at"))
        jumps = found.select("part", "at", "last").join(links, ["part", "last"]).select("part", "at", "to_part", "to_at")
        reach = 1
        while reach < max(len(numbers) for numbers, _ in chains.values()):
            jumps = written(jumps, "session-jumps")
            hops = marked.join(jumps, ["part", "at"]).select(F.col("to_part").alias("part"), F.col("to_at").alias("at"))
            marked = written(marked.union(hops).distinct(), "session-marks")
            onward = jumps.toDF("to_part", "to_at", "part2", "at2")
            jumps = jumps.join(onward, ["to_part", "to_at"]).select("part", "at", F.col("part2").alias("to_part"), F.col("at2").alias("to_at"))
            reach *= 2
        starts = {r["part"]: (r["last"],) for r in marked.join(found, ["part", "at"]).select("part", "last").collect()}
        after, state = {}, ()
        for part in parts:
            # A part without a start of its own lies within the session before it.
            after[part] = state = starts.get(part, heads.get(part, state))
        return after

    return finish


def rate_limited(calls: DataFrame, window_seconds: int, max_requests: int) -> DataFrame:
    """calls(key, at_us, call_id) with ``allowed``."""
    return replay(
        calls.withColumn("flag", F.lit(False)), limiter(window_seconds, max_requests), "boolean", window_seconds * MICROS
    ).select("key", "call_id", F.col("label").alias("allowed"))


def breaker_log(calls: DataFrame, threshold: int, reset_seconds: int) -> DataFrame:
    """calls(key, at_us, call_id, failed) with ``verdict``."""
    return replay(
        calls.withColumnRenamed("failed", "flag"), breaker(threshold, reset_seconds), "string"
    ).select("key", "call_id", F.col("flag").alias("failed"), F.col("label").alias("verdict"))


def session_log(calls: DataFrame, lifetime_seconds: int) -> DataFrame:
    """calls(key, at_us, call_id) with the start of the session each call falls into."""
    lifetime = lifetime_seconds * MICROS
    labelled = replay(
        calls.withColumn("flag", F.lit(False)), sessions(lifetime_seconds), "bigint", lifetime,
        _by_links(lifetime) if lifetime > 0 else None,
    )
    return labelled.select("key", "call_id", "at_us", F.col("label").alias("session_start_us"))
