"""Live request metrics, live rate limiting, and catalog enrichment with hot reload."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shopledger.operators.lookup import point_lookup
from shopledger.operators.replay import limiter
from shopledger.operators.telemetry import with_route


def live_metrics(requests: DataFrame, window: str = "1 minute") -> DataFrame:
    """Requests and summed duration per window, method, route and status.

    Every request counts, however late it comes: there is no watermark, so summing the windows
    gives the batch counters and duration summary. The state is one row per window and label set.
    """
    return (
        with_route(requests)
        .groupBy(F.window("ts", window).alias("w"), "method", "route", "status")
        .agg(F.count("*").alias("requests"), F.sum("took_us").alias("sum_us"))
        .select(
            F.col("w.start").alias("window_start"), "method", "route", "status", "requests", "sum_us"
        )
    )


class _Limiter(StatefulProcessor):
    """State: times of the calls accepted within the last window, at most the limit of them."""

    def __init__(self, window_seconds: int, max_requests: int):
        self._advance = limiter(window_seconds, max_requests)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._accepted = handle.getValueState("accepted", "times array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        calls = sorted((r["at_us"], r["call_id"]) for r in rows)
        state = tuple(self._accepted.get()[0]) if self._accepted.exists() else ()
        labels, state = self._advance(state, [at for at, _ in calls], [])
        self._accepted.update((list(state),))
        for (_, call_id), allowed in zip(calls, labels):
            yield Row(key=key[0], call_id=call_id, allowed=allowed)

    def close(self) -> None:
        pass


def live_rate_limit(calls: DataFrame, window_seconds: int, max_requests: int) -> DataFrame:
    """A stream of calls(key, at_us, call_id) with ``allowed``; keys and ids keep the stream's types."""
    key, call = (calls.schema[c].dataType.simpleString() for c in ("key", "call_id"))
    return calls.groupBy("key").transformWithState(
        _Limiter(window_seconds, max_requests), f"key {key}, call_id {call}, allowed boolean", "Append", "None"
    )


def enrich_with_reload(
    load: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: look products up in a catalog read anew for every micro-batch."""

    def enrich(batch: DataFrame, batch_id: int) -> None:
        sink(point_lookup(batch, load()), batch_id)

    return enrich
