"""Cart state kept up to date by a stream of cart events."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# A user's products are dealt over this many keys, so a busy user is not one task's work.
SHARES = 8


def _type(events: DataFrame, column: str) -> str:
    return events.schema[column].dataType.simpleString()


class _CartShare(StatefulProcessor):
    """State of one share of a user's products: quantity per product, ids of the stream's own type."""

    def __init__(self, product_type: str):
        self._product_type = product_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._lines = handle.getMapState("lines", f"product_id {self._product_type}", "quantity bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        user_id, last = key[0], {}
        # One micro-batch of one share; its size is set by the stream's trigger limits.
        for row in sorted(rows, key=lambda r: r["seq"]):
            if row["kind"] == "empty":
                for (product_id,) in list(self._lines.keys()):
                    last[product_id] = (0, row["seq"])
                self._lines.clear()
            else:
                product = (row["product_id"],)
                held = self._lines.getValue(product)[0] if self._lines.containsKey(product) else 0
                self._lines.updateValue(product, (held + row["quantity"],))
                last[row["product_id"]] = (held + row["quantity"], row["seq"])
        for product_id, (quantity, seq) in last.items():
            yield Row(user_id=user_id, product_id=product_id, quantity=quantity, seq=seq)

    def close(self) -> None:
        pass


def cart_updates(events: DataFrame) -> DataFrame:
    """Changed lines per micro-batch; quantity 0 means the line is gone. Ids keep the stream's types.

    An add goes to its product's share, an empty to every share of the user. The session
    needs the RocksDB state store provider.
    """
    share = F.pmod(F.xxhash64("product_id"), F.lit(SHARES)).cast("int")
    shares = F.when(F.col("kind") == "empty", F.sequence(F.lit(0), F.lit(SHARES - 1))).otherwise(F.array(share))
    product = _type(events, "product_id")
    out = f"user_id {_type(events, 'user_id')}, product_id {product}, quantity bigint, seq {_type(events, 'seq')}"
    return (
        events.withColumn("share", F.explode(shares))
        .groupBy("user_id", "share")
        .transformWithState(_CartShare(product), out, "Update", "None")
    )


def current_lines(updates: DataFrame) -> DataFrame:
    """Lines as the latest update of each left them, from a table of collected updates.

    A micro-batch gives one row per line, so the latest batch decides; the numbers of the
    events do not, as they may arrive late.
    """
    latest = updates.groupBy("user_id", "product_id").agg(F.max_by("quantity", "batch_id").alias("quantity"))
    return latest.filter(F.col("quantity") > 0)
