"""Cart table readers and writers: Parquet folders, catalog tables, databases over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopledger.operators.carts import empty_carts, upsert_cart
from shopledger.sources.catalog import checked_identifier

CART_COLUMNS = ["user_id", "product_id", "quantity"]


def read_cart_table(spark: SparkSession, config: dict) -> DataFrame:
    """Cart lines; a filter on the user is pushed to the store.

    Keys: ``path`` of a Parquet folder, or ``table``, with ``jdbc`` options when it lives in
    a database. A large database table is read in parallel when the options name a
    partition column, its bounds and the number of partitions.
    """
    if config.get("path"):
        lines = spark.read.parquet(config["path"])
    elif config.get("jdbc"):
        table = checked_identifier(config["table"])
        lines = spark.read.format("jdbc").options(**config["jdbc"], dbtable=table).load()
    else:
        lines = spark.table(checked_identifier(config["table"]))
    names = {"userId": "user_id", "productId": "product_id"}
    return lines.withColumnsRenamed(names).select(*CART_COLUMNS)


def write_cart_table(lines: DataFrame, path: str) -> None:
    """A new version of the cart table. Write it beside the version it was made from."""
    lines.select(*CART_COLUMNS).write.mode("overwrite").parquet(path)


def apply_cart_changes(
    spark: SparkSession, current_path: str, next_path: str, adds: DataFrame, emptied: DataFrame
) -> None:
    """Next version of a cart table: carts of ``emptied`` users removed, then adds merged in."""
    current = read_cart_table(spark, {"path": current_path})
    write_cart_table(upsert_cart(empty_carts(current, emptied), adds), next_path)
