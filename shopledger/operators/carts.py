"""Cart tables: merge, upsert, delete, replay of the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of a user that meet the user's row in one task, as long as few users have more.
USER_ROWS, HOT_USERS = 1_000_000, 4_096


def join_users(rows: DataFrame, users: DataFrame, how: str, differing: list[str], user_rows: int = USER_ROWS) -> DataFrame:
    """``rows`` joined on user_id with a table of one row per user.

    Users with more than ``user_rows`` rows (the 4,096 with most of them; no other has more than a 4,096th
    of all rows) are dealt out by the ``differing`` columns over as many tasks as their rows
    need, and their own row is copied as often; all others are copied once. Spark's own splitting
    of skewed joins does not apply here: it needs both sides to come straight from a shuffle, and
    the users usually come from an aggregate.
    """
    shares = F.coalesce("_shares", F.lit(1))
    hot = hot_users(rows, user_rows)
    salted = rows.join(hot, "user_id", "left").withColumn("_salt", F.pmod(F.xxhash64(*differing), shares).cast("int")).drop("_shares")
    return salted.join(user_copies(rows, users, user_rows), ["user_id", "_salt"], how).drop("_salt")


def hot_users(rows: DataFrame, user_rows: int) -> DataFrame:
    """(user_id, _shares) of users with more rows; HOT_USERS at most, so they can be broadcast."""
    counts = rows.groupBy("user_id").agg(F.count("*").alias("n")).filter(F.col("n") > user_rows)
    most = counts.orderBy(F.desc("n"), "user_id").limit(HOT_USERS)
    return F.broadcast(most.select("user_id", F.ceil(F.col("n") / user_rows).cast("int").alias("_shares")))


def user_copies(rows: DataFrame, users: DataFrame, user_rows: int) -> DataFrame:
    """users with ``_salt``: a copy for each share of the user's rows."""
    shares = F.coalesce("_shares", F.lit(1))
    copied = users.join(hot_users(rows, user_rows), "user_id", "left")
    return copied.withColumn("_salt", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")


def merge_lines(lines: DataFrame, owner: str = "user_id") -> DataFrame:
    """One line per (owner, product) with the summed quantity."""
    return lines.groupBy(owner, "product_id").agg(F.sum("quantity").alias("quantity"))


def upsert_cart(current: DataFrame, adds: DataFrame) -> DataFrame:
    """Current lines plus added quantities."""
    columns = ["user_id", "product_id", "quantity"]
    return merge_lines(current.select(*columns).unionByName(adds.select(*columns)))


def empty_carts(current: DataFrame, users: DataFrame) -> DataFrame:
    """Lines of all users but the given ones."""
    return join_users(current, users.select("user_id"), "left_anti", ["product_id"])


def cart_of(current: DataFrame, users: DataFrame) -> DataFrame:
    """Lines of the given users; a user without lines has an empty cart."""
    return join_users(current, users.select("user_id"), "left_semi", ["product_id"])


def cart_size(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id").agg(F.sum("quantity").alias("cart_size"))


def cart_state(events: DataFrame) -> DataFrame:
    """Carts after a log of (seq, user_id, kind add|empty, product_id, quantity).

    An add counts when it comes after the user's last empty. Order of arrival does not
    matter, and the lines keep the seq of their first counted add.
    """
    last_empty = (
        events.filter(F.col("kind") == "empty").groupBy("user_id").agg(F.max("seq").alias("emptied"))
    )
    adds = events.filter(F.col("kind") == "add")
    live = join_users(adds, last_empty, "left", ["seq"]).filter(
        F.col("emptied").isNull() | (F.col("seq") > F.col("emptied"))
    )
    return live.groupBy("user_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.min("seq").alias("first_seq")
    )
