"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows lie in blocks (a hash of the row decides the block). How many rows each block sends to
each shard is drawn from the exact law of a uniform shuffle: row by row, a multivariate
hypergeometric draw over the places still free in the shards. Then every block orders its rows
at random and deals them out by these counts, the rows are exchanged, and every shard orders
what it has got at random again. The order inside a shard is made in cells: a row picks a cell at
random, each cell is ordered at random, and cells follow one another, which is a uniform order
too, and no task holds a whole shard.

Law `rows`: shard sizes differ by one at most. Only ids, sizes and checksums are moved, never texts.

A row's random numbers are hashes of its columns and its number among rows that are equal in all of them, so such
rows fall apart like any others, and the same rows give the same shuffle, however they are read.

Defined results: a null text has size 1 (0 bytes plus 1) and the checksum of the empty text; null
and repeated ids and equal rows are rows like any other; an empty table gives an empty result; other columns of
the input are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shopledger.llm.common import written

BLOCK_ROWS = 1_024  # rows a block holds on average, as long as there are at most MOST_BLOCKS
EQUAL_ROWS = 1 << 16  # rows equal in all columns that are numbered at a time
MOST_BLOCKS = 100_000  # bounds the matrix on the driver; beyond, blocks grow


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """Number of good items among `taken` of good + bad, for populations of any size.

    Weights run outwards from the mode by their exact ratios over 14 standard deviations
    and are normalised, so no factorial of a large number is needed.
    """
    low, high = max(0, taken - bad), min(taken, good)
    if low >= high:
        return low
    total = good + bad
    mode = min(max((taken + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(taken * (good / total) * (bad / total) * max(total - taken, 1) / max(total - 1, 1))
    reach = int(14 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)  # log weight of k + 1 over that of k
    ratio = (np.log(good - k) + np.log(taken - k)) - (np.log(k + 1) + np.log(bad - taken + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    weights = np.exp(logs - logs.max())
    return int(first + np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right").clip(0, last - first))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """counts[block][shard] with the given row and column sums, drawn exactly."""
    rng = np.random.default_rng(seed)
    free = list(shards)
    matrix = []
    for rows in blocks:
        counts, left, others = [], rows, sum(free)
        for s, places in enumerate(free):
            others -= places
            counts.append(draw_hypergeometric(rng, places, others, left) if others else left)
            left -= counts[-1]
        free = [a - b for a, b in zip(free, counts)]
        matrix.append(counts)
    return matrix


def shuffled_shards(keys: DataFrame, shards: int, seed: int, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """keys with `shard` and `slot`; the column `draw` (a 64-bit hash of the row) must be there.

    Rows with equal `draw` are ordered by all other columns.
    """
    spark = keys.sparkSession
    n = keys.count()
    blocks = max(1, math.ceil(n / max(block_rows, n / MOST_BLOCKS)))
    ties = [F.col(c) for c in keys.columns if c != "draw"]

    def random(step: int):
        return F.xxhash64(F.lit(seed + step), F.col("draw"))

    dealt = keys.withColumn("block", F.pmod(random(1), F.lit(blocks)).cast("int"))
    found = {r["block"]: r["n"] for r in dealt.groupBy("block").agg(F.count("*").alias("n")).collect()}
    names = sorted(found)
    sizes = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([found[b] for b in names], sizes, seed)
    bounds = spark.createDataFrame(
        [(b, np.cumsum(counts).tolist()) for b, counts in zip(names, matrix)],
        T.StructType([T.StructField("block", T.IntegerType()), T.StructField("bounds", T.ArrayType(T.LongType()))]),
    )
    local = Window.partitionBy("block").orderBy(random(2), "draw", *ties)
    cells = max(1, math.ceil(max(sizes, default=0) / max(block_rows, n / MOST_BLOCKS)))
    placed = (
        dealt.withColumn("place", F.row_number().over(local) - 1)
        .join(bounds, "block")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("place"))))
        .withColumn("cell", F.pmod(random(3), F.lit(cells)).cast("int"))
        .drop("block", "place", "bounds")
    )
    placed = written(placed, "shards")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
        .select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    again = Window.partitionBy("shard", "cell").orderBy(random(4), "draw", *ties)
    return (
        placed.withColumn("place", F.row_number().over(again) - 1)
        .join(starts, ["shard", "cell"])
        .withColumn("slot", (F.col("start") + F.col("place")).cast("long"))
        .drop("cell", "place", "start", "draw")
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 42, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # equal rows are counted and numbered: they are rows like any other
    columns = keys.columns
    keys = keys.groupBy(*columns).agg(F.count("*").alias("copies"))
    first = F.explode(F.sequence(F.lit(1).cast("long"), "copies", F.lit(EQUAL_ROWS).cast("long"))).alias("first")
    keys = keys.select(*columns, "copies", first).repartition(*columns, "first")
    keys = keys.select(*columns, F.explode(F.sequence("first", F.least("copies", F.col("first") + (EQUAL_ROWS - 1)))).alias("row"))
    keys = keys.withColumn("draw", F.xxhash64(F.lit(seed), F.isnull("doc_id"), *columns, "row"))
    placed = shuffled_shards(written(keys, "shard-keys"), shards, seed, block_rows=block_rows)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
