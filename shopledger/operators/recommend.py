"""Recommendations: a seeded sample of the catalog without what the user has carted.

Work grows with users and cart lines, never with users x catalog: every product gets a
dense number, every user walks a pseudo-random permutation of those numbers, and only
the first ``k + (carted products)`` steps of the walk are produced. That many steps hold
at least k products outside the cart whenever the catalog has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions.seeded import digest, hex_number
from shopledger.session import scratch_path
from shopledger.sources.fixed_values import RECOMMENDED_IDS, RECOMMENDED_SHOWN

# Steps produced per row, so that no single row holds a long walk.
STEPS_PER_ROW = 256


def numbered(catalog: DataFrame, buckets: int = 4096) -> DataFrame:
    """(product_id, number): dense numbers from 0, by hash bucket and id.

    Ids are unique, so buckets are even; only the table of bucket sizes is ordered whole.
    """
    bucket = (hex_number(digest(F.col("id")), 1, 8) % buckets).cast("int")
    placed = catalog.select(F.col("id").alias("product_id"), bucket.alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "bucket",
        (F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("offset"),
    )
    within = F.row_number().over(W.partitionBy("bucket").orderBy("product_id"))
    return (
        placed.withColumn("within", within)
        .join(F.broadcast(offsets), "bucket")  # one row per bucket
        .select("product_id", (F.col("offset") + F.col("within") - 1).alias("number"))
    )


def next_prime(n: int) -> int:
    """Smallest prime >= n."""
    candidate = max(n, 2)
    while any(candidate % d == 0 for d in range(2, int(candidate**0.5) + 1)):
        candidate += 1
    return candidate


def _walks(users: DataFrame, size: int, k: int, seed: str) -> DataFrame:
    """(user_id, step, number) for users(user_id, carted): a * step + b modulo a prime."""
    prime = next_prime(size)
    hexa = digest(seed, F.col("user_id"))
    stride = hex_number(hexa, 1, 15) % max(prime - 1, 1) + 1
    start = hex_number(hexa, 17, 15) % prime
    # Numbers from size to prime - 1 belong to no product; allow for meeting all of them.
    needed = F.least(F.col("carted") + (k + prime - size), F.lit(prime).cast("bigint"))
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((needed - 1) / STEPS_PER_ROW)))
    blocks = users.select("user_id", stride.alias("a"), start.alias("b"), needed.alias("needed"), pieces.alias("piece"))
    first = F.col("piece") * STEPS_PER_ROW
    steps = F.sequence(first, F.least(first + (STEPS_PER_ROW - 1), F.col("needed") - 1))
    # A user with a very full cart has many pieces; only those are dealt out to many tasks.
    long = F.col("needed") > STEPS_PER_ROW
    dealt = blocks.filter(~long).unionByName(blocks.filter(long).repartition("user_id", "piece"))
    walked = dealt.select("user_id", "a", "b", F.explode(steps).alias("step"))
    # a * step + b stays within 63 bits for catalogs of up to three billion products.
    wide = "bigint" if prime < 3_000_000_000 else "decimal(19,0)"
    number: Column = (
        (F.col("a").cast(wide) * F.col("step").cast(wide) + F.col("b").cast(wide)) % F.lit(prime)
    ).cast("bigint")
    return walked.select("user_id", "step", number.alias("number")).filter(F.col("number") < size)


def recommend(
    users: DataFrame, cart_items: DataFrame, catalog: DataFrame, seed: str, k: int = RECOMMENDED_IDS
) -> DataFrame:
    """(user_id, rank, product_id): up to k products per user, none of them in the cart.

    The numbered catalog is written once to the shared folder and read from there.
    """
    spark = catalog.sparkSession
    path = scratch_path(spark, "numbered-catalog")
    numbered(catalog).write.parquet(path)
    numbers = spark.read.parquet(path)
    size = numbers.count()  # from the files' footers
    carted = cart_items.select("user_id", "product_id").distinct()
    sizes = carted.groupBy("user_id").agg(F.count("*").alias("carted"))
    wanted = users.select("user_id").join(sizes, "user_id", "left").fillna(0, ["carted"])
    taken = carted.join(numbers, "product_id").select("user_id", "number")
    fresh = _walks(wanted, size, k, seed).join(taken, ["user_id", "number"], "left_anti")
    order = W.partitionBy("user_id").orderBy("step")
    best = fresh.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(numbers, "number").select("user_id", "rank", "product_id")


def shown_recommendations(recommended: DataFrame, catalog: DataFrame) -> DataFrame:
    """The first few recommendations with their products; the cut comes before the join."""
    first = recommended.filter(F.col("rank") <= RECOMMENDED_SHOWN)
    products = catalog.select(F.col("id").alias("product_id"), "name", "price_usd")
    return first.join(products, "product_id")


def random_recommendations(candidates: Column, k: int = RECOMMENDED_IDS) -> Column:
    """An unseeded sample of an array of ids."""
    return F.slice(F.shuffle(candidates), 1, k)
