"""Ad selection: by context keys, random when nothing matches, then one ad per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.seeded import digest, ordinal
from shopledger.sources.fixed_values import ADS_SERVED_WITHOUT_MATCH


def context_ads(requests: DataFrame, ads: DataFrame) -> DataFrame:
    """requests(request_id, context_keys): each key's ads in key order, repeats kept."""
    keyed = requests.select("request_id", F.posexplode("context_keys").alias("key_pos", "category"))
    return keyed.join(ads, "category").select(
        "request_id", "key_pos", "pos", "category", "redirect_url", "text", "ad_no"
    )


def random_ads(requests: DataFrame, ads: DataFrame, seed: str) -> DataFrame:
    """Two ads per request, drawn with replacement."""
    total = ads.agg(F.count("*")).scalar()
    draws = F.explode(F.sequence(F.lit(0), F.lit(ADS_SERVED_WITHOUT_MATCH - 1)))
    drawn = requests.select("request_id", draws.alias("key_pos")).withColumn(
        "ad_no", ordinal(total, seed, F.col("request_id"), F.col("key_pos")).cast("int")
    )
    return drawn.join(ads, "ad_no").select(
        "request_id", "key_pos", "pos", "category", "redirect_url", "text", "ad_no"
    )


def serve_ads(requests: DataFrame, ads: DataFrame, seed: str) -> DataFrame:
    """Context ads where any key has one, else random ads."""
    by_context = context_ads(requests, ads)
    unserved = requests.join(by_context.select("request_id").distinct(), "request_id", "left_anti")
    return by_context.unionByName(random_ads(unserved, ads, seed))


def choose_ad(served: DataFrame, seed: str) -> DataFrame:
    """One of the served ads per request, each row equally likely."""
    draw = digest(seed, F.col("request_id"), F.col("key_pos"), F.col("pos"))
    return served.groupBy("request_id").agg(
        F.min_by(F.struct("ad_no", "redirect_url", "text"), draw).alias("ad")
    ).select("request_id", "ad.*")


def select_ads(requests: DataFrame, ads: DataFrame, seed: str) -> DataFrame:
    return choose_ad(serve_ads(requests, ads, seed), seed)
