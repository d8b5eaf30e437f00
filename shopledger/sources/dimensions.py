"""Small fixed dimensions: exchange rates, ISO codes, ads. Bounded by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.fixed_values import ADS, ISO_CURRENCY_CODES, RATES_JSON


def rates_from_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects of code -> rate text, as rows (code, rate)."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    return documents.select(F.explode(parsed).alias("code", "rate_text")).select(
        "code", F.col("rate_text").cast("double").alias("rate")
    )


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return rates_from_json(spark.read.text(path, wholetext=True))


def rates(spark: SparkSession) -> DataFrame:
    """The shop's 33 rates."""
    return rates_from_json(spark.range(1).select(F.lit(RATES_JSON).alias("value")))


def iso_codes(spark: SparkSession) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in ISO_CURRENCY_CODES])
    return spark.range(1).select(F.explode(codes).alias("code"))


def ads(spark: SparkSession) -> DataFrame:
    """(category, pos, redirect_url, text, ad_no); ad_no counts all ads from 0."""
    rows = [
        F.struct(
            F.lit(category).alias("category"),
            F.lit(pos).alias("pos"),
            F.lit(url).alias("redirect_url"),
            F.lit(text).alias("text"),
            F.lit(number).alias("ad_no"),
        )
        for number, (category, pos, url, text) in enumerate(ADS)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
