"""Currency conversion of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.fx import converted
from shopledger.sources.fixed_values import ALLOWED_CURRENCIES, DEFAULT_CURRENCY


def _with_rate(df: DataFrame, rates: DataFrame, code: Column | str, name: str) -> DataFrame:
    """Adds the rate of a code column, or of one code that holds for the whole table."""
    if isinstance(code, str):
        row = rates.filter(F.col("code") == code).first()
        return df.withColumn(name, F.lit(row["rate"] if row else None).cast("double"))
    # There are at most as many rates as currencies.
    listed = F.broadcast(rates.select(F.col("code").alias("_code"), F.col("rate").alias(name)))
    return df.join(listed, code == F.col("_code"), "left").drop("_code")


def convert_money(
    df: DataFrame,
    units: Column,
    nanos: Column,
    from_code: Column | str,
    to_code: Column | str,
    rates: DataFrame,
    prefix: str = "converted",
) -> DataFrame:
    """Adds ``<prefix>_units``, ``<prefix>_nanos`` and ``<prefix>_reason`` (NULL when fine).

    Codes are columns, or plain strings where one currency holds for the whole table.
    """
    priced = _with_rate(_with_rate(df, rates, from_code, "_from_rate"), rates, to_code, "_to_rate")
    reason = F.when(
        F.col("_from_rate").isNull() | F.col("_to_rate").isNull(), F.lit("unsupported_currency")
    ).when((units < 0) | (nanos < 0), F.lit("negative_amount"))
    out_units, out_nanos = converted(units, nanos, F.col("_from_rate"), F.col("_to_rate"))
    return (
        priced.withColumn(f"{prefix}_reason", reason)
        .withColumn(f"{prefix}_units", F.when(reason.isNull(), out_units))
        .withColumn(f"{prefix}_nanos", F.when(reason.isNull(), out_nanos).cast("int"))
        .drop("_from_rate", "_to_rate")
    )


def offered_rates(rates: DataFrame) -> DataFrame:
    """Rates of the currencies a shopper may pick."""
    return rates.filter(F.col("code").isin(ALLOWED_CURRENCIES))


def preferred_currency(preference: Column) -> Column:
    return F.coalesce(preference, F.lit(DEFAULT_CURRENCY))


def price_list(catalog: DataFrame, codes: list[str], rates: DataFrame) -> DataFrame:
    """Every product with its price in each of a few given currencies."""
    wanted = F.explode(F.array(*[F.lit(c) for c in codes])).alias("currency_code")
    listed = catalog.select("id", "name", "price_usd", wanted)
    price = F.col("price_usd")
    return convert_money(
        listed, price["units"], price["nanos"], price["currency_code"], F.col("currency_code"), rates, "price"
    ).drop("price_usd")
