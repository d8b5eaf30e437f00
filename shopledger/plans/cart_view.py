"""Cart page: lines with localized totals, and per cart the size, shipping and grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.money import display
from shopledger.operators.recommend import shown_recommendations
from shopledger.plans.checkout import order_totals, priced_lines


def cart_lines(requests: DataFrame, cart_items: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Each line with quantity x unit price in the shopper's currency and its display text."""
    lines = priced_lines(requests, cart_items, catalog, rates)
    units, nanos = F.col("line_units"), F.col("line_nanos")
    return lines.select(
        "order_id", "product_id", "quantity", "currency_code",
        "line_units", "line_nanos",
        display(F.col("currency_code"), units, nanos).alias("line_text"),
    )


def cart_totals(requests: DataFrame, cart_items: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Per cart: number of items, shipping and grand total as shown on the page."""
    lines = priced_lines(requests, cart_items, catalog, rates)
    code = F.col("user_currency")
    return order_totals(requests, lines, rates).select(
        "order_id", "user_id", "item_count",
        display(code, F.col("shipping_units"), F.col("shipping_nanos")).alias("shipping_text"),
        display(code, F.col("total_units"), F.col("total_nanos")).alias("total_text"),
    )


def cart_recommendations(requests: DataFrame, recommended: DataFrame, catalog: DataFrame) -> DataFrame:
    """The products shown beside each cart: the first few recommended to its user."""
    shown = shown_recommendations(recommended, catalog)
    return requests.select("order_id", "user_id").join(shown, "user_id")
