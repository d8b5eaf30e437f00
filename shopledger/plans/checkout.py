"""Checkout: price carts in the buyer's currency, add shipping, screen the card, issue orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.money import exact_sum, nanos_of, times, total_nanos, units_of
from shopledger.functions.shipping import address_text, quote_nanos, quote_units, tracking_id
from shopledger.operators.exchange import convert_money
from shopledger.operators.validation import screen_payments
from shopledger.sources.fixed_values import DEFAULT_CURRENCY


def priced_lines(requests: DataFrame, cart_items: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Cart lines of the requests with their unit price in the buyer's currency.

    Adds unit_units, unit_nanos, line_units, line_nanos (quantity x unit) and line_reason.
    The catalog is joined first so that the join on the order leaves the rows where the
    per-order sums need them. Only the two columns needed of each request are moved.
    """
    products = catalog.select(F.col("id").alias("_id"), F.col("price_usd").alias("_price"))
    buyers = requests.select("order_id", F.col("user_currency").alias("currency_code"))
    lines = (
        cart_items.select("order_id", "product_id", "quantity")
        .join(products, F.col("product_id") == F.col("_id"), "left")
        .join(buyers, "order_id")
    )
    price = F.col("_price")
    localized = convert_money(
        lines, price["units"], price["nanos"], price["currency_code"], F.col("currency_code"), rates, "unit"
    )
    reason = (
        F.when(F.col("_id").isNull(), F.lit("unknown_product"))
        .when(F.col("quantity") < 1, F.lit("invalid_quantity"))
        .otherwise(F.col("unit_reason"))
    )
    line_units, line_nanos = times(F.col("unit_units"), F.col("unit_nanos"), F.col("quantity"))
    return localized.select(
        "order_id", "product_id", "quantity", "currency_code", "unit_units", "unit_nanos",
        line_units.alias("line_units"), line_nanos.alias("line_nanos"), reason.alias("line_reason"),
    )


def merged_lines(priced: DataFrame) -> DataFrame:
    """Priced lines of a product in an order as one, with their number (`lines`)."""
    merged = priced.groupBy("order_id", "product_id", "currency_code", "unit_units", "unit_nanos").agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("lines"), F.min("line_reason").alias("line_reason")
    )
    line_units, line_nanos = times(F.col("unit_units"), F.col("unit_nanos"), F.col("quantity"))
    return merged.withColumn("line_units", line_units).withColumn("line_nanos", line_nanos)


def order_totals(requests: DataFrame, lines: DataFrame, rates: DataFrame) -> DataFrame:
    """Requests with item count, shipping and total; an empty cart is an order of total 0.

    ``prep_reason`` is set when a line or the shipping could not be priced; such a request has
    neither shipping nor total.
    """
    count = F.sum("lines") if "lines" in lines.columns else F.count("*")
    sums = lines.groupBy("order_id").agg(
        exact_sum(F.col("line_units"), F.col("line_nanos")).alias("items_nanos"),
        F.sum("quantity").alias("item_count"),
        count.alias("line_count"),
        F.min("line_reason").alias("line_reason"),
    )
    carts = requests.join(sums, "order_id", "left").fillna(0, ["item_count", "line_count"])
    shipped = convert_money(
        carts.withColumn("_units", quote_units(F.col("item_count"))).withColumn(
            "_nanos", quote_nanos(F.col("item_count"))
        ),
        F.col("_units"), F.col("_nanos"), DEFAULT_CURRENCY, F.col("user_currency"), rates, "shipping",
    )
    items = F.coalesce("items_nanos", F.lit(0).cast("decimal(38,0)"))
    total = items + total_nanos(F.col("shipping_units"), F.col("shipping_nanos"))
    reason = F.coalesce("line_reason", "shipping_reason")
    whole = reason.isNull()
    return (
        shipped.withColumn("_total", F.when(whole, total.cast("decimal(38,0)")))
        .withColumn("total_units", units_of(F.col("_total")))
        .withColumn("total_nanos", nanos_of(F.col("_total")))
        .withColumn("shipping_units", F.when(whole, F.col("shipping_units")))
        .withColumn("shipping_nanos", F.when(whole, F.col("shipping_nanos")))
        .withColumn("prep_reason", reason)
        .drop("_units", "_nanos", "_total", "items_nanos", "line_reason", "shipping_reason")
    )


def place_orders(
    requests: DataFrame,
    cart_items: DataFrame,
    catalog: DataFrame,
    rates: DataFrame,
    as_of: date,
    seed: str = "ship",
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per request with ``decision``, ``reason`` and, when accepted, a tracking id.

    A request fails as a whole: on a line that cannot be priced, or on its card. ``lines`` are the
    priced lines, where the caller has them already.
    """
    if lines is None:
        lines = priced_lines(requests, cart_items, catalog, rates)
    screened = screen_payments(order_totals(requests, lines, rates), as_of)
    reason = F.coalesce("prep_reason", "reason")
    address = address_text(F.col("street_address"), F.col("city"), F.col("state"))
    tracking = tracking_id(F.col("order_id"), address, seed)
    return (
        screened.withColumn("reason", reason)
        .withColumn("decision", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
        .withColumn("transaction_id", F.when(F.col("reason").isNull(), F.col("transaction_id")))
        .withColumn("tracking_id", F.when(F.col("reason").isNull(), tracking))
        .drop("prep_reason")
    )


def issue_orders(
    requests: DataFrame,
    cart_items: DataFrame,
    catalog: DataFrame,
    rates: DataFrame,
    as_of: date,
    seed: str = "ship",
) -> tuple[DataFrame, DataFrame]:
    """(orders, items): all requests as `place_orders` decides them, and the items of the accepted ones.

    Lines are scanned and priced once: totals and items are both made of the lines merged by product, with the
    same columns, so that Spark reuses their shuffle. It is dealt out by order and product,
    so an order of very many lines does not gather in one task.
    """
    merged = merged_lines(priced_lines(requests, cart_items, catalog, rates))
    orders = place_orders(requests, cart_items, catalog, rates, as_of, seed, merged)
    # an accepted order has no line with a reason; asking for it keeps the columns of both uses the same
    return orders, order_items(orders, merged.filter(F.col("line_reason").isNull() & (F.col("lines") > 0)))


def accepted(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("reason").isNull())


def rejected(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("reason").isNotNull())


def emptied_carts(orders: DataFrame) -> DataFrame:
    """Users whose cart an accepted order has used up, for ``apply_cart_changes``."""
    return accepted(orders).select("user_id").distinct()


def order_heads(orders: DataFrame) -> DataFrame:
    """Accepted orders as issued, without their items."""
    return accepted(orders).select(
        "order_id",
        F.col("tracking_id").alias("shipping_tracking_id"),
        F.struct(
            F.col("user_currency").alias("currency_code"),
            F.col("shipping_units").alias("units"),
            F.col("shipping_nanos").alias("nanos"),
        ).alias("shipping_cost"),
        F.struct("street_address", "city", "state", "country", "zip_code").alias("shipping_address"),
    )


def order_items(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Items of accepted orders, a row per order and product: (order_id, item, cost).

    A flat table, so that no row grows with its order; lines of a product are merged.
    """
    merged = lines if "lines" in lines.columns else merged_lines(lines)
    item = F.struct("product_id", "quantity").alias("item")
    cost = F.struct("currency_code", F.col("unit_units").alias("units"), F.col("unit_nanos").alias("nanos")).alias("cost")
    return merged.join(accepted(orders).select("order_id"), "order_id", "left_semi").select("order_id", item, cost)


def recomputed_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Accepted orders with shipping + sum of unit cost x quantity over the items as issued.

    ``agrees`` tells whether that is the total the order was charged.
    """
    units, nanos = times(F.col("cost.units"), F.col("cost.nanos"), F.col("item.quantity"))
    sums = items.select("order_id", units.alias("u"), nanos.alias("n")).groupBy("order_id").agg(
        exact_sum(F.col("u"), F.col("n")).alias("items_nanos")
    )
    shipping = total_nanos(F.col("shipping_units"), F.col("shipping_nanos"))
    again = shipping + F.coalesce("items_nanos", F.lit(0).cast("decimal(38,0)"))
    stored = total_nanos(F.col("total_units"), F.col("total_nanos"))
    return (
        accepted(orders)
        .join(sums, "order_id", "left")
        .select(
            "order_id",
            units_of(again).alias("recomputed_units"),
            nanos_of(again).alias("recomputed_nanos"),
            (again == stored).alias("agrees"),
        )
    )


def write_orders(heads_or_items: DataFrame, path: str) -> None:
    heads_or_items.write.mode("overwrite").json(path)
