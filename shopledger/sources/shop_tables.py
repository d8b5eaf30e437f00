"""Shop tables derived from the supplied relational and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.catalog import catalog_from_flat
from shopledger.sources.fixed_values import ALLOWED_CURRENCIES

# Public test card numbers and near misses, picked by customer key.
TEST_CARDS = [
    "4111111111111111", "5555555555554444", "4012888888881881", "5105105105105100",
    "378282246310005", "4111111111111112", "2223003122003222", "6011111111111117",
]
ROUTE_PATHS = {
    "view": ("GET", "/product/"),
    "click": ("POST", "/cart"),
    "purchase": ("POST", "/cart/checkout"),
    "signup": ("GET", "/"),
    "error": ("GET", "/no/such/page/"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flat_catalog(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_type", "p_brand", "p_name").alias("description"),
        F.concat(F.lit("/static/img/products/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("picture"),
        F.lit("USD").alias("price_usd_currency_code"),
        F.call_function("div", cents, F.lit(100)).cast("int").alias("price_usd_units"),
        ((cents % 100) * 10_000_000).alias("price_usd_nanos"),
        F.concat(F.col("p_type"), F.lit(","), F.replace("p_name", F.lit(" "), F.lit(","))).alias("categories"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalog_from_flat(flat_catalog(spark, folder))


def picked(values: list[str], key: Column) -> Column:
    """The element of a short list that a non-negative key selects, round robin."""
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def order_carts(spark: SparkSession, folder: str) -> DataFrame:
    """What lay in the cart of each order: (order_id, line_no, product_id, quantity)."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def user_carts(spark: SparkSession, folder: str) -> DataFrame:
    """All lines a user ever carted: (user_id, product_id, quantity), lines not merged."""
    users = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    return order_carts(spark, folder).join(users, "order_id").select("user_id", "product_id", "quantity")


def shoppers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with address, card and currency."""
    key = F.col("c_custkey")
    text_key = key.cast("string")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    odd_card = F.concat(F.lit("4"), F.lpad(text_key, 14, "0"), (key % 10).cast("string"))
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            key.alias("user_id"),
            picked(ALLOWED_CURRENCIES, F.col("c_nationkey")).alias("user_currency"),
            F.concat(F.lower("c_mktsegment"), text_key, F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("street_address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit("Spark").alias("country"),
            (key % 100000).cast("int").alias("zip_code"),
            F.when(key % 4 == 3, odd_card).otherwise(picked(TEST_CARDS, key)).alias("credit_card_number"),
            (key % 1000).cast("int").alias("credit_card_cvv"),
            (2023 + key % 4).cast("int").alias("credit_card_expiration_year"),
            (key % 12 + 1).cast("int").alias("credit_card_expiration_month"),
        )
    )


def checkout_requests(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    return orders.join(shoppers(spark, folder), "user_id")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events with the product number taken out of the JSON properties."""
    return table(spark, folder, "events").withColumn(
        "product_id", F.get_json_object("props", "$.k").cast("bigint")
    )


def as_cart_events(raw: DataFrame) -> DataFrame:
    """(seq, user_id, kind, product_id, quantity): clicks add, purchases empty the cart."""
    return raw.filter(F.col("event_type").isin("click", "purchase")).select(
        F.col("event_id").alias("seq"),
        "user_id",
        F.when(F.col("event_type") == "click", "add").otherwise("empty").alias("kind"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        (F.col("event_id") % 10 + 1).alias("quantity"),
    )


def cart_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_cart_events(table(spark, folder, "events"))


def as_request_log(raw: DataFrame) -> DataFrame:
    """One request per event: (req_id, ts, session, method, path, status, took_us, bytes)."""
    product = F.get_json_object("props", "$.k")
    method = F.lit(None).cast("string")
    path = F.lit(None).cast("string")
    for kind, (verb, prefix) in ROUTE_PATHS.items():
        full = F.concat(F.lit(prefix), product) if prefix.endswith("/") and prefix != "/" else F.lit(prefix)
        method = F.when(F.col("event_type") == kind, verb).otherwise(method)
        path = F.when(F.col("event_type") == kind, full).otherwise(path)
    return raw.select(
        F.col("event_id").alias("req_id"),
        "ts",
        F.col("user_id").alias("session"),
        method.alias("method"),
        path.alias("path"),
        F.when(F.col("event_type") == "error", 500)
        .when(F.col("event_type") == "signup", 0)
        .otherwise(200)
        .alias("status"),
        F.round(F.col("value") * 10_000).cast("bigint").alias("took_us"),
        F.length("props").cast("bigint").alias("bytes"),
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_request_log(table(spark, folder, "events"))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("item_id"), "text")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages shoppers wrote to the assistant."""
    return (
        table(spark, folder, "conversations")
        .filter(F.col("role") == "user")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    )
