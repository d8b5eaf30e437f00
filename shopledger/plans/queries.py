"""The queries of the shop: name -> function of (session, folder of tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.functions import money, text
from shopledger.functions.seeded import digest, ordinal
from shopledger.functions.shipping import address_text, quote_nanos, quote_units, tracking_id
from shopledger.operators import ads as ad_ops
from shopledger.operators import carts, exchange, lookup, recommend, replay, retrieval, telemetry, validation
from shopledger.plans import assistant, cart_view, checkout
from shopledger.session import tune
from shopledger.sources import catalog as catalogs
from shopledger.sources import dimensions, fixed_values
from shopledger.sources import shop_tables as shop

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = date(2024, 6, 15)
SEED = "shop"
CATALOG_VIEW = "shop_flat_catalog"
# Currencies dealt to nations by their key, in turn; XXX has no rate.
HOME_CODES = ["BGN", "CAD", "CHF", "CZK", "EUR", "GBP", "JPY", "SGD", "TRY", "USD", "XXX", "ZAR"]
# Context words of ad requests and shelves; some have ads.
AD_WORDS = ["clothing", "garden", "kitchen", "decor", "books", "hair", "toys", "footwear", "accessories"]


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[name] = run
        return run

    return register


def _price(c: str = "price_usd") -> list:
    return [
        F.col(f"{c}.currency_code").alias("currency_code"),
        F.col(f"{c}.units").alias("units"),
        F.col(f"{c}.nanos").alias("nanos"),
    ]


def _catalog_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "name", "description", "picture", *_price(), F.array_join("categories", "|").alias("categories")
    )


# --- sources and sinks -------------------------------------------------------------------


def _camel(spark: SparkSession, folder: str):
    p = shop.catalog(spark, folder)
    return p, F.struct(
        F.col("id").cast("string").alias("id"), "name", "description", "picture",
        F.struct(
            F.col("price_usd.currency_code").alias("currencyCode"),
            F.col("price_usd.units").alias("units"),
            F.col("price_usd.nanos").alias("nanos"),
        ).alias("priceUsd"),
        "categories",
    )


@query("src1_catalog_json")
def _(spark, folder):
    products, item = _camel(spark, folder)
    documents = products.select(F.to_json(F.struct(F.array(item).alias("products"))).alias("value"))
    return _catalog_columns(catalogs.catalog_from_json(documents))


@query("src2_catalog_flat")
def _(spark, folder):
    return _catalog_columns(catalogs.catalog_from_flat(shop.flat_catalog(spark, folder)))


@query("src3_catalog_source")
def _(spark, folder):
    shop.flat_catalog(spark, folder).createOrReplaceTempView(CATALOG_VIEW)
    loaded = catalogs.load_catalog(spark, {"table": CATALOG_VIEW})
    return loaded.select("id", "name", *_price(), F.size("categories").alias("n_categories"))


@query("src4_assistant_catalog")
def _(spark, folder):
    _, item = _camel(spark, folder)
    products = shop.catalog(spark, folder)
    loose = F.struct(F.col("id").cast("string").alias("id"), "name", "description", "categories")
    # Every seventh document is an object instead of an array and must yield nothing.
    document = F.when(F.col("id") % 7 == 0, F.to_json(loose)).otherwise(F.to_json(F.array(loose)))
    items = catalogs.assistant_items(products.select(document.alias("value")))
    return items.select("id", "name", "description", F.array_join("categories", "|").alias("categories"))


def _home_currencies(spark, folder):
    nation = shop.table(spark, folder, "nation")
    return (
        shop.table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_acctbal"),
            shop.picked(HOME_CODES, F.col("n_nationkey")).alias("code"),
        )
    )


@query("src5_fx_rates")
def _(spark, folder):
    homes = _home_currencies(spark, folder).groupBy("code").agg(F.count("*").alias("customers"))
    return dimensions.rates(spark).join(homes, "code", "left").fillna(0, ["customers"])


@query("src6_cart_read")
def _(spark, folder):
    users = shop.table(spark, folder, "customer").filter(F.col("c_acctbal") < 0)
    return carts.cart_of(
        carts.merge_lines(shop.user_carts(spark, folder)), users.select(F.col("c_custkey").alias("user_id"))
    )


def _packaging(spark, folder):
    size = F.col("p_size").cast("float")
    return (
        shop.table(spark, folder, "part")
        .filter(F.col("p_partkey") % 3 != 0)
        .select(
            F.col("p_partkey").alias("product_id"),
            (size * 2).alias("weight"), size.alias("width"), (size / 2).cast("float").alias("height"),
            (size + 1).cast("float").alias("depth"),
        )
    )


def _packaging_out(df):
    return df.select("product_id", "name", *[F.col(c).cast("double").alias(c) for c in ["weight", "width", "height", "depth"]])


@query("src7_packaging")
def _(spark, folder):
    products = shop.catalog(spark, folder).select(F.col("id").alias("product_id"), "name")
    return _packaging_out(lookup.with_packaging(products, _packaging(spark, folder)))


@query("snk1_flatten_catalog")
def _(spark, folder):
    products = shop.catalog(spark, folder)
    quoted = products.withColumn("name", F.concat(F.lit("o'"), "name", F.lit("'s")))
    return catalogs.flatten_catalog(quoted)


def _carts_of(spark, folder, chosen):
    orders = shop.table(spark, folder, "orders").filter(chosen)
    users = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return shop.order_carts(spark, folder).join(users, "order_id").select("user_id", "product_id", "quantity")


@query("snk2_cart_upsert")
def _(spark, folder):
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    current = carts.merge_lines(_carts_of(spark, folder, finished))
    return carts.upsert_cart(current, _carts_of(spark, folder, ~finished))


@query("snk3_cart_delete")
def _(spark, folder):
    buyers = shop.cart_events(spark, folder).filter(F.col("kind") == "empty").select("user_id").distinct()
    return carts.empty_carts(carts.merge_lines(shop.user_carts(spark, folder)), buyers)


@query("snk4_record_json")
def _(spark, folder):
    return catalogs.product_json(shop.catalog(spark, folder))


@query("snk5_metrics_text")
def _(spark, folder):
    return telemetry.metrics_text(shop.request_log(spark, folder))


# --- projections, filters, lookups -------------------------------------------------------


@query("f1_list_products")
def _(spark, folder):
    return _catalog_columns(shop.catalog(spark, folder))


@query("f2_point_lookup")
def _(spark, folder):
    asked = shop.events(spark, folder).select(
        F.col("event_id").alias("request_id"), (F.col("product_id") * 40 + F.col("event_id") % 40).alias("product_id")
    )
    return lookup.point_lookup(asked, shop.catalog(spark, folder)).select("request_id", "product_id", "found", "name")


def _search_terms(spark, folder):
    words = F.split("p_name", " ")
    named = shop.table(spark, folder, "part").select(F.explode(words).alias("query"))
    upper = named.select(F.upper("query").alias("query"))
    literal = spark.range(1).select(F.explode(F.array(F.lit("%"), F.lit("_"), F.lit(""), F.lit("#1"))).alias("query"))
    return named.unionByName(upper).unionByName(literal).distinct()


@query("f3_search_products")
def _(spark, folder):
    return lookup.search_products(_search_terms(spark, folder), shop.catalog(spark, folder))


@query("j6_substring_join")
def _(spark, folder):
    brands = shop.table(spark, folder, "part").select(F.col("p_brand").alias("query")).distinct()
    found = lookup.search_products(brands, shop.catalog(spark, folder))
    return found.groupBy("query").agg(F.count("*").alias("products"), F.min("id").alias("first_id"))


@query("f4_supported_currencies")
def _(spark, folder):
    homes = _home_currencies(spark, folder).groupBy("code").agg(F.count("*").alias("customers"))
    codes = dimensions.rates(spark).select("code", F.lit(True).alias("supported"))
    return homes.join(F.broadcast(codes), "code", "left").fillna(False, ["supported"])


@query("f5_currency_allow_list")
def _(spark, folder):
    offered = exchange.offered_rates(dimensions.rates(spark)).select("code")
    return _home_currencies(spark, folder).join(F.broadcast(offered), "code", "left_semi").select("user_id", "code")


@query("f6_currency_preference")
def _(spark, folder):
    homes = _home_currencies(spark, folder)
    kept = F.when(F.col("user_id") % 3 != 0, F.col("code"))
    return homes.select("user_id", exchange.preferred_currency(kept).alias("currency_code"))


@query("f7_cart_product_ids")
def _(spark, folder):
    return carts.merge_lines(shop.user_carts(spark, folder)).select("user_id", "product_id")


@query("f8_price_list")
def _(spark, folder):
    listed = exchange.price_list(
        shop.catalog(spark, folder), fixed_values.ALLOWED_CURRENCIES, dimensions.rates(spark)
    )
    shown = money.display(F.col("currency_code"), F.col("price_units"), F.col("price_nanos"))
    return listed.select("id", "currency_code", "price_units", "price_nanos", shown.alias("price_text"))


@query("f9_route_label")
def _(spark, folder):
    return telemetry.with_route(shop.request_log(spark, folder)).select("req_id", "method", "path", "route", "status")


@query("f10_log_normalisation")
def _(spark, folder):
    level = F.upper("event_type")
    severity = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(F.col("event_id") % 3 == 1, F.lit(""))
    stamp = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("t"), F.col("event_id").cast("string")))
    line = F.struct(
        severity.alias("severity"), level.alias("levelname"), stamp.alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created"), F.col("props").alias("message"),
    )
    lines = shop.table(spark, folder, "events").select("event_id", F.to_json(line).alias("value"))
    return telemetry.normalised_logs(lines)


# --- validation --------------------------------------------------------------------------


def _errors(df, *columns):
    return df.select(*columns, F.size("errors").alias("n_errors"), validation.error_text(F.col("errors")).alias("errors"))


@query("v1_add_to_cart")
def _(spark, folder):
    asked = shop.events(spark, folder).select(
        "event_id",
        (F.col("event_id") % 13).alias("quantity"),
        F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("product_id").cast("string")).alias("product_id"),
    )
    return _errors(validation.validate(asked, validation.add_to_cart_rules()), "event_id")


@query("v2_place_order")
def _(spark, folder):
    u = shop.shoppers(spark, folder)
    key = F.col("user_id")
    spoiled = (
        u.withColumn("email", F.when(key % 11 == 1, F.col("city")).when(key % 11 == 2, "").otherwise(F.col("email")))
        .withColumn("street_address", F.when(key % 13 == 1, F.repeat("street_address", 40)).otherwise(F.col("street_address")))
        .withColumn("city", F.when(key % 17 == 1, "").otherwise(F.col("city")))
        .withColumn(
            "credit_card_expiration_month",
            F.when(key % 19 == 1, 13).when(key % 19 == 2, 0).otherwise(F.col("credit_card_expiration_month")),
        )
    )
    return _errors(validation.validate(spoiled, validation.place_order_rules()), "user_id")


@query("v3_currency_code")
def _(spark, folder):
    asked = _home_currencies(spark, folder).select(
        "user_id",
        F.when(F.col("user_id") % 5 == 0, F.lower("code"))
        .when(F.col("user_id") % 5 == 1, "")
        .when(F.col("user_id") % 5 == 2, "ABC")
        .otherwise(F.col("code"))
        .alias("code"),
    )
    return validation.with_known_currency(asked, "code", dimensions.iso_codes(spark))


def _signed_amounts(spark, folder):
    """Line prices turned into amounts of either sign, some of them invalid."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    units = F.call_function("div", cents, F.lit(100)) * F.when(key % 2 == 0, 1).otherwise(-1)
    nanos = (cents % 100) * 10_000_000 * F.when(key % 6 < 3, 1).otherwise(-1)
    nanos = F.when(key % 29 == 0, nanos + 1_000_000_000).otherwise(nanos)
    return shop.table(spark, folder, "lineitem").select(
        key.alias("order_id"), line.alias("line_no"), F.col("l_partkey").alias("product_id"),
        F.when(key % 31 == 0, F.lit("")).when(line % 2 == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("code"),
        F.when(key % 37 == 0, F.lit(0)).otherwise(units).cast("bigint").alias("units"),
        nanos.cast("int").alias("nanos"),
    )


@query("v4_money_validity")
def _(spark, folder):
    u, n = F.col("units"), F.col("nanos")
    checked = _signed_amounts(spark, folder).select(
        "order_id", "line_no", "product_id", "units", "nanos",
        money.is_valid(u, n).alias("is_valid"), money.is_zero(u, n).alias("is_zero"),
        money.is_positive(u, n).alias("is_positive"), money.is_negative(u, n).alias("is_negative"),
    )
    return checked


def _raw_messages(spark, folder):
    m = shop.messages(spark, folder)
    key = F.col("query_id")
    raw = (
        F.when(key % 9 == 0, F.concat(F.col("text"), F.lit("%zz")))
        .when(key % 9 == 1, F.lit("%20%20"))
        .when(key % 9 == 2, F.repeat("text", 60))
        .when(key % 9 == 3, F.lit(""))
        .otherwise(F.concat(F.lit("%20"), F.col("text"), F.lit("+a%5B"), key.cast("string"), F.lit("%5D%20")))
    )
    return m.select("query_id", raw.alias("raw_message"))


@query("v5_assistant_request")
def _(spark, folder):
    checked = validation.assistant_requests(_raw_messages(spark, folder))
    return checked.select("query_id", "accepted", "message")


@query("v6_payment_screening")
def _(spark, folder):
    charges = shop.checkout_requests(spark, folder).select(
        "order_id", "user_id", "credit_card_number", "credit_card_cvv",
        "credit_card_expiration_year", "credit_card_expiration_month",
    )
    return validation.screen_payments(charges, AS_OF).select(
        "order_id", "user_id", "decision", "reason", "last4", "transaction_id"
    )


@query("v7_identifier")
def _(spark, folder):
    part = shop.table(spark, folder, "part")
    name = (
        F.when(F.col("p_partkey") % 4 == 0, F.col("p_name"))
        .when(F.col("p_partkey") % 4 == 1, F.replace("p_name", F.lit(" "), F.lit("_")))
        .when(F.col("p_partkey") % 4 == 2, F.concat(F.col("p_partkey").cast("string"), F.col("p_type")))
        .otherwise(F.col("p_brand"))
    )
    return part.select("p_partkey", name.alias("name")).withColumn("is_identifier", validation.is_identifier(F.col("name")))


# --- joins -------------------------------------------------------------------------------


def _checkout_inputs(spark, folder):
    return (
        shop.checkout_requests(spark, folder),
        shop.order_carts(spark, folder),
        shop.catalog(spark, folder),
        dimensions.rates(spark),
    )


@query("j1_cart_catalog")
def _(spark, folder):
    lines = shop.order_carts(spark, folder)
    shifted = lines.withColumn(
        "product_id", F.when(F.col("order_id") % 10 == 0, F.col("product_id") + 1_000_000_000).otherwise(F.col("product_id"))
    )
    found = lookup.point_lookup(shifted, shop.catalog(spark, folder).select("id", "name"))
    return found.groupBy("order_id").agg(
        F.bool_and("found").alias("all_found"), F.count_if("found").alias("found_lines"), F.count("*").alias("lines")
    )


def _cross_amounts(spark, folder):
    """Each order's total as an amount in a currency of its own, to convert into another."""
    codes = [*HOME_CODES, "EUR"]
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    cents = F.when(F.col("o_orderkey") % 41 == 0, -cents).otherwise(cents)
    return shop.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        shop.picked(codes, F.col("o_orderkey")).alias("from_code"),
        shop.picked(codes, F.col("o_custkey")).alias("to_code"),
        F.call_function("div", cents, F.lit(100)).alias("units"),
        ((cents % 100) * 10_000_000 + F.when(cents > 0, F.col("o_orderkey") % 9_999_999).otherwise(0)).cast("int").alias("nanos"),
    )


def _converted(spark, folder):
    return exchange.convert_money(
        _cross_amounts(spark, folder), F.col("units"), F.col("nanos"),
        F.col("from_code"), F.col("to_code"), dimensions.rates(spark), "out",
    )


@query("j2_money_rates")
def _(spark, folder):
    return (
        _converted(spark, folder)
        .groupBy("from_code", "to_code", "out_reason")
        .agg(F.count("*").alias("amounts"), F.sum("out_units").alias("units"), F.sum(F.col("out_nanos").cast("bigint")).alias("nanos"))
    )


@query("j3_ids_catalog")
def _(spark, folder):
    asked = shop.cart_events(spark, folder).filter(F.col("kind") == "add").select(F.col("seq").alias("request_id"), "product_id")
    products = shop.catalog(spark, folder).select(F.col("id").alias("product_id"), "name", *_price())
    return asked.join(products, "product_id")


@query("j4_anti_join")
def _(spark, folder):
    viewed = shop.events(spark, folder).select("user_id", "product_id").distinct()
    return lookup.not_in_cart(viewed, shop.user_carts(spark, folder))


def _ad_requests(spark, folder):
    """One ad request per event; its context keys are words some of which no ad has."""
    first, second = shop.picked(AD_WORDS, F.col("product_id")), shop.picked(AD_WORDS, F.col("event_id"))
    keys = (
        F.when(F.col("event_id") % 5 == 0, F.array().cast("array<string>"))
        .when(F.col("event_id") % 5 == 1, F.array(first))
        .otherwise(F.array(first, second, first))
    )
    return shop.events(spark, folder).select(F.col("event_id").alias("request_id"), keys.alias("context_keys"))


@query("j5_context_ads")
def _(spark, folder):
    found = ad_ops.context_ads(_ad_requests(spark, folder), dimensions.ads(spark))
    return found.select("request_id", "key_pos", "pos", "category", "redirect_url", "text")


@query("j7_token_overlap_join")
def _(spark, folder):
    benchmark = shop.table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return retrieval.token_search(benchmark, shop.corpus(spark, folder), k=10)


def _citing_replies(spark, folder):
    """Assistant turns with a product id, an unknown id and a token that is no id appended."""
    turns = shop.table(spark, folder, "conversations").filter(F.col("role") == "assistant")
    key = F.col("conv_id") * 1000 + F.col("turn")
    cite = F.concat(
        F.lit(" ["), (key % 97).cast("string"), F.lit("], [no-such-id] and [NO_MATCH], ["), (key % 31).cast("string"),
        F.lit("], ["), (key % 97).cast("string"), F.lit("]\n- one\n- two"),
    )
    return turns.select(
        key.alias("query_id"), F.when(key % 3 == 0, F.col("text")).otherwise(F.concat("text", cite)).alias("reply")
    )


@query("j8_cited_ids")
def _(spark, folder):
    replies = _citing_replies(spark, folder)
    found = lookup.cited_products(replies, text.cited_ids(F.col("reply")), shop.catalog(spark, folder))
    return found.select("query_id", "cite_pos", "cited_id", "name")


@query("j9_optional_enrichment")
def _(spark, folder):
    products = shop.catalog(spark, folder).select(F.col("id").alias("product_id"), "name")
    packed = lookup.with_packaging(products, _packaging(spark, folder))
    # Shelves of the shop, some of which have several ads and some none.
    shelf = shop.picked(AD_WORDS, F.col("product_id"))
    ads = dimensions.ads(spark).select("category", F.col("text").alias("ad_text"))
    return packed.withColumn("category", shelf).join(ads, "category", "left").select(
        "product_id", "name", "category", F.col("weight").cast("double").alias("weight"), "ad_text"
    )


# --- aggregations ------------------------------------------------------------------------


@query("agg1_money_sum")
def _(spark, folder):
    valid = _signed_amounts(spark, folder).filter(money.is_valid(F.col("units"), F.col("nanos")))
    sums = valid.groupBy("order_id", "code").agg(money.exact_sum(F.col("units"), F.col("nanos")).alias("t"))
    return sums.select("order_id", "code", money.units_of(F.col("t")).alias("units"), money.nanos_of(F.col("t")).alias("nanos"))


@query("agg2_cart_size")
def _(spark, folder):
    return carts.cart_size(shop.user_carts(spark, folder))


@query("agg3_cart_merge")
def _(spark, folder):
    return carts.merge_lines(shop.user_carts(spark, folder))


@query("agg4_request_counter")
def _(spark, folder):
    return telemetry.request_counts(shop.request_log(spark, folder))


@query("agg5_duration_summary")
def _(spark, folder):
    return telemetry.duration_summary(shop.request_log(spark, folder))


@query("agg6_latency_histogram")
def _(spark, folder):
    log = telemetry.with_route(shop.request_log(spark, folder))
    seconds = F.col("took_us") / F.lit(1e6)
    return telemetry.cumulative_histogram(log, ["method", "route"], seconds, fixed_values.LATENCY_BOUNDS)


@query("agg6_score_histogram")
def _(spark, folder):
    counts = retrieval.overlap_counts(shop.messages(spark, folder), shop.corpus(spark, folder))
    return telemetry.cumulative_histogram(
        counts.withColumn("backend", F.lit("json")), ["backend"], F.col("score"), fixed_values.SCORE_BOUNDS, F.col("pairs")
    )


@query("agg7_labelled_counters")
def _(spark, folder):
    log = shop.request_log(spark, folder)
    status = F.when(F.col("status") >= 500, "error").when(F.col("bytes") < 8, "bad_request").otherwise("ok")
    served = log.select(
        status.alias("status"),
        shop.picked(["hosted", "local"], F.col("session")).alias("provider"),
        shop.picked(["vector", "json"], F.col("req_id")).alias("backend"),
    )
    return telemetry.labelled_counters(served, ["status", "provider", "backend"])


def _assistant_log(spark, folder):
    return shop.request_log(spark, folder).select(
        shop.picked(["hosted", "local"], F.col("session")).alias("provider"),
        shop.picked(["vector", "json"], F.col("req_id")).alias("backend"), "took_us",
    )


@query("agg6_assistant_latency")
def _(spark, folder):
    seconds = F.col("took_us") / F.lit(1e6)
    return telemetry.cumulative_histogram(
        _assistant_log(spark, folder), ["provider", "backend"], seconds, fixed_values.LATENCY_BOUNDS
    )


@query("agg7_retrieval_counters")
def _(spark, folder):
    asked, corpus = shop.messages(spark, folder), shop.corpus(spark, folder)
    vectors, stored = _vectors(spark, folder)
    return telemetry.retrieval_counters(asked, retrieval.token_search(asked, corpus), "json").unionByName(
        telemetry.retrieval_counters(vectors, retrieval.vector_search(vectors, stored), "vector")
    )


@query("agg7_rejected_calls")
def _(spark, folder):
    return telemetry.rejected_calls(replay.rate_limited(_timed(spark, folder), 86_400, 2))


@query("agg8_vector_hit_ratio")
def _(spark, folder):
    asked, stored = _vectors(spark, folder)
    found = retrieval.vector_search(asked, stored).groupBy("query_id").agg(F.count("*").alias("hits"))
    searches = asked.join(found, "query_id", "left").select(
        "query_id", F.col("query_id").alias("written_at"), F.lit("vector").alias("backend"),
        telemetry.vector_hit_ratio(F.coalesce("hits", F.lit(0))).alias("ratio"),
    )
    return telemetry.latest_ratio(searches)


@query("agg8_hit_ratio")
def _(spark, folder):
    asked = shop.messages(spark, folder)
    corpus = shop.corpus(spark, folder)
    found = retrieval.token_search(asked, corpus).groupBy("query_id").agg(F.count("*").alias("hits"))
    size = corpus.agg(F.count("*")).scalar()
    ratio = telemetry.hit_ratio(F.coalesce("hits", F.lit(0)), fixed_values.SEARCH_LIMIT, size)
    searches = asked.join(found, "query_id", "left").select(
        "query_id",
        F.col("query_id").alias("written_at"),
        shop.picked(["json", "json-replica"], F.col("query_id")).alias("backend"),
        ratio.alias("ratio"),
    )
    return telemetry.latest_ratio(searches)


@query("agg9_distinct_ids")
def _(spark, folder):
    replies = _citing_replies(spark, folder)
    return replies.select("query_id", F.array_join(F.array_distinct(text.cited_ids(F.col("reply"))), ",").alias("ids"))


@query("agg10_load_report")
def _(spark, folder):
    log = telemetry.with_route(shop.request_log(spark, folder)).withColumn("status", F.col("status").cast("int"))
    report = telemetry.load_report(log, ["route"])
    return report.withColumn("error_rate", F.round("error_rate", 9))


@query("agg11_id_set")
def _(spark, folder):
    return shop.events(spark, folder).select("user_id", "product_id").distinct()


# --- sorts, limits, top-k, sampling ------------------------------------------------------


@query("l1_label_sort")
def _(spark, folder):
    counts = telemetry.in_label_order(
        telemetry.request_counts(shop.request_log(spark, folder)), ["method", "route", "status"]
    )
    return counts.select(F.concat("method", "route", "status").alias("label"), "requests")


@query("l2_top_k_relevance")
def _(spark, folder):
    brands = shop.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("query_id"),
        F.concat(F.lit("a red small promo ring Brand "), (F.col("s_suppkey") % 25).cast("string")).alias("text"),
    )
    products = shop.catalog(spark, folder)
    features = text.feature_text(F.col("name"), F.col("description"), F.col("categories"))
    items = products.select(F.col("id").alias("item_id"), features.alias("text"))
    return retrieval.token_search(brands, items)


def _vectors(spark, folder):
    v = shop.table(spark, folder, "embeddings")
    return (
        v.select(F.col("vec_id").alias("query_id"), "embedding"),
        v.select(F.col("vec_id").alias("item_id"), "embedding"),
    )


@query("l3_vector_top_k")
def _(spark, folder):
    asked, stored = _vectors(spark, folder)
    return retrieval.vector_search(asked, stored, k=3).select("query_id", "item_id", "rank", "score")


def _users(spark, folder):
    return shop.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))


def _recommended(spark, folder):
    return recommend.recommend(
        _users(spark, folder), shop.user_carts(spark, folder), shop.catalog(spark, folder), SEED
    )


@query("l4_sample")
def _(spark, folder):
    return _recommended(spark, folder)


@query("l4_random_sample")
def _(spark, folder):
    # Another sample on every run: the seed is new.
    drawn = recommend.recommend(
        _users(spark, folder), shop.user_carts(spark, folder), shop.catalog(spark, folder), uuid.uuid4().hex
    )
    ids = F.array_sort(F.collect_list(F.col("product_id")))
    return drawn.groupBy("user_id").agg(F.array_join(ids.cast("array<string>"), " ").alias("sample"))


@query("l5_cap_after_lookup")
def _(spark, folder):
    shown = recommend.shown_recommendations(_recommended(spark, folder), shop.catalog(spark, folder))
    return shown.select("user_id", "rank", "product_id", "name", *_price())


@query("l6_random_ads")
def _(spark, folder):
    asked = shop.events(spark, folder).select(F.col("event_id").alias("request_id"))
    return ad_ops.random_ads(asked, dimensions.ads(spark), SEED).select("request_id", "key_pos", "ad_no", "redirect_url")


@query("l7_choose_ad")
def _(spark, folder):
    served = ad_ops.context_ads(_ad_requests(spark, folder), dimensions.ads(spark))
    return ad_ops.choose_ad(served, SEED)


@query("l8_fallback_ids")
def _(spark, folder):
    replies = _citing_replies(spark, folder)
    return replies.select("query_id", F.array_join(text.fallback_ids(text.cited_ids(F.col("reply"))), ",").alias("ids"))


# --- set operations ----------------------------------------------------------------------


@query("set1_difference")
def _(spark, folder):
    # Products no event is about.
    return lookup.never_carted(shop.catalog(spark, folder), shop.events(spark, folder).select("product_id"))


@query("set2_concat_ads")
def _(spark, folder):
    found = ad_ops.context_ads(_ad_requests(spark, folder), dimensions.ads(spark))
    return found.groupBy("category").agg(
        F.count("*").alias("served"), F.count_distinct("request_id").alias("requests")
    )


@query("set3_token_intersection")
def _(spark, folder):
    key = F.col("conv_id")
    turns = shop.table(spark, folder, "conversations").select(key, "turn", text.tokens(F.col("text")).alias("t"))
    following = turns.select(key, (F.col("turn") - 1).alias("turn"), F.col("t").alias("next_t"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.size(F.array_intersect("t", "next_t")).cast("bigint").alias("shared")
    )


# --- scalar functions over whole tables --------------------------------------------------


@query("m1_money_arithmetic")
def _(spark, folder):
    amounts = _signed_amounts(spark, folder)
    other = (F.lit("USD"), F.col("units") + 7, F.when(F.col("units") + 7 >= 0, 250_000_000).otherwise(-250_000_000))
    failure = money.sum_failure((F.col("code"), F.col("units"), F.col("nanos")), other)
    total = money.total_nanos(F.col("units"), F.col("nanos")) + money.total_nanos(other[1], other[2])
    return amounts.select(
        "order_id", "line_no", "product_id", failure.alias("reason"),
        F.when(failure.isNull(), money.units_of(total)).alias("sum_units"),
        F.when(failure.isNull(), money.nanos_of(total)).alias("sum_nanos"),
        (-F.col("units")).alias("neg_units"), (-F.col("nanos")).alias("neg_nanos"),
        money.same_currency(F.col("code"), other[0]).alias("same_currency"),
        ((F.col("units") == other[1]) & (F.col("nanos") == other[2])).alias("equal"),
    )


@query("m2_convert_money")
def _(spark, folder):
    return _converted(spark, folder).select("order_id", "from_code", "to_code", "out_units", "out_nanos", "out_reason")


@query("m3_multiply_money")
def _(spark, folder):
    lines = shop.order_carts(spark, folder)
    prices = shop.catalog(spark, folder).select(F.col("id").alias("product_id"), "price_usd")
    priced = lines.join(prices, "product_id")
    units, nanos = money.times(F.col("price_usd.units"), F.col("price_usd.nanos"), F.col("quantity"))
    return priced.select(
        "order_id", "line_no", "product_id", "quantity", units.alias("units"), nanos.alias("nanos")
    )


@query("m4_shipping_quote")
def _(spark, folder):
    orders = shop.table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"))
    counted = shop.order_carts(spark, folder).groupBy("order_id").agg(F.sum("quantity").alias("item_count"))
    sized = orders.join(counted, "order_id", "left").fillna(0, ["item_count"])
    return sized.select(
        "order_id", "item_count", quote_units(F.col("item_count")).alias("units"),
        quote_nanos(F.col("item_count")).alias("nanos"),
    )


@query("m5_dollars_and_cents")
def _(spark, folder):
    whole, cents = money.whole_and_cents(F.col("o_totalprice"))
    return shop.table(spark, folder, "orders").select("o_orderkey", whole.alias("dollars"), cents.alias("cents"))


@query("m6_display_money")
def _(spark, folder):
    prices = shop.catalog(spark, folder)
    code = shop.picked([*fixed_values.ALLOWED_CURRENCIES, "CHF"], F.col("id"))
    return prices.select("id", money.display(code, F.col("price_usd.units"), F.col("price_usd.nanos")).alias("shown"))


@query("m7_currency_symbol")
def _(spark, folder):
    homes = _home_currencies(spark, folder)
    return homes.groupBy("code").agg(F.count("*").alias("customers")).withColumn("symbol", money.symbol(F.col("code")))


@query("m8_long_money_text")
def _(spark, folder):
    p = F.col("price_usd")
    return shop.catalog(spark, folder).select("id", money.long_text(p["currency_code"], p["units"], p["nanos"]).alias("long_text"))


@query("s0_tokens")
def _(spark, folder):
    corpus = shop.corpus(spark, folder).select("item_id", text.tokens(F.col("text")).alias("t"))
    return corpus.select("item_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join(F.array_sort("t"), " ")).alias("digest"))


@query("s2_feature_text")
def _(spark, folder):
    p = shop.catalog(spark, folder)
    missing = F.when(F.col("id") % 5 != 0, F.col("description"))
    return p.select("id", text.feature_text(F.col("name"), missing, F.col("categories")).alias("feature_text"))


@query("s3_cited_ids")
def _(spark, folder):
    reply = F.col("reply")
    return _citing_replies(spark, folder).select(
        "query_id", text.has_cited_id(reply).alias("cites"), F.array_join(text.cited_ids(reply), ",").alias("ids")
    )


@query("s4_id_footer")
def _(spark, folder):
    replies = _citing_replies(spark, folder)
    ids = F.when(F.col("query_id") % 2 == 0, F.array().cast("array<string>")).otherwise(
        F.array(*[(F.col("query_id") + i).cast("string") for i in range(4)])
    )
    return replies.select("query_id", F.md5(text.with_id_footer(F.col("reply"), ids)).alias("digest"), F.right(text.with_id_footer(F.col("reply"), ids), F.lit(30)).alias("tail"))


@query("s5_strip_list_tail")
def _(spark, folder):
    return _citing_replies(spark, folder).select("query_id", text.without_list_tail(F.col("reply")).alias("stripped"))


@query("s6_metadata_id")
def _(spark, folder):
    products = shop.catalog(spark, folder)
    ident = F.col("id").cast("string")
    deep = F.to_json(F.struct(F.struct(F.struct(F.struct(ident.alias("id")).alias("metadata")).alias("kwargs")).alias("raw")))
    doc = (
        F.when(F.col("id") % 4 == 0, F.to_json(F.struct(ident.alias("id"), F.lit("x").alias("name"))))
        .when(F.col("id") % 4 == 1, deep)
        .when(F.col("id") % 4 == 2, F.to_json(F.struct(F.struct(ident.alias("id")).alias("metadata"))))
        .otherwise(F.to_json(F.struct(F.col("name").alias("name"))))
    )
    return products.select("id", text.metadata_id(doc).alias("doc_id"))


@query("s6_metadata_ids")
def _(spark, folder):
    """Documents with an id at the top, in both places of their metadata, numbers instead of texts, or none."""
    ident, number = F.col("id").cast("string"), F.col("id")

    def within(raw, own):
        deep = F.struct(F.struct(F.struct(raw.alias("id")).alias("metadata")).alias("kwargs"))
        return F.to_json(F.struct(deep.alias("raw"), F.struct(own.alias("id")).alias("metadata")))

    doc = (
        F.when(F.col("id") % 5 == 0, F.to_json(F.struct(ident.alias("id"), F.struct(F.lit("m").alias("id")).alias("metadata"))))
        .when(F.col("id") % 5 == 1, within(F.concat(F.lit("r"), ident), F.concat(F.lit("m"), ident)))
        .when(F.col("id") % 5 == 2, within(ident, ident))
        .when(F.col("id") % 5 == 3, within(number, F.concat(F.lit("m"), ident)))
        .otherwise(F.to_json(F.struct(number.alias("id"))))
    )
    products = shop.catalog(spark, folder)
    return products.select("id", F.array_join(text.metadata_ids(doc), ",").alias("doc_ids"))


@query("s7_tracking_id")
def _(spark, folder):
    r = shop.checkout_requests(spark, folder)
    city = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("Zürich "), F.col("city"))).otherwise(F.col("city"))
    address = address_text(F.col("street_address"), city, F.col("state"))
    return r.select("order_id", tracking_id(F.col("order_id"), address, SEED).alias("tracking_id"))


@query("s8_label_escape")
def _(spark, folder):
    value = F.concat(F.lit("a\\b"), F.col("props"), F.lit("\n"), F.col("event_type"))
    return shop.table(spark, folder, "events").select("event_id", text.escaped_label(value).alias("label"))


@query("a1_explode_rebuild")
def _(spark, folder):
    p = shop.catalog(spark, folder).select("id", F.posexplode("categories").alias("pos", "category"))
    rebuilt = p.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "category"))).alias("c"))
    return rebuilt.select(
        "id", F.size("c").cast("bigint").alias("n"), F.array_join(F.transform("c", lambda c: F.upper(c["category"])), ",").alias("categories")
    )


# --- retrieval ---------------------------------------------------------------------------


@query("t1_token_search")
def _(spark, folder):
    return retrieval.token_search(shop.messages(spark, folder), shop.corpus(spark, folder))


@query("t2_vector_search")
def _(spark, folder):
    asked, stored = _vectors(spark, folder)
    return retrieval.vector_search(asked, stored).select("query_id", "item_id", "rank", "score")


def hashed_words(texts: list[str]):
    """A deterministic stand-in for an embedding model: word counts hashed into 16 buckets."""
    import zlib

    import numpy as np

    out = np.zeros((len(texts), 16), dtype=np.float32)
    for row, words in enumerate(texts):
        for word in words.lower().split():
            out[row, zlib.crc32(word.encode()) % 16] += 1
    return out


@query("t3_embed_column")
def _(spark, folder):
    embedded = retrieval.with_embeddings(
        shop.catalog(spark, folder).select("id", "description"), "description", "hashed-words-16", hashed_words
    )
    size = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return embedded.select("id", "embed_model", F.size("embedding").alias("dims"), size.cast("bigint").alias("words"))


@query("t4_backend_choice")
def _(spark, folder):
    asked, stored = _vectors(spark, folder)
    by_vector = retrieval.search(asked, stored, "vector", k=1).select(F.lit("vector").alias("method"), "query_id", "item_id")
    benchmark = shop.table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    by_tokens = retrieval.search(benchmark, shop.corpus(spark, folder), "tokens", k=1).select(
        F.lit("tokens").alias("method"), "query_id", "item_id"
    )
    return by_vector.unionByName(by_tokens)


@query("t5_prompt")
def _(spark, folder):
    m = shop.messages(spark, folder)
    prompt = assistant.design_prompt(
        F.lit("You are a designer."), F.lit("warm"), F.concat(F.lit("ids "), F.col("query_id").cast("string")), F.col("text")
    )
    return m.select("query_id", F.md5(prompt).alias("digest"), F.char_length(prompt).cast("bigint").alias("n_chars"))


@query("t6_degraded_reply")
def _(spark, folder):
    calls = replay.breaker_log(_model_calls(spark, folder), 2, 86_400)
    m = shop.table(spark, folder, "events").select(F.col("event_id").alias("call_id"), "props")
    reply = F.when(F.col("failed") | (F.col("verdict") == "blocked"), assistant.degraded_reply(F.col("props")))
    return calls.join(m, "call_id").select("call_id", F.coalesce(reply, F.concat(F.lit("ok "), "props")).alias("reply"))


# --- whole jobs --------------------------------------------------------------------------


@query("p1_checkout")
def _(spark, folder):
    orders = checkout.place_orders(*_checkout_inputs(spark, folder), AS_OF)
    return orders.select(
        "order_id", "user_id", "user_currency", "item_count", "shipping_units", "shipping_nanos",
        "total_units", "total_nanos", "decision", "reason", "last4", "tracking_id",
    )


@query("p1_order_documents")
def _(spark, folder):
    requests, lines, products, rates = _checkout_inputs(spark, folder)
    orders, items = checkout.issue_orders(requests, lines, products, rates, AS_OF)
    return items.join(checkout.order_heads(orders), "order_id").select(
        "order_id", "shipping_tracking_id", F.col("shipping_cost.units").alias("shipping_units"),
        "item.product_id", "item.quantity", F.col("cost.units").alias("cost_units"), F.col("cost.nanos").alias("cost_nanos"),
    )


@query("p1_rejected_orders")
def _(spark, folder):
    requests, lines, products, rates = _checkout_inputs(spark, folder)
    damaged = lines.withColumn(
        "product_id", F.when(F.col("order_id") % 10 == 0, F.col("product_id") + 1_000_000_000).otherwise(F.col("product_id"))
    )
    known = requests.withColumn("user_currency", F.when(F.col("order_id") % 9 == 0, "XXX").otherwise(F.col("user_currency")))
    orders = checkout.place_orders(known, damaged, products, rates, AS_OF)
    return checkout.rejected(orders).select("order_id", "reason", "last4")


@query("p2_cart_lines")
def _(spark, folder):
    return cart_view.cart_lines(*_checkout_inputs(spark, folder))


@query("p2_cart_view")
def _(spark, folder):
    return cart_view.cart_totals(*_checkout_inputs(spark, folder))


@query("p2_cart_recommendations")
def _(spark, folder):
    requests, _, products, _ = _checkout_inputs(spark, folder)
    shown = cart_view.cart_recommendations(requests, _recommended(spark, folder), products)
    return shown.select("order_id", "rank", "product_id", "name")


@query("p3_reconciliation")
def _(spark, folder):
    requests, lines, products, rates = _checkout_inputs(spark, folder)
    orders, issued = checkout.issue_orders(requests, lines, products, rates, AS_OF)
    # Every 50th order was tampered with after it was issued: one more of its first product.
    first = F.col("item.product_id") == F.min("item.product_id").over(W.partitionBy("order_id"))
    more = F.when((F.col("order_id") % 50 == 0) & first, 1).otherwise(0)
    changed = F.struct(F.col("item.product_id").alias("product_id"), (F.col("item.quantity") + more).alias("quantity"))
    return checkout.recomputed_totals(orders, issued.select("order_id", changed.alias("item"), "cost"))


@query("p4_recommendations")
def _(spark, folder):
    shown = recommend.shown_recommendations(_recommended(spark, folder), shop.catalog(spark, folder))
    return shown.groupBy("user_id").agg(
        F.count("*").alias("shown"), F.sum(F.col("price_usd.units")).alias("units"), F.min("name").alias("first_name")
    )


@query("p5_ad_selection")
def _(spark, folder):
    return ad_ops.select_ads(_ad_requests(spark, folder), dimensions.ads(spark), SEED)


@query("p6_assistant_candidates")
def _(spark, folder):
    found = assistant.assistant_candidates(
        _raw_messages(spark, folder), shop.corpus(spark, folder), F.lit("minimal oak"), "You are a designer."
    )
    return found.select(
        "query_id", F.array_join("candidate_ids", ",").alias("candidate_ids"), F.md5("prompt").alias("prompt_digest")
    )


@query("p6_final_replies")
def _(spark, folder):
    ids = F.array(F.col("query_id").cast("string"), F.lit("7"))
    replies = _citing_replies(spark, folder).select(
        "query_id", F.concat(F.lit("m"), F.col("query_id").cast("string")).alias("message"),
        F.when(F.col("query_id") % 4 != 0, F.col("reply")).alias("reply"), ids.alias("candidate_ids"),
    )
    return assistant.finalize_replies(replies).select("query_id", F.md5("content").alias("digest"))


@query("s1_cart_replay")
def _(spark, folder):
    return carts.cart_state(shop.cart_events(spark, folder))


# --- stateful and streaming --------------------------------------------------------------


def _timed(spark, folder, *columns):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return shop.table(spark, folder, "events").select(
        F.col("user_id").alias("key"), at.alias("at_us"), F.col("event_id").alias("call_id"), *columns
    )


def _model_calls(spark, folder):
    return _timed(spark, folder, F.col("event_type").isin("error", "view").alias("failed"))


@query("st1_cart_stream")
def _(spark, folder):
    from shopledger.streaming import carts as live
    from shopledger.streaming import runs

    schema = shop.table(spark, folder, "events").schema
    stream = runs.event_stream(spark, f"{folder}/events.parquet", schema)
    updates = runs.run_available(live.cart_updates(shop.as_cart_events(stream)), "update", "carts")
    return live.current_lines(updates)


@query("st2_request_stream")
def _(spark, folder):
    from shopledger.streaming import requests as live
    from shopledger.streaming import runs

    schema = shop.table(spark, folder, "events").schema
    stream = shop.as_request_log(runs.event_stream(spark, f"{folder}/events.parquet", schema))
    stamped = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    seen = runs.run_available(live.live_metrics(stamped, "1 hour"), "update", "metrics")
    final = seen.groupBy("window_start", "method", "route", "status").agg(
        F.max_by(F.struct("requests", "sum_us"), "batch_id").alias("m")
    )
    return final.select(
        F.unix_seconds("window_start").alias("window_start_s"), "method", "route", "status", "m.requests", "m.sum_us"
    )


@query("st3_rate_limit")
def _(spark, folder):
    return replay.rate_limited(_timed(spark, folder), 86_400, 2)


@query("st4_breaker")
def _(spark, folder):
    return replay.breaker_log(_model_calls(spark, folder), 3, 43_200).select("key", "call_id", "verdict")


@query("st5_sessions")
def _(spark, folder):
    return replay.session_log(_timed(spark, folder), fixed_values.SESSION_SECONDS).select(
        "key", "call_id", "session_start_us",
        digest(SEED, F.col("key"), F.col("session_start_us")).alias("session_id"),
    )


@query("st6_hot_reload")
def _(spark, folder):
    from shopledger.streaming import requests as live
    from shopledger.streaming import runs

    schema = shop.table(spark, folder, "events").schema
    stream = shop.as_cart_events(runs.event_stream(spark, f"{folder}/events.parquet", schema))
    seen = runs.run_available(
        stream.filter(F.col("kind") == "add"), "append", "enriched",
        lambda path: live.enrich_with_reload(
            lambda: shop.catalog(spark, folder).select("id", "name"), runs.table_sink(path)
        ),
    )
    return seen.select("seq", "product_id", "found", "name")


@query("st7_request_log")
def _(spark, folder):
    log = shop.request_log(spark, folder)
    took_ms = F.call_function("div", F.col("took_us"), F.lit(1000))
    return log.select("req_id", "session", "method", "path", took_ms.alias("took_ms"), "status", "bytes")
