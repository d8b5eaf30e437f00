"""One key holds a third of the rows: results stay whole and the hot key is split."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.operators import carts, lookup, retrieval
from shopledger.plans import checkout
from shopledger.sources import dimensions

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def small_partitions(spark):
    """Thresholds small enough for test data to count as skewed."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def hot(column, n):
    """A third of the values are 0, the rest are spread out."""
    return F.when(F.col(column) % 3 == 0, F.lit(0)).otherwise(F.xxhash64(column) % n + n).cast("bigint")


def test_cart_replay_of_a_hot_user(spark, small_partitions):
    log = spark.range(0, 200_000, numPartitions=8).select(
        F.col("id").alias("seq"), hot("id", 500).alias("user_id"),
        F.when(F.col("id") % 9973 == 0, "empty").otherwise("add").alias("kind"),
        (F.xxhash64("id", F.lit(1)) % 50).alias("product_id"), F.lit(1).cast("bigint").alias("quantity"),
    )
    rows, plan = executed(carts.cart_state(log))
    assert re.search(r"hashpartitioning\(user_id#\w+, _salt#\w+", plan)
    got = {(r.user_id, r.product_id): r.quantity for r in rows}
    pdf = log.toPandas()
    emptied = pdf[pdf.kind == "empty"].groupby("user_id").seq.max()
    live = pdf[(pdf.kind == "add") & (pdf.seq > pdf.user_id.map(emptied).fillna(-1))]
    assert got == live.groupby(["user_id", "product_id"]).quantity.sum().to_dict()


def test_checkout_of_a_hot_order(spark, small_partitions):
    catalog = spark.range(40).select(
        "id", F.lit("n").alias("name"),
        F.struct(
            F.lit("USD").alias("currency_code"), F.col("id").alias("units"), F.lit(250_000_000).alias("nanos")
        ).alias("price_usd"),
    )
    lines = spark.range(0, 200_000, numPartitions=8).select(
        hot("id", 500).alias("order_id"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("product_id"), F.lit(2).alias("quantity")
    )
    requests = lines.select("order_id").distinct().select(
        "order_id", F.col("order_id").alias("user_id"), F.lit("EUR").alias("user_currency"),
        *[F.lit("x").alias(c) for c in ["street_address", "city", "state", "country", "email"]],
        F.lit(1).alias("zip_code"), F.lit("4111111111111111").alias("credit_card_number"),
        F.lit(1).alias("credit_card_cvv"), F.lit(2030).alias("credit_card_expiration_year"),
        F.lit(1).alias("credit_card_expiration_month"),
    )
    rates = dimensions.rates(spark)
    rows, plan = executed(checkout.place_orders(requests, lines, catalog, rates, date(2024, 1, 1)))
    assert "skew=true" in plan

    def euros(units, nanos):
        u1 = units / 1.1305
        n1 = nanos / 1.1305 + (u1 % 1) * 1e9
        whole, rest = int(u1) + int(n1 // 1e9), int(n1 % 1e9 + 0.5)
        return whole * 10**9 + rest

    price = {i: euros(i, 250_000_000) for i in range(40)}
    counts = lines.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("q")).collect()
    total = {}
    for r in counts:
        total[r.order_id] = total.get(r.order_id, euros(8, 990_000_000)) + price[r.product_id] * r.q
    assert {r.order_id: r.total_units * 10**9 + r.total_nanos for r in rows} == total


def test_token_search_with_a_token_in_a_third_of_the_items(spark, small_partitions):
    """Same rows as counting all pairs; postings of the common token are dealt out by item."""
    stored = spark.range(0, 6_000, numPartitions=4).select(
        F.col("id").alias("item_id"),
        F.concat_ws(" ", F.when(F.col("id") % 3 == 0, "common"), F.concat(F.lit("w"), F.col("id") % 50), F.concat(F.lit("r"), F.col("id") % 997)).alias("text"),
    )
    queries = {1: "common w7 r70", 2: "common", 3: "w3 common nothing", 4: "r5 w5 r6 w6 common", 5: "", 6: "nothing"}
    asked = spark.createDataFrame(list(queries.items()), "query_id bigint, text string")
    rows, _ = executed(retrieval.token_search(asked, stored, 6, 100))
    found = retrieval.token_search(asked, stored, 6, 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(code#\w+, share#\w+|\[code#\w+, share#\w+\], \[code#", plan)
    items = {r.item_id: set(r.text.split()) for r in stored.collect()}
    expected = set()
    for q, text in queries.items():
        scored = sorted((-len(set(text.split()) & t), i) for i, t in items.items())
        expected |= {(q, i, -s, n) for n, (s, i) in enumerate([x for x in scored if x[0] < 0][:6], 1)}
    assert {(r.query_id, r.item_id, r.score, r["rank"]) for r in rows} == expected


def test_substring_search_with_a_hot_letter_group(spark, small_partitions):
    """A letter group that a third of the products have is dealt out by product; short and empty texts too."""
    catalog = spark.range(0, 3_000, numPartitions=4).select(
        "id", F.concat(F.when(F.col("id") % 3 == 0, "Common ").otherwise("rare"), F.col("id").cast("string")).alias("name"),
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("xx common_ab "), F.col("id") % 11)).alias("description"),
    )
    texts = ["common 12", "ON_a", "mm", "9", "", "common_ab 10", "%", "omm", "nomatch", "aaaa", "Common 9"]
    terms = spark.createDataFrame([(t,) for t in texts + ["mm"]], "query string")
    found = lookup.search_products(terms, catalog, places=200)
    rows, plan = executed(found)
    assert re.search(r"gram#\w+, share#\w+", plan)
    products = catalog.collect()
    expected = {
        (t, p.id, p.name) for t in texts for p in products
        if t.lower() in p.name.lower() or (p.description is not None and t.lower() in p.description.lower())
    }
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left"])
def test_only_hot_users_are_copied(spark, small_partitions, how):
    """Two hot users get as many tasks as their rows need; every other user's row is copied once."""
    rows = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 1_000).cast("bigint").alias("user_id"),
        F.col("id").alias("product_id"),
    )
    users = spark.range(0, 600, 1, 4).withColumnRenamed("id", "user_id").withColumn("x", F.lit(1)).groupBy("user_id").agg(F.max("x").alias("x"))
    found = carts.join_users(rows, users, how, ["product_id"], 1_000)
    plan = executed(found)[1]
    assert re.search(r"user_id#\w+, _salt#\w+", plan)
    want = {
        "left_semi": rows.filter("user_id < 600").count(), "left_anti": rows.filter("user_id >= 600").count(), "left": rows.count(),
    }[how]
    assert found.count() == want
    joined = carts.user_copies(rows, users, 1_000)
    counts = {r.user_id: r["count"] for r in joined.groupBy("user_id").count().collect()}
    assert counts == {u: 11 if u < 2 else 1 for u in range(600)}
