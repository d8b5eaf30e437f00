import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopledger.functions import text
from shopledger.functions.shipping import tracking_id
from shopledger.operators import ads, carts, lookup, recommend, validation
from shopledger.plans import checkout
from shopledger.sources import catalog as catalogs
from shopledger.sources import dimensions


def product(pid, name, description="", price=(1, 0), categories=("x",)):
    return (pid, name, description, "/p.jpg", ("USD", *price), list(categories))


CATALOG = (
    "id string, name string, description string, picture string, "
    "price_usd struct<currency_code:string,units:bigint,nanos:int>, categories array<string>"
)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [
            product("T-1", "Copper kettle"), product("T-2", "Bath towel", "100% linen"),
            product("T-3", "Kettle brush"), product("T-4", "Tea tin", "fits any KETTLEDRUM set"),
        ],
        CATALOG,
    )


def test_catalog_files(spark, tmp_path):
    item = {
        "id": "A1", "name": "Mug's", "description": "d", "picture": "/m.jpg",
        "priceUsd": {"currencyCode": "USD", "units": 8, "nanos": 990000000}, "categories": ["Kitchen", "Decor"],
    }
    path = tmp_path / "products.json"
    path.write_text(json.dumps({"products": [item]}, indent=2))
    nested = catalogs.load_catalog(spark, {"path": str(path)})
    row = nested.first()
    assert (row.id, row.price_usd.units, row.categories) == ("A1", 8, ["Kitchen", "Decor"])

    flat = catalogs.flatten_catalog(nested)
    assert flat.first().name == "Mugs"
    flat.createOrReplaceTempView("flat_items")
    back = catalogs.load_catalog(spark, {"table": "flat_items"}).first()
    assert back.categories == ["kitchen", "decor"]
    assert back.price_usd == row.price_usd
    with pytest.raises(ValueError):
        catalogs.load_catalog(spark, {"table": "flat_items; DROP TABLE users"})


def test_assistant_catalog(spark, tmp_path):
    good, bad = tmp_path / "a.json", tmp_path / "b.json"
    good.write_text('[\n {"id": "A", "name": "n", "description": "d", "categories": ["c"]}\n]')
    bad.write_text('{"id": "A", "name": "n"}')
    assert catalogs.read_assistant_catalog(spark, str(good)).count() == 1
    assert catalogs.read_assistant_catalog(spark, str(bad)).count() == 0
    assert catalogs.read_assistant_catalog(spark, str(tmp_path / "none.json")).count() == 0


def test_point_lookup(spark, products):
    asked = spark.createDataFrame([("T-3",), ("T-9",)], "product_id string")
    got = {r.product_id: (r.found, r.name) for r in lookup.point_lookup(asked, products).collect()}
    assert got == {"T-3": (True, "Kettle brush"), "T-9": (False, None)}


def test_search(spark, products):
    """Signs are literal, case does not count, and the empty text matches all."""
    texts = ["kettle", "%", "_", "", "zz", "T", "tle b", "BATH TOWEL"]
    terms = spark.createDataFrame([(t,) for t in texts], "query string")
    found = {}
    for row in lookup.search_products(terms, products).collect():
        found.setdefault(row["query"], set()).add(row["id"][-1])
    assert found == {
        "kettle": set("134"), "%": set("2"), "": set("1234"), "T": set("1234"), "tle b": set("3"), "BATH TOWEL": set("2"),
    }


def test_cart_merge_empty_and_order(spark):
    log = [
        (1, 1, "add", 7, 1), (2, 1, "add", 7, 1), (3, 2, "add", 7, 4), (4, 2, "empty", None, None),
        (5, 3, "add", 1, 1), (6, 3, "empty", None, None), (7, 3, "add", 2, 3), (8, 3, "add", 2, 1),
    ]
    schema = "seq bigint, user_id bigint, kind string, product_id bigint, quantity bigint"
    expected = {(1, 7, 2, 1), (3, 2, 4, 7)}
    for order in (log, log[::-1]):
        state = carts.cart_state(spark.createDataFrame(order, schema)).collect()
        assert {(r.user_id, r.product_id, r.quantity, r.first_seq) for r in state} == expected


def test_validation_texts(spark):
    rows = [(1, "p"), (10, "p"), (0, "p"), (11, "p"), (5, ""), (0, "")]
    df = spark.createDataFrame(rows, "quantity int, product_id string")
    out = validation.validate(df, validation.add_to_cart_rules())
    got = [validation_row for validation_row in out.select(validation.error_text(F.col("errors"))).toPandas().iloc[:, 0]]
    assert got == [
        "", "", "Field 'Quantity' is invalid: required\n", "Field 'Quantity' is invalid: lte\n",
        "Field 'ProductID' is invalid: required\n",
        "Field 'Quantity' is invalid: required\nField 'ProductID' is invalid: required\n",
    ]


ORDER = {
    "email": "mira@teashop.example", "street_address": "7 Quay Lane", "zip_code": 4021, "city": "Linz",
    "state": "Upper Austria", "country": "Austria", "credit_card_number": "4012888888881881",
    "credit_card_expiration_month": 9, "credit_card_expiration_year": 2031, "credit_card_cvv": 77,
}


@pytest.mark.parametrize(
    "change",
    [
        {"email": "mira at teashop"}, {"email": ""}, {"street_address": "q" * 600}, {"street_address": ""},
        {"zip_code": 0}, {"city": "é" * 150}, {"state": "s" * 200}, {"country": ""},
        {"credit_card_number": "4012888888881882"}, {"credit_card_expiration_month": 14},
        {"credit_card_expiration_month": 0}, {"credit_card_expiration_year": 0}, {"credit_card_cvv": 0},
    ],
)
def test_place_order_rules(spark, change):
    df = spark.createDataFrame([ORDER, {**ORDER, **change}])
    out = validation.validate(df, validation.place_order_rules()).select(F.size("errors")).collect()
    assert [r[0] for r in out] == [0, 1]


def test_currency_codes(spark):
    codes = ["CHF", "SEK", "ZAR", "chf", "QQQ", "12", ""]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    out = validation.with_known_currency(df, "code", dimensions.iso_codes(spark)).collect()
    errors = {r.code: r.currency_error for r in out}
    assert [errors[c] for c in codes] == [None] * 3 + ["iso4217"] * 3 + ["required"]


def test_identifiers(spark):
    names = ["basket_2", "_b", "basket x", "shop.basket", "2baskets", "basket'--"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(validation.is_identifier(F.col("n"))).collect()] == [True, True] + [False] * 4


def test_assistant_requests(spark):
    rows = ["", "a%20shelf%20for%20tea%20tins", "a+b", "50%", "%20 ", "x" * 2001, "\t"]
    df = spark.createDataFrame([(r,) for r in rows], "raw_message string")
    out = validation.assistant_requests(df).select("accepted", "message").collect()
    assert [r.accepted for r in out] == [False, True, True, True, False, False, False]
    assert [r.message for r in out[1:4]] == ["a shelf for tea tins", "a+b", "50%"]


def test_payment_screening(spark):
    cards = [
        (1, "4111111111111111", 2025, 1, None), (2, "123456", 2030, 1, "invalid_card"),
        (3, "378282246310005", 2030, 1, "unaccepted_card"), (4, "5555555555554444", 2024, 5, "expired_card"),
        (5, "5555555555554444", 2024, 6, None), (6, "2223003122003222", 2030, 1, None), (7, None, 2030, 1, "invalid_card"),
    ]
    df = spark.createDataFrame(
        [(*c[:2], 123, *c[2:]) for c in cards],
        "order_id bigint, credit_card_number string, credit_card_cvv int, credit_card_expiration_year int,"
        "credit_card_expiration_month int, expected string",
    )
    out = validation.screen_payments(df, date(2024, 6, 15))
    assert "credit_card_number" not in out.columns
    for row in out.collect():
        assert row.reason == row.expected
        assert (row.decision == "accepted") == (row.expected is None) == (row.transaction_id is not None)


def test_tracking_id_shape(spark):
    address = "7 Quay Lane, Linz"
    df = spark.range(200).select("id", tracking_id(F.col("id"), F.lit(address), "s").alias("t"))
    ids = [r.t for r in df.collect()]
    assert len(set(ids)) > 190
    assert all(len(t) == 17 and t[2:5] == "-17" and t[8:10] == "-8" for t in ids)
    assert df.filter(~F.col("t").rlike(r"^[A-Y]{2}-\d+-\d+$")).count() == 0


def test_reply_texts(spark):
    df = spark.createDataFrame(
        [("plain \n", ["a1", "b2", "c3", "d4"]), ("see [abc]", ["x"]), ("none", []), ("see [ab]", ["q"])],
        "t string, ids array<string>",
    )
    got = [r[0] for r in df.select(text.with_id_footer(F.col("t"), F.col("ids"))).collect()]
    assert got == ["plain\n推荐ID: [a1], [b2], [c3]", "see [abc]", "none\n推荐ID: [NO_MATCH]", "see [ab]\n推荐ID: [q]"]


def test_recommendations(spark):
    """Right size, no carted product, no repeats; also when the cart holds nearly everything."""
    catalog = spark.range(50).select("id")
    users = spark.range(40).select(F.col("id").alias("user_id"))
    rng = random.Random(3)
    lines = [(u, p) for u in range(1, 39) for p in rng.sample(range(50), rng.randint(1, 20))]
    lines += [(39, p) for p in range(48)] + [(39, 1)]
    cart = spark.createDataFrame(lines, "user_id bigint, product_id bigint")
    got = {}
    for row in recommend.recommend(users, cart, catalog, "s").collect():
        got.setdefault(row.user_id, []).append(row.product_id)
    held = {}
    for u, p in lines:
        held.setdefault(u, set()).add(p)
    assert set(got) == set(range(40))
    for u, ids in got.items():
        assert len(ids) == len(set(ids)) == min(5, 50 - len(held.get(u, ())))
        assert not set(ids) & held.get(u, set())
    assert len({tuple(v) for v in got.values()}) > 30


def test_ads(spark):
    requests = spark.createDataFrame(
        [(1, ["kitchen", "none", "hair", "kitchen"]), (2, ["none"]), (3, []), (4, None)],
        "request_id bigint, context_keys array<string>",
    )
    table = dimensions.ads(spark)
    found = ads.context_ads(requests, table).orderBy("key_pos", "pos").collect()
    assert [(r.key_pos, r.pos, r.category) for r in found] == [
        (0, 0, "kitchen"), (0, 1, "kitchen"), (2, 0, "hair"), (3, 0, "kitchen"), (3, 1, "kitchen"),
    ]
    served = ads.serve_ads(requests, table, "s")
    assert {r.request_id: r["count"] for r in served.groupBy("request_id").count().collect()} == {1: 5, 2: 2, 3: 2, 4: 2}
    chosen = ads.select_ads(requests, table, "s").collect()
    assert sorted(r.request_id for r in chosen) == [1, 2, 3, 4]


def test_items_of_a_large_order(spark):
    """A cart of many lines, copies of one product among them, comes out as one row per product."""
    catalog = spark.range(300).select(
        "id", F.lit("n").alias("name"),
        F.struct(F.lit("USD").alias("currency_code"), F.lit(1).cast("bigint").alias("units"), F.lit(0).alias("nanos")).alias("price_usd"),
    )
    lines = spark.range(300).select(F.lit(1).alias("order_id"), F.col("id").alias("product_id"), F.lit(2).alias("quantity"))
    copies = spark.range(500).select(F.lit(1).alias("order_id"), F.lit(7).cast("bigint").alias("product_id"), F.lit(1).alias("quantity"))
    request = {**ORDER, "order_id": 1, "user_id": 1, "user_currency": "EUR", "credit_card_expiration_year": 2030}
    requests = spark.createDataFrame([request, {**request, "order_id": 2}])
    cart, rates = lines.unionByName(copies), dimensions.rates(spark)
    priced = checkout.priced_lines(requests, cart, catalog, rates)
    orders = checkout.place_orders(requests, cart, catalog, rates, date(2024, 6, 15))
    items = checkout.order_items(orders, priced)
    quantity = {r["item"]["product_id"]: r["item"]["quantity"] for r in items.filter("order_id = 1").collect()}
    assert items.count() == len(quantity) == 300
    assert quantity[7] == 502 and sum(quantity.values()) == 1100
    heads = {r.order_id: r for r in checkout.order_heads(orders).collect()}
    assert set(heads) == {1, 2} and heads[2].shipping_cost.units == 0


def small_checkout(spark, lines):
    catalog = spark.createDataFrame([(5, "tin", ("USD", 3, 500_000_000)), (6, "pot", ("USD", 20, 0))],
                                    "id bigint, name string, price_usd struct<currency_code:string,units:bigint,nanos:int>")
    request = {**ORDER, "user_currency": "EUR"}
    requests = spark.createDataFrame([{**request, "order_id": o, "user_id": 100 + o} for o in (1, 2, 3)])
    cart = spark.createDataFrame(lines, "order_id bigint, product_id bigint, quantity int")
    rates = dimensions.rates(spark)
    return (
        checkout.place_orders(requests, cart, catalog, rates, date(2024, 6, 15)),
        checkout.priced_lines(requests, cart, catalog, rates),
    )


def test_tampered_order_disagrees(spark):
    orders, priced = small_checkout(spark, [(1, 5, 2), (1, 6, 1), (2, 6, 4)])
    items = checkout.order_items(orders, priced)
    assert all(r.agrees for r in checkout.recomputed_totals(orders, items).collect())
    cost = F.col("cost").withField("units", F.col("cost.units") + F.when(F.col("order_id") == 2, 1).otherwise(0))
    changed = checkout.recomputed_totals(orders, items.withColumn("cost", cost)).collect()
    assert {r.order_id: r.agrees for r in changed} == {1: True, 2: False, 3: True}


def test_rejected_order_has_no_total_and_keeps_its_cart(spark):
    orders, _ = small_checkout(spark, [(1, 5, 2), (1, 999, 1), (2, 6, 4)])
    row = {r.order_id: r for r in orders.collect()}[1]
    assert row.reason == "unknown_product" and row.total_units is None and row.shipping_units is None
    assert {r.user_id for r in checkout.emptied_carts(orders).collect()} == {102, 103}


def test_metadata_ids(spark):
    docs = [
        ('{"id": "a", "metadata": {"id": "b"}}', ["a"]),
        ('{"raw": {"kwargs": {"metadata": {"id": "r"}}}, "metadata": {"id": "m"}}', ["r", "m"]),
        ('{"raw": {"kwargs": {"metadata": {"id": 4}}}, "metadata": {"id": "m"}}', ["m"]),
        ('{"id": 7}', []), ("not json", []), (None, []),
    ]
    df = spark.createDataFrame([(d,) for d, _ in docs], "d string").select(text.metadata_ids(F.col("d")))
    assert [r[0] for r in df.collect()] == [want for _, want in docs]


def test_random_sample(spark):
    catalog = spark.range(30).select("id")
    users = spark.range(12).select(F.col("id").alias("user_id"))
    cart = users.select("user_id", F.explode(F.sequence(F.lit(0), F.col("user_id") * 2)).alias("product_id"))
    drawn = {}
    for seed in ("x", "y"):
        for r in recommend.recommend(users, cart, catalog, seed).collect():
            drawn.setdefault((seed, r.user_id), []).append(r.product_id)
    for (_, user), ids in drawn.items():
        assert len(ids) == len(set(ids)) == min(5, 30 - (2 * user + 1)) and min(ids) > 2 * user
    assert any(drawn["x", u] != drawn["y", u] for u in range(12))


def test_cart_table_versions(spark, tmp_path):
    from shopledger.sources.carts import apply_cart_changes, read_cart_table, write_cart_table

    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    schema = "user_id bigint, product_id bigint, quantity bigint"
    write_cart_table(spark.createDataFrame([(1, 7, 2), (2, 7, 5), (3, 1, 1)], schema), first)
    adds = spark.createDataFrame([(1, 7, 3), (2, 9, 1)], schema)
    apply_cart_changes(spark, first, second, adds, spark.createDataFrame([(2,)], "user_id bigint"))
    assert {tuple(r) for r in read_cart_table(spark, {"path": second}).collect()} == {(1, 7, 5), (2, 9, 1), (3, 1, 1)}
    read_cart_table(spark, {"path": second}).withColumnsRenamed({"user_id": "userId", "product_id": "productId"}).createOrReplaceTempView("CartItems")
    assert read_cart_table(spark, {"table": "CartItems"}).filter("user_id = 1").count() == 1
    with pytest.raises(ValueError):
        read_cart_table(spark, {"table": "public.CartItems"})
