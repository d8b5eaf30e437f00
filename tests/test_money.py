import pytest
from pyspark.sql import functions as F

from shopledger.functions import money
from shopledger.functions.fx import converted
from shopledger.functions.shipping import quote_nanos, quote_units
from shopledger.operators.exchange import convert_money
from shopledger.sources import dimensions

BIG = 981273891273
NANOS = 999_999_999


def one(spark, values, *columns):
    row = spark.createDataFrame([values], ", ".join(f"c{i} {t}" for i, t in enumerate(_types(values))))
    return row.select(*columns).first()


def _types(values):
    return ["string" if isinstance(v, str) else "double" if isinstance(v, float) else "bigint" for v in values]


@pytest.mark.parametrize(
    ("units", "nanos", "valid"),
    [
        (-BIG, -NANOS, True), (BIG, NANOS, True), (-BIG, NANOS, False), (BIG, -NANOS, False),
        (3, 1_000_000_000, False), (3, -1_000_000_000, False), (-3, 1_000_000_000, False),
        (-3, -1_000_000_000, False), (0, 0, True), (0, -5, True),
    ],
)
def test_validity(spark, units, nanos, valid):
    assert one(spark, (units, nanos), money.is_valid(F.col("c0"), F.col("c1")))[0] is valid


def test_sign_predicates(spark):
    u, n = F.col("c0"), F.col("c1")
    preds = (money.is_zero(u, n), money.is_positive(u, n), money.is_negative(u, n))
    assert tuple(one(spark, (0, 0), *preds)) == (True, False, False)
    assert tuple(one(spark, (-1, 1), *preds)) == (False, False, False)
    assert tuple(one(spark, (1, 1), *preds)) == (False, True, False)
    assert tuple(one(spark, (1, -1), *preds)) == (False, False, False)
    assert tuple(one(spark, (0, -7), *preds)) == (False, False, True)


@pytest.mark.parametrize(("a", "b", "same"), [("", "", False), ("", "USD", False), ("USD", "USD", True)])
def test_same_currency(spark, a, b, same):
    assert one(spark, (a, b), money.same_currency(F.col("c0"), F.col("c1")))[0] is same


@pytest.mark.parametrize(
    ("left", "right", "expected"),
    [
        ((2, 200000000), (2, 900000000), (5, 100000000)),
        ((-2, -200000000), (-2, -900000000), (-5, -100000000)),
        ((11, 100000000), (-2, -9000000), (9, 91000000)),
        ((-11, -100000000), (2, 9000000), (-9, -91000000)),
        ((0, 300000000), (0, 300000000), (0, 600000000)),
    ],
)
def test_sum(spark, left, right, expected):
    c = [F.col(f"c{i}") for i in range(4)]
    total = money.total_nanos(c[0], c[1]) + money.total_nanos(c[2], c[3])
    assert tuple(one(spark, (*left, *right), money.units_of(total), money.nanos_of(total))) == expected


def test_sum_failures(spark):
    c = [F.col(f"c{i}") for i in range(6)]
    failure = money.sum_failure((c[0], c[1], c[2]), (c[3], c[4], c[5]))
    assert one(spark, ("AAA", 1, 0, "BBB", 1, 0), failure)[0] == "mismatching_currency"
    assert one(spark, ("AAA", 1, -1, "BBB", 0, 0), failure)[0] == "invalid_value"
    assert one(spark, ("AAA", 1, 1, "AAA", 0, 0), failure)[0] is None


GOLDEN = {
    # USD amount: EUR, JPY, GBP, TRY, CAD
    "19.990000000": ("17.682441398", "2235.060592707", "15.201594869", "108.299648830", "26.749997346"),
    "18.990000000": ("16.797877046", "2123.251658614", "14.441134896", "102.881957543", "25.411828395"),
    "109.990000000": ("97.293233083", "12297.864661691", "83.642992481", "595.891864663", "147.185203007"),
    "24.990000000": ("22.105263158", "2794.105263171", "19.003894736", "135.388105263", "33.440842105"),
    "5.490000000": ("4.856258293", "613.831048235", "4.174925254", "29.743125167", "7.346547545"),
    "8.990000000": ("7.952233525", "1005.162317560", "6.836535161", "48.705044670", "12.030138876"),
}


def test_conversion_golden_values(spark):
    rows = [
        (*map(int, amount.split(".")), code, expected)
        for amount, values in GOLDEN.items()
        for code, expected in zip(["EUR", "JPY", "GBP", "TRY", "CAD"], values)
    ]
    df = spark.createDataFrame(rows, "units bigint, nanos bigint, to_code string, expected string")
    out = convert_money(df, F.col("units"), F.col("nanos"), "USD", F.col("to_code"), dimensions.rates(spark))
    for row in out.collect():
        assert f"{row.converted_units}.{row.converted_nanos:09d}" == row.expected


def test_conversion_of_equal_codes_is_not_skipped(spark):
    usd = F.lit(1.1305)
    got = one(spark, (4409, 228672858), *converted(F.col("c0"), F.col("c1"), usd, usd))
    assert tuple(got) == (4409, 228672857)


def test_conversion_reasons(spark):
    df = spark.createDataFrame([(1, 0, "XXX"), (-1, 0, "EUR"), (1, 0, "EUR")], "units bigint, nanos bigint, to_code string")
    out = convert_money(df, F.col("units"), F.col("nanos"), "USD", F.col("to_code"), dimensions.rates(spark))
    got = {(r.units, r.to_code): (r.converted_reason, r.converted_units) for r in out.collect()}
    assert got[(1, "XXX")] == ("unsupported_currency", None)
    assert got[(-1, "EUR")] == ("negative_amount", None)
    assert got[(1, "EUR")] == (None, 0)


@pytest.mark.parametrize(
    ("amount", "expected"),
    [(0.0, (0, 0)), (10.0, (10, 0)), (8.99, (8, 99)), (0.5, (0, 50)), (100.01, (100, 1)), (0.29, (0, 28)), (1.15, (1, 14)), (4.35, (4, 34))],
)
def test_whole_and_cents(spark, amount, expected):
    assert tuple(one(spark, (amount,), *money.whole_and_cents(F.col("c0")))) == expected


@pytest.mark.parametrize(("count", "expected"), [(4, (8, 990000000)), (0, (0, 0))])
def test_shipping_quote(spark, count, expected):
    assert tuple(one(spark, (count,), quote_units(F.col("c0")), quote_nanos(F.col("c0")))) == expected


def test_display(spark):
    c = [F.col(f"c{i}") for i in range(3)]
    assert one(spark, ("JPY", 12, 59999999), money.display(*c))[0] == "¥12.05"
    assert one(spark, ("CHF", 1, 990000000), money.display(*c))[0] == "$1.99"
    assert one(spark, ("EUR", 1, 5), money.long_text(*c))[0] == "1.000000005 EUR"


def test_exact_sum_and_times(spark):
    """Against Python integers, with both signs and carries."""
    import random

    rng = random.Random(4)
    rows = []
    for _ in range(500):
        sign, quantity = rng.choice([-1, 1]), rng.randint(1, 2**31 - 1)
        rows.append((sign * rng.randint(0, 10**6), sign * rng.randint(0, NANOS), quantity))
    df = spark.createDataFrame(rows, "u bigint, n int, q int")
    total = df.agg(money.exact_sum(F.col("u"), F.col("n"))).first()[0]
    assert int(total) == sum(u * 10**9 + n for u, n, _ in rows)
    for row in df.select("*", *[c.alias(a) for c, a in zip(money.times(F.col("u"), F.col("n"), F.col("q")), ["tu", "tn"])]).collect():
        assert row.tu * 10**9 + row.tn == (row.u * 10**9 + row.n) * row.q
        assert abs(row.tn) < 10**9 and row.tu * row.tn >= 0
