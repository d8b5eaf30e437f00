"""Validation: predicate sets that add the list of failed fields to each row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.cards import brand, last4, passes_luhn
from shopledger.functions.seeded import digest
from shopledger.functions.text import percent_decoded
from shopledger.sources.fixed_values import EMAIL_PATTERN, IDENTIFIER_PATTERN

Rule = tuple[str, list[tuple[str, Column]]]


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``errors``: one text per failed field, naming the first rule it broke."""
    failures = []
    for field, checks in rules:
        broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(tag)) for tag, ok in checks])
        failures.append(F.concat(F.lit(f"Field '{field}' is invalid: "), broken, F.lit("\n")))
    return df.withColumn("errors", F.array_compact(F.array(*failures)))


def error_text(errors: Column) -> Column:
    return F.array_join(errors, "")


def _given(name: str) -> tuple[str, Column]:
    return "required", (F.col(name).isNotNull() & (F.col(name).cast("string") != ""))


def _nonzero(name: str) -> tuple[str, Column]:
    return "required", F.col(name) != 0


def add_to_cart_rules() -> list[Rule]:
    quantity = F.col("quantity")
    return [
        ("Quantity", [_nonzero("quantity"), ("gte", quantity >= 1), ("lte", quantity <= 10)]),
        ("ProductID", [_given("product_id")]),
    ]


def place_order_rules() -> list[Rule]:
    month = F.col("credit_card_expiration_month")

    def short(name: str, limit: int) -> list[tuple[str, Column]]:
        return [_given(name), ("max", F.char_length(F.col(name)) <= limit)]

    return [
        ("Email", [_given("email"), ("email", F.col("email").rlike(EMAIL_PATTERN))]),
        ("StreetAddress", short("street_address", 512)),
        ("ZipCode", [_nonzero("zip_code")]),
        ("City", short("city", 128)),
        ("State", short("state", 128)),
        ("Country", short("country", 128)),
        ("CcNumber", [_given("credit_card_number"), ("credit_card", passes_luhn(F.col("credit_card_number")))]),
        ("CcMonth", [_nonzero("credit_card_expiration_month"), ("gte", month >= 1), ("lte", month <= 12)]),
        ("CcYear", [_nonzero("credit_card_expiration_year")]),
        ("CcCVV", [_nonzero("credit_card_cvv")]),
    ]


def with_known_currency(df: DataFrame, code_column: str, codes: DataFrame) -> DataFrame:
    """Adds ``currency_error``: NULL, 'required' or 'iso4217'. ``codes`` is the bounded code table."""
    listed = F.broadcast(codes.select(F.col("code").alias("_known")))
    checked = df.join(listed, F.col(code_column) == F.col("_known"), "left")
    error = F.when(F.coalesce(F.col(code_column), F.lit("")) == "", F.lit("required")).when(
        F.col("_known").isNull(), F.lit("iso4217")
    )
    return checked.withColumn("currency_error", error).drop("_known")


def assistant_requests(df: DataFrame) -> DataFrame:
    """Adds ``message`` (decoded, trimmed) and ``accepted``; length limits hold for the raw text."""
    raw = F.col("raw_message")
    message = F.regexp_replace(percent_decoded(raw), r"^\s+|\s+$", "")
    in_limits = F.char_length(raw).between(1, 2000)
    return df.withColumn("message", message).withColumn(
        "accepted", F.coalesce(in_limits & (F.col("message") != ""), F.lit(False))
    )


def is_identifier(name: Column) -> Column:
    return name.rlike(IDENTIFIER_PATTERN)


def screen_payments(charges: DataFrame, as_of: date, seed: str = "charge") -> DataFrame:
    """Adds ``decision``, ``reason``, ``last4``, ``transaction_id``; drops number and cvv.

    Reasons are tested in this order: invalid number, brand not taken, card expired.
    """
    number = F.col("credit_card_number")
    expiry = F.col("credit_card_expiration_year") * 12 + F.col("credit_card_expiration_month")
    valid = number.rlike("^[0-9]{12,19}$") & passes_luhn(number)
    reason = (
        F.when(~F.coalesce(valid, F.lit(False)), F.lit("invalid_card"))
        .when(~brand(number).isin("visa", "mastercard"), F.lit("unaccepted_card"))
        .when(F.lit(as_of.year * 12 + as_of.month) > expiry, F.lit("expired_card"))
    )
    screened = charges.withColumn("reason", reason).withColumn("last4", last4(number))
    return (
        screened.withColumn("decision", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
        .withColumn(
            "transaction_id", F.when(F.col("reason").isNull(), digest(seed, F.col("order_id")))
        )
        .drop("credit_card_number", "credit_card_cvv")
    )
