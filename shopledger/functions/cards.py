"""Card number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.sources.fixed_values import MASTERCARD_PATTERN, VISA_PATTERN


def passes_luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def brand(number: Column) -> Column:
    return (
        F.when(number.rlike(VISA_PATTERN), "visa")
        .when(number.rlike(MASTERCARD_PATTERN), "mastercard")
        .otherwise("other")
    )


def last4(number: Column) -> Column:
    return F.right(number, F.lit(4))
