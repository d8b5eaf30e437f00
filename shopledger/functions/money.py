"""Exact money arithmetic.

An amount is (currency_code, units, nanos). Single amounts are multiplied in 64-bit
integers with a carry; sums end in one DECIMAL(38,0) of total nanos, so they do not
depend on order and never lose a nano. Units and nanos are split off again at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.sources.fixed_values import CURRENCY_SYMBOLS, DEFAULT_CURRENCY_SYMBOL

NANOS_PER_UNIT = 1_000_000_000
NANOS_MAX = NANOS_PER_UNIT - 1
TOTAL_TYPE = "decimal(38,0)"


def _billion() -> Column:
    return F.lit(NANOS_PER_UNIT).cast("decimal(10,0)")


def total_nanos(units: Column, nanos: Column) -> Column:
    """(units, nanos) as one exact number of nanos."""
    return (units.cast("decimal(20,0)") * _billion() + nanos.cast("decimal(10,0)")).cast(TOTAL_TYPE)


def times(units: Column, nanos: Column, quantity: Column) -> tuple[Column, Column]:
    """(units, nanos) of an amount taken ``quantity`` (a 32-bit integer) times."""
    rest = nanos.cast("bigint") * quantity.cast("bigint")
    billion = F.lit(NANOS_PER_UNIT).cast("bigint")
    whole = units.cast("bigint") * quantity.cast("bigint") + F.call_function("div", rest, billion)
    return whole, (rest % billion).cast("int")


# Nanos are summed in two parts below 2**16 each, so 64-bit sums hold for 10**14 rows per group.
_PART = 1 << 15


def exact_sum(units: Column, nanos: Column) -> Column:
    """Aggregate: the exact total nanos of a group, from 64-bit partial sums."""
    part = F.lit(_PART).cast("bigint")
    rest = nanos.cast("bigint")
    whole = F.sum(units.cast("bigint")).cast("decimal(20,0)") * _billion()
    high = F.sum(F.call_function("div", rest, part)).cast("decimal(20,0)") * part.cast("decimal(5,0)")
    return (whole + high + F.sum(rest % part).cast("decimal(20,0)")).cast(TOTAL_TYPE)


def units_of(total: Column) -> Column:
    """Whole units of a total, truncated toward zero."""
    return F.call_function("div", total, _billion()).cast("bigint")


def nanos_of(total: Column) -> Column:
    """Remaining nanos of a total; carries the sign of the total."""
    return (total % _billion()).cast("int")


def is_valid(units: Column, nanos: Column) -> Column:
    same_sign = (units == 0) | (nanos == 0) | ((units > 0) == (nanos > 0))
    return nanos.between(-NANOS_MAX, NANOS_MAX) & same_sign


def is_zero(units: Column, nanos: Column) -> Column:
    return (units == 0) & (nanos == 0)


def is_positive(units: Column, nanos: Column) -> Column:
    return is_valid(units, nanos) & ((units > 0) | ((units == 0) & (nanos > 0)))


def is_negative(units: Column, nanos: Column) -> Column:
    return is_valid(units, nanos) & ((units < 0) | ((units == 0) & (nanos < 0)))


def same_currency(left_code: Column, right_code: Column) -> Column:
    """Two amounts are comparable only when both carry the same, non-empty code."""
    return (left_code == right_code) & (left_code != "")


def sum_failure(
    left: tuple[Column, Column, Column], right: tuple[Column, Column, Column]
) -> Column:
    """Why two (code, units, nanos) amounts cannot be added, or NULL when they can."""
    both_valid = is_valid(left[1], left[2]) & is_valid(right[1], right[2])
    return F.when(~both_valid, F.lit("invalid_value")).when(
        left[0] != right[0], F.lit("mismatching_currency")
    )


def display(code: Column, units: Column, nanos: Column) -> Column:
    """Symbol and two truncated decimals, for amounts >= 0."""
    cents = F.call_function("div", nanos.cast("bigint"), F.lit(10_000_000).cast("bigint"))
    return F.concat(symbol(code), units.cast("string"), F.lit("."), F.lpad(cents.cast("string"), 2, "0"))


def symbol(code: Column) -> Column:
    pairs = [F.lit(x) for item in CURRENCY_SYMBOLS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(DEFAULT_CURRENCY_SYMBOL))


def long_text(code: Column, units: Column, nanos: Column) -> Column:
    """All nine decimals and the code: ``12.340000000 EUR``."""
    return F.concat(
        units.cast("string"), F.lit("."), F.lpad(nanos.cast("string"), 9, "0"), F.lit(" "), code
    )


def whole_and_cents(amount: Column) -> tuple[Column, Column]:
    """A double cut into whole units and cents by truncation; binary error stays visible."""
    whole = amount.cast("int")
    return whole, ((amount - whole) * F.lit(100.0)).cast("int")
