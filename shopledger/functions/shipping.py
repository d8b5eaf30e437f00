"""Shipping quote and tracking id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.functions.seeded import digest, hex_number
from shopledger.sources.fixed_values import SHIPPING_FLAT_NANOS, SHIPPING_FLAT_UNITS, TRACKING_LETTERS


def quote_units(item_count: Column) -> Column:
    return F.when(item_count == 0, F.lit(0)).otherwise(F.lit(SHIPPING_FLAT_UNITS)).cast("bigint")


def quote_nanos(item_count: Column) -> Column:
    return F.when(item_count == 0, F.lit(0)).otherwise(F.lit(SHIPPING_FLAT_NANOS)).cast("int")


def address_text(street: Column, city: Column, state: Column) -> Column:
    return F.concat(street, F.lit(", "), city, F.lit(", "), state)


def tracking_id(order_id: Column, address: Column, seed: str) -> Column:
    """``AA-<bytes><3 digits>-<bytes/2><7 digits>`` drawn from a digest of seed and order."""
    hexa = digest(seed, order_id)
    size = F.octet_length(address)

    def letter(start: int) -> Column:
        return F.substring(
            F.lit(TRACKING_LETTERS),
            (hex_number(hexa, start, 4) % F.lit(len(TRACKING_LETTERS)) + 1).cast("int"),
            F.lit(1),
        )

    def digits(start: int, n: int) -> Column:
        return F.lpad((hex_number(hexa, start, 8) % F.lit(10**n)).cast("string"), n, "0")

    half = F.call_function("div", size, F.lit(2))
    return F.concat(
        letter(1), letter(5), F.lit("-"),
        size.cast("string"), digits(9, 3), F.lit("-"),
        half.cast("string"), digits(17, 7),
    )
