"""Currency conversion through EUR in IEEE doubles, with the carry between units and nanos."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BILLION = 1e9


def converted(
    units: Column, nanos: Column, from_rate: Column, to_rate: Column
) -> tuple[Column, Column]:
    """(units, nanos) of a non-negative amount after conversion; NULL when a rate is NULL.

    Nanos are rounded half up after the step into EUR and floored after the step out
    of it. Converting between equal codes is not skipped: it may move a nano.
    """
    billion = F.lit(_BILLION)
    units_eur = units.cast("double") / from_rate
    nanos_eur = nanos.cast("double") / from_rate + (units_eur % F.lit(1.0)) * billion
    whole_eur = F.floor(units_eur) + F.floor(nanos_eur / billion)
    rest_eur = F.floor((nanos_eur % billion) + F.lit(0.5))

    units_out = whole_eur * to_rate
    nanos_out = rest_eur * to_rate + (units_out % F.lit(1.0)) * billion
    whole_out = F.floor(units_out) + F.floor(nanos_out / billion)
    rest_out = F.floor(nanos_out % billion)
    return whole_out.cast("bigint"), rest_out.cast("bigint")
