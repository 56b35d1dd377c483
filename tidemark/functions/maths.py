"""Arithmetic that never raises on zero or null input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_list, as_operand

# Earth radius in miles, and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _zero_if_null(field) -> Column:
    return F.coalesce(as_operand(field), F.lit(0))


def safe_add(fields) -> Column:
    """Sum of the fields, nulls counting as 0."""
    return reduce(lambda total, term: total + term, map(_zero_if_null, as_list(fields)))


def safe_subtract(fields) -> Column:
    """First field minus all others, nulls counting as 0."""
    return reduce(lambda total, term: total - term, map(_zero_if_null, as_list(fields)))


def safe_divide(numerator, denominator) -> Column:
    """Quotient, null where the denominator is 0 or either side is null."""
    return F.try_divide(as_operand(numerator), as_operand(denominator))


def percent_change(current, previous, digits: int = 2) -> Column:
    """Rounded change against the size of the previous value, null if that is 0."""
    current, previous = as_column(current), as_column(previous)
    return F.round(F.try_divide(current - previous, F.abs(previous)) * 100, digits)


def round_scaled(value, digits: int) -> Column:
    """Round the number scaled by 10^digits, ties away from zero.

    ``F.round`` rounds the shortest decimal that prints as the number, so the two differ where
    that decimal ends in 5 and the stored number lies just below it. The marts were defined on
    an engine that rounds this way.
    """
    scale = float(10**digits)
    return F.round(as_column(value) * scale) / scale


def width_bucket(value, low, high, buckets) -> Column:
    """Equal-width bucket 1..n; 0 below ``low``, n + 1 at or above ``high``."""
    return F.width_bucket(as_operand(value), as_operand(low), as_operand(high), as_operand(buckets))


def radians(degrees) -> Column:
    return F.radians(as_operand(degrees))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = map(as_operand, (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    chord = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord)) * (KM_PER_MILE if unit == "km" else 1)
