"""Numeric column expressions: lenient cast, stable rounding, percent change, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles from here on carry no digits after the point worth rounding, and the
# decimal type used below holds every smaller one.
_ROUNDABLE = 1e15


def to_number(c: Column) -> Column:
    """Cast to double; text that is no number, and NaN, become NULL."""
    return nan_to_null(c.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    """NULL for NaN, which would turn a whole mean into NaN."""
    return F.nullif(c, F.lit(float("nan")))


def round_stable(c: Column, decimals: int) -> Column:
    """Round half up after snapping to eight decimals.

    The order in which a distributed sum adds its doubles changes the last bits of a mean.
    Snapping first makes a mean that is a tie on paper a tie in the plan too, so a result
    does not depend on how its rows were partitioned.
    """
    v = c.cast("double")
    snapped = F.round(v.try_cast("decimal(24,8)"), decimals).cast("double")
    return F.when(F.abs(v) < _ROUNDABLE, snapped).otherwise(v)


def round_stable_text(name: str, decimals: int) -> str:
    """:func:`round_stable` of a column as an expression: one call where a table has many."""
    v = f"CAST(`{name}` AS double)"
    snapped = f"CAST(round(try_cast({v} AS decimal(24,8)), {int(decimals)}) AS double)"
    return f"CASE WHEN abs({v}) < {_ROUNDABLE} THEN {snapped} ELSE {v} END"


def pct_change(new: Column, old: Column) -> Column:
    """Percent by which ``new`` differs from ``old``; NULL when ``old`` is 0 or NULL."""
    return F.try_divide(new - old, old) * 100


def _round_binary(v: Column, scale: int) -> Column:
    """Round a non-negative double to 1/``scale`` by its exact binary value, half to even.

    The JVM formatter rounds the shortest decimal text instead and prints 15.95 as 16.0,
    though the stored double lies below the tie. The fraction is split in two short parts so
    that both products are exact; the sign of their sum then tells the side of the tie.
    """
    whole = F.floor(v).cast("double")
    frac = v - whole
    high = F.floor(frac * 2.0**26) / 2.0**26
    digit = F.floor(high * scale).cast("double")
    side = (high * scale - digit - 0.5) + (frac - high) * scale
    odd = (whole * scale + digit) % 2 == 1
    up = (side > 0) | ((side == 0) & odd)
    return whole + (digit + F.when(up, 1.0).otherwise(0.0)) / scale


def signed_percent_label(p: Column) -> Column:
    """One-decimal percent with its sign, such as ``-26.5%``; NULL stays NULL."""
    sign = F.when(p < 0, "-").otherwise("+")
    text = F.format_string("%.1f%%", _round_binary(F.abs(p), 10))
    return F.when(p.isNotNull(), F.concat(sign, text))


def whole_number_label(v: Column) -> Column:
    """Value without decimals, ties to even; NULL stays NULL."""
    return F.when(v.isNotNull(), F.format_string("%.0f", F.rint(v)))
