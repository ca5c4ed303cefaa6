"""Column expressions reused by batch and streaming operators."""

from functools import reduce

from pyspark.sql import functions as F


#: Digits after the point that amounts are summed with.
SCALE = 6

# Bits of an integer that ``wide_sum`` adds up apart from those above them.
_LOWER = 20


def units(column):
    """An amount in millionths: integer sums are exact in any order and cheap to add up.

    Halves of a millionth are rounded away from 0. NaN, infinities and single amounts beyond 64 bits
    (some 9.2 million millions) are errors, not wrong numbers; so are their sums by ``F.sum``, but not by ``wide_sum``.
    """
    return F.round(F.col(column) * 10 ** SCALE).cast("long")


def wide_sum(integers):
    """Exact sum of 64-bit integers as a decimal, which may itself be too large for 64 bits.

    Upper and lower bits are summed apart, each in 64 bits: there is room for sums of up to 83 bits, and for 2 ** 43 rows.
    """
    upper, lower = F.shiftright(integers, _LOWER), integers.bitwiseAND((1 << _LOWER) - 1)
    return F.sum(upper).cast("decimal(20,0)") * (1 << _LOWER) + F.sum(lower)


def amount(summed_units):
    """Summed millionths as a double in the currency unit, rounded once."""
    return (summed_units.cast("decimal(25,0)") / 10 ** SCALE).cast("double")


def total(column):
    """Exact sum of an amount."""
    return amount(wide_sum(units(column)))


def growth(current, previous):
    """Relative change; null unless the previous value is positive."""
    return F.when(previous > 0, (current - previous) / previous)


def percentage(part, whole):
    """``part`` in ``whole`` as a percentage, 0 when there is nothing to divide by."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def year_of(column):
    return F.year(column).alias("ano")


def quarter_of(column):
    return F.quarter(column).alias("trimestre")


def period_start(column, period):
    """First day of the calendar period holding ``column``."""
    return F.date_trunc(period, column).cast("date")


def same_keys(left, right, keys):
    """Null-safe equality on every key: a null segment matches a null segment."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
