"""Scalar and aggregate column expressions of the model.

All of them are built from ``pyspark.sql.functions``, so they compile into
whole-stage codegen; none of them calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import COORDINATE, MICROS_PER_DAY, MONEY, MONEY_SUM


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Signed microseconds from ``start`` to ``end``; NULL if either is NULL.

    ``timestampdiff`` works on zone-less timestamps (``unix_micros`` does not).
    """
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def day_diff(end: Column | str, start: Column | str) -> Column:
    """Fractional days ``end - start`` as double, sign kept, NULL-propagating."""
    return micros_between(start, end) / F.lit(MICROS_PER_DAY)


def hour_diff(end: Column | str, start: Column | str) -> Column:
    """Fractional hours ``end - start`` (the day difference times 24)."""
    return day_diff(end, start) * F.lit(24)


def year_part(ts: Column | str) -> Column:
    return F.year(_c(ts))


def month_part(ts: Column | str) -> Column:
    return F.month(_c(ts))


def year_month_label(ts: Column | str) -> Column:
    """``yyyy-MM`` text of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def late_flag(delivered: Column | str, estimated: Column | str) -> Column:
    """Three-valued: NULL when either date is NULL, else delivered > estimated."""
    return _c(delivered) > _c(estimated)


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``1 - num / den`` as double, NULL when the denominator is 0 (or NULL)."""
    den = _c(denominator)
    return F.when(den != 0, F.lit(1.0) - _c(numerator).cast("double") / den)


def round_money(col: Column | str) -> Column:
    """Money to two places as DECIMAL(14,2) (half-up on the decimal value)."""
    return _c(col).cast(MONEY)


def sum_money(col: Column | str) -> Column:
    """Exact, order-independent sum of single money values (DECIMAL(14,2)).

    Summed as whole cents in a 64-bit integer (fast fixed-width arithmetic
    instead of an arbitrary-precision buffer) and turned back into
    DECIMAL(18,2) once per group; an overflow raises under ANSI mode.
    """
    cents = (_c(col).cast(MONEY) * 100).cast("long")
    return (F.sum(cents).cast("decimal(18,0)") / 100).cast(MONEY_SUM)


def sum_totals(col: Column | str) -> Column:
    """Exact sum of already-summed money (DECIMAL(18,2) totals)."""
    return F.sum(_c(col)).cast(MONEY_SUM)


def avg_money(col: Column | str) -> Column:
    """Average of a money column: exact decimal sum, then one double division."""
    c = _c(col)
    return F.sum(c).cast("double") / F.count(c)


def avg_score(col: Column | str) -> Column:
    """Average of per-order mean scores: summed as decimals of 12 places, so the result
    does not depend on row order."""
    c = _c(col)
    return F.sum(c.cast("decimal(20,12)")).cast("double") / F.count(c)


def avg_micros_as_days(micros: Column | str) -> Column:
    """Average of a duration given in whole microseconds, returned in days.

    Summing integers keeps the result independent of row order; averaging the
    per-row double values would not be. The sum is a decimal of 30 digits: a 64-bit
    one overflows at 290,000 years, which 100,000 orders of three years each reach.
    """
    m = _c(micros)
    return F.sum(m.cast("decimal(20,0)")).cast("double") / F.count(m) / F.lit(MICROS_PER_DAY)


def mean_coordinate(col: Column | str) -> Column:
    """Mean of a coordinate, nulls skipped, rounded to 7 places.

    The sum runs in DECIMAL(20,15) so it does not depend on row order; the mean
    of full-precision inputs is then rounded once, like the reference does.
    """
    c = _c(col)
    return (F.sum(c.cast("decimal(20,15)")).cast("double") / F.count(c)).cast(COORDINATE)


def first_by_order(value: Column | str, order: Column | str) -> Column:
    """Value of the row with the smallest ``order`` among rows where value is set.

    Makes "first non-null in file order" explicit; equal orders give the smallest value.
    """
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), F.struct(_c(order).alias("o"), v.alias("v"))))


def any_not_null(*cols: Column | str) -> Column:
    """Per-row flag: at least one of the columns is set."""
    flag = _c(cols[0]).isNotNull()
    for c in cols[1:]:
        flag = flag | _c(c).isNotNull()
    return flag
