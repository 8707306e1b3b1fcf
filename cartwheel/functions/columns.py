"""Column helpers. All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / nullif(den, 0)`` as DOUBLE: NULL instead of an error or infinity (trap T8)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d != 0, n / d)


def round_half_up(x: ColumnOrName, digits: int) -> Column:
    """Round a DOUBLE to ``digits`` places, halves away from zero (trap T5).

    Written with ``floor`` on the scaled magnitude, because ``round`` of a DOUBLE
    goes through its decimal text in some engines and not in others.
    """
    scale = float(10**digits)
    v = _c(x)
    return (F.signum(v) * F.floor(F.abs(v) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


MONEY = "decimal(38,12)"


def money(x: ColumnOrName) -> Column:
    """Decimal view of a number with 12 fractional digits (26 before the point), so sums
    do not depend on row order (trap T13) and converted currencies keep their fractions."""
    return _c(x).cast(MONEY)


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` as INT."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar days from ``start`` to ``end`` (midnight crossings) as BIGINT."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def week_diff(start: ColumnOrName, end: ColumnOrName, calendar_weeks: bool = False) -> Column:
    """Weeks from ``start`` to ``end`` as BIGINT.

    Default: whole 7-day spans, ``floor(days / 7)`` (trap T4). With
    ``calendar_weeks`` the number of Monday boundaries crossed.
    """
    if calendar_weeks:
        return F.floor(
            F.datediff(F.trunc(F.to_date(_c(end)), "week"), F.trunc(F.to_date(_c(start)), "week")) / 7
        ).cast("bigint")
    return F.floor(F.datediff(F.to_date(_c(end)), F.to_date(_c(start))) / 7).cast("bigint")
