"""Column-expression builders shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen. Money is summed exactly (DECIMAL, whatever the order of rows) and
rounded half up like SQL's ``ROUND``; amounts that no DECIMAL holds (1e15 and
above, Infinity, NaN) are summed as DOUBLE next to it, so they neither abort an
analysis nor drop out of it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Thresholds
from . import labels as L

# amounts below EXACT_LIMIT, to ten decimals; their sums fit DECIMAL(38,10)
EXACT = "decimal(25,10)"
EXACT_LIMIT = 1e15


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: str | Column) -> Column:
    """``ROUND(c, 2)``, halves away from zero on the number as written: 1.005
    gives 1.01; Infinity and NaN stay."""
    return F.round(col(c), 2)


def exact_part(c: str | Column) -> Column:
    """The amount as DECIMAL; NULL where it does not fit."""
    return F.when(F.abs(col(c)) < EXACT_LIMIT, col(c).cast(EXACT))


def rest_part(c: str | Column) -> Column:
    """The amount as it is where ``exact_part`` has none."""
    return F.when(F.abs(col(c)) >= EXACT_LIMIT, col(c).cast("double"))


def joined(exact: Column, rest: Column) -> Column:
    """The sum of both parts as DOUBLE; NULL when both are."""
    return F.when(rest.isNull(), exact.cast("double")).otherwise(
        F.coalesce(exact.cast("double"), F.lit(0.0)) + rest)


def money_sum(c: str | Column) -> Column:
    """Sum of a money column, as DOUBLE."""
    return joined(F.sum(exact_part(c)), F.sum(rest_part(c)))


def money_total(c: str | Column) -> Column:
    return round2(money_sum(c))


def money_avg(c: str | Column) -> Column:
    """AVG over non-null values, from the sum."""
    return round2(money_sum(c) / F.count(col(c)).cast("double"))


def pct(part: Column, whole: Column) -> Column:
    """``ROUND(part * 100.0 / whole, 2)`` in DECIMAL; NULL when whole is 0."""
    count = "decimal(20,0)"
    share = part.cast(count) * F.lit(Decimal("100.0")) / F.when(whole != 0, whole.cast(count))
    return F.round(share, 2).cast("double")


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true; NULL counts as false."""
    return F.count_if(cond)


def flag(cond: Column) -> Column:
    """Boolean that is false where the condition is NULL."""
    return F.coalesce(cond, F.lit(False))


def time_slot(hour: str | Column, t: Thresholds) -> Column:
    h = col(hour)
    m, a, e, n = t.slot_hours
    return (
        F.when((h >= m) & (h < a), L.SLOT_MORNING)
        .when((h >= a) & (h < e), L.SLOT_AFTERNOON)
        .when((h >= e) & (h < n), L.SLOT_EVENING)
        .otherwise(L.SLOT_NIGHT)
    )


def amount_category(amount: str | Column, t: Thresholds) -> Column:
    a = col(amount)
    lo, mid, hi = t.amount_bands
    return (
        F.when(a < lo, L.AMOUNT_LOW)
        .when(a < mid, L.AMOUNT_MEDIUM)
        .when(a < hi, L.AMOUNT_HIGH)
        .otherwise(L.AMOUNT_VERY_HIGH)
    )


def velocity_label(minutes: str | Column, t: Thresholds) -> Column:
    m = col(minutes)
    fast, normal, slow = t.velocity_minutes
    return (
        F.when(m < fast, L.VELOCITY_VERY_FAST)
        .when(m < normal, L.VELOCITY_FAST)
        .when(m < slow, L.VELOCITY_NORMAL)
        .when(m >= slow, L.VELOCITY_SLOW)
        .otherwise(L.VELOCITY_FIRST)
    )


def slot_rank(slot: str | Column) -> Column:
    """Report order of time slots (Madrugada first)."""
    s = col(slot)
    expr = None
    for i, name in enumerate(L.SLOT_ORDER, start=1):
        expr = F.when(s == name, i) if expr is None else expr.when(s == name, i)
    return expr
