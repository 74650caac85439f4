"""Rates, masks, shares and associations (Column -> Column)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_CELL = 10
MIN_BASE_RANKING = 30
EXACT = T.DecimalType(24, 4)


def mask_count(value: Column, min_cell: int = MIN_CELL) -> Column:
    """Hide counts from 1 to ``min_cell - 1``; zero and NULL stay as they are."""
    return F.when(value.between(1, min_cell - 1), F.lit(None)).otherwise(value)


def exact_rate(num: Column, den: Column, scale: int = 100, digits: int = 2) -> Column:
    """``scale * num / den`` of two counts, rounded half away from zero; zero base gives NULL.

    Whole-number arithmetic: no intermediate quotient is rounded, however large the counts are.
    """
    whole = T.DecimalType(20, 0)
    top, base = num.cast(whole), F.nullif(den.cast(whole), F.lit(0).cast(whole))
    double = F.lit(2 * scale * 10**digits).cast("decimal(10,0)")
    units = F.call_function(
        "div", F.abs(top) * double + F.abs(base), F.abs(base) * F.lit(2).cast("decimal(1,0)")
    )
    sign = F.when((top < 0) != (base < 0), F.lit(-1)).otherwise(F.lit(1))
    return (units * sign).cast(whole) * F.lit(Decimal(1).scaleb(-digits))


def rate(num: Column, den: Column, scale: int = 100, digits: int = 2) -> Column:
    return exact_rate(num, den, scale, digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Part over whole; NULL without a base."""
    return F.try_divide(part.cast(EXACT), whole.cast(EXACT))


def share(part: Column, whole: Column) -> Column:
    """Part of a whole, never above one; NULL without a base."""
    exact = ratio(part, whole)
    return F.when(exact.isNotNull(), F.least(exact, F.lit(1).cast("decimal(1,0)")))


def zero_sum(*parts: Column) -> Column:
    """Sum in which a missing part counts as zero."""
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total


def published_if(value: Column, base: Column, minimum: int = MIN_CELL) -> Column:
    """The value only where its base is large enough."""
    return F.when(base >= minimum, value)


def eligible(base: Column, minimum: int = MIN_BASE_RANKING) -> Column:
    return base >= minimum


def pearson(x: Column, y: Column, digits: int = 3) -> Column:
    """Aggregate: correlation over pairs with both values; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px = F.when(both, x.cast("double"))
    py = F.when(both, y.cast("double"))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.round(F.try_divide(F.covar_pop(px, py), spread), digits)


def weighted_percentage(hits: Column, size: Column, pct: Column) -> Column:
    """Aggregate: 100 * hits / size over rows with ``pct``, else the size-weighted mean of ``pct``."""
    base = F.nullif(F.sum(F.when(pct.isNotNull(), size)), F.lit(0)).cast(EXACT)
    hit_sum = F.sum(F.when(pct.isNotNull(), hits)).cast(EXACT)
    # A sum widens its decimal type; narrowed again, the quotient keeps its digits.
    mean = F.try_divide(F.sum((pct * size).cast(EXACT)).cast(EXACT), base)
    exact = F.try_divide(hit_sum * F.lit(100).cast("decimal(3,0)"), base)
    kind = T.DecimalType(38, 12)
    return F.coalesce(exact.cast(kind), mean.cast(kind))


def local_time(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))
