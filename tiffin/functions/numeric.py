"""Shares and means rounded to two decimals without double error.

All arithmetic is on decimals, where ``round`` is half away from zero. ``avg`` over a decimal column
keeps only four more digits than its input and would round twice, so a mean is a sum over a count at
high scale. The operand types below leave at least 14 fractional digits before the final rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COUNT = "decimal(18,0)"
_AMOUNT = "decimal(20,2)"
RATIO = "decimal(20,2)"


def _or_null_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("decimal(1,0)"))


def pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, both counts; NULL where ``whole`` is 0."""
    share = part.cast(_COUNT) * F.lit(100) / _or_null_if_zero(whole.cast(_COUNT))
    return F.round(share, 2).cast(RATIO)


def pct_amount(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, both amounts with two decimals."""
    share = part.cast(_AMOUNT) * F.lit(100) / _or_null_if_zero(whole.cast(_AMOUNT))
    return F.round(share, 2).cast(RATIO)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a total (whole or with two decimals) and a count; NULL where the count is 0."""
    return F.round(total.cast(_AMOUNT) / _or_null_if_zero(count.cast(_COUNT)), 2).cast(RATIO)


def avg2(c: Column) -> Column:
    """Aggregate: mean of the non-NULL values of ``c``, rounded to two decimals."""
    return mean_of(F.sum(c), F.count(c))
