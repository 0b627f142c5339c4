"""Running totals over cohorts."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def running_total(value: str, partition: str, order: str) -> Column:
    """Sum of ``value`` up to the current row; a NULL ``order`` comes last.

    Meant for rows already grouped by ``(partition, order)``: a partition then holds one row per
    month, however many records lie behind it.
    """
    window = (
        Window.partitionBy(partition)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(value).over(window)
