"""Checks that report bad values without changing the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rating_out_of_range(rows: DataFrame, column: str, low: Decimal, high: Decimal) -> DataFrame:
    """Rows whose rating lies outside ``low`` to ``high``; a missing rating is not reported."""
    return rows.filter(~F.col(column).between(F.lit(low), F.lit(high)))


def value_not_in(rows: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """``(value, n)`` for the values of ``column`` outside ``allowed``; NULL is not reported."""
    return (
        rows.filter(~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class Link:
    """A foreign key: ``child.column`` holds values of ``parent.key``."""

    child: str
    column: str
    parent: str
    key: str


def orphans(tables: Mapping[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """``(table_name, foreign_key, value, n)``: foreign keys that their parent lacks, with their row counts.

    All links at once. Every row of a table becomes the values it uses and the keys it offers, so each table is
    read once; one aggregate over (link, value), which combines before the shuffle, finds what is used and not offered.
    """
    parts = []
    for name, table in tables.items():
        uses = [(i, link.column, True) for i, link in enumerate(links) if link.child == name]
        offers = [(i, link.key, False) for i, link in enumerate(links) if link.parent == name]
        tagged = [
            F.struct(
                F.lit(i).alias("link"),
                F.col(column).cast("string").alias("value"),
                F.lit(int(used)).cast("bigint").alias("used"),
                F.lit(not used).alias("offered"),
            )
            for i, column, used in uses + offers
        ]
        if tagged:
            parts.append(table.select(F.inline(F.array(*tagged))).filter("value IS NOT NULL"))
    per_value = (
        reduce(DataFrame.unionAll, parts)
        .groupBy("link", "value")
        .agg(F.sum("used").alias("n"), F.max("offered").alias("known"))
    )
    children = F.array(*[F.lit(link.child) for link in links])
    columns = F.array(*[F.lit(link.column) for link in links])
    return per_value.filter("n > 0 AND NOT known").select(
        F.element_at(children, F.col("link") + 1).alias("table_name"),
        F.element_at(columns, F.col("link") + 1).alias("foreign_key"),
        "value",
        "n",
    )
