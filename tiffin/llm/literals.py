"""Small tables from the driver, as SQL values: local relations, whose size Spark knows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(value: str | float) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{float(value)!r}D"


def local_table(
    spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[str | float]]
) -> DataFrame:
    """A table of texts and doubles. Without rows, all columns are texts."""
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    names = ", ".join(columns)
    if not values:
        empty = ", ".join("''" for _ in columns)
        return spark.sql(f"SELECT * FROM VALUES ({empty}) AS t({names}) WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
