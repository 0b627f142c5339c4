"""Joins that stay balanced when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def spread_join(
    rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` to a table that is grouped by ``key`` and small beside them.

    A grouped table is already partitioned by the key, so a plain join would bring the rows of each
    key into one task and Spark could not split it. Here the rows of a key are first spread over
    ``salts`` parts by their content, and ``per_key`` is repeated for each part. Both sides then meet
    in a shuffle of their own, where Spark splits what is still too large. The repeated table is never
    broadcast, as Spark estimates its size without the repetition. ``per_key`` is copied ``salts``
    times, so it should hold narrow values only. A stored table needs none of this: a plain join gives
    it a shuffle of its own, or broadcasts it by its size on disk.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        rows.withColumn("_part", part)
        .join(per_key.withColumn("_part", every_part).hint("merge"), [key, "_part"], how)
        .drop("_part")
    )
