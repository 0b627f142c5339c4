"""Silver build: cleaned tables, rebuilt in full, and appended audit records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame

from tiffin.operators.quality import (
    HOT_ROWS,
    KEEP,
    audit_rows,
    clean,
    duplicate_rejections,
    hot_buckets,
    in_buckets,
    losers_per_key,
    normalise,
    rejected_keys,
    rejections,
    repeated_keys,
    repeated_rows,
)
from tiffin.plans.reconcile import kept_figures
from tiffin.plans.together import AT_ONCE, run_together
from tiffin.schemas import TABLES, TableSpec
from tiffin.sources.warehouse import SILVER, Stage, Warehouse


def stored_rejections(
    warehouse: Warehouse, spec: TableSpec, stage: Stage, null_key: str = KEEP
) -> DataFrame:
    """Rejected rows of a bronze table, with the bad keys written to the stage layer first."""
    bronze = warehouse.bronze(spec)
    bad, _ = stage.store(
        f"bad_keys_{spec.silver_name}", rejected_keys(normalise(bronze, spec), spec)
    )
    return rejections(bronze, spec, null_key, bad)


def stored_duplicates(
    warehouse: Warehouse, spec: TableSpec, stage: Stage, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Losers among the rows of a key. Of hot keys, the repeated ones, then their rows, are stored first."""
    bronze = warehouse.bronze(spec)
    rows = normalise(bronze, spec)
    hot = hot_buckets(rows, spec.key, hot_rows)
    losers = losers_per_key(bronze, spec, hot)
    if not hot:
        return losers
    keys, _ = stage.store(
        f"repeated_{spec.silver_name}", repeated_keys(rows.filter(in_buckets(spec.key, hot)), spec)
    )
    several, _ = stage.store(f"several_{spec.silver_name}", repeated_rows(bronze, spec, keys))
    return losers.unionAll(duplicate_rejections(bronze, spec, several))


def cleaned(warehouse: Warehouse, spec: TableSpec, null_key: str = KEEP) -> DataFrame:
    """The silver table of a stored bronze table, the keys of which are counted first."""
    bronze = warehouse.bronze(spec)
    return clean(bronze, spec, null_key, hot_buckets(normalise(bronze, spec), spec.key))


def build_silver_table(
    warehouse: Warehouse,
    spec: TableSpec,
    stage: Stage,
    null_key: str = KEEP,
    rejected_at: Column | None = None,
) -> tuple[int, int]:
    """Rebuild one silver table and append its rejects, both or neither; returns both row counts."""
    on = warehouse.version(SILVER, spec.silver_name)
    kept = cleaned(warehouse, spec, null_key)
    rejected = audit_rows(stored_rejections(warehouse, spec, stage, null_key), rejected_at)
    return warehouse.rebuild(kept, rejected, spec, kept_figures(spec), on)


def build_silver(
    warehouse: Warehouse,
    specs: Iterable[TableSpec] = TABLES,
    null_key: str = KEEP,
    rejected_at: Column | None = None,
    at_once: int = AT_ONCE,
) -> dict[str, tuple[int, int]]:
    """All silver tables; an error ends the build."""
    specs = list(specs)
    with Stage(warehouse) as stage:
        counts = run_together(
            warehouse.spark,
            lambda spec: build_silver_table(warehouse, spec, stage, null_key, rejected_at),
            specs,
            at_once,
        )
    return {spec.silver_name: count for spec, count in zip(specs, counts, strict=True)}
