"""Bronze load: CSV extracts appended to typed tables, with a report."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tiffin.operators.quality import audit_rows
from tiffin.plans.together import AT_ONCE, run_together
from tiffin.schemas import TABLES, TableSpec
from tiffin.sources.csv_files import (
    RAISE,
    SKIP,
    malformed_records,
    path_exists,
    read_bronze_csv,
)
from tiffin.sources.warehouse import Warehouse

LOADED, LOADED_BEFORE, MISSING, MALFORMED = "loaded", "loaded before", "missing", "malformed"
TO_AUDIT = "audit"


def load_bronze(
    warehouse: Warehouse,
    csv_folder: str,
    specs: Iterable[TableSpec] = TABLES,
    multiline: bool | None = None,
    at_once: int = AT_ONCE,
    day_first: bool = False,
    malformed: str = RAISE,
    load_id: str | None = None,
) -> list[tuple[str, str, int | None]]:
    """Append ``<csv_folder>/<Table>.csv`` to each bronze table; a missing file is reported only.

    Parse, convert and write are one pass, without a shuffle. The counts come from that
    write; each output partition counts once, also when a task is run again. ``malformed="audit"``
    writes records that do not fit the header to the audit and loads the others, with a line of its
    own in the report; by default such a record ends the load.

    A table takes in all of an extract or nothing. ``load_id`` names the load: repeated after a failure, it
    passes over the tables that have it already. Loads without a name are always new ones.
    """
    load_id = load_id or uuid.uuid4().hex
    if malformed not in (RAISE, TO_AUDIT):
        raise ValueError(f"malformed must be '{RAISE}' or '{TO_AUDIT}', not {malformed!r}")
    how = SKIP if malformed == TO_AUDIT else RAISE

    def load(spec: TableSpec) -> list[tuple[str, str, int | None]]:
        path = f"{csv_folder.rstrip('/')}/{spec.bronze_name}.csv"
        if not path_exists(warehouse.spark, path):
            return [(spec.bronze_name, MISSING, None)]
        if (before := warehouse.loaded(spec, load_id)) is not None:
            return [(spec.bronze_name, LOADED_BEFORE, before)]
        rows = read_bronze_csv(warehouse.spark, path, spec, multiline, day_first, how)
        bad = None
        if malformed == TO_AUDIT:
            bad = audit_rows(malformed_records(warehouse.spark, path, spec, multiline))
        counts = warehouse.load(rows, spec, load_id, bad)
        return [(spec.bronze_name, status, n) for status, n in zip((LOADED, MALFORMED), counts, strict=False)]

    return [step for steps in run_together(warehouse.spark, load, specs, at_once) for step in steps]


def load_report(spark: SparkSession, report: list[tuple[str, str, int | None]]) -> DataFrame:
    return spark.createDataFrame(report, "table_name string, status string, rows bigint")
