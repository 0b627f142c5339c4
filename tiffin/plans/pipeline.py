"""The whole pipeline: bronze, silver, gold, reconciliation."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.operators.quality import KEEP
from tiffin.plans import gold
from tiffin.plans.bronze import load_bronze, load_report
from tiffin.plans.reconcile import (
    CHECKS,
    COUNTS,
    SOLD,
    kept_counts,
    known_figures,
    reconcile_checks,
    sold_quantities,
)
from tiffin.plans.silver import build_silver
from tiffin.plans.together import AT_ONCE, run_together
from tiffin.schemas import GOLD_SCHEMAS, TABLES
from tiffin.sources.csv_files import RAISE
from tiffin.sources.warehouse import AUDIT, GOLD, SILVER, Stage, Warehouse

GOLD_TABLES = tuple(GOLD_SCHEMAS)

Step = tuple[str, str, str, int | None]


def silver_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {spec.silver_name: warehouse.silver(spec) for spec in TABLES}


def gold_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.read(GOLD, name, schema) for name, schema in GOLD_SCHEMAS.items()}


def gold_plan(
    name: str,
    silver: Callable[[str], DataFrame],
    as_of: datetime.date | str | None = None,
    store: Callable[[str, DataFrame], tuple[DataFrame, int | None]] | None = None,
) -> DataFrame:
    """Plan of one gold table over the silver tables that ``silver`` gives by name.

    ``store(name, plan)`` gives an intermediate table back as a stored one, with its number of rows;
    without it, intermediate tables stay part of the plan and are computed each time they are used.
    """
    store = store or (lambda _, plan: (plan, None))
    orders = silver("orders")
    if name == "orders_summary":
        totals, _ = store("order_totals", gold.order_totals(orders, silver("order_items")))
        return gold.orders_summary(orders, totals)
    if name == "menu_performance":
        menu = gold.menu_items(silver("order_items"), orders, silver("restaurants"))
        stored, rows = store("menu_items", menu)
        if rows is None:
            return gold.menu_performance(stored, orders)
        totals, _ = store("cuisine_totals", gold.cuisine_totals(stored))
        return gold.menu_performance(stored, orders, totals)
    if name == "customer_summary":
        return gold.customer_summary(silver("customers"), orders, as_of)
    if name == "restaurant_summary":
        totals, _ = store("order_totals", gold.order_totals(orders, silver("order_items")))
        return gold.restaurant_summary(silver("restaurants"), totals)
    if name == "partner_summary":
        return gold.partner_summary(silver("delivery_partners"), orders, as_of)
    raise ValueError(f"no gold table {name!r}")


def _sold(warehouse: Warehouse, stage: Stage) -> int:
    """The quantity that the menu must hold, from the totals of the orders, which other gold tables use, too."""
    silver = warehouse.silver_by_name
    totals, _ = stage.store("order_totals", gold.order_totals(silver("orders"), silver("order_items")))
    return sold_quantities(totals, silver("restaurants")).agg(F.sum("quantity")).first()[0] or 0


def build_gold(
    warehouse: Warehouse,
    as_of: datetime.date | str | None = None,
    mode: str = "overwrite",
    on_error: str = "raise",
    at_once: int = AT_ONCE,
) -> list[Step]:
    """All gold tables from the stored silver tables.

    ``mode="ignore"`` leaves tables that exist as they are. ``on_error="skip"`` builds one table after
    the other, records one that fails, skips those after it and returns, instead of raising.
    Intermediate tables are written once to the stage layer of this run.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    with Stage(warehouse) as stage:

        def build(name: str) -> Step:
            if mode == "ignore" and warehouse.exists(GOLD, name):
                return "gold", name, "kept", None
            plan = gold_plan(name, warehouse.silver_by_name, as_of, stage.store)
            known = {SOLD: _sold(warehouse, stage)} if name == "menu_performance" else {}
            return "gold", name, "built", warehouse.write(plan, GOLD, name, mode, known=known)

        if on_error == "raise":
            return run_together(warehouse.spark, build, GOLD_TABLES, at_once)
        steps: list[Step] = []
        for i, name in enumerate(GOLD_TABLES):
            try:
                steps.append(build(name))
            except Exception as error:
                steps.append(("gold", name, f"failed: {type(error).__name__}", None))
                steps.extend(("gold", later, "skipped", None) for later in GOLD_TABLES[i + 1 :])
                break
        return steps


def run_pipeline(
    warehouse: Warehouse,
    csv_folder: str,
    as_of: datetime.date | str | None = None,
    null_key: str = KEEP,
    gold_mode: str = "overwrite",
    on_gold_error: str = "raise",
    rejected_at: Column | None = None,
    multiline: bool | None = None,
    day_first: bool = False,
    malformed: str = RAISE,
    load_id: str | None = None,
) -> DataFrame:
    """Run all layers and the reconciliation; returns ``(layer, table_name, status, rows)``.

    There is a row per table, then one per count and check of the reconciliation, which also runs after
    a gold table that failed. A run that is repeated with its ``load_id`` loads no table twice. The load report is kept as the table ``load_report`` of the audit layer
    as soon as bronze is loaded, the report of the whole run as ``run_report``.
    """
    loaded = load_bronze(
        warehouse,
        csv_folder,
        multiline=multiline,
        day_first=day_first,
        malformed=malformed,
        load_id=load_id,
    )
    warehouse.write(load_report(warehouse.spark, loaded), AUDIT, "load_report")
    steps: list[Step] = [("bronze", *step) for step in loaded]
    for name, (kept, rejected) in build_silver(
        warehouse, null_key=null_key, rejected_at=rejected_at
    ).items():
        steps.append(("silver", name, "built", kept))
        steps.append(("audit", name, "appended", rejected))
    steps.extend(build_gold(warehouse, as_of, gold_mode, on_gold_error))
    steps.extend(reconcile_steps(warehouse))
    report = warehouse.spark.createDataFrame(
        steps, "layer string, table_name string, status string, rows bigint"
    )
    warehouse.write(report, AUDIT, "run_report")
    return report


def stored_tables(warehouse: Warehouse) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The silver and the gold tables that are there."""
    silver = {
        spec.silver_name: warehouse.silver(spec)
        for spec in TABLES
        if warehouse.exists(SILVER, spec.silver_name)
    }
    gold_ = {
        name: warehouse.read(GOLD, name, schema)
        for name, schema in GOLD_SCHEMAS.items()
        if warehouse.exists(GOLD, name)
    }
    return silver, gold_


def reconcile(warehouse: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Counts and checks over the stored silver and gold tables that are there."""
    silver, gold_ = stored_tables(warehouse)
    return kept_counts(warehouse), reconcile_checks(silver, gold_, known_figures(warehouse))


def reconcile_steps(warehouse: Warehouse) -> list[Step]:
    """A report row for each count and check; an error of the reconciliation is a row too.

    Checks have the status ``ok``, ``differs`` or ``missing`` (a table is not there) and the figure
    found in gold.
    """
    try:
        counted, checked = reconcile(warehouse)
        counts = {r["name"]: r["value"] for r in counted.collect()}
        checks = {r["check"]: r for r in checked.collect()}
    except Exception as error:
        return [("reconcile", "all", f"failed: {type(error).__name__}", None)]
    steps: list[Step] = [
        ("reconcile", name, "counted" if name in counts else "missing", counts.get(name))
        for name in COUNTS
    ]
    for name in CHECKS:
        found = checks.get(name)
        sides = (found["expected"], found["actual"]) if found else (None, None)
        status = "missing" if None in sides else "ok" if found["ok"] else "differs"
        steps.append(("reconcile", name, status, sides[1]))
    return steps
