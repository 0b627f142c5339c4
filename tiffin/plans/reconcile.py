"""Reconciliation of silver and gold.

All figures are sums of contributions of rows. Those of silver are added up while a table is written, and kept
with it in the log of the warehouse, so that a reconciliation reads them there and no fact table. Figures that are
not kept come from one pass over their table, and one small shuffle adds up those of all tables. Tables that
are missing have no figures.

Sums of hashes of the rows are kept, too. ``stored_figures`` holds them against the stored rows: a row that was
lost, added or changed after the write makes them differ.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.plans import gold as gold_plans
from tiffin.schemas import TABLES, TableSpec
from tiffin.sources.warehouse import GOLD, SILVER, Warehouse

# Names of the counts, with the layer and table each one counts.
COUNTS = {
    "total_orders": ("silver", "orders"),
    "gold_total_orders": ("gold", "orders_summary"),
    "total_customers": ("silver", "customers"),
    "gold_total_customers": ("gold", "customer_summary"),
    "total_restaurants": ("silver", "restaurants"),
    "gold_total_restaurants": ("gold", "restaurant_summary"),
    "total_partners": ("silver", "delivery_partners"),
    "gold_total_partners": ("gold", "partner_summary"),
}

# Kept with the menu, by the build of which it is counted in another way.
SOLD = "silver.sold.quantity"

# Check: the figure from silver that the figure from gold must equal.
CHECKS = {
    "orders_in_summary": ("silver.orders.ids", "gold.orders_summary.orders"),
    "customers_in_running_totals": ("silver.customers.ids", "gold.customer_summary.last"),
    "customers_in_cohorts": ("silver.customers.ids", "gold.customer_summary.new"),
    "restaurants_in_running_totals": ("silver.restaurants.ids", "gold.restaurant_summary.last"),
    "restaurants_in_cohorts": ("silver.restaurants.ids", "gold.restaurant_summary.new"),
    "partners_in_all_row": ("silver.delivery_partners.ids", "gold.partner_summary.all"),
    "partners_by_vehicle": ("silver.delivery_partners.ids", "gold.partner_summary.vehicles"),
    "quantity_in_menu": (SOLD, "gold.menu_performance.quantity"),
}

Tables = Mapping[str, DataFrame]

_KEYS = {
    "orders": "Order_id",
    "customers": "Customer_id",
    "restaurants": "Restaurant_id",
    "delivery_partners": "Partner_id",
}


_CONTENT = {"content_a": F.xxhash64, "content_b": F.hash}
# Sums of up to 10^12 rows fit 64 bits.
_CONTENT_RANGE = 1_000_003


def kept_figures(spec: TableSpec) -> dict[str, Column]:
    """What is added up while a silver table is written."""
    columns = [x for c in spec.silver_columns for x in (F.col(c), F.col(c).isNull())]
    content = {n: F.pmod(hashed(*columns), F.lit(_CONTENT_RANGE)) for n, hashed in _CONTENT.items()}
    return {"ids": F.col(spec.key).isNotNull().cast("int"), **content}


def known_figures(warehouse: Warehouse) -> dict[str, int]:
    """The figures that the warehouse has kept, by their full names."""
    known = {}
    for layer in (SILVER, GOLD):
        for table, state in warehouse.states(layer).items():
            known[f"{layer}.{table}.rows"] = state.rows
            known |= {name if "." in name else f"{layer}.{table}.{name}": v for name, v in state.figures.items()}
    return known


def stored_figures(warehouse: Warehouse) -> DataFrame:
    """``(table_name, figure, kept, found, ok)`` for silver tables: the figures kept, and those of the rows stored now.

    Each table is read once, and its figures are one aggregate.
    """
    parts = []
    for spec in TABLES:
        state = warehouse.states(SILVER).get(spec.silver_name)
        if state is None or not state.figures:
            continue
        kept = {"rows": state.rows, **state.figures}
        sums = {"rows": F.lit(1), **kept_figures(spec)}
        found = warehouse.silver(spec).agg(
            *[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(n) for n, c in sums.items()]
        )
        figures = [
            F.struct(F.lit(n).alias("figure"), F.lit(kept[n]).cast("bigint").alias("kept"), F.col(n).alias("found"))
            for n in sums
        ]
        parts.append(found.select(F.lit(spec.silver_name).alias("table_name"), F.inline(F.array(*figures))))
    if not parts:
        raise ValueError("no figures are kept")
    return reduce(DataFrame.unionAll, parts).withColumn("ok", F.col("kept") == F.col("found"))


def _contributions(table: str, df: DataFrame, **values: Column) -> tuple[list[str], DataFrame]:
    """The names of a table's figures, and what each row adds to each of them."""
    names = [f"{table}.{name}" for name in values]
    parts = [
        F.struct(F.lit(name).alias("figure"), F.coalesce(value.cast("bigint"), F.lit(0)).alias("value"))
        for name, value in zip(names, values.values(), strict=True)
    ]
    return names, df.select(F.inline(F.array(*parts)))


def _cohorts(df: DataFrame, total: str, new: str) -> DataFrame:
    return df.groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(new).alias("new"), F.max(total).alias("last")
    )


def _figures(silver: Tables, gold: Tables, known: Mapping[str, int]) -> DataFrame | None:
    """``(figure, value)`` of the tables that are there, without those that are known."""
    one = F.lit(1)
    parts = []
    for table, key in _KEYS.items():
        if table in silver and not {f"silver.{table}.rows", f"silver.{table}.ids"} <= set(known):
            has_key = F.col(key).isNotNull().cast("int")
            parts.append(_contributions(f"silver.{table}", silver[table], rows=one, ids=has_key))
    if "orders_summary" in gold:
        orders = F.col("total_orders")
        parts.append(
            _contributions("gold.orders_summary", gold["orders_summary"], rows=one, orders=orders)
        )
    for table, total, new in (
        ("customer_summary", "total_customers", "new_customers"),
        ("restaurant_summary", "total_restaurants", "new_restaurants"),
    ):
        if table in gold:
            columns = {name: F.col(name) for name in ("rows", "new", "last")}
            parts.append(
                _contributions(f"gold.{table}", _cohorts(gold[table], total, new), **columns)
            )
    if "partner_summary" in gold:
        # The ALL row is the last one of the union; vehicles of that name are not expected.
        of_all = F.col("Vehicle_type").eqNullSafe("ALL")
        n = F.col("total_partners")
        parts.append(
            _contributions(
                "gold.partner_summary",
                gold["partner_summary"],
                rows=one,
                all=F.when(of_all, n),
                vehicles=F.when(~of_all, n),
            )
        )
    if "menu_performance" in gold:
        quantity = F.col("total_quantity_sold")
        parts.append(
            _contributions("gold.menu_performance", gold["menu_performance"], quantity=quantity)
        )
    if {"orders", "restaurants", "order_items"} <= set(silver) and SOLD not in known:
        parts.append(_contributions("silver.sold", _sold(silver), quantity=F.col("quantity")))
    if not parts:
        return None
    names = F.array(*[F.lit(name) for own, _ in parts for name in own])
    # A table without rows has figures too: each one starts from 0.
    spark = parts[0][1].sparkSession
    zeros = spark.range(1).select(
        F.explode(names).alias("figure"), F.lit(0).cast("bigint").alias("value")
    )
    every = reduce(DataFrame.union, [rows for _, rows in parts], zeros)
    return every.groupBy("figure").agg(F.sum("value").alias("value"))


def _sold(silver: Tables) -> DataFrame:
    """Quantities of the items of orders from restaurants with a cuisine."""
    totals = gold_plans.order_totals(silver["orders"], silver["order_items"])
    return sold_quantities(totals, silver["restaurants"])


def sold_quantities(order_totals: DataFrame, restaurants: DataFrame) -> DataFrame:
    """``(quantity)`` of each restaurant with a cuisine. Orders are summed per restaurant before they meet it."""
    per_restaurant = order_totals.groupBy("Restaurant_id").agg(F.sum("quantity").alias("quantity"))
    known = restaurants.filter("cuisine_type IS NOT NULL").select("Restaurant_id")
    return per_restaurant.join(known, "Restaurant_id").select("quantity")


def reconcile_counts(silver: Tables, gold: Tables) -> DataFrame:
    """``(name, value)``: the row counts of the silver tables and of the gold tables built on them."""
    layers = {"silver": silver, "gold": gold}
    parts = [
        layers[layer][table].select(F.lit(name).alias("name"), F.lit(1).cast("bigint").alias("value"))
        for name, (layer, table) in COUNTS.items()
        if table in layers[layer]
    ]
    if not parts:
        raise ValueError("there is no table to count")
    there = [F.lit(n) for n, (layer, table) in COUNTS.items() if table in layers[layer]]
    zeros = parts[0].sparkSession.range(1).select(
        F.explode(F.array(*there)).alias("name"), F.lit(0).cast("bigint").alias("value")
    )
    every = reduce(DataFrame.union, parts, zeros)
    return every.groupBy("name").agg(F.sum("value").alias("value"))


def kept_counts(warehouse: Warehouse) -> DataFrame:
    """``reconcile_counts`` from the log of the warehouse: no table is read."""
    known = known_figures(warehouse)
    rows = [(n, known[f"{layer}.{t}.rows"]) for n, (layer, t) in COUNTS.items() if f"{layer}.{t}.rows" in known]
    if not rows:
        raise ValueError("there is no table to count")
    return warehouse.spark.createDataFrame(rows, "name string, value bigint")


def reconcile_checks(
    silver: Tables, gold: Tables, known: Mapping[str, int] | None = None
) -> DataFrame:
    """``(check, expected, actual, ok)``: figures of gold recomputed from silver in another way.

    A side without a table is NULL, and the check is not ok. What is ``known`` is not computed again.
    """
    known = known or {}
    figures = _figures(silver, gold, known)
    needed = {figure for sides in CHECKS.values() for figure in sides}
    rows = [(name, value) for name, value in known.items() if name in needed]
    if rows:
        spark = next(iter({**silver, **gold}.values())).sparkSession
        kept = spark.createDataFrame(rows, "figure string, value bigint")
        figures = kept if figures is None else figures.filter(~F.col("figure").isin(*known)).union(kept)
    if figures is None:
        raise ValueError("there is no table to check")
    sides: dict[str, list[tuple[str, str]]] = {}
    for check, (expected, actual) in CHECKS.items():
        sides.setdefault(expected, []).append((check, "expected"))
        sides.setdefault(actual, []).append((check, "actual"))
    uses = F.create_map(
        *[
            x
            for figure, own in sides.items()
            for x in (
                F.lit(figure),
                F.array(*[F.struct(F.lit(c).alias("check"), F.lit(s).alias("side")) for c, s in own]),
            )
        ]
    )
    used = figures.filter(F.col("figure").isin(*sides)).select(
        F.explode(F.element_at(uses, F.col("figure"))).alias("use"), "value"
    )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("use.side") == name, F.col("value"))).alias(name)

    return (
        used.groupBy(F.col("use.check").alias("check"))
        .agg(side("expected"), side("actual"))
        .withColumn("ok", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))
    )
