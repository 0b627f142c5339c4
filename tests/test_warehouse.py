"""The log of the warehouse: failures between any two steps, writers at the same time, loads repeated."""

from __future__ import annotations

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from tiffin.plans import pipeline
from tiffin.plans.bronze import load_bronze
from tiffin.plans.reconcile import stored_figures
from tiffin.plans.silver import build_silver
from tiffin.schemas import CUSTOMERS, ORDER_ITEMS, RESTAURANTS, TABLES
from tiffin.sources import testbed
from tiffin.sources.csv_files import write_csv
from tiffin.sources.manifest import Change, Conflict, Manifest
from tiffin.sources.warehouse import AUDIT, BRONZE, GOLD, SILVER, Warehouse

SF = "/root/testdata/sf0.001"


class Crash(Exception):
    pass


class Steps:
    """Counts the steps of a write (files, log entries, removals) and fails at a given one."""

    def __init__(self, monkeypatch, after: bool):
        self.fail_at, self.seen, self._after = None, 0, after
        for owner, name in ((Warehouse, "_counted"), (Manifest, "_create"), (Warehouse, "delete")):
            monkeypatch.setattr(owner, name, self._step(getattr(owner, name)))

    def _step(self, method):
        def run(*args):
            number, self.seen = self.seen, self.seen + 1
            if number == self.fail_at and not self._after:
                raise Crash
            result = method(*args)
            if number == self.fail_at:
                raise Crash
            return result

        return run

    def begin(self, fail_at=None):
        self.fail_at, self.seen = fail_at, 0


@pytest.mark.parametrize("after", [False, True])
def test_a_crash_at_any_step_leaves_old_or_new_tables(spark, tmp_path, monkeypatch, after):
    warehouse = Warehouse(spark, str(tmp_path))
    steps = Steps(monkeypatch, after)

    def rows(n):
        kept = spark.range(n).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CUSTOMERS.silver_schema])
        records = spark.range(1).select(
            F.lit("customers").alias("table_name"), F.lit(f"build {n}").alias("reason"),
            F.lit("{}").alias("row_data"), F.current_timestamp().cast("timestamp_ntz").alias("rejected_at"),
        )
        return kept, records

    def stored():
        return warehouse.silver(CUSTOMERS).count(), [r.reason for r in warehouse.audit().orderBy("reason").collect()]

    # Three builds, so that the third one also removes a version.
    for n in (1, 2, 3):
        steps.begin()
        warehouse.rebuild(*rows(n), CUSTOMERS)
    assert steps.seen == 4 and stored() == (3, ["build 1", "build 2", "build 3"])
    built = ["build 1", "build 2", "build 3"]
    for step in range(4):
        n = 4 + step
        steps.begin(step)
        try:
            warehouse.rebuild(*rows(n), CUSTOMERS)
        except Crash:
            pass
        steps.begin()
        # The entry of the log decides: before it nothing has changed, after it all has.
        if step + after > 2:
            assert stored() == (n, [*built, f"build {n}"])
        else:
            assert stored() == (n - 1, built)
            warehouse.rebuild(*rows(n), CUSTOMERS)
        built.append(f"build {n}")
        assert stored() == (n, built)
    steps.begin()
    needed = {f for s in warehouse.manifest.state().values() for f in (*s.folders, *s.before)}
    warehouse.vacuum(older_than_hours=0)
    there = {os.path.relpath(p, tmp_path) for p in glob.glob(f"{tmp_path}/*/**/v-*", recursive=True)}
    assert there == needed and stored() == (7, built)


def _meet(monkeypatch, n=2):
    """Log entries of ``n`` writers are first written at the same time."""
    create, gate, first = Manifest._create, threading.Barrier(n, timeout=60), threading.local()

    def slow(self, number, state):
        if not getattr(first, "seen", False):
            first.seen = True
            gate.wait()
        return create(self, number, state)

    monkeypatch.setattr(Manifest, "_create", slow)


def _together(*writes):
    errors = []

    def run(write):
        try:
            write()
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(w,)) for w in writes]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return errors


def test_writers_at_the_same_time_all_land(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    _meet(monkeypatch, 6)
    errors = _together(*[lambda n=n: warehouse.write(spark.range(n), GOLD, "t", "append") for n in range(1, 6)],
                       lambda: warehouse.write(spark.range(9), GOLD, "u"))
    assert errors == []
    assert warehouse.read(GOLD, "t").count() == 15 and warehouse.read(GOLD, "u").count() == 9
    assert warehouse.states(GOLD)["t"].rows == 15
    assert len(glob.glob(f"{tmp_path}/_log/*")) == 6


def test_a_build_on_a_replaced_table_is_told(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write(testbed.bronze(spark, SF, RESTAURANTS), BRONZE, RESTAURANTS.bronze_name)
    build_silver(warehouse, [RESTAURANTS])
    audit = warehouse.audit().count()
    _meet(monkeypatch)
    errors = _together(*[lambda: build_silver(warehouse, [RESTAURANTS])] * 2)
    assert [type(e) for e in errors] == [Conflict]
    assert warehouse.audit().count() == 2 * audit


def test_a_table_of_the_other_build_is_no_conflict(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    for spec in (RESTAURANTS, CUSTOMERS):
        warehouse.write(testbed.bronze(spark, SF, spec), BRONZE, spec.bronze_name)
    _meet(monkeypatch)
    assert _together(*[lambda s=s: build_silver(warehouse, [s]) for s in (RESTAURANTS, CUSTOMERS)]) == []
    assert set(warehouse.states(SILVER)) == {"restaurants", "customers"}


def test_a_repeated_load_is_taken_in_once(spark, tmp_path, monkeypatch):
    header = ",".join(f.name for f in ORDER_ITEMS.fields)
    (tmp_path / "Order_Items.csv").write_text(f"{header}\nI1,O1,tea,1,1.00\nI2,O1,Soup, hot,2,3.50\n")
    write_csv(testbed.bronze(spark, SF, CUSTOMERS), f"{tmp_path}/Customers.csv")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    specs = [CUSTOMERS, ORDER_ITEMS]
    steps = Steps(monkeypatch, after=False)
    # Customers land (two steps), items and their audit are written, their entry is not.
    steps.begin(4)
    with pytest.raises(Crash):
        load_bronze(warehouse, str(tmp_path), specs, at_once=1, malformed="audit", load_id="monday")
    steps.begin()
    assert set(warehouse.states(BRONZE)) == {"Customers"} and warehouse.audit().count() == 0
    for _ in range(2):
        load_bronze(warehouse, str(tmp_path), specs, malformed="audit", load_id="monday")
        assert warehouse.bronze(CUSTOMERS).count() == 188
        assert warehouse.bronze(ORDER_ITEMS).count() == 1 and warehouse.audit().count() == 1
    again = load_bronze(warehouse, str(tmp_path), specs, malformed="audit", load_id="monday")
    assert again == [("Customers", "loaded before", 188), ("Order_Items", "loaded before", 1)]
    # Loads of another name, or of none, are new ones.
    for i, load_id in enumerate(("tuesday", None, None)):
        load_bronze(warehouse, str(tmp_path), specs, malformed="audit", load_id=load_id)
        assert warehouse.bronze(CUSTOMERS).count() == 188 * (i + 2)
        assert warehouse.audit().count() == i + 2


def test_loads_of_one_name_at_the_same_time_land_once(spark, tmp_path, monkeypatch):
    write_csv(testbed.bronze(spark, SF, CUSTOMERS), f"{tmp_path}/Customers.csv")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    _meet(monkeypatch)
    assert _together(*[lambda: load_bronze(warehouse, str(tmp_path), [CUSTOMERS], load_id="x")] * 2) == []
    assert warehouse.bronze(CUSTOMERS).count() == 188
    assert len(glob.glob(f"{tmp_path}/w/bronze/Customers/v-*")) == 1


def test_figures_are_kept_with_the_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for n in (3, 5):
        warehouse.write(spark.range(n), GOLD, "t", "append", {"total": F.col("id"), "even": F.when(F.col("id") % 2 == 0, 1)})
    state = warehouse.states(GOLD)["t"]
    assert (state.rows, state.figures) == (8, {"total": 13, "even": 5})
    warehouse.write(spark.range(0), GOLD, "t", figures={"total": F.col("id")})
    assert warehouse.states(GOLD)["t"].figures == {"total": 0}


@pytest.mark.parametrize("change", ["drop", "swap", "none"])
def test_changed_rows_differ_from_their_figures(spark, tmp_path, change):
    """Files of a table are replaced behind the back of the log."""
    warehouse = Warehouse(spark, str(tmp_path))
    for spec in (RESTAURANTS, CUSTOMERS):
        warehouse.write(testbed.bronze(spark, SF, spec), BRONZE, spec.bronze_name)
    build_silver(warehouse, [RESTAURANTS, CUSTOMERS])
    found = stored_figures(warehouse)
    assert found.count() == 8 and found.filter("NOT ok").isEmpty()
    folder = f"{tmp_path}/{warehouse.states(SILVER)['restaurants'].folders[0]}"
    first = F.col("Restaurant_id") == warehouse.silver(RESTAURANTS).agg(F.min("Restaurant_id")).first()[0]
    rows = warehouse.silver(RESTAURANTS)
    if change == "drop":
        rows = rows.filter(~first | F.col("Restaurant_id").isNull())
    elif change == "swap":
        rows = rows.withColumn("city", F.when(first, F.lit("Elsewhere")).otherwise(F.col("city")))
    rows.repartition(3).write.parquet(str(tmp_path / "other"))
    spark.read.parquet(str(tmp_path / "other")).write.mode("overwrite").parquet(folder)
    odd = {(r.table_name, r.figure) for r in stored_figures(warehouse).filter("NOT ok").collect()}
    differ = {"drop": {"rows", "ids", "content_a", "content_b"}, "swap": {"content_a", "content_b"}, "none": set()}
    assert odd == {("restaurants", figure) for figure in differ[change]}


def test_counts_and_ids_need_no_scan(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for spec in TABLES:
        warehouse.write(testbed.bronze(spark, SF, spec), BRONZE, spec.bronze_name)
    build_silver(warehouse)
    pipeline.build_gold(warehouse, testbed.AS_OF)
    counts, checks = pipeline.reconcile(warehouse)
    assert counts.inputFiles() == []
    assert all("/gold/" in file for file in checks.inputFiles())
    slow = pipeline.reconcile_checks(*pipeline.stored_tables(warehouse))
    assert sorted(checks.collect()) == sorted(slow.collect()) and checks.filter("NOT ok").isEmpty()
    # A gold table that lost rows no longer fits the figures of silver.
    summary = warehouse.read(GOLD, "partner_summary").filter("Vehicle_type <> 'Car'")
    warehouse.write(summary, GOLD, "partner_summary")
    failed = [r.check for r in pipeline.reconcile(warehouse)[1].filter("NOT ok").collect()]
    assert failed == ["partners_by_vehicle"]


def test_entries_are_never_replaced(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "log"))
    assert manifest.commit([Change("t", "t/v-1", 1)]) == []
    state = manifest.state()
    assert manifest._create(2, {}) and not manifest._create(2, state) and not manifest._create(1, {})
    assert manifest.state() == {} and sorted(os.listdir(tmp_path / "log")) == [f"{i:020}.json" for i in (1, 2)]
    with pytest.raises(LookupError, match="no table audit/x"):
        Warehouse(spark, str(tmp_path)).read(AUDIT, "x")
