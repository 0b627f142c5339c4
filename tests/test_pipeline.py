from __future__ import annotations

import glob
import json
import threading

import pytest
from pyspark.sql import functions as F

from tiffin.plans import pipeline
from tiffin.plans.silver import build_silver
from tiffin.plans.bronze import load_bronze
from tiffin.schemas import AUDIT_SCHEMA, TABLES
from tiffin.session import shared_folder
from tiffin.sources import testbed
from tiffin.sources.csv_files import write_csv
from tiffin.sources.warehouse import AUDIT, GOLD, SILVER, Stage, Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    for spec in TABLES:
        write_csv(testbed.bronze(spark, SF, spec), f"{folder}/{spec.bronze_name}.csv")
    return folder


@pytest.fixture(scope="module")
def built(spark, landing, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    report = pipeline.run_pipeline(warehouse, landing, testbed.AS_OF, rejected_at=at)
    return warehouse, report.collect()


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_report(built):
    warehouse, report = built
    assert [(r.layer, r.table_name, r.status) for r in report] == (
        [("bronze", s.bronze_name, "loaded") for s in TABLES]
        + [
            (layer, s.silver_name, status)
            for s in TABLES
            for layer, status in (("silver", "built"), ("audit", "appended"))
        ]
        + [("gold", name, "built") for name in pipeline.GOLD_TABLES]
        + [("reconcile", name, "counted") for name in pipeline.COUNTS]
        + [("reconcile", name, "ok") for name in pipeline.CHECKS]
    )
    rows = {(r.layer, r.table_name): r.rows for r in report}
    assert rows["silver", "orders"] == 1463
    assert rows["gold", "orders_summary"] == 1
    assert sorted(warehouse.read(AUDIT, "run_report").collect()) == sorted(report)
    assert sorted(r.table_name for r in warehouse.read(AUDIT, "load_report").collect()) == sorted(
        s.bronze_name for s in TABLES
    )
    left = glob.glob(f"{warehouse.root}/stage/*/*")
    assert left == []


def test_stored_rows_match_the_report(built):
    warehouse, report = built
    for r in report:
        if r.layer in (SILVER, GOLD):
            assert warehouse.read(r.layer, r.table_name).count() == r.rows
    audit = warehouse.audit()
    assert audit.dtypes == [(f.name, f.dataType.simpleString()) for f in AUDIT_SCHEMA]
    assert {r.table_name for r in audit.select("table_name").distinct().collect()} == {
        r.table_name for r in report if r.layer == AUDIT and r.rows
    }
    assert audit.count() == sum(r.rows for r in report if r.layer == AUDIT)
    assert audit.select("rejected_at").distinct().count() == 1
    assert all(json.loads(r.row_data) for r in audit.collect())


def test_stored_schemas(built):
    warehouse, _ = built
    for spec in TABLES:
        assert warehouse.read(SILVER, spec.silver_name).dtypes == warehouse.silver(spec).dtypes
    for name, table in pipeline.gold_tables(warehouse).items():
        assert warehouse.read(GOLD, name).dtypes == table.dtypes


def test_reconciliation(built):
    warehouse, report = built
    counts, checks = pipeline.reconcile(warehouse)
    rows = {(r.layer, r.table_name): r.rows for r in report}
    assert {r.name: r.value for r in counts.collect()} == {
        "total_orders": rows["silver", "orders"],
        "gold_total_orders": 1,
        "total_customers": rows["silver", "customers"],
        "gold_total_customers": rows["gold", "customer_summary"],
        "total_restaurants": rows["silver", "restaurants"],
        "gold_total_restaurants": rows["gold", "restaurant_summary"],
        "total_partners": rows["silver", "delivery_partners"],
        "gold_total_partners": rows["gold", "partner_summary"],
    }
    result = checks.collect()
    assert len(result) == 8 and all(r.ok for r in result)


def test_a_broken_gold_table_fails_its_check(spark, built):
    warehouse, _ = built
    silver = pipeline.silver_tables(warehouse)
    gold = pipeline.gold_tables(warehouse)
    gold["partner_summary"] = gold["partner_summary"].filter("Vehicle_type <> 'Car'")
    failed = {r.check for r in pipeline.reconcile_checks(silver, gold).collect() if not r.ok}
    assert failed == {"partners_by_vehicle"}


def test_second_load_doubles_bronze_and_leaves_silver(spark, landing, tmp_path, built):
    first, report = built
    warehouse = Warehouse(spark, str(tmp_path))
    for _ in range(2):
        load_bronze(warehouse, landing)
    kept = build_silver(warehouse)
    rows = {(r.layer, r.table_name): r.rows for r in report}
    for spec in TABLES:
        assert warehouse.bronze(spec).count() == 2 * rows["bronze", spec.bronze_name]
        assert kept[spec.silver_name][0] == rows["silver", spec.silver_name]
        assert _same(warehouse.silver(spec), first.silver(spec))
    # Silver is rebuilt, the audit grows.
    again = build_silver(warehouse)
    assert again == kept
    assert warehouse.audit().count() == 2 * sum(r for _, r in kept.values())


def test_gold_if_absent(spark, built):
    warehouse, _ = built
    before = warehouse.read(GOLD, "customer_summary").collect()
    steps = pipeline.build_gold(warehouse, "1999-01-01", mode="ignore")
    assert [s[1:] for s in steps] == [(n, "kept", None) for n in pipeline.GOLD_TABLES]
    assert warehouse.read(GOLD, "customer_summary").collect() == before


def test_gold_failure_policy(spark, landing, tmp_path):
    """Without silver restaurants, the first table is built and the second one fails."""
    warehouse = Warehouse(spark, str(tmp_path))
    load_bronze(warehouse, landing)
    build_silver(warehouse, [s for s in TABLES if s.silver_name != "restaurants"])
    with pytest.raises(Exception, match="restaurants"):
        pipeline.build_gold(warehouse, testbed.AS_OF)
    steps = pipeline.build_gold(warehouse, testbed.AS_OF, on_error="skip")
    assert [s[2].split(":")[0] for s in steps] == ["built", "failed"] + ["skipped"] * 3
    with pytest.raises(ValueError):
        pipeline.build_gold(warehouse, on_error="ignore")


def test_an_error_ends_the_silver_build(spark, landing, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load_bronze(warehouse, landing, TABLES[1:])
    with pytest.raises(Exception, match="Customers"):
        build_silver(warehouse, at_once=1)
    assert not any(warehouse.exists(SILVER, s.silver_name) for s in TABLES[1:])
    with pytest.raises(Exception, match="Customers"):
        build_silver(warehouse)


def test_reconciliation_follows_a_failed_gold_table(spark, landing, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no menu")

    monkeypatch.setattr(pipeline.gold, "menu_items", broken)
    warehouse = Warehouse(spark, str(tmp_path))
    steps = pipeline.run_pipeline(warehouse, landing, testbed.AS_OF, on_gold_error="skip").collect()
    status = {(r.layer, r.table_name): r.status for r in steps}
    assert status["gold", "menu_performance"] == "failed: RuntimeError"
    assert status["gold", "partner_summary"] == "skipped"
    assert status["reconcile", "total_partners"] == "counted"
    assert status["reconcile", "gold_total_partners"] == "missing"
    assert status["reconcile", "orders_in_summary"] == "ok"
    assert status["reconcile", "quantity_in_menu"] == "missing"


def test_the_load_report_survives_a_failing_silver_build(spark, landing, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("no silver")

    monkeypatch.setattr(pipeline, "build_silver", broken)
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(warehouse, landing, testbed.AS_OF)
    assert warehouse.read(AUDIT, "load_report").count() == len(TABLES)


def test_a_failed_rebuild_leaves_both_tables(spark, tmp_path):
    spec = TABLES[0]
    warehouse = Warehouse(spark, str(tmp_path))
    bronze = testbed.bronze(spark, SF, spec)
    warehouse.write(bronze, "bronze", spec.bronze_name, "append")
    kept = build_silver(warehouse, [spec])[spec.silver_name]
    rows, audit = warehouse.silver(spec).collect(), warehouse.audit().count()
    fails = F.when(F.col("city").isNotNull(), F.raise_error(F.lit("broken task")).cast("string"))
    good = warehouse.silver(spec)
    with pytest.raises(Exception, match="broken task"):
        warehouse.rebuild(good.withColumn("city", fails), warehouse.audit(), spec)
    broken_audit = warehouse.audit().withColumn(
        "reason", F.when(F.col("reason").isNotNull(), F.raise_error(F.lit("broken audit")).cast("string"))
    )
    with pytest.raises(Exception, match="broken audit"):
        warehouse.rebuild(good, broken_audit, spec)
    assert warehouse.silver(spec).collect() == rows and warehouse.audit().count() == audit == kept[1]
    with pytest.raises(Exception, match="broken task"):
        warehouse.write(good.withColumn("city", fails), SILVER, spec.silver_name)
    assert warehouse.silver(spec).collect() == rows
    reader = warehouse.silver(spec)
    assert build_silver(warehouse, [spec])[spec.silver_name] == kept
    assert reader.count() == len(rows) and warehouse.audit().count() == 2 * audit


def test_replaced_versions_go(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for n in range(1, 5):
        warehouse.write(spark.range(n), GOLD, "t")
        assert warehouse.read(GOLD, "t").count() == n
    assert len(glob.glob(f"{tmp_path}/gold/t/v-*")) == 2


def test_intermediate_tables_are_written_at_the_same_time(spark, tmp_path):
    """Each of two writes waits for the other to begin."""
    warehouse = Warehouse(spark, str(tmp_path))
    begun = threading.Barrier(2, timeout=60)

    class Waiting(Stage):
        pass

    with Waiting(warehouse) as stage:
        counted = Warehouse._counted

        def slow(self, df, path, mode):
            begun.wait()
            return counted(self, df, path, mode)

        Warehouse._counted = slow
        try:
            found = {}
            threads = [
                threading.Thread(
                    target=lambda name=name, n=n: found.update({name: stage.store(name, spark.range(n))[1]})
                )
                for name, n in (("a", 3), ("b", 4))
            ]
            for thread in threads:
                thread.start()
            for thread in threads:
                thread.join()
        finally:
            Warehouse._counted = counted
        assert found == {"a": 3, "b": 4}
        assert stage.store("a", spark.range(9))[1] == 3
    assert glob.glob(f"{tmp_path}/stage/*") == []


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
