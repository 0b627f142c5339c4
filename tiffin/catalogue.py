"""The registered queries: each operator over the whole test tables.

As in the pipeline, each layer reads the stored tables of the layer before it. Those are built on
first use, once per application and source directory, in the shared folder. Decimals and zoneless timestamps are turned
into doubles and timestamps in the results only, so that engines can compare them.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.dates import whole_days
from tiffin.functions.numeric import avg2, pct, pct_amount
from tiffin.functions.text import initcap_words
from tiffin.operators import checks, quality
from tiffin.plans import gold
from tiffin.plans import reconcile as reconciliation
from tiffin.plans.bronze import load_bronze, load_report
from tiffin.plans.pipeline import (
    GOLD_TABLES,
    build_gold,
    gold_plan,
    gold_tables,
    reconcile,
    run_pipeline,
    silver_tables,
    stored_tables,
)
from tiffin.plans.silver import build_silver, cleaned, stored_duplicates, stored_rejections
from tiffin.plans.together import AT_ONCE, run_together
from tiffin.schemas import (
    BY_SILVER_NAME,
    CUSTOMERS,
    ORDER_ITEMS,
    ORDERS,
    RESTAURANTS,
    TABLES,
    TableSpec,
)
from tiffin.session import shared_folder
from tiffin.sources import testbed
from tiffin.sources.csv_files import NULL_TOKENS, read_bronze_csv, write_csv
from tiffin.sources.manifest import Change
from tiffin.sources.warehouse import BRONZE, GOLD, SILVER, Stage, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

_ready: set[tuple[str, str]] = set()


def comparable(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = c.cast("timestamp")
        return c.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])


def _folder(spark: SparkSession, sf_dir: str) -> str:
    return f"{shared_folder(spark)}/{zlib.crc32(sf_dir.encode()):08x}"


def _once(folder: str, step: str, build: Callable[[], object]) -> None:
    if (folder, step) not in _ready:
        build()
        _ready.add((folder, step))


def fresh_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}")


def landing(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Folder with the CSV extracts of the bronze tables ``names`` (all by default)."""
    folder = f"{_folder(spark, sf_dir)}/landing"
    for spec in TABLES:
        if not names or spec.bronze_name in names:
            path = f"{folder}/{spec.bronze_name}.csv"
            _once(
                path,
                "csv",
                lambda spec=spec, path=path: write_csv(testbed.bronze(spark, sf_dir, spec), path),
            )
    return folder


def with_bronze(spark: SparkSession, sf_dir: str, *specs: TableSpec) -> Warehouse:
    """Warehouse with the bronze tables of ``specs``, loaded from their CSV extracts."""
    warehouse = Warehouse(spark, f"{_folder(spark, sf_dir)}/warehouse")

    def build(spec: TableSpec) -> None:
        folder = landing(spark, sf_dir, spec.bronze_name)
        _once(
            warehouse.folder(BRONZE, spec.bronze_name), BRONZE, lambda: load_bronze(warehouse, folder, [spec])
        )

    run_together(spark, build, specs, AT_ONCE)
    return warehouse


def stored_bronze(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    return with_bronze(spark, sf_dir, spec).bronze(spec)


def with_silver(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse with all silver tables."""
    warehouse = Warehouse(spark, f"{_folder(spark, sf_dir)}/warehouse")

    def store(spec: TableSpec) -> None:
        rows = cleaned(warehouse, spec)
        warehouse.write(rows, SILVER, spec.silver_name, figures=reconciliation.kept_figures(spec))

    def build(spec: TableSpec) -> None:
        with_bronze(spark, sf_dir, spec)
        _once(warehouse.folder(SILVER, spec.silver_name), SILVER, lambda: store(spec))

    run_together(spark, build, TABLES, AT_ONCE)
    return warehouse


def with_gold(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse with all silver and gold tables."""
    warehouse = with_silver(spark, sf_dir)
    _once(warehouse.root, GOLD, lambda: build_gold(warehouse, testbed.AS_OF))
    return warehouse


def _bronze(name: str) -> Query:
    spec = BY_SILVER_NAME[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = landing(spark, sf_dir, spec.bronze_name)
        return read_bronze_csv(spark, f"{folder}/{spec.bronze_name}.csv", spec)

    return run


def _dirty_load(spark: SparkSession, text: DataFrame, spec: TableSpec) -> DataFrame:
    """Write ``text`` as a CSV extract of ``spec`` (columns it lacks are empty) and load it."""
    missing = [f.name for f in spec.fields if f.name not in text.columns]
    rows = text.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    path = f"{fresh_warehouse(spark).root}/{spec.bronze_name}.csv"
    write_csv(rows, path)
    return read_bronze_csv(spark, path, spec).select(*text.columns)


def bronze_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the null tokens in turn, beside real names and a padded token, which is text."""
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    customer = testbed.source_table(spark, sf_dir, "customer")
    text = customer.selectExpr(
        "'C' || CAST(c_custkey AS STRING) AS Customer_id",
        f"CASE WHEN c_custkey % 20 = 19 THEN c_name "
        f"ELSE array({tokens})[CAST(c_custkey % 20 AS INT) % {len(NULL_TOKENS)}] END AS First_Name",
        "CASE WHEN c_custkey % 3 = 0 THEN 'NULL' ELSE ' NA ' END AS Last_Name",
    )
    return _dirty_load(spark, text, CUSTOMERS)


# Spellings of a day in ``bronze_date_coerce``: a format, and what follows the day.
DATE_SPELLINGS = (
    ("yyyy-MM-dd", ""),
    ("yyyy-MM-dd", " 23:59:59"),
    ("yyyy-MM-dd", "T13:45:00"),
    ("yyyy/MM/dd", ""),
    ("MM/dd/yyyy", ""),
    ("MM/dd/yyyy", " 08:30:00"),
    ("M/d/yyyy", ""),
    ("yyyy-M-d", ""),
    ("yyyy-MM-dd", " 13:45"),
    ("yyyy-MM-dd", "T13:45"),
    ("yyyy-MM-dd", " 13:45:00+00:00"),
    ("yyyy-MM-dd", "T23:59:59.123456Z"),
    ("dd-MMM-yyyy", ""),
    ("d MMM yyyy", ""),
    ("MMM d, yyyy", ""),
    ("MMMM d, yyyy", ""),
    ("yyyy/MM/dd", " 10:00:00"),
    ("M/d/yyyy", " 9:05 pm"),
)
# Texts that are no day.
NO_DAYS = ("1996-02-30", "13/13/1996", "1996-01-05 25:00", "soon", "NaN")


def bronze_date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in each of the spellings in turn, and texts that are no dates."""
    day = "CAST(o_orderdate AS DATE)"
    spelled = [f"date_format({day}, '{fmt}') || '{rest}'" for fmt, rest in DATE_SPELLINGS]
    spelled += [f"'{text}'" for text in NO_DAYS]
    cases = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(spelled))
    text = testbed.source_table(spark, sf_dir, "orders").selectExpr(
        "'O' || CAST(o_orderkey AS STRING) AS Order_id",
        f"CASE o_orderkey % {len(spelled)} {cases} END AS Order_date",
    )
    return _dirty_load(spark, text, ORDERS)


def bronze_numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities and prices as whole, decimal, exponent, padded, the largest that fit, and not numeric."""
    whole = "CAST(CAST(l_quantity AS INT) AS STRING)"
    part = "CAST(l_partkey AS STRING)"
    text = testbed.source_table(spark, sf_dir, "lineitem").selectExpr(
        "'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS Order_item_id",
        f"""CASE l_orderkey % 7
            WHEN 0 THEN {whole} WHEN 1 THEN {whole} || '.0' WHEN 2 THEN {whole} || '.5'
            WHEN 3 THEN {whole} || 'e2' WHEN 4 THEN {whole} || 'd' WHEN 5 THEN '2147483647'
            ELSE ''
        END AS Quantity""",
        f"""CASE l_partkey % 5
            WHEN 0 THEN {part} || '.125' WHEN 1 THEN '-' || {part} WHEN 2 THEN ' ' || {part} || '.5 '
            WHEN 3 THEN '1,' || {part} ELSE '99999999.99'
        END AS Price""",
    )
    return _dirty_load(spark, text, ORDER_ITEMS)


def _raw_items(spark: SparkSession, sf_dir: str, line: str) -> str:
    """An extract of order items whose records are given as text by an SQL expression.

    Every partition of the source becomes a part file with a header of its own.
    """
    folder = f"{fresh_warehouse(spark).root}/landing"
    header = ",".join(f.name for f in ORDER_ITEMS.fields)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
        yield from batches

    lines = testbed.source_table(spark, sf_dir, "lineitem").selectExpr(f"{line} AS value")
    lines.mapInArrow(headed, "value string").write.text(f"{folder}/Order_Items.csv")
    return folder


_ITEM = "'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ',O' || CAST(l_orderkey AS STRING)"


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with too many fields, an open quote or too few fields, beside good ones, by reason.

    Every line is a record here, so an open quote ends with its line.
    """
    line = f'''{_ITEM} || CASE l_partkey % 10
        WHEN 0 THEN ',Soup, hot,2,3.50' WHEN 1 THEN ',"Rice,1,2.00' WHEN 2 THEN ',"Tea, ""green""",2'
        WHEN 3 THEN ',"a, b",1,2.00' ELSE ',Bread,1,2.00' END'''
    warehouse = fresh_warehouse(spark)
    steps = load_bronze(
        warehouse, _raw_items(spark, sf_dir, line), [ORDER_ITEMS], multiline=False, malformed="audit"
    )
    by_reason = warehouse.audit().groupBy("table_name", F.col("reason").alias("status"))
    audited = by_reason.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.get_json_object("row_data", "$.record")).alias("records"),
    )
    nulls = warehouse.bronze(ORDER_ITEMS).agg(F.count_if(F.col("Price").isNull())).scalar()
    return load_report(spark, steps).withColumn("records", nulls).unionByName(audited)


def bronze_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commas, quotes and line breaks inside quotes."""
    line = f'''{_ITEM} || CASE l_partkey % 4
        WHEN 0 THEN ',"Soup, hot",2,3.50' WHEN 1 THEN ',"Rice\nand\n\nbeans",1,2.00'
        WHEN 2 THEN ',"the ""best"" tea",2,1.00' ELSE ',Bread,1,2.00' END'''
    folder = _raw_items(spark, sf_dir, line)
    path = f"{folder}/Order_Items.csv"
    return read_bronze_csv(spark, path, ORDER_ITEMS)


def bronze_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one extract with columns in another order, and with more of them, also with line breaks."""
    path = f"{fresh_warehouse(spark).root}/landing/Order_Items.csv"
    rows = testbed.bronze(spark, sf_dir, ORDER_ITEMS)
    names = [f.name for f in ORDER_ITEMS.fields]
    remark = F.concat_ws("\n", F.lit("said"), "Menu_item").alias("Remark")
    third = F.pmod(F.xxhash64(*names), F.lit(3))
    for part, columns in enumerate((names, names[::-1], [remark, *names])):
        write_csv(rows.filter(third == part).select(*columns), path, "append")
    return read_bronze_csv(spark, path, ORDER_ITEMS)


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same extract twice holds every row twice."""
    warehouse = fresh_warehouse(spark)
    folder = landing(spark, sf_dir, "Customers")
    for _ in range(2):
        load_bronze(warehouse, folder, [CUSTOMERS])
    return (
        warehouse.read(BRONZE, "Customers")
        .groupBy("Customer_id", "Email", "City")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


class CrashingWarehouse(Warehouse):
    """Writes files like a warehouse, and ends before they are committed."""

    def commit(self, *changes: Change) -> None:
        raise RuntimeError("crash before the commit")


def bronze_append_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails amid its tasks, then before its commit, then is repeated twice; and a second load."""
    warehouse = fresh_warehouse(spark)
    folder = landing(spark, sf_dir, "Customers")
    rows = read_bronze_csv(spark, f"{folder}/Customers.csv", CUSTOMERS)
    broken = F.when(F.col("Customer_id").isNotNull(), F.raise_error(F.lit("broken customer")).cast("string"))
    with suppress_error("broken customer"):
        warehouse.load(rows.withColumn("City", broken), CUSTOMERS, "first")
    with suppress_error("crash before the commit"):
        load_bronze(CrashingWarehouse(spark, warehouse.root), folder, [CUSTOMERS], load_id="first")
    for load_id in ("first", "first", "second"):
        load_bronze(warehouse, folder, [CUSTOMERS], load_id=load_id)
    return (
        warehouse.bronze(CUSTOMERS)
        .groupBy("Customer_id", "Email", "City")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def silver_audit_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit after a build, one that ends before its commit, and one more: that of two builds."""
    warehouse = fresh_warehouse(spark)
    warehouse.write(testbed.bronze(spark, sf_dir, ORDERS), BRONZE, ORDERS.bronze_name)
    build_silver(warehouse, [ORDERS])
    with suppress_error("crash before the commit"):
        build_silver(CrashingWarehouse(spark, warehouse.root), [ORDERS])
    build_silver(warehouse, [ORDERS])
    return _rejects_per_key(warehouse.audit(), ORDERS.key)


def bronze_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load where the partners' extract is missing."""
    folder = f"{fresh_warehouse(spark).root}/landing"
    for spec in TABLES:
        if spec.bronze_name != "Delivery_Partners":
            write_csv(testbed.bronze(spark, sf_dir, spec), f"{folder}/{spec.bronze_name}.csv")
    return load_report(spark, load_bronze(fresh_warehouse(spark), folder))


def _silver(name: str, null_key: str = quality.KEEP) -> Query:
    spec = BY_SILVER_NAME[name]
    return lambda spark, sf_dir: quality.clean(stored_bronze(spark, sf_dir, spec), spec, null_key)


def _rejects_per_key(rejected: DataFrame, key: str) -> DataFrame:
    return rejected.groupBy(
        "table_name", "reason", F.get_json_object("row_data", f"$.{key}").alias("key")
    ).agg(F.count(F.lit(1)).alias("n"))


def _audit(name: str, null_key: str = quality.KEEP) -> Query:
    spec = BY_SILVER_NAME[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = with_bronze(spark, sf_dir, spec)
        rejected = stored_rejections(warehouse, spec, Stage(warehouse), null_key)
        return _rejects_per_key(quality.audit_rows(rejected), spec.key)

    return run


def _with_missing_keys(spark: SparkSession, sf_dir: str, spec: TableSpec) -> Warehouse:
    """Warehouse whose bronze table also has rows without a key."""
    warehouse = Warehouse(spark, f"{_folder(spark, sf_dir)}/missing_keys")
    _once(
        warehouse.folder(BRONZE, spec.bronze_name),
        BRONZE,
        lambda: warehouse.write(
            testbed.bronze(spark, sf_dir, spec, missing_keys=True), BRONZE, spec.bronze_name
        ),
    )
    return warehouse


def _silver_reject(name: str) -> Query:
    spec = BY_SILVER_NAME[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze = _with_missing_keys(spark, sf_dir, spec).bronze(spec)
        return quality.clean(bronze, spec, quality.REJECT)

    return run


def _audit_reject(name: str) -> Query:
    spec = BY_SILVER_NAME[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = _with_missing_keys(spark, sf_dir, spec)
        rejected = stored_rejections(warehouse, spec, Stage(warehouse), quality.REJECT)
        return _rejects_per_key(quality.audit_rows(rejected), spec.key)

    return run


def audit_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored audit of orders and restaurants, with typed fields from the rejected rows."""
    warehouse = fresh_warehouse(spark)
    for spec in (ORDERS, RESTAURANTS):
        warehouse.write(testbed.bronze(spark, sf_dir, spec), BRONZE, spec.bronze_name)
    build_silver(warehouse, [ORDERS, RESTAURANTS])
    audit = warehouse.audit()
    recent = F.col("rejected_at") >= F.current_timestamp().cast("timestamp_ntz") - F.expr("interval 1 day")
    times = audit.groupBy("table_name").agg(
        F.count_distinct("rejected_at").alias("times"), F.every(recent).alias("recent")
    )

    def field(*names: str):
        return F.coalesce(*[F.get_json_object("row_data", f"$.{n}") for n in names])

    return audit.join(times, "table_name").select(
        "table_name",
        "reason",
        field("Order_id", "Restaurant_id").alias("key"),
        field("Customer_City", "city").alias("place"),
        field("Order_amount", "Rating").cast("double").alias("number"),
        field("Order_date").cast("timestamp_ntz").alias("day"),
        "times",
        "recent",
    )


def silver_after_failed_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders after a rebuild whose tasks fail: those of the build before it."""
    warehouse = fresh_warehouse(spark)
    warehouse.write(testbed.bronze(spark, sf_dir, ORDERS), BRONZE, ORDERS.bronze_name)
    build_silver(warehouse, [ORDERS])
    orders = warehouse.silver(ORDERS)
    broken = F.raise_error(F.concat(F.lit("broken order "), F.col("Order_id"))).cast("string")
    failing = orders.withColumn("Payment_mode", F.when(F.col("Order_amount") >= 0, broken))
    # The message of the failure is the proof that it was this one.
    with suppress_error("broken order"):
        warehouse.rebuild(failing, warehouse.audit(), ORDERS)
    return warehouse.silver(ORDERS)


@contextmanager
def suppress_error(message: str) -> Iterator[None]:
    """Passes over an error with ``message`` in it; any other outcome is an error."""
    try:
        yield
    except Exception as error:
        if message not in str(error):
            raise
    else:
        raise AssertionError(f"no error with {message!r}")


def dedup_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates of a key removed without any rules."""
    rows = quality.normalise(stored_bronze(spark, sf_dir, ORDER_ITEMS), ORDER_ITEMS)
    return quality.one_row_per_key(rows, ORDER_ITEMS.key)


def _gold(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = with_silver(spark, sf_dir)
        # Only the menu uses its intermediate tables twice.
        store = Stage(warehouse).store if name == "menu_performance" else None
        return gold_plan(name, warehouse.silver_by_name, testbed.AS_OF, store)

    return run


def gold_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write that must leave the first one's table as it is."""
    silver = silver_tables(with_silver(spark, sf_dir))
    target = fresh_warehouse(spark)
    for as_of in (testbed.AS_OF, "1999-01-01"):
        summary = gold.partner_summary(silver["delivery_partners"], silver["orders"], as_of)
        target.write(summary, GOLD, "partner_summary", mode="ignore")
    return target.read(GOLD, "partner_summary")


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = reconcile(with_gold(spark, sf_dir))
    return counts


def reconcile_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = reconcile(with_gold(spark, sf_dir))
    return found


def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and checks again, without the figures that are kept: from the stored rows."""
    silver, gold_ = stored_tables(with_gold(spark, sf_dir))
    counted = reconciliation.reconcile_counts(silver, gold_)
    checked = reconciliation.reconcile_checks(silver, gold_)
    return counted.unionAll(checked.select("check", "expected")).unionAll(checked.select("check", "actual"))


def silver_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and identifiers of silver tables as kept by the writes, and as found in the stored rows."""
    figures = reconciliation.stored_figures(with_silver(spark, sf_dir))
    both = figures.filter("figure IN ('rows', 'ids')").select("table_name", "figure", "kept", "found", "ok")
    whole = figures.groupBy("table_name").agg(F.every("ok").alias("whole"))
    return both.join(whole, "table_name")


def dq_rating_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings outside 1.5 to 4.5, narrower than the scale so that there are some."""
    silver = silver_tables(with_silver(spark, sf_dir))
    return reduce(
        DataFrame.union,
        [
            checks.rating_out_of_range(
                silver[name], "Rating", Decimal("1.50"), Decimal("4.50")
            ).select(F.lit(name).alias("table_name"), F.col(key).alias("key"), "Rating")
            for name, key in (("restaurants", "Restaurant_id"), ("delivery_partners", "Partner_id"))
        ],
    )


def dq_duplicate_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for spec in TABLES:
        rows = quality.normalise(stored_bronze(spark, sf_dir, spec), spec).distinct()
        repeated = quality.duplicate_keys(rows, spec.key)
        parts.append(
            repeated.select(
                F.lit(spec.silver_name).alias("table_name"), F.col(spec.key).alias("key"), "copies"
            )
        )
    return reduce(DataFrame.union, parts)


def audit_duplicate_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = with_bronze(spark, sf_dir, *TABLES)
    stage = Stage(warehouse)
    losers = run_together(
        spark, lambda spec: stored_duplicates(warehouse, spec, stage), TABLES, AT_ONCE
    )
    return reduce(
        DataFrame.union,
        [_rejects_per_key(rows, spec.key) for rows, spec in zip(losers, TABLES, strict=True)],
    )


def dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = [
        checks.Link("orders", "Customer_id", "customers", "Customer_id"),
        checks.Link("orders", "Restaurant_id", "restaurants", "Restaurant_id"),
        checks.Link("orders", "Partner_id", "delivery_partners", "Partner_id"),
        checks.Link("order_items", "Order_id", "orders", "Order_id"),
    ]
    return checks.orphans(silver_tables(with_silver(spark, sf_dir)), links)


def dq_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_silver(spark, sf_dir).silver(ORDERS)
    allowed = {
        "Payment_mode": list(gold.PAYMENT_SHARES.values()),
        "Delivery_status": [gold.DELIVERED, "Cancelled"],
    }
    return reduce(
        DataFrame.union,
        [
            checks.value_not_in(orders, column, values).select(
                F.lit(column).alias("column_name"), "value", "n"
            )
            for column, values in allowed.items()
        ],
    )


def fn_initcap_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = testbed.source_table(spark, sf_dir, "documents")
    return documents.select("doc_id", initcap_words(F.col("text")).alias("capitalised"))


def fn_day_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testbed.source_table(spark, sf_dir, "events")
    per_user = events.groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    first, last = F.col("t0"), F.col("t1")
    return per_user.select(
        "user_id",
        whole_days(last, first).cast("bigint").alias("span_days"),
        whole_days(first, last).cast("bigint").alias("reverse_days"),
    )


def fn_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    value = F.col("l_extendedprice").cast("decimal(12,2)")
    return (
        testbed.source_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            pct(F.count_if(returned), F.count(F.lit(1))).alias("returned_pct"),
            avg2(F.col("l_quantity").cast("bigint")).alias("avg_quantity"),
            pct_amount(F.sum(F.when(returned, value)), F.sum(value)).alias("returned_value_pct"),
        )
    )


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV extracts through all layers; one row per table."""
    return run_pipeline(fresh_warehouse(spark), landing(spark, sf_dir), testbed.AS_OF)


def pipeline_failed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose third gold table fails, for want of a valid day; the reconciliation still reports."""
    report = run_pipeline(
        fresh_warehouse(spark), landing(spark, sf_dir), "no day", on_gold_error="skip"
    )
    return report.withColumn("status", F.split("status", ":")[0])


def queries() -> dict[str, Query]:
    names = list(BY_SILVER_NAME)
    out: dict[str, Query] = {}
    out.update({f"bronze_{name}": _bronze(name) for name in names})
    out.update({f"silver_{name}": _silver(name) for name in names})
    out.update({f"audit_{name}": _audit(name) for name in names})
    out["silver_customers_reject_null_key"] = _silver("customers", quality.REJECT)
    out["audit_customers_reject_null_key"] = _audit("customers", quality.REJECT)
    for name in names:
        if name != "customers":
            out[f"silver_{name}_reject_null_key"] = _silver_reject(name)
            out[f"audit_{name}_reject_null_key"] = _audit_reject(name)
    out.update({f"gold_{name}": _gold(name) for name in GOLD_TABLES})
    for query in (
        bronze_null_tokens,
        bronze_date_coerce,
        bronze_numeric_coerce,
        bronze_malformed,
        bronze_quoted,
        bronze_mixed_headers,
        bronze_append,
        bronze_append_retry,
        bronze_load_report,
        audit_payload,
        silver_after_failed_rebuild,
        silver_audit_after_crash,
        dedup_pk,
        gold_if_absent,
        reconcile_counts,
        reconcile_checks,
        reconcile_tables,
        silver_figures,
        dq_rating_range,
        dq_duplicate_pk,
        audit_duplicate_pk,
        dq_fk_orphans,
        dq_enum,
        fn_initcap_words,
        fn_day_lag,
        fn_pct,
        pipeline_run,
        pipeline_failed_gold,
    ):
        out[query.__name__] = query
    return {name: _comparable(query) for name, query in out.items()}


def _comparable(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))
