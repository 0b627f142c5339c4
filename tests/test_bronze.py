from __future__ import annotations

import datetime
import json
import random
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from settings import conf

from tiffin.plans.bronze import load_bronze, load_report
from tiffin.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, RESTAURANTS, TABLES
from tiffin.sources import testbed
from tiffin.sources.csv_files import (
    NULL_TOKENS,
    malformed_records,
    read_bronze_csv,
    read_csv_text,
    to_day,
    write_csv,
)
from tiffin.sources.warehouse import BRONZE, GOLD, Warehouse

SF = "/root/testdata/sf0.001"
ITEMS = ",".join(f.name for f in ORDER_ITEMS.fields)


def _csv(tmp_path, spec, text: str) -> str:
    path = tmp_path / f"{spec.bronze_name}.csv"
    path.write_text(text)
    return str(path)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = _csv(
        tmp_path,
        ORDER_ITEMS,
        'Price,Extra,Menu_item,Order_item_id,Quantity,Order_id\n1.50,x,"a ""b"", c",I1,2,O1\n',
    )
    rows = read_bronze_csv(spark, path, ORDER_ITEMS)
    assert rows.schema == ORDER_ITEMS.bronze_schema
    assert rows.collect() == [("I1", "O1", 'a "b", c', 2, Decimal("1.50"))]


def test_missing_column_fails(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, "Order_item_id,Order_id\nI1,O1\n")
    with pytest.raises(AnalysisException):
        read_bronze_csv(spark, path, ORDER_ITEMS)


def _parts(tmp_path, **texts):
    folder = tmp_path / "Order_Items.csv"
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text, newline="")
    return str(folder)


def test_parts_are_read_by_their_own_headers(spark, tmp_path):
    """Reordered, extra and repeated columns, in parts with and without line breaks inside quotes."""
    header = [f.name for f in ORDER_ITEMS.fields]
    texts = {
        "a": ",".join(header) + "\nI1,O1,tea,1,1.00\n",
        "b": ",".join(header) + "\nI2,O1,tea,1,1.00\n",
        "c": ",".join(reversed(header)) + "\n1.00,1,tea,O1,I3\n",
        "d": ",".join(["Extra", *header, "Extra", ""]) + "\nx,I4,O1,tea,1,1.00,y,z\n",
        "empty": "",
        "only_header": ",".join(header) + "\n",
    }
    want = [(f"I{i}", "O1", "tea", 1, Decimal("1.00")) for i in (1, 2, 3, 4)]
    path = _parts(tmp_path, **texts)
    assert sorted(map(tuple, read_bronze_csv(spark, path, ORDER_ITEMS).collect())) == want
    (tmp_path / "Order_Items.csv" / "e.csv").write_text(",".join(reversed(header)) + '\n1.00,1,"te\na",O1,I5\n')
    got = sorted(map(tuple, read_bronze_csv(spark, path, ORDER_ITEMS).collect()))
    assert got == [*want, ("I5", "O1", "te\na", 1, Decimal("1.00"))]


def test_each_part_is_read_once_and_each_record_parsed_once(spark, tmp_path):
    path = _parts(
        tmp_path,
        a=f"{ITEMS}\nI1,O1,tea,1,1.00\n",
        b='Price,Quantity,Menu_item,Order_id,Order_item_id\n2.00,2,"rice\nand beans",O1,I2\n',
        c=f"Remark,{ITEMS}\nnew,I3,O2,soup,3,3.00\n",
    )
    with conf(spark, **{"spark.sql.maxMetadataStringLength": "5000"}):
        rows = read_bronze_csv(spark, path, ORDER_ITEMS)
        assert sorted(r["Menu_item"] for r in rows.collect()) == ["rice\nand beans", "soup", "tea"]
        execution = rows._jdf.queryExecution()
        assert execution.optimizedPlan().toString().count("from_csv") == 3
        plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3
    for name in "abc":
        assert sum(f"/{name}.csv" in scan for scan in scans) == 1


def test_names_of_parts_with_signs_of_patterns(spark, tmp_path):
    folder = tmp_path / "Order_Items.csv"
    folder.mkdir()
    (folder / "part[1] {a}.csv").write_text(f'{ITEMS}\nI1,O1,"a\nb",1,1.00\n')
    (folder / "part?.csv").write_text(f"x,{ITEMS}\nx,I2,O1,tea,1,1.00\n")
    rows = read_bronze_csv(spark, str(folder), ORDER_ITEMS)
    assert sorted(r["Menu_item"] for r in rows.collect()) == ["a\nb", "tea"]


def test_a_part_without_a_column_is_named(spark, tmp_path):
    header = [f.name for f in ORDER_ITEMS.fields]
    path = _parts(tmp_path, a=",".join(header) + "\n", b=",".join(header[1:]) + "\nO1,tea,1,1.00\n")
    with pytest.raises(AnalysisException, match=r"b\.csv has no column Order_item_id"):
        read_bronze_csv(spark, path, ORDER_ITEMS)


def test_null_tokens(spark, tmp_path):
    lines = [f'"{t}",C{i}' for i, t in enumerate((*NULL_TOKENS, " NA", "na", "Null"))]
    other = ",".join(f.name for f in CUSTOMERS.fields if f.name not in ("City", "Customer_id"))
    path = _csv(tmp_path, CUSTOMERS, f"City,Customer_id,{other}\n" + "\n".join(lines) + "\n")
    cities = {r.Customer_id: r.City for r in read_bronze_csv(spark, path, CUSTOMERS).collect()}
    kept = {c: v for c, v in cities.items() if v is not None}
    n = len(NULL_TOKENS)
    assert kept == {f"C{n}": " NA", f"C{n + 1}": "na", f"C{n + 2}": "Null"}


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-02-29", "2024-02-29"),
        ("2024-02-29 23:59:59", "2024-02-29"),
        ("2024-02-29 23:59:59.123", "2024-02-29"),
        ("2024-02-29T10:00:00", "2024-02-29"),
        ("2024/02/29", "2024-02-29"),
        ("02/29/2024", "2024-02-29"),
        ("1/5/2024", "2024-01-05"),
        ("2024-1-5", "2024-01-05"),
        ("2024-01-05 13:45", "2024-01-05"),
        ("2024-01-05T13:45", "2024-01-05"),
        ("2024-01-05 23:45:00-05:00", "2024-01-05"),
        ("2024-01-05T23:59:59.999999Z", "2024-01-05"),
        ("05-JAN-2024", "2024-01-05"),
        ('"jan 5, 2024"', "2024-01-05"),
        ('"January 5, 2024 9:05 PM"', "2024-01-05"),
        ("2024/01/05 10:00:00", "2024-01-05"),
        (" 2024-01-05 ", "2024-01-05"),
        ("2024-01-05 24:00", None),
        ("2024-01-05 noon", None),
        ("2023-02-29", None),
        ("13/13/2024", None),
        ("soon", None),
        ("", None),
    ],
)
def test_dates(spark, tmp_path, text, day):
    header = ",".join(f.name for f in ORDERS.fields)
    path = _csv(tmp_path, ORDERS, f"{header}\nO1,C1,X,R1,P1,{text},Delivered,COD,1\n")
    got = read_bronze_csv(spark, path, ORDERS).first().Order_date
    expected = day and datetime.datetime.fromisoformat(day)
    assert got == expected


@pytest.mark.parametrize(
    ("quantity", "price", "expected"),
    [
        ("2", "10.5", (2, Decimal("10.50"))),
        ("2.0", "1e3", (2, Decimal("1000.00"))),
        ("2.5", "10.005", (3, Decimal("10.01"))),
        ("-2.5", "-0.004", (-3, Decimal("0.00"))),
        ("many", '"1,000"', (None, None)),
        ("2147483647", "99999999.994", (2147483647, Decimal("99999999.99"))),
        ("1d", "1.5f", (None, None)),
        ("NULL", "NaN", (None, None)),
        (" 4 ", " 7.25 ", (4, Decimal("7.25"))),
    ],
)
def test_numbers(spark, tmp_path, quantity, price, expected):
    header = ",".join(f.name for f in ORDER_ITEMS.fields)
    path = _csv(tmp_path, ORDER_ITEMS, f"{header}\nI1,O1,tea,{quantity},{price}\n")
    row = read_bronze_csv(spark, path, ORDER_ITEMS).first()
    assert (row.Quantity, row.Price) == expected


@pytest.mark.parametrize(
    ("quantity", "price", "column"),
    [("99999999999", "1", "Quantity"), ("1", "123456789012.50", "Price"), ("1e400", "1", "Quantity"),
     ("1", "inf", "Price"), ("1", "99999999.995", "Price")],
)
def test_numbers_that_do_not_fit_end_the_load(spark, tmp_path, quantity, price, column):
    path = _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\nI1,O1,tea,{quantity},{price}\n")
    with pytest.raises(Exception, match=f"{column} does not fit"):
        read_bronze_csv(spark, path, ORDER_ITEMS).collect()


def test_usual_days_are_converted_without_trying_formats(spark):
    texts = ["1996-02-29", "1996-02-30", "1900-02-29", "9999-12-31 23:59:59", "1996-01-05T24:00:00", "1996-01-05\n"]
    days = spark.createDataFrame([(t,) for t in texts], "c string").select(to_day(F.col("c")).alias("day"))
    assert [str(r["day"]) for r in days.collect()] == ["1996-02-29", "None", "None", "9999-12-31", "None", "None"]
    usual = spark.createDataFrame([("1996-02-29 10:00:00",)], "c string").repartition(1)
    plan = usual.select(to_day(F.col("c")).alias("day"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN RLIKE") < plan.index("coalesce(")


def test_day_first(spark, tmp_path):
    header = ",".join(f.name for f in ORDERS.fields)
    path = _csv(tmp_path, ORDERS, f"{header}\nO1,C1,X,R1,P1,1/5/2024 10:00,Delivered,COD,1\n")
    got = read_bronze_csv(spark, path, ORDERS, day_first=True).first().Order_date
    assert got == datetime.datetime(2024, 5, 1)


def test_too_long_text_fails(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\n{'I' * 21},O1,tea,1,1\n")
    with pytest.raises(Exception, match="longer than 20"):
        read_bronze_csv(spark, path, ORDER_ITEMS).collect()


def test_blanks_beyond_the_width_are_cut(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, f'{ITEMS}\n"{"I" * 18}     ",O1  ,tea,1,1\n')
    row = read_bronze_csv(spark, path, ORDER_ITEMS).first()
    assert row.Order_item_id == "I" * 18 + "  " and row.Order_id == "O1  "


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, f'{ITEMS}\nI1,O1,"green\ntea",1,1\n')
    for multiline in (None, True):
        row = read_bronze_csv(spark, path, ORDER_ITEMS, multiline=multiline).first()
        assert row.Menu_item == "green\ntea"
    with pytest.raises(Exception, match="Unclosed quote"):
        read_bronze_csv(spark, path, ORDER_ITEMS, multiline=False).collect()


def test_a_file_that_ends_inside_quotes(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, f'{ITEMS}\nI1,O1,"green\ntea",1,1\nI2,O1,"green,1,1\n')
    with pytest.raises(ValueError, match=r"Unclosed quote at the end of .*Order_Items\.csv"):
        read_bronze_csv(spark, path, ORDER_ITEMS)
    # Line by line, as no line can be told to be the one with the open quote.
    assert read_bronze_csv(spark, path, ORDER_ITEMS, malformed="skip").collect() == []
    assert malformed_records(spark, path, ORDER_ITEMS).count() == 3


CELLS = ["a", "", '"', '""', '"x', 'x"', ",", "\n", "\r\n", "\n\n", '"\n', '\n"', "tea", " ", '","', "é🙂"]


def _written(rng, rows):
    """CSV text of rows, with quotes where they are needed and in places where they are not."""
    lines = []
    for row in rows:
        cells = []
        for cell in row:
            needed = cell[:1] == '"' or any(c in cell for c in ",\n\r")
            quoted = needed or rng.random() < 0.3
            cells.append('"' + cell.replace('"', '""') + '"' if quoted else cell)
        lines.append(",".join(cells) + rng.choice(["\n", "\r\n"]))
        if rng.random() < 0.1:
            lines.append("\n")
    return "".join(lines)


@pytest.mark.parametrize("split_bytes", [1, 7, 64, 1000])
def test_records_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    """Random files, in splits of any size: the cells come back as they were written."""
    rng = random.Random(split_bytes)
    header = [f.name for f in ORDER_ITEMS.fields]
    texts, want = {}, []
    for part in range(3):
        rows = [
            (f"I{part}-{i}", "O1", "".join(rng.choices(CELLS, k=rng.randrange(6))) + "x", "1", "1.00")
            for i in range(rng.randrange(1, 25))
        ]
        want += rows
        texts[f"p{part}"] = ",".join(header) + "\r\n" + _written(rng, rows)
    path = _parts(tmp_path, **texts)
    settings = {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.files.openCostInBytes": "0",
    }
    with conf(spark, **settings):
        got = [
            tuple(r)
            for _, text in read_csv_text(spark, path)
            for r in text.filter("_reason IS NULL").select(*header).collect()
        ]
    assert sorted(got) == sorted(want)


def test_many_tasks_read_a_file_with_line_breaks(spark, tmp_path):
    lines = "".join(f'I{i},O{i},"tea\nno. {i}",1,1.00\n' for i in range(5000))
    path = _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\n{lines}")
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "10000"}):
        rows = read_bronze_csv(spark, path, ORDER_ITEMS)
        whole = read_bronze_csv(spark, path, ORDER_ITEMS, multiline=True)
        per_task = rows.groupBy(F.spark_partition_id().alias("task")).count()
        assert per_task.filter("count > 0").count() > 10
        assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()


def test_changed_splits_are_an_error(spark, tmp_path):
    lines = "".join(f'I{i},O{i},"tea\nno. {i}",1,1.00\n' for i in range(500))
    path = _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\n{lines}")
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "10000"}):
        rows = read_bronze_csv(spark, path, ORDER_ITEMS)
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "3000"}):
        with pytest.raises(Exception, match="splits of an extract changed"):
            rows.collect()


BAD_LINES = (
    'I1,O1,Soup, hot,2,3.50\nI2,O1,"a, ""b""",1,2.00\nI3,O1,"Rice\nand beans",1,2.00\nI4,O1,short\n'
)


def test_records_with_too_many_fields_end_the_load(spark, tmp_path):
    path = _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\nI1,O1,Soup, hot,2,3.50\n")
    with pytest.raises(Exception, match="Too many fields in Order_Items: I1,O1"):
        read_bronze_csv(spark, path, ORDER_ITEMS).collect()
    header = ITEMS.replace("Price", "Price,Extra")
    path = _csv(tmp_path, ORDER_ITEMS, f"{header}\nI1,O1,Soup,2,3.50,x,y\n")
    with pytest.raises(Exception, match="Too many fields"):
        read_bronze_csv(spark, path, ORDER_ITEMS).collect()


def test_malformed_records_can_go_to_the_audit(spark, tmp_path):
    _csv(tmp_path, ORDER_ITEMS, f"{ITEMS}\n{BAD_LINES}")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    steps = load_bronze(warehouse, str(tmp_path), [ORDER_ITEMS], multiline=False, malformed="audit")
    assert steps == [("Order_Items", "loaded", 2), ("Order_Items", "malformed", 3)]
    loaded = {r.Order_item_id: (r.Menu_item, r.Price) for r in warehouse.bronze(ORDER_ITEMS).collect()}
    assert loaded == {"I2": ('a, "b"', Decimal("2.00")), "I4": ("short", None)}
    audit = {(r.reason, json.loads(r.row_data)["record"]) for r in warehouse.audit().collect()}
    assert audit == {
        ("Too many fields", "I1,O1,Soup, hot,2,3.50"),
        ("Unclosed quote", 'I3,O1,"Rice'),
        ("Unclosed quote", 'and beans",1,2.00'),
    }
    for multiline in (None, True):
        whole = Warehouse(spark, str(tmp_path / f"whole-{multiline}"))
        steps = load_bronze(whole, str(tmp_path), [ORDER_ITEMS], malformed="audit", multiline=multiline)
        assert steps == [("Order_Items", "loaded", 3), ("Order_Items", "malformed", 1)]
    with pytest.raises(Exception, match="Too many fields"):
        load_bronze(whole, str(tmp_path), [ORDER_ITEMS])
    with pytest.raises(ValueError):
        load_bronze(whole, str(tmp_path), [ORDER_ITEMS], malformed="ignore")


@pytest.mark.parametrize("spec", TABLES, ids=lambda s: s.bronze_name)
def test_round_trip(spark, tmp_path, spec):
    rows = testbed.bronze(spark, SF, spec)
    path = str(tmp_path / "x.csv")
    write_csv(rows, path)
    back = read_bronze_csv(spark, path, spec)
    assert back.dtypes == rows.dtypes
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_load_appends_and_reports(spark, tmp_path):
    folder = str(tmp_path / "landing")
    for spec in (CUSTOMERS, ORDERS):
        write_csv(testbed.bronze(spark, SF, spec), f"{folder}/{spec.bronze_name}.csv")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for times in (1, 2):
        report = load_bronze(warehouse, folder, [CUSTOMERS, RESTAURANTS, ORDERS])
        assert load_report(spark, report).collect() == [
            ("Customers", "loaded", 188),
            ("Restaurants", "missing", None),
            ("Orders", "loaded", 1500),
        ]
        assert warehouse.bronze(CUSTOMERS).count() == 188 * times
    assert not warehouse.exists(BRONZE, "Restaurants")


def test_write_modes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    one, two = spark.range(3), spark.range(3, 5)

    def stored():
        return sorted(r.id for r in warehouse.read(GOLD, "t").collect())

    assert warehouse.write(one, GOLD, "t", "ignore") == 3
    assert warehouse.write(two, GOLD, "t", "ignore") == 0
    assert stored() == [0, 1, 2]
    assert warehouse.write(two, GOLD, "t", "append") == 2
    assert stored() == [0, 1, 2, 3, 4]
    assert warehouse.write(two, GOLD, "t") == 2
    assert stored() == [3, 4]


def test_testbed_counts(spark):
    customers = testbed.bronze(spark, SF, CUSTOMERS)
    assert customers.agg(
        F.count("*"),
        F.count("Customer_id"),
        F.count_distinct("Customer_id"),
        F.count_if(~F.col("Email").like("%@%")),
        F.count_if(F.col("Signup_date").isNull()),
    ).first()[:] == (188, 183, 148, 18, 8)
    items = testbed.bronze(spark, SF, ORDER_ITEMS)
    assert items.agg(
        F.count("*"),
        F.count_distinct("Order_item_id"),
        F.count_if(F.col("Quantity") <= 0),
        F.count_if(F.col("Price") < 0),
        F.sum(F.col("Quantity") * F.col("Price")),
    ).first()[:] == (6000, 4599, 107, 125, Decimal("1985722.78"))
