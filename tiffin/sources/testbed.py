"""Bronze rows derived from the test tables, with dirt added by arithmetic on their keys.

The statements use only SQL that Spark and DuckDB share, so that the same rows feed the queries and
the SQL they are checked against. Dirt: missing keys, bad and missing emails, missing dates, rows
differing in case only, conflicting rows of one key, repeated item keys, negative and zero values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiffin.schemas import TABLES, TableSpec

# The day after the newest test order.
AS_OF = "2001-08-02"

_CUSTOMERS = """
SELECT
    c_custkey AS k,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'C' || CAST(c_custkey AS STRING) END AS Customer_id,
    '  ' || lower(split_part(c_name, '#', 1)) || ' ' AS First_Name,
    split_part(c_name, '#', 2) AS Last_Name,
    CASE
        WHEN c_custkey % 13 = 0 THEN 'C' || CAST(c_custkey AS STRING) || '.example.com'
        WHEN c_custkey % 29 = 0 THEN NULL
        ELSE ' C' || CAST(c_custkey AS STRING) || '@Example.COM '
    END AS Email,
    ' ' || lpad(CAST(c_custkey AS STRING), 10, '9') || ' ' AS Phone_number,
    ' ' || replace(n_name, '_', '-') || ' ' AS City,
    CASE
        WHEN c_custkey % 31 = 0 THEN NULL
        ELSE DATE '1995-01-01' + CAST(c_custkey % 700 AS INT)
    END AS Signup_date
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

STATEMENTS = {
    "Customers": f"""
WITH clean AS ({_CUSTOMERS})
SELECT Customer_id, First_Name, Last_Name, Email, Phone_number, City, Signup_date FROM clean
UNION ALL
SELECT Customer_id, upper(First_Name), Last_Name, Email, Phone_number, lower(City), Signup_date
FROM clean WHERE k % 7 = 0
UNION ALL
SELECT Customer_id, First_Name, Last_Name, Email, Phone_number, 'zz moved city', Signup_date
FROM clean WHERE k % 11 = 0
UNION ALL
SELECT Customer_id, First_Name, Last_Name, 'no-at-sign', Phone_number, City, Signup_date
FROM clean WHERE k % 101 = 0
""",
    "Restaurants": """
SELECT
    CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE 'R' || CAST(p_partkey AS STRING) END
        AS Restaurant_id,
    ' ' || p_name || '''s diner ' AS Name,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS Cuisine_type,
    ' new-' || p_brand || ' ' AS City,
    CASE
        WHEN p_partkey % 19 = 0 THEN NULL
        ELSE CAST(
            CAST(100 + (p_partkey * 7) % 401 AS DECIMAL(10, 0)) * CAST(0.01 AS DECIMAL(3, 2))
            AS DECIMAL(3, 2))
    END AS Rating,
    CASE
        WHEN p_partkey % 37 = 0 THEN NULL
        ELSE DATE '1994-01-15' + CAST(p_partkey % 500 AS INT)
    END AS Open_date
FROM {part}
""",
    "Delivery_Partners": """
SELECT
    'P' || CAST(s_suppkey AS STRING) AS Partner_id,
    s_name AS Partner_name,
    ' ' || lpad(CAST(s_suppkey AS STRING), 10, '8') || ' ' AS Phone_number,
    'nation-' || CAST(s_nationkey AS STRING) AS City,
    CASE WHEN s_suppkey % 3 = 0 THEN 'Bike' WHEN s_suppkey % 3 = 1 THEN 'Car' ELSE 'Scooter' END
        AS Vehicle_type,
    CAST(
        CAST(100 + (s_suppkey * 13) % 401 AS DECIMAL(10, 0)) * CAST(0.01 AS DECIMAL(3, 2))
        AS DECIMAL(3, 2)) AS Rating,
    CASE
        WHEN s_suppkey % 23 = 5 THEN NULL
        ELSE DATE '2000-06-01' + CAST((s_suppkey * 11) % 420 AS INT)
    END AS Join_date
FROM {supplier}
""",
    "Orders": """
SELECT
    'O' || CAST(o_orderkey AS STRING) AS Order_id,
    'C' || CAST(o_custkey AS STRING) AS Customer_id,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 'City ' || CAST(o_custkey % 25 AS STRING) END
        AS Customer_City,
    'R' || CAST((o_orderkey * 7) % 250 AS STRING) AS Restaurant_id,
    'P' || CAST(o_orderkey % 120 AS STRING) AS Partner_id,
    CAST(CAST(o_orderdate AS DATE) AS {timestamp}) AS Order_date,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END
        AS Delivery_status,
    CASE o_orderpriority
        WHEN '1-URGENT' THEN 'COD'
        WHEN '2-HIGH' THEN 'Card'
        WHEN '3-MEDIUM' THEN 'UPI'
        WHEN '4-NOT SPECIFIED' THEN 'Wallet'
        ELSE 'NetBanking'
    END AS Payment_mode,
    CASE
        WHEN o_orderkey % 41 = 0 THEN CAST(-1.00 AS DECIMAL(10, 2))
        ELSE CAST(o_totalprice AS DECIMAL(10, 2))
    END AS Order_amount
FROM {orders}
""",
    "Order_Items": """
SELECT
    'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS Order_item_id,
    'O' || CAST(l_orderkey AS STRING) AS Order_id,
    p_name AS Menu_item,
    CASE WHEN (l_partkey + l_linenumber) % 53 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END
        AS Quantity,
    CASE
        WHEN l_partkey % 59 = 0 THEN CAST(-0.50 AS DECIMAL(10, 2))
        ELSE CAST(
            CAST((l_partkey * 37 + l_linenumber * 11) % 3000 AS DECIMAL(10, 0))
            * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(10, 2))
    END AS Price
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
}

_SOURCES = ("customer", "nation", "part", "supplier", "orders", "lineitem")


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_missing_keys(bronze_name: str) -> str:
    """The statement of a table with copies of some rows that have lost their key, the first column."""
    spec = next(t for t in TABLES if t.bronze_name == bronze_name)
    statement = STATEMENTS[bronze_name]
    rest = ", ".join(f.name for f in spec.fields[1:])
    return f"""SELECT * FROM ({statement}) AS r
UNION ALL
SELECT CAST(NULL AS STRING) AS {spec.key}, {rest} FROM ({statement}) AS r WHERE {spec.key} LIKE '%7'"""


def bronze(
    spark: SparkSession, sf_dir: str, spec: TableSpec, missing_keys: bool = False
) -> DataFrame:
    """Bronze rows of one table, derived from the test tables in ``sf_dir``."""
    statement = STATEMENTS[spec.bronze_name]
    if missing_keys:
        statement = with_missing_keys(spec.bronze_name)
    sources = {
        name: source_table(spark, sf_dir, name) for name in _SOURCES if f"{{{name}}}" in statement
    }
    rows = spark.sql(statement.replace("{timestamp}", "TIMESTAMP_NTZ"), **sources)
    return rows.select(*[rows[f.name].cast(f.type) for f in spec.fields])


def all_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {spec.silver_name: bronze(spark, sf_dir, spec) for spec in TABLES}
