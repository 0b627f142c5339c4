"""One statement per query."""

from __future__ import annotations

from oracle.pieces import (
    CLEANED,
    MISSING_KEY_REASON,
    bronze_sql,
    capitalised,
    distinct_rows,
    mean,
    percent,
    ranked,
    rule_steps,
    silver_ctes,
    with_,
)
from tiffin.catalogue import DATE_SPELLINGS, NO_DAYS
from tiffin.sources.testbed import AS_OF

_DAY_US = 86_400_000_000
_DECIMALS = {"Rating", "Price", "Order_amount"}


def _plain(columns) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _DECIMALS else c for c in columns)


def _silver(table: str) -> str:
    return with_(silver_ctes(table), f"SELECT {_plain(CLEANED[table].columns)} FROM s_{table}")


def _audit(table: str, extra: str = "", missing_keys: bool = False) -> str:
    """Rows of each rejected key at the rule that rejects it."""
    t = CLEANED[table]
    parts = [
        f"SELECT '{table}' AS table_name, '{reason}' AS reason, {t.key} AS key, "
        f"CAST(count(*) AS BIGINT) AS n FROM {table}_{i} WHERE {t.key} IN "
        f"(SELECT {t.key} FROM {table}_{i} WHERE {condition}) GROUP BY {t.key}"
        for i, (condition, reason) in enumerate(t.rules)
    ]
    if not parts:
        parts = [
            "SELECT '' AS table_name, '' AS reason, '' AS key, CAST(0 AS BIGINT) AS n WHERE 1 = 0"
        ]
    return with_(
        [distinct_rows(table, missing_keys), *rule_steps(table)], "\nUNION ALL\n".join(parts) + extra
    )


def _silver_reject(table: str) -> str:
    t = CLEANED[table]
    last = ranked(table, f"{table}_{len(t.rules)}")
    return with_(
        [distinct_rows(table, missing_keys=True), *rule_steps(table)],
        f"SELECT {_plain(t.columns)} FROM ({last}) WHERE rn = 1 AND {t.key} IS NOT NULL",
    )


def _audit_reject(table: str) -> str:
    extra = (
        f"\nUNION ALL\nSELECT '{table}', '{MISSING_KEY_REASON[table]}', NULL, count(*) "
        f"FROM {table}_0 WHERE {CLEANED[table].key} IS NULL HAVING count(*) > 0"
    )
    return _audit(table, extra, missing_keys=True)


def _month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS TIMESTAMP)"


_ORDERS_SUMMARY_CTES = [
    *silver_ctes("orders", "order_items"),
    """baskets AS (
    SELECT any_value(o.Customer_City) AS town, any_value(o.Payment_mode) AS mode,
        any_value(o.Delivery_status) AS status, count(i.Order_item_id) AS items,
        sum(i.Quantity * i.Price) AS spent
    FROM s_orders o LEFT JOIN s_order_items i USING (Order_id) GROUP BY o.Order_id)""",
    f"""towns AS (
    SELECT town, CAST(round(100 * {percent("count(*) FILTER (status = 'Delivered')", "count(*)")})
        AS BIGINT) AS rate
    FROM baskets GROUP BY town)""",
]


def _share(condition: str) -> str:
    return percent(f"count(*) FILTER ({condition})", "count(*)")


_ORDERS_SUMMARY = f"""SELECT
    (SELECT count(DISTINCT Order_id) FROM s_orders) AS total_orders,
    {mean("100 * sum(items)", "count(*)")} AS avg_basket_size,
    {_share("mode = 'COD'")} AS cash_share_pct,
    {_share("mode = 'Card'")} AS card_share_pct,
    {_share("mode = 'UPI'")} AS upi_share_pct,
    {_share("mode = 'Wallet'")} AS wallet_share_pct,
    {_share("spent > 1000")} AS high_value_order_share_pct,
    {_share("status = 'Delivered'")} AS delivery_success_rate_pct,
    (SELECT {mean("sum(rate)", "count(*)")} FROM towns) AS avg_city_reliability_pct
FROM baskets"""

_MENU_CTES = silver_ctes("orders", "order_items", "restaurants")

# Revenue as whole cents, and the cuisine total as a window over the groups.
_MENU = f"""SELECT Menu_item, Cuisine, total_orders, total_quantity_sold,
    CAST(cents / 100.0 AS DOUBLE) AS total_revenue,
    {percent("total_orders", "(SELECT count(*) FROM s_orders WHERE Order_id IS NOT NULL)")}
        AS popularity_index,
    {percent("cents", "sum(cents) OVER (PARTITION BY Cuisine)")} AS cuisine_revenue_share
FROM (
    SELECT Menu_item, cuisine_type AS Cuisine, count(DISTINCT Order_id) AS total_orders,
        CAST(sum(Quantity) AS BIGINT) AS total_quantity_sold,
        CAST(sum(100 * Quantity * Price) AS HUGEINT) AS cents
    FROM s_order_items JOIN s_orders USING (Order_id) JOIN s_restaurants USING (Restaurant_id)
    WHERE cuisine_type IS NOT NULL
    GROUP BY Menu_item, cuisine_type)"""


def _days(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) // {_DAY_US})"


_CUSTOMER_CTES = [
    *silver_ctes("customers", "orders"),
    f"""people AS (
    SELECT {_month("c.Signup_date")} AS acquisition_month, c.city, c.Customer_id,
        count(o.Order_id) AS orders,
        {_days("max(o.Order_date)", "min(o.Order_date)")} AS span,
        {_days(f"TIMESTAMP '{AS_OF}'", "max(o.Order_date)")} AS idle
    FROM s_customers c LEFT JOIN s_orders o ON o.Customer_id = c.Customer_id
    GROUP BY ALL)""",
    f"""cohorts AS (
    SELECT acquisition_month, city, count(Customer_id) AS new_customers,
        {_share("orders >= 2")} AS retention_rate_pct,
        {_share("idle > 90")} AS dormant_customer_pct,
        count(*) FILTER (idle <= 30) AS active_customers,
        {mean("100 * sum(span)", "count(span)")} AS avg_first_to_last_order_lag
    FROM people GROUP BY acquisition_month, city)""",
]

_CUSTOMER = """SELECT a.acquisition_month, a.city,
    CAST(sum(b.new_customers) AS BIGINT) AS total_customers,
    a.new_customers, a.retention_rate_pct, a.dormant_customer_pct, a.active_customers,
    a.avg_first_to_last_order_lag
FROM cohorts a JOIN cohorts b ON b.city IS NOT DISTINCT FROM a.city
    AND (a.acquisition_month IS NULL OR b.acquisition_month <= a.acquisition_month)
GROUP BY ALL"""

_RESTAURANT_CTES = [
    *silver_ctes("restaurants", "orders", "order_items"),
    f"""places AS (
    SELECT {_month("r.Open_date")} AS opening_month, r.city, r.Restaurant_id,
        any_value(r.Rating) AS stars, sum(i.Quantity * i.Price) AS sold
    FROM s_restaurants r
    LEFT JOIN (s_orders o JOIN s_order_items i ON i.Order_id = o.Order_id)
        ON o.Restaurant_id = r.Restaurant_id
    GROUP BY ALL)""",
    """openings AS (
    SELECT opening_month, city, count(Restaurant_id) AS new_restaurants,
        CAST(sum(CASE WHEN stars IS NULL OR sold IS NULL THEN 0 ELSE sold * stars END) AS DOUBLE)
            AS performance_score
    FROM places GROUP BY opening_month, city)""",
]

_RESTAURANT = """SELECT a.opening_month, a.city, a.new_restaurants,
    CAST(sum(b.new_restaurants) AS BIGINT) AS total_restaurants, a.performance_score
FROM openings a JOIN openings b ON b.city IS NOT DISTINCT FROM a.city
    AND (a.opening_month IS NULL OR b.opening_month <= a.opening_month)
GROUP BY ALL"""

_PARTNER_CTES = [
    *silver_ctes("delivery_partners", "orders"),
    f"""couriers AS (
    SELECT Partner_id, Vehicle_type, Rating, Join_date < DATE '{AS_OF}' - 180 AS seasoned,
        (SELECT count(*) FROM s_orders o WHERE o.Partner_id = p.Partner_id) AS trips
    FROM s_delivery_partners p)""",
]


_PARTNER = f"""SELECT
    CASE WHEN grouping(Vehicle_type) = 1 THEN 'ALL' ELSE Vehicle_type END AS Vehicle_type,
    count(Partner_id) AS total_partners,
    {mean("100 * sum(trips)", "count(*)")} AS avg_orders_per_partner,
    {mean("sum(100 * Rating)", "count(Rating)")} AS avg_partner_rating,
    {_share("seasoned")} AS partner_retention_rate
FROM couriers GROUP BY GROUPING SETS ((Vehicle_type), ())"""


def _counts(*pairs: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS name, CAST(({sql}) AS BIGINT) AS value" for name, sql in pairs
    )


def _merge(*lists: list[str]) -> list[str]:
    """CTE lists put together, each CTE once, in order."""
    return list(dict.fromkeys(cte for ctes in lists for cte in ctes))


_ALL_CTES = _merge(
    silver_ctes(*CLEANED), _ORDERS_SUMMARY_CTES, _CUSTOMER_CTES, _RESTAURANT_CTES, _PARTNER_CTES
)

_COUNTS = {
    "total_orders": "SELECT count(*) FROM s_orders",
    "gold_total_orders": "SELECT 1",
    "total_customers": "SELECT count(*) FROM s_customers",
    "gold_total_customers": "SELECT count(*) FROM cohorts",
    "total_restaurants": "SELECT count(*) FROM s_restaurants",
    "gold_total_restaurants": "SELECT count(*) FROM openings",
    "total_partners": "SELECT count(*) FROM s_delivery_partners",
    "gold_total_partners": "SELECT 1 + count(DISTINCT Vehicle_type) FROM couriers",
}

_RECONCILE_COUNTS = with_(_ALL_CTES, _counts(*_COUNTS.items()))

_CHECKS = {
    "orders_in_summary": "SELECT count(Order_id) FROM s_orders",
    "customers_in_running_totals": "SELECT count(Customer_id) FROM s_customers",
    "customers_in_cohorts": "SELECT count(Customer_id) FROM s_customers",
    "restaurants_in_running_totals": "SELECT count(Restaurant_id) FROM s_restaurants",
    "restaurants_in_cohorts": "SELECT count(Restaurant_id) FROM s_restaurants",
    "partners_in_all_row": "SELECT count(Partner_id) FROM s_delivery_partners",
    "partners_by_vehicle": "SELECT count(Partner_id) FROM s_delivery_partners",
    "quantity_in_menu": (
        "SELECT sum(Quantity) FROM s_order_items JOIN s_orders USING (Order_id) "
        "JOIN s_restaurants USING (Restaurant_id) WHERE cuisine_type IS NOT NULL"
    ),
}

_RECONCILE_CHECKS = with_(
    silver_ctes(*CLEANED),
    'SELECT name AS "check", value AS expected, value AS actual, TRUE AS ok FROM ('
    + _counts(*_CHECKS.items())
    + ")",
)


def _orphans(child: str, child_key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{child_key}' AS foreign_key, c.{child_key} AS value, "
        f"count(*) AS n FROM s_{child} c LEFT JOIN s_{parent} p ON p.{parent_key} = c.{child_key} "
        f"WHERE p.{parent_key} IS NULL AND c.{child_key} IS NOT NULL GROUP BY c.{child_key}"
    )


_FK_ORPHANS = with_(
    silver_ctes(*CLEANED),
    "\nUNION ALL\n".join(
        [
            _orphans("orders", "Customer_id", "customers", "Customer_id"),
            _orphans("orders", "Restaurant_id", "restaurants", "Restaurant_id"),
            _orphans("orders", "Partner_id", "delivery_partners", "Partner_id"),
            _orphans("order_items", "Order_id", "orders", "Order_id"),
        ]
    ),
)


def _enum(column: str, allowed: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, {column} AS value, count(*) AS n FROM s_orders "
        f"WHERE {column} NOT IN ({allowed}) GROUP BY {column}"
    )


_ENUM = with_(
    silver_ctes("orders"),
    _enum("Payment_mode", "'COD', 'Card', 'UPI', 'Wallet'")
    + "\nUNION ALL\n"
    + _enum("Delivery_status", "'Delivered', 'Cancelled'"),
)

_RATING = with_(
    silver_ctes("restaurants", "delivery_partners"),
    """SELECT 'restaurants' AS table_name, Restaurant_id AS key, CAST(Rating AS DOUBLE) AS Rating
FROM s_restaurants WHERE Rating < 1.5 OR Rating > 4.5
UNION ALL
SELECT 'delivery_partners', Partner_id, CAST(Rating AS DOUBLE)
FROM s_delivery_partners WHERE Rating < 1.5 OR Rating > 4.5""",
)

_DUPLICATE_KEYS = with_(
    [distinct_rows(t) for t in CLEANED],
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, {t.key} AS key, max(rn) AS copies "
        f"FROM ({ranked(name, f'{name}_0')}) WHERE {t.key} IS NOT NULL "
        f"GROUP BY {t.key} HAVING max(rn) > 1"
        for name, t in CLEANED.items()
    ),
)


def _audit_duplicates() -> str:
    ctes, parts = [], []
    for name, t in CLEANED.items():
        ctes.extend([distinct_rows(name), *rule_steps(name)])
        parts.append(
            f"SELECT '{name}' AS table_name, 'Duplicate PK' AS reason, {t.key} AS key, "
            f"count(*) AS n FROM ({ranked(name, f'{name}_{len(t.rules)}')}) "
            f"WHERE rn > 1 AND {t.key} IS NOT NULL GROUP BY {t.key}"
        )
    return with_(ctes, "\nUNION ALL\n".join(parts))


def _bronze(table: str) -> str:
    t = CLEANED[table]
    return f"SELECT * REPLACE ({_replace(table)}) FROM ({bronze_sql(t.bronze)})" if _replace(
        table
    ) else bronze_sql(t.bronze)


def _replace(table: str) -> str:
    names = [c for c in CLEANED[table].columns if c in _DECIMALS]
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in names)


_NULL_TOKENS = """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS Customer_id,
    CASE WHEN c_custkey % 20 = 19 THEN c_name END AS First_Name,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE ' NA ' END AS Last_Name
FROM customer"""

_DATE_COERCE = f"""SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS Order_id,
    CASE WHEN o_orderkey % {len(DATE_SPELLINGS) + len(NO_DAYS)} < {len(DATE_SPELLINGS)}
        THEN date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) END AS Order_date
FROM orders"""

_NUMERIC_COERCE = """SELECT
    'I' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Order_item_id,
    CASE l_orderkey % 7
        WHEN 0 THEN CAST(l_quantity AS INT) WHEN 1 THEN CAST(l_quantity AS INT)
        WHEN 2 THEN CAST(l_quantity AS INT) + 1 WHEN 3 THEN CAST(l_quantity AS INT) * 100
        WHEN 5 THEN 2147483647
    END AS Quantity,
    CASE l_partkey % 5
        WHEN 0 THEN CAST(l_partkey AS INT) + 0.13 WHEN 1 THEN -l_partkey
        WHEN 2 THEN l_partkey + 0.5 WHEN 4 THEN 99999999.99 END :: DOUBLE AS Price
FROM lineitem"""

_MALFORMED = """SELECT 'Order_Items' AS table_name, 'loaded' AS status,
    count(*) FILTER (l_partkey % 10 > 1) AS rows, count(*) FILTER (l_partkey % 10 = 2) AS records
FROM lineitem
UNION ALL SELECT 'Order_Items', 'malformed', count(*) FILTER (l_partkey % 10 < 2),
    count(*) FILTER (l_partkey % 10 = 2) FROM lineitem
UNION ALL SELECT 'order_items', 'Too many fields', count(*),
    count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem WHERE l_partkey % 10 = 0
UNION ALL SELECT 'order_items', 'Unclosed quote', count(*),
    count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem WHERE l_partkey % 10 = 1"""

_QUOTED = """SELECT
    'I' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Order_item_id,
    'O' || CAST(l_orderkey AS VARCHAR) AS Order_id,
    CASE l_partkey % 4 WHEN 0 THEN 'Soup, hot' WHEN 1 THEN 'Rice' || chr(10) || 'and' || chr(10) || chr(10) || 'beans'
        WHEN 2 THEN 'the "best" tea' ELSE 'Bread' END AS Menu_item,
    CASE WHEN l_partkey % 4 IN (0, 2) THEN 2 ELSE 1 END AS Quantity,
    CASE l_partkey % 4 WHEN 0 THEN 3.5 WHEN 2 THEN 1.0 ELSE 2.0 END :: DOUBLE AS Price
FROM lineitem"""

_APPEND = f"""SELECT Customer_id, Email, City, CAST(2 * count(*) AS BIGINT) AS copies
FROM ({bronze_sql("Customers")}) GROUP BY Customer_id, Email, City"""

_LOAD_REPORT = "\nUNION ALL\n".join(
    f"SELECT '{t.bronze}' AS table_name, 'loaded' AS status, count(*) AS rows "
    f"FROM ({bronze_sql(t.bronze)})"
    if t.bronze != "Delivery_Partners"
    else "SELECT 'Delivery_Partners' AS table_name, 'missing' AS status, NULL AS rows"
    for t in CLEANED.values()
)

_REJECT_NULL_KEY = with_(
    silver_ctes("customers"),
    f"SELECT {_plain(CLEANED['customers'].columns)} FROM s_customers WHERE Customer_id IS NOT NULL",
)

_AUDIT_REJECT_NULL_KEY = _audit(
    "customers",
    "\nUNION ALL\nSELECT 'customers', "
    f"'{MISSING_KEY_REASON['customers']}', NULL, count(*) FROM customers_0 "
    "WHERE Customer_id IS NULL HAVING count(*) > 0",
)

_DEDUP = with_(
    [distinct_rows("order_items")],
    f"SELECT {_plain(CLEANED['order_items'].columns)} "
    f"FROM ({ranked('order_items', 'order_items_0')}) WHERE rn = 1 OR Order_item_id IS NULL",
)

_INITCAP = f"""SELECT doc_id, {capitalised("text")} AS capitalised FROM documents"""

_DAY_LAG = f"""SELECT user_id, (t1 - t0) // {_DAY_US} AS span_days,
    -((t1 - t0) // {_DAY_US}) AS reverse_days
FROM (SELECT user_id, epoch_us(min(ts)) AS t0, epoch_us(max(ts)) AS t1 FROM events GROUP BY user_id)"""

_PCT = f"""SELECT l_suppkey, {_share("l_returnflag = 'R'")} AS returned_pct,
    {mean("100 * CAST(sum(CAST(l_quantity AS BIGINT)) AS HUGEINT)", "count(*)")} AS avg_quantity,
    {percent("sum(CAST(100 * CAST(l_extendedprice AS DECIMAL(12, 2)) AS BIGINT)) "
             "FILTER (l_returnflag = 'R')",
             "sum(CAST(100 * CAST(l_extendedprice AS DECIMAL(12, 2)) AS BIGINT))")}
        AS returned_value_pct
FROM lineitem GROUP BY l_suppkey"""


def _pipeline_run(failed: bool = False) -> str:
    """The report of a run; with ``failed`` its third gold table and those after it are missing."""
    rows = []
    for name, t in CLEANED.items():
        rows.append(("bronze", t.bronze, "loaded", f"SELECT count(*) FROM ({bronze_sql(t.bronze)})"))
        rows.append(("silver", name, "built", f"SELECT count(*) FROM s_{name}"))
        rows.append(
            ("audit", name, "appended", f"SELECT (SELECT count(*) FROM {name}_0) - "
             f"(SELECT count(*) FROM {name}_{len(t.rules)})")
        )
    gold = {
        "orders_summary": "SELECT 1",
        "menu_performance": "SELECT count(*) FROM (SELECT DISTINCT Menu_item, cuisine_type "
        "FROM s_order_items JOIN s_orders USING (Order_id) JOIN s_restaurants USING "
        "(Restaurant_id) WHERE cuisine_type IS NOT NULL)",
        "customer_summary": "SELECT count(*) FROM cohorts",
        "restaurant_summary": "SELECT count(*) FROM openings",
        "partner_summary": "SELECT 1 + count(DISTINCT Vehicle_type) FROM couriers",
    }
    there = list(gold)[:2] if failed else list(gold)
    for name, sql in gold.items():
        status = "built" if name in there else "failed" if name == "customer_summary" else "skipped"
        rows.append(("gold", name, status, sql if name in there else "SELECT NULL"))
    for name, sql in _COUNTS.items():
        gone = failed and name.startswith("gold_") and name != "gold_total_orders"
        rows.append(("reconcile", name, *(("missing", "SELECT NULL") if gone else ("counted", sql))))
    for name, sql in _CHECKS.items():
        gone = failed and name not in ("orders_in_summary", "quantity_in_menu")
        rows.append(("reconcile", name, *(("missing", "SELECT NULL") if gone else ("ok", sql))))
    return with_(
        _ALL_CTES,
        "\nUNION ALL\n".join(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{status}' AS status, "
            f"CAST(({sql}) AS BIGINT) AS rows"
            for layer, table, status, sql in rows
        ),
    )


_AUDIT_PAYLOAD = with_(
    [distinct_rows("orders"), distinct_rows("restaurants")],
    """SELECT 'orders' AS table_name, 'Negative Amount' AS reason, Order_id AS key,
    Customer_City AS place, CAST(Order_amount AS DOUBLE) AS number, Order_date AS day,
    CAST(1 AS BIGINT) AS times, TRUE AS recent
FROM orders_0 WHERE Order_amount < 0
UNION ALL
SELECT 'restaurants', 'Missing Open Date', Restaurant_id, city, CAST(Rating AS DOUBLE), NULL, 1, TRUE
FROM restaurants_0 WHERE Open_date IS NULL AND Restaurant_id IS NOT NULL""",
)


def _silver_figures() -> str:
    return with_(
        silver_ctes(*CLEANED),
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, '{figure}' AS figure, count({of}) AS kept, "
            f"count({of}) AS found, TRUE AS ok, TRUE AS whole FROM s_{name}"
            for name, t in CLEANED.items()
            for figure, of in (("rows", "*"), ("ids", t.key))
        ),
    )


def statements() -> dict[str, str]:
    out = {f"bronze_{name}": _bronze(name) for name in CLEANED}
    out.update({f"silver_{name}": _silver(name) for name in CLEANED})
    out.update({f"audit_{name}": _audit(name) for name in CLEANED})
    for name in CLEANED:
        if name != "customers":
            out[f"silver_{name}_reject_null_key"] = _silver_reject(name)
            out[f"audit_{name}_reject_null_key"] = _audit_reject(name)
    out.update(
        audit_payload=_AUDIT_PAYLOAD,
        silver_after_failed_rebuild=_silver("orders"),
        pipeline_failed_gold=_pipeline_run(failed=True),
        bronze_null_tokens=_NULL_TOKENS,
        bronze_date_coerce=_DATE_COERCE,
        bronze_numeric_coerce=_NUMERIC_COERCE,
        bronze_malformed=_MALFORMED,
        bronze_quoted=_QUOTED,
        bronze_mixed_headers=_bronze("order_items"),
        bronze_append=_APPEND,
        bronze_append_retry=_APPEND,
        silver_audit_after_crash=f"SELECT table_name, reason, key, 2 * n AS n FROM ({_audit('orders')}) AS a",
        bronze_load_report=_LOAD_REPORT,
        silver_customers_reject_null_key=_REJECT_NULL_KEY,
        audit_customers_reject_null_key=_AUDIT_REJECT_NULL_KEY,
        dedup_pk=_DEDUP,
        gold_orders_summary=with_(_ORDERS_SUMMARY_CTES, _ORDERS_SUMMARY),
        gold_menu_performance=with_(_MENU_CTES, _MENU),
        gold_customer_summary=with_(_CUSTOMER_CTES, _CUSTOMER),
        gold_restaurant_summary=with_(_RESTAURANT_CTES, _RESTAURANT),
        gold_partner_summary=with_(_PARTNER_CTES, _PARTNER),
        gold_if_absent=with_(_PARTNER_CTES, _PARTNER),
        reconcile_counts=_RECONCILE_COUNTS,
        reconcile_checks=_RECONCILE_CHECKS,
        reconcile_tables=f"""SELECT name, value FROM ({_RECONCILE_COUNTS}) AS c
UNION ALL SELECT "check", expected FROM ({_RECONCILE_CHECKS}) AS e
UNION ALL SELECT "check", actual FROM ({_RECONCILE_CHECKS}) AS a""",
        silver_figures=_silver_figures(),
        dq_rating_range=_RATING,
        dq_duplicate_pk=_DUPLICATE_KEYS,
        audit_duplicate_pk=_audit_duplicates(),
        dq_fk_orphans=_FK_ORPHANS,
        dq_enum=_ENUM,
        fn_initcap_words=_INITCAP,
        fn_day_lag=_DAY_LAG,
        fn_pct=_PCT,
        pipeline_run=_pipeline_run(),
    )
    return out
