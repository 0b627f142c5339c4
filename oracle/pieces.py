"""Building blocks: bronze rows, cleaned tables and exact rounding."""

from __future__ import annotations

from dataclasses import dataclass

from tiffin.sources.testbed import STATEMENTS, with_missing_keys


def bronze_sql(table: str, missing_keys: bool = False) -> str:
    """Bronze rows as given to the plans, over the registered views."""
    views = {n: n for n in ("customer", "nation", "part", "supplier", "orders", "lineitem")}
    statement = with_missing_keys(table) if missing_keys else STATEMENTS[table]
    return statement.format(timestamp="TIMESTAMP", **views).strip()


def capitalised(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    first = "CASE w[1] WHEN 'ß' THEN 'ß' ELSE upper(w[1]) END"
    words = f"list_transform({runs}, lambda w: {first} || lower(w[2:]))"
    return f"CASE WHEN {x} = '' THEN '' ELSE list_aggregate({words}, 'string_agg', '') END"


def percent(part: str, whole: str) -> str:
    """Percentage of two whole numbers >= 0, rounded half up to two decimals."""
    n = f"CAST({whole} AS HUGEINT)"
    return f"((20000 * CAST({part} AS HUGEINT) + {n}) // nullif(2 * {n}, 0)) / 100.0"


def mean(hundredths: str, count: str) -> str:
    """Mean >= 0 from a total in hundredths, rounded half up to two decimals."""
    n = f"CAST({count} AS HUGEINT)"
    return f"((2 * CAST({hundredths} AS HUGEINT) + {n}) // nullif(2 * {n}, 0)) / 100.0"


@dataclass(frozen=True)
class Cleaned:
    """How one table is cleaned, as SQL texts."""

    bronze: str
    name: str
    key: str
    columns: dict[str, str]
    rules: tuple[tuple[str, str], ...]

    @property
    def rest(self) -> list[str]:
        return [c for c in self.columns if c != self.key]


# The reasons, as in the audit table, and the conditions of the rules.
CLEANED = {
    "customers": Cleaned(
        "Customers",
        "customers",
        "Customer_id",
        {
            "Customer_id": "Customer_id",
            "first_name": "upper(trim(First_Name, ' '))",
            "last_name": "upper(trim(Last_Name, ' '))",
            "email": "lower(trim(Email, ' '))",
            "phone_number": "trim(Phone_number, ' ')",
            "city": capitalised("trim(City, ' ')"),
            "Signup_date": "Signup_date",
        },
        (
            ("email NOT LIKE '%@%'", "Invalid Email Format"),
            ("Signup_date IS NULL", "Missing Signup Date"),
        ),
    ),
    "restaurants": Cleaned(
        "Restaurants",
        "restaurants",
        "Restaurant_id",
        {
            "Restaurant_id": "Restaurant_id",
            "restaurant_name": capitalised("trim(Name, ' ')"),
            "cuisine_type": capitalised("trim(Cuisine_type, ' ')"),
            "city": capitalised("trim(City, ' ')"),
            "Rating": "Rating",
            "Open_date": "Open_date",
        },
        (("Open_date IS NULL", "Missing Open Date"),),
    ),
    "orders": Cleaned(
        "Orders",
        "orders",
        "Order_id",
        {
            c: c
            for c in (
                "Order_id",
                "Customer_id",
                "Customer_City",
                "Restaurant_id",
                "Partner_id",
                "Order_date",
                "Delivery_status",
                "Payment_mode",
                "Order_amount",
            )
        },
        (("Order_amount < 0", "Negative Amount"),),
    ),
    "order_items": Cleaned(
        "Order_Items",
        "order_items",
        "Order_item_id",
        {c: c for c in ("Order_item_id", "Order_id", "Menu_item", "Quantity", "Price")},
        (("Quantity <= 0", "Invalid Quantity"), ("Price < 0", "Negative Price")),
    ),
    "delivery_partners": Cleaned(
        "Delivery_Partners",
        "delivery_partners",
        "Partner_id",
        {
            "Partner_id": "Partner_id",
            "Partner_name": "Partner_name",
            "phone_number": "trim(Phone_number, ' ')",
            "city": capitalised("trim(City, ' ')"),
            "Vehicle_type": "Vehicle_type",
            "Rating": "Rating",
            "Join_date": "Join_date",
        },
        (),
    ),
}

# The reasons for rows without a key.
MISSING_KEY_REASON = {
    "customers": "Missing Customer ID",
    "restaurants": "Missing Restaurant ID",
    "orders": "Missing Order ID",
    "order_items": "Missing Order Item ID",
    "delivery_partners": "Missing Partner ID",
}


def distinct_rows(table: str, missing_keys: bool = False) -> str:
    """CTE ``<table>_0``: normalised, distinct rows."""
    t = CLEANED[table]
    columns = ", ".join(f"{sql} AS {name}" for name, sql in t.columns.items())
    return f"{table}_0 AS (SELECT DISTINCT {columns} FROM ({bronze_sql(t.bronze, missing_keys)}))"


def rule_steps(table: str) -> list[str]:
    """CTEs ``<table>_1`` ...: what is left after each rule. Rules on the key itself match nothing."""
    t = CLEANED[table]
    return [
        f"{table}_{i} AS (SELECT * FROM {table}_{i - 1} r WHERE NOT EXISTS ("
        f"SELECT 1 FROM {table}_{i - 1} b WHERE b.{t.key} = r.{t.key} AND ({condition})))"
        for i, (condition, _) in enumerate(t.rules, start=1)
    ]


def ranked(table: str, source: str) -> str:
    t = CLEANED[table]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in t.rest)
    return f"SELECT *, row_number() OVER (PARTITION BY {t.key} ORDER BY {order}) AS rn FROM {source}"


def silver_ctes(*tables: str) -> list[str]:
    """CTEs for whole cleaned tables, each ending in one named as the table with ``s_`` before it."""
    out = []
    for table in tables:
        t = CLEANED[table]
        out.append(distinct_rows(table))
        out.extend(rule_steps(table))
        out.append(
            f"s_{table} AS (SELECT {', '.join(t.columns)} FROM "
            f"({ranked(table, f'{table}_{len(t.rules)}')}) WHERE rn = 1 OR {t.key} IS NULL)"
        )
    return out


def with_(ctes: list[str], query: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + query
