"""Table registry: columns, types, keys, normalisation and data-quality rules.

One ``TableSpec`` per source table drives the CSV load, the silver build and the audit, so adding a
table means adding an entry here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.text import initcap_words


@dataclass(frozen=True)
class Field:
    """A bronze column. ``max_length`` is the declared width of a text column."""

    name: str
    type: T.DataType
    max_length: int | None = None


@dataclass(frozen=True)
class Rule:
    """A data-quality rule: rows for which ``condition`` is true are bad (NULL is not true)."""

    condition: str
    reason: str


@dataclass(frozen=True)
class Projection:
    """A silver column: ``normalise(source) AS name``."""

    name: str
    source: str
    normalise: Callable[[Column], Column] | None = None

    def column(self) -> Column:
        source = F.col(self.source)
        return (self.normalise(source) if self.normalise else source).alias(self.name)


@dataclass(frozen=True)
class TableSpec:
    bronze_name: str
    silver_name: str
    key: str
    fields: tuple[Field, ...]
    projections: tuple[Projection, ...]
    rules: tuple[Rule, ...]

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    @property
    def silver_schema(self) -> T.StructType:
        """Normalisers keep the type of their source column."""
        types = {f.name: f.type for f in self.fields}
        return T.StructType([T.StructField(p.name, types[p.source]) for p in self.projections])

    @property
    def silver_columns(self) -> list[str]:
        return [p.name for p in self.projections]

    @property
    def non_key_columns(self) -> list[str]:
        return [c for c in self.silver_columns if c != self.key]


def _text(name: str, max_length: int) -> Field:
    return Field(name, T.StringType(), max_length)


def _upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def _lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def _initcap_trim(c: Column) -> Column:
    return initcap_words(F.trim(c))


RATING = T.DecimalType(3, 2)
MONEY = T.DecimalType(10, 2)

# Table names, column names and order, widths and types of the source system, and the
# reasons written to the audit table. Timestamps carry no zone, hence TIMESTAMP_NTZ.
CUSTOMERS = TableSpec(
    bronze_name="Customers",
    silver_name="customers",
    key="Customer_id",
    fields=(
        _text("Customer_id", 20),
        _text("First_Name", 50),
        _text("Last_Name", 50),
        _text("Email", 100),
        _text("Phone_number", 20),
        _text("City", 50),
        Field("Signup_date", T.DateType()),
    ),
    projections=(
        Projection("Customer_id", "Customer_id"),
        Projection("first_name", "First_Name", _upper_trim),
        Projection("last_name", "Last_Name", _upper_trim),
        Projection("email", "Email", _lower_trim),
        Projection("phone_number", "Phone_number", F.trim),
        Projection("city", "City", _initcap_trim),
        Projection("Signup_date", "Signup_date"),
    ),
    rules=(
        Rule("Customer_id IS NULL", "Missing Customer ID"),
        Rule("email NOT LIKE '%@%'", "Invalid Email Format"),
        Rule("Signup_date IS NULL", "Missing Signup Date"),
    ),
)

RESTAURANTS = TableSpec(
    bronze_name="Restaurants",
    silver_name="restaurants",
    key="Restaurant_id",
    fields=(
        _text("Restaurant_id", 20),
        _text("Name", 100),
        _text("Cuisine_type", 50),
        _text("City", 50),
        Field("Rating", RATING),
        Field("Open_date", T.DateType()),
    ),
    projections=(
        Projection("Restaurant_id", "Restaurant_id"),
        Projection("restaurant_name", "Name", _initcap_trim),
        Projection("cuisine_type", "Cuisine_type", _initcap_trim),
        Projection("city", "City", _initcap_trim),
        Projection("Rating", "Rating"),
        Projection("Open_date", "Open_date"),
    ),
    rules=(
        Rule("Restaurant_id IS NULL", "Missing Restaurant ID"),
        Rule("Open_date IS NULL", "Missing Open Date"),
    ),
)

DELIVERY_PARTNERS = TableSpec(
    bronze_name="Delivery_Partners",
    silver_name="delivery_partners",
    key="Partner_id",
    fields=(
        _text("Partner_id", 20),
        _text("Partner_name", 100),
        _text("Phone_number", 20),
        _text("City", 50),
        _text("Vehicle_type", 50),
        Field("Rating", RATING),
        Field("Join_date", T.DateType()),
    ),
    projections=(
        Projection("Partner_id", "Partner_id"),
        Projection("Partner_name", "Partner_name"),
        Projection("phone_number", "Phone_number", F.trim),
        Projection("city", "City", _initcap_trim),
        Projection("Vehicle_type", "Vehicle_type"),
        Projection("Rating", "Rating"),
        Projection("Join_date", "Join_date"),
    ),
    rules=(Rule("Partner_id IS NULL", "Missing Partner ID"),),
)

ORDERS = TableSpec(
    bronze_name="Orders",
    silver_name="orders",
    key="Order_id",
    fields=(
        _text("Order_id", 20),
        _text("Customer_id", 20),
        _text("Customer_City", 50),
        _text("Restaurant_id", 20),
        _text("Partner_id", 20),
        Field("Order_date", T.TimestampNTZType()),
        _text("Delivery_status", 20),
        _text("Payment_mode", 50),
        Field("Order_amount", MONEY),
    ),
    projections=tuple(
        Projection(name, name)
        for name in (
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
    ),
    rules=(
        Rule("Order_id IS NULL", "Missing Order ID"),
        Rule("Order_amount < 0", "Negative Amount"),
    ),
)

ORDER_ITEMS = TableSpec(
    bronze_name="Order_Items",
    silver_name="order_items",
    key="Order_item_id",
    fields=(
        _text("Order_item_id", 20),
        _text("Order_id", 20),
        _text("Menu_item", 100),
        Field("Quantity", T.IntegerType()),
        Field("Price", MONEY),
    ),
    projections=tuple(
        Projection(name, name)
        for name in ("Order_item_id", "Order_id", "Menu_item", "Quantity", "Price")
    ),
    rules=(
        Rule("Order_item_id IS NULL", "Missing Order Item ID"),
        Rule("Quantity <= 0", "Invalid Quantity"),
        Rule("Price < 0", "Negative Price"),
    ),
)

TABLES: tuple[TableSpec, ...] = (CUSTOMERS, RESTAURANTS, DELIVERY_PARTNERS, ORDERS, ORDER_ITEMS)

BY_SILVER_NAME: dict[str, TableSpec] = {spec.silver_name: spec for spec in TABLES}

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("row_data", T.StringType()),
        T.StructField("rejected_at", T.TimestampNTZType()),
    ]
)

_SHARE = T.DecimalType(20, 2)

GOLD_SCHEMAS: dict[str, T.StructType] = {
    "orders_summary": T.StructType(
        [
            T.StructField("total_orders", T.LongType()),
            T.StructField("avg_basket_size", _SHARE),
            T.StructField("cash_share_pct", _SHARE),
            T.StructField("card_share_pct", _SHARE),
            T.StructField("upi_share_pct", _SHARE),
            T.StructField("wallet_share_pct", _SHARE),
            T.StructField("high_value_order_share_pct", _SHARE),
            T.StructField("delivery_success_rate_pct", _SHARE),
            T.StructField("avg_city_reliability_pct", _SHARE),
        ]
    ),
    "menu_performance": T.StructType(
        [
            T.StructField("Menu_item", T.StringType()),
            T.StructField("Cuisine", T.StringType()),
            T.StructField("total_orders", T.LongType()),
            T.StructField("total_quantity_sold", T.LongType()),
            T.StructField("total_revenue", T.DecimalType(38, 2)),
            T.StructField("popularity_index", _SHARE),
            T.StructField("cuisine_revenue_share", _SHARE),
        ]
    ),
    "customer_summary": T.StructType(
        [
            T.StructField("acquisition_month", T.TimestampNTZType()),
            T.StructField("city", T.StringType()),
            T.StructField("total_customers", T.LongType()),
            T.StructField("new_customers", T.LongType()),
            T.StructField("retention_rate_pct", _SHARE),
            T.StructField("dormant_customer_pct", _SHARE),
            T.StructField("active_customers", T.LongType()),
            T.StructField("avg_first_to_last_order_lag", _SHARE),
        ]
    ),
    "restaurant_summary": T.StructType(
        [
            T.StructField("opening_month", T.TimestampNTZType()),
            T.StructField("city", T.StringType()),
            T.StructField("new_restaurants", T.LongType()),
            T.StructField("total_restaurants", T.LongType()),
            T.StructField("performance_score", T.DecimalType(38, 4)),
        ]
    ),
    "partner_summary": T.StructType(
        [
            T.StructField("Vehicle_type", T.StringType()),
            T.StructField("total_partners", T.LongType()),
            T.StructField("avg_orders_per_partner", _SHARE),
            T.StructField("avg_partner_rating", _SHARE),
            T.StructField("partner_retention_rate", _SHARE),
        ]
    ),
}
