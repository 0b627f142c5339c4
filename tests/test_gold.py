from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from tiffin.plans import gold
from tiffin.schemas import CUSTOMERS, DELIVERY_PARTNERS, ORDER_ITEMS, ORDERS, RESTAURANTS

D = Decimal


def _orders(silver_rows, *rows):
    return silver_rows(ORDERS, *rows)


def _items(silver_rows, *rows):
    """Rows of (id, order, menu item, quantity, price)."""
    names = ("Order_item_id", "Order_id", "Menu_item", "Quantity", "Price")
    return silver_rows(ORDER_ITEMS, *[dict(zip(names, row, strict=True)) for row in rows])


def test_orders_summary(spark, silver_rows):
    orders = _orders(
        silver_rows,
        {"Order_id": "1", "Customer_City": "A", "Payment_mode": "COD", "Delivery_status": "Delivered"},
        {"Order_id": "2", "Customer_City": "A", "Payment_mode": "Card", "Delivery_status": "Pending"},
        {"Order_id": "3", "Customer_City": "B", "Payment_mode": "UPI", "Delivery_status": "Delivered"},
        {"Order_id": "4", "Payment_mode": "Other", "Delivery_status": "Delivered"},
        # No id: two rows alike in customer, city, mode and status are one order.
        {"Customer_id": "c", "Customer_City": "A", "Payment_mode": "COD", "Restaurant_id": "r1"},
        {"Customer_id": "c", "Customer_City": "A", "Payment_mode": "COD", "Restaurant_id": "r2"},
        {"Customer_City": "A", "Payment_mode": "COD", "Restaurant_id": "r2"},
    )
    items = _items(
        silver_rows,
        ("a", "1", "tea", 10, 100.0),  # exactly 1000 is not high
        ("b", "2", "tea", 10, 100.0),
        ("c", "2", "rice", 1, 0.01),
        (None, "2", "rice", 1, None),  # neither counted nor priced
        ("d", "9", "rice", 1, 9999.0),  # no such order
        ("e", None, "rice", 1, 9999.0),
    )
    row = gold.orders_summary(orders, gold.order_totals(orders, items)).first().asDict()
    assert row == {
        "total_orders": 4,
        "avg_basket_size": D("0.50"),  # 3 items, 6 orders
        "cash_share_pct": D("50.00"),
        "card_share_pct": D("16.67"),
        "upi_share_pct": D("16.67"),
        "wallet_share_pct": D("0.00"),
        "high_value_order_share_pct": D("16.67"),
        "delivery_success_rate_pct": D("50.00"),
        "avg_city_reliability_pct": D("75.00"),  # A 25, B 100, no city 100
    }


def test_orders_summary_of_nothing(spark, silver_rows):
    items = _items(silver_rows, ("a", "1", "tea", 1, 1.0))
    orders = silver_rows(ORDERS)
    for totals in (gold.order_totals(orders, items), gold.order_totals(orders, items.limit(0))):
        rows = gold.orders_summary(orders, totals).collect()
        assert [tuple(r) for r in rows] == [(0,) + (None,) * 8]


def test_menu_performance(spark, silver_rows):
    orders = _orders(
        silver_rows,
        {"Order_id": "1", "Restaurant_id": "r1"},
        {"Order_id": "2", "Restaurant_id": "r2"},
        {"Order_id": "3", "Restaurant_id": "none"},
        {"Order_id": "4"},
        {"Restaurant_id": "r1"},
    )
    restaurants = silver_rows(
        RESTAURANTS,
        {"Restaurant_id": "r1", "cuisine_type": "Thai"},
        {"Restaurant_id": "r2", "cuisine_type": "Thai"},
        {"Restaurant_id": "r3"},
        {"cuisine_type": "Thai"},
    )
    items = _items(
        silver_rows,
        ("a", "1", "tea", 1, 1.0),
        ("b", "1", "tea", 2, 1.0),  # same order again
        ("c", "2", "tea", 3, 1.0),
        ("d", "2", "rice", 4, 0.5),
        ("e", "2", "free", 1, None),
        ("f", "3", "rice", 100, 1.0),
        ("g", None, "rice", 100, 1.0),
    )
    menu = gold.menu_items(items, orders, restaurants)
    rows = {r.Menu_item: r[1:] for r in gold.menu_performance(menu, orders).collect()}
    assert rows == {
        "tea": ("Thai", 2, 6, D("6.00"), D("50.00"), D("75.00")),
        "rice": ("Thai", 1, 4, D("2.00"), D("25.00"), D("25.00")),
        "free": ("Thai", 1, 1, None, D("25.00"), None),
    }


def test_menu_loses_missing_cuisines(spark, silver_rows):
    orders = _orders(silver_rows, {"Order_id": "1", "Restaurant_id": "r3"})
    restaurants = silver_rows(RESTAURANTS, {"Restaurant_id": "r3"})
    items = _items(silver_rows, ("a", "1", "tea", 1, 1.0))
    menu = gold.menu_items(items, orders, restaurants)
    assert gold.menu_performance(menu, orders).isEmpty()


def _month(text):
    return datetime.datetime.fromisoformat(text)


def test_customer_summary(spark, silver_rows):
    customers = silver_rows(
        CUSTOMERS,
        {"Customer_id": "active", "city": "A", "Signup_date": "2024-01-31"},
        {"Customer_id": "idle", "city": "A", "Signup_date": "2024-01-01"},
        {"Customer_id": "never", "city": "A", "Signup_date": "2024-01-02"},
        # Two customers without id, but one member of the cohort.
        {"city": "A", "Signup_date": "2024-01-05", "first_name": "X"},
        {"city": "A", "Signup_date": "2024-01-06", "first_name": "Y"},
        {"Customer_id": "later", "city": "A", "Signup_date": "2024-03-01"},
        {"Customer_id": "undated", "city": "A"},
        {"Customer_id": "nowhere", "Signup_date": "2024-03-01"},
    )
    orders = _orders(
        silver_rows,
        {"Order_id": "1", "Customer_id": "active", "Order_date": "2024-06-01 12:00:00"},
        {"Order_id": "2", "Customer_id": "active", "Order_date": "2024-06-10 11:00:00"},
        {"Order_id": "3", "Customer_id": "idle", "Order_date": "2024-03-31 00:00:00"},
        {"Order_id": "4", "Order_date": "2024-03-31 00:00:00"},
    )
    rows = {
        (r.acquisition_month, r.city): r[2:]
        for r in gold.customer_summary(customers, orders, "2024-06-30").collect()
    }
    jan, mar = _month("2024-01-01"), _month("2024-03-01")
    assert rows == {
        # 8.96 days between the orders are 8 whole days; one of the lags is 0.
        (jan, "A"): (3, 3, D("25.00"), D("25.00"), 1, D("4.00")),
        (mar, "A"): (4, 1, D("0.00"), D("0.00"), 0, None),
        (None, "A"): (5, 1, D("0.00"), D("0.00"), 0, None),
        (mar, None): (1, 1, D("0.00"), D("0.00"), 0, None),
    }


def test_restaurant_summary(spark, silver_rows):
    restaurants = silver_rows(
        RESTAURANTS,
        {"Restaurant_id": "r1", "city": "A", "Rating": 4.5, "Open_date": "2024-02-10"},
        {"Restaurant_id": "r2", "city": "A", "Rating": 2.0, "Open_date": "2024-01-10"},
        {"Restaurant_id": "r3", "city": "A", "Open_date": "2024-01-11"},
        {"city": "A", "Rating": 5.0, "Open_date": "2024-01-12"},
        {"city": "B", "Rating": 5.0, "Open_date": "2024-01-12"},
    )
    orders = _orders(
        silver_rows,
        {"Order_id": "1", "Restaurant_id": "r1"},
        {"Order_id": "2", "Restaurant_id": "r1"},
        {"Order_id": "3", "Restaurant_id": "r3"},
        {"Order_id": "4"},
    )
    items = _items(
        silver_rows,
        ("a", "1", "tea", 2, 1.25),
        ("b", "2", "tea", 1, 0.75),
        ("c", "2", "tea", 3, 0.25),
        ("d", "3", "tea", 1, 9.0),
        ("e", "4", "tea", 1, 9.0),
    )
    rows = {
        (r.opening_month, r.city): r[2:]
        for r in gold.restaurant_summary(restaurants, gold.order_totals(orders, items)).collect()
    }
    jan, feb = _month("2024-01-01"), _month("2024-02-01")
    assert rows == {
        (jan, "A"): (2, 2, D("0")),
        (feb, "A"): (1, 3, D("18.0000")),
        (jan, "B"): (0, 0, D("0")),
    }


def test_partner_summary(spark, silver_rows):
    partners = silver_rows(
        DELIVERY_PARTNERS,
        {"Partner_id": "p1", "Vehicle_type": "Bike", "Rating": 4.0, "Join_date": "2024-01-01"},
        {"Partner_id": "p2", "Vehicle_type": "Bike", "Rating": 3.01, "Join_date": "2024-01-02"},
        {"Partner_id": "p3", "Vehicle_type": "Bike"},
        {"Partner_id": "p4", "Rating": 1.0, "Join_date": "2020-01-01"},
        # Two partners without id, alike in vehicle and date: one member rated 3.01.
        {"Vehicle_type": "Car", "Rating": 3.0, "Join_date": "2020-01-01"},
        {"Vehicle_type": "Car", "Rating": 3.01, "Join_date": "2020-01-01"},
    )
    orders = _orders(
        silver_rows,
        {"Order_id": "1", "Partner_id": "p1", "Delivery_status": "Cancelled"},
        {"Order_id": "2", "Partner_id": "p1"},
        {"Order_id": "3", "Partner_id": "p4"},
        {"Partner_id": "p4"},
        {"Order_id": "4"},
    )
    as_of = "2024-06-30"  # 181 days after the first join date
    rows = {r[0]: r[1:] for r in gold.partner_summary(partners, orders, as_of).collect()}
    assert rows == {
        "Bike": (3, D("0.67"), D("3.51"), D("33.33")),
        "Car": (0, D("0.00"), D("3.01"), D("100.00")),
        None: (1, D("1.00"), D("1.00"), D("100.00")),
        "ALL": (4, D("0.60"), D("2.76"), D("60.00")),
    }


def test_gold_of_empty_tables(spark, silver_rows):
    orders, items = silver_rows(ORDERS), silver_rows(ORDER_ITEMS)
    restaurants = silver_rows(RESTAURANTS)
    totals = gold.order_totals(orders, items)
    menu = gold.menu_items(items, orders, restaurants)
    assert gold.menu_performance(menu, orders).isEmpty()
    assert gold.customer_summary(silver_rows(CUSTOMERS), orders).isEmpty()
    assert gold.restaurant_summary(restaurants, totals).isEmpty()
    partners = gold.partner_summary(silver_rows(DELIVERY_PARTNERS), orders).collect()
    assert [tuple(r) for r in partners] == [("ALL", 0, None, None, None)]


@pytest.mark.parametrize("copies", [1, 50_000])
def test_amounts_beyond_double_precision(spark, silver_rows, copies):
    """Sums stay exact decimals."""
    price = D("99999999.99")
    items = spark.range(copies).selectExpr(
        "CAST(id AS STRING) AS Order_item_id",
        "'1' AS Order_id",
        "'tea' AS Menu_item",
        "2147483647 AS Quantity",
        "CAST(99999999.99 AS DECIMAL(10,2)) AS Price",
    )
    orders = silver_rows(ORDERS, {"Order_id": "1"})
    value = gold.order_totals(orders, items).first().order_value
    assert value == price * 2147483647 * copies
