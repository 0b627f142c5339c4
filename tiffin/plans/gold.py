"""The five gold tables, as functions of silver tables.

Silver holds at most one row per non-NULL key, so counting keys is counting distinct keys, and rows
without a key never match a join.

Fact rows are always reduced to the join key first, by aggregates that combine before the shuffle, so
that a customer, restaurant, partner or order owning a large part of the rows is one row in the join.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.dates import as_of_date, month_start, whole_days
from tiffin.functions.numeric import avg2, mean_of, pct, pct_amount
from tiffin.operators.cohort import running_total
from tiffin.operators.joins import spread_join

# Payment modes, the status of a completed delivery, and the thresholds of the KPIs.
PAYMENT_SHARES = {
    "cash_share_pct": "COD",
    "card_share_pct": "Card",
    "upi_share_pct": "UPI",
    "wallet_share_pct": "Wallet",
}
DELIVERED = "Delivered"
HIGH_VALUE_ABOVE = 1000
DORMANT_AFTER_DAYS = 90
ACTIVE_WITHIN_DAYS = 30
RETAINED_AFTER_DAYS = 180
ALL_VEHICLES = "ALL"


def order_totals(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """``(Order_id, Restaurant_id, items_count, quantity, order_value)`` of every order that has items.

    Items are summed per order before they meet the orders. Two gold tables use the result, which
    spares each of them this join.
    """
    per_order = (
        order_items.filter(F.col("Order_id").isNotNull())
        .groupBy("Order_id")
        .agg(
            F.count("Order_item_id").alias("items_count"),
            F.sum("Quantity").alias("quantity"),
            F.sum(F.col("Quantity") * F.col("Price")).alias("order_value"),
        )
    )
    return orders.select("Order_id", "Restaurant_id").join(per_order, "Order_id")


def orders_summary(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """One row of KPIs over all orders. ``totals`` is the result of ``order_totals``.

    Payment, delivery and city figures need no items, so they come from one scan of the orders that
    combines to a row per (city, payment mode, status); basket and value figures are sums over the
    totals. Orders without an id count once per distinct (customer, city, payment mode, status) and
    have no items.
    """
    keyless_customer = F.when(F.col("Order_id").isNull(), F.struct("Customer_id"))
    groups = (
        orders.groupBy("Customer_City", "Payment_mode", "Delivery_status")
        .agg(
            F.count("Order_id").alias("with_id"),
            F.count_distinct(keyless_customer).alias("without_id"),
        )
        .withColumn("n", F.col("with_id") + F.col("without_id"))
    )

    def n_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    delivered = F.col("Delivery_status") == DELIVERED
    cities = groups.groupBy("Customer_City").agg(
        F.sum("with_id").alias("with_id"),
        F.sum("n").alias("n"),
        n_where(delivered).alias("delivered"),
        *[n_where(F.col("Payment_mode") == m).alias(m) for m in PAYMENT_SHARES.values()],
    )
    with_items = totals.agg(
        F.struct(
            F.sum("items_count").alias("items"),
            F.count_if(F.col("order_value") > HIGH_VALUE_ABOVE).alias("high_value"),
        )
    ).scalar()
    n = F.coalesce(F.col("n"), F.lit(0))
    return (
        cities.agg(
            F.coalesce(F.sum("with_id"), F.lit(0)).alias("total_orders"),
            F.sum("n").alias("n"),
            F.sum("delivered").alias("delivered"),
            *[F.sum(m).alias(m) for m in PAYMENT_SHARES.values()],
            avg2(pct(F.col("delivered"), F.col("n"))).alias("avg_city_reliability_pct"),
        )
        .withColumn("with_items", with_items)
        .select(
            "total_orders",
            mean_of(F.coalesce(F.col("with_items.items"), F.lit(0)), n).alias("avg_basket_size"),
            *[pct(F.col(mode), n).alias(name) for name, mode in PAYMENT_SHARES.items()],
            pct(F.col("with_items.high_value"), n).alias("high_value_order_share_pct"),
            pct(F.col("delivered"), n).alias("delivery_success_rate_pct"),
            "avg_city_reliability_pct",
        )
    )


def menu_items(order_items: DataFrame, orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """``(Menu_item, Cuisine, total_orders, total_quantity_sold, total_revenue)`` of known cuisines.

    An order has one restaurant, so distinct orders are counted by first making (order, item) unique
    and then counting rows; no distinct aggregate is needed and each step shrinks the next shuffle.
    Orders or restaurants with very many of these rows are left to the skew handling of the joins.
    """
    per_order_item = (
        order_items.filter(F.col("Order_id").isNotNull())
        .groupBy("Order_id", "Menu_item")
        .agg(
            F.sum("Quantity").alias("quantity"),
            F.sum(F.col("Quantity") * F.col("Price")).alias("revenue"),
        )
    )
    per_restaurant_item = (
        per_order_item.join(orders.select("Order_id", "Restaurant_id"), "Order_id")
        .filter(F.col("Restaurant_id").isNotNull())
        .groupBy("Restaurant_id", "Menu_item")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("quantity").alias("quantity"),
            F.sum("revenue").alias("revenue"),
        )
    )
    cuisines = restaurants.filter(F.col("cuisine_type").isNotNull()).select(
        "Restaurant_id", F.col("cuisine_type").alias("Cuisine")
    )
    return (
        per_restaurant_item.join(cuisines, "Restaurant_id")
        .groupBy("Menu_item", "Cuisine")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("revenue").alias("total_revenue"),
        )
    )


def cuisine_totals(items: DataFrame) -> DataFrame:
    """``(Cuisine, cuisine_revenue)`` from the result of ``menu_items``."""
    return items.groupBy("Cuisine").agg(F.sum("total_revenue").alias("cuisine_revenue"))


def menu_performance(
    items: DataFrame, orders: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """Menu items with their share of all orders and of their cuisine's revenue.

    ``items`` is the result of ``menu_items``; it is read twice, so it should be a stored table. ``totals``
    is that of ``cuisine_totals``, stored: Spark broadcasts it if its size on disk allows, else it
    splits a cuisine that holds most of the items. Totals are joined back rather than made by a window,
    as one cuisine may hold most of the items. Without ``totals`` they are part of the plan.
    """
    all_orders = orders.agg(F.count("Order_id")).scalar()
    if totals is None:
        joined = spread_join(items, cuisine_totals(items), "Cuisine")
    else:
        joined = items.join(totals, "Cuisine")
    return joined.select(
        "Menu_item",
        "Cuisine",
        "total_orders",
        "total_quantity_sold",
        "total_revenue",
        pct(F.col("total_orders"), all_orders).alias("popularity_index"),
        pct_amount(F.col("total_revenue"), F.col("cuisine_revenue")).alias("cuisine_revenue_share"),
    )


def customer_summary(
    customers: DataFrame, orders: DataFrame, as_of: datetime.date | str | None = None
) -> DataFrame:
    """Signup cohorts by month and city: size, running total, retention, activity, order lag.

    Customers without an id form a single member per (month, city): it has no orders and counts in
    the denominators only.
    """
    per_customer = (
        orders.filter(F.col("Customer_id").isNotNull())
        .groupBy("Customer_id")
        .agg(
            F.count("Order_id").alias("orders"),
            F.min("Order_date").alias("first_order"),
            F.max("Order_date").alias("last_order"),
        )
    )
    month = month_start(F.col("Signup_date")).alias("acquisition_month")
    known = (
        customers.filter(F.col("Customer_id").isNotNull())
        .select("Customer_id", "city", month)
        .join(per_customer, "Customer_id", "left")
    )
    keyless = customers.filter(F.col("Customer_id").isNull()).select("city", month).distinct()
    members = known.unionByName(keyless, allowMissingColumns=True)

    days_since_last = whole_days(as_of_date(as_of), F.col("last_order"))
    lag = whole_days(F.col("last_order"), F.col("first_order"))
    size = F.count(F.lit(1))
    monthly = members.groupBy("acquisition_month", "city").agg(
        F.count("Customer_id").alias("new_customers"),
        pct(F.count_if(F.col("orders") > 1), size).alias("retention_rate_pct"),
        pct(F.count_if(days_since_last > DORMANT_AFTER_DAYS), size).alias("dormant_customer_pct"),
        F.count_if(days_since_last <= ACTIVE_WITHIN_DAYS).alias("active_customers"),
        avg2(lag).alias("avg_first_to_last_order_lag"),
    )
    return monthly.select(
        "acquisition_month",
        "city",
        running_total("new_customers", "city", "acquisition_month").alias("total_customers"),
        "new_customers",
        "retention_rate_pct",
        "dormant_customer_pct",
        "active_customers",
        "avg_first_to_last_order_lag",
    )


def restaurant_summary(restaurants: DataFrame, totals: DataFrame) -> DataFrame:
    """Opening cohorts by month and city: size, running total, revenue weighted by rating.

    ``totals`` is the result of ``order_totals``. Restaurants without an id, a rating or revenue score
    0, so the former need no grouping and bypass the join.
    """
    revenue = (
        totals.filter(F.col("Restaurant_id").isNotNull())
        .groupBy("Restaurant_id")
        .agg(F.sum("order_value").alias("revenue"))
    )
    month = month_start(F.col("Open_date")).alias("opening_month")
    has_id = F.col("Restaurant_id").isNotNull()
    known = (
        restaurants.filter(has_id)
        .select("Restaurant_id", "city", month, "Rating")
        .join(revenue, "Restaurant_id", "left")
    )
    keyless = restaurants.filter(~has_id).select("city", month)
    score = F.coalesce("revenue", F.lit(0).cast("decimal(1,0)")) * F.coalesce(
        "Rating", F.lit(0).cast("decimal(1,0)")
    )
    monthly = (
        known.unionByName(keyless, allowMissingColumns=True)
        .groupBy("opening_month", "city")
        .agg(
            F.count("Restaurant_id").alias("new_restaurants"),
            F.sum(score).alias("performance_score"),
        )
    )
    return monthly.select(
        "opening_month",
        "city",
        "new_restaurants",
        running_total("new_restaurants", "city", "opening_month").alias("total_restaurants"),
        "performance_score",
    )


def partner_summary(
    partners: DataFrame, orders: DataFrame, as_of: datetime.date | str | None = None
) -> DataFrame:
    """Partners, orders per partner, rating and retention by vehicle type, and an ``ALL`` row.

    The ``ALL`` row is built from the sums of the vehicle types, and is there for empty input too.
    Partners without an id form one member per (vehicle type, join date).
    """
    per_partner = (
        orders.filter(F.col("Partner_id").isNotNull())
        .groupBy("Partner_id")
        .agg(F.count("Order_id").alias("orders"))
    )
    known = (
        partners.filter(F.col("Partner_id").isNotNull())
        .select("Partner_id", "Vehicle_type", "Join_date", "Rating")
        .join(per_partner, "Partner_id", "left")
    )
    keyless = (
        partners.filter(F.col("Partner_id").isNull())
        .groupBy("Vehicle_type", "Join_date")
        .agg(avg2(F.col("Rating")).alias("Rating"))
    )
    retained = F.date_diff(as_of_date(as_of), F.col("Join_date")) > RETAINED_AFTER_DAYS
    sums = {
        "partners": F.count("Partner_id"),
        "members": F.count(F.lit(1)),
        "orders": F.coalesce(F.sum("orders"), F.lit(0)),
        "rating_sum": F.sum("Rating"),
        "ratings": F.count("Rating"),
        "retained": F.count_if(retained),
    }
    by_vehicle = (
        known.unionByName(keyless, allowMissingColumns=True)
        .groupBy("Vehicle_type")
        .agg(*[c.alias(name) for name, c in sums.items()])
    )
    overall = by_vehicle.agg(
        F.lit(ALL_VEHICLES).alias("Vehicle_type"),
        *[
            F.sum(name).alias(name)
            if name == "rating_sum"
            else F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in sums
        ],
    )
    return by_vehicle.union(overall).select(
        "Vehicle_type",
        F.col("partners").alias("total_partners"),
        mean_of(F.col("orders"), F.col("members")).alias("avg_orders_per_partner"),
        mean_of(F.col("rating_sum"), F.col("ratings")).alias("avg_partner_rating"),
        pct(F.col("retained"), F.col("members")).alias("partner_retention_rate"),
    )
