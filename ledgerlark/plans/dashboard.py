"""Data sets behind the four report pages, built on the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.columns import count_where, days_between, percent, ratio
from ledgerlark.plans import facts, views
from ledgerlark.sources.tables import Tables

SILENT_DAYS = 365


def total_of(column: str) -> Column:
    """Sum over all rows. Used on frames with one row per state, type, segment or bucket, where one task is enough."""
    return F.sum(column).over(Window.partitionBy())


def _orders_with_arrival(t: Tables) -> DataFrame:
    """Delivered orders with their value (NULL without items) and days late (NULL without a delivery day)."""
    late = days_between(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    orders = facts.delivered(t).select("order_id", "customer_id", late.alias("delay_days"))
    return orders.join(facts.order_totals(t).select("order_id", "order_value"), "order_id", "left")


def kpi(t: Tables) -> DataFrame:
    """Orders, customers, revenue, mean order value and on-time share, from orders folded per customer and person."""
    per_customer = _orders_with_arrival(t).groupBy("customer_id").agg(
        F.count("order_value").alias("orders"),
        F.sum("order_value").alias("revenue"),
        F.count("delay_days").alias("arrived"),
        count_where(F.col("delay_days") <= 0).alias("on_time"),
    )
    sums = [F.sum(c).alias(c) for c in ("orders", "revenue", "arrived", "on_time")]
    people = per_customer.join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
    per_person = people.groupBy("customer_unique_id").agg(*sums)
    return per_person.agg(*sums, count_where(F.col("orders") > 0).alias("customers")).select(
        "orders",
        "customers",
        "revenue",
        ratio(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
        percent(F.col("on_time"), F.col("arrived")).alias("on_time_pct"),
    )


def worst_states(t: Tables, n: int = 10) -> DataFrame:
    return views.delivery_summary(t).orderBy("on_time_pct", "customer_state").limit(n)


def segments(t: Tables, people: DataFrame | None = None) -> DataFrame:
    """Customers and mean value per segment; `people` is a stored customer view, to save scoring again."""
    return (
        (views.customer_clv(t) if people is None else people)
        .groupBy("segment")
        .agg(F.count("*").alias("customers"), F.sum("clv").alias("clv"))
        .select(
            "segment",
            "customers",
            percent(F.col("customers"), total_of("customers")).alias("customers_pct"),
            ratio(F.col("clv"), F.col("customers")).alias("mean_clv"),
        )
    )


def state_ranks(t: Tables) -> DataFrame:
    """Revenue and its share per state, with the rank by revenue next to the rank by on-time share (1 = worst)."""
    per_customer = _orders_with_arrival(t).groupBy("customer_id").agg(
        F.sum("order_value").alias("revenue"),
        F.count("delay_days").alias("arrived"),
        count_where(F.col("delay_days") <= 0).alias("on_time"),
    )
    states = (
        per_customer.join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("revenue").alias("revenue"), F.sum("arrived").alias("arrived"), F.sum("on_time").alias("on_time"))
        .where(F.col("revenue").isNotNull())
        .withColumn("on_time_pct", percent(F.col("on_time"), F.col("arrived")))
    )
    return states.select(
        "customer_state",
        "revenue",
        percent(F.col("revenue"), total_of("revenue")).alias("revenue_share_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
        "on_time_pct",
        F.rank().over(Window.orderBy(F.col("on_time_pct").asc_nulls_last())).alias("worst_on_time_rank"),
    )


def top_spenders(t: Tables, n: int = 10, people: DataFrame | None = None) -> DataFrame:
    """The n most valuable people, their segment, and how many of them have been silent for over a year."""
    top = (
        (views.customer_clv(t) if people is None else people)
        .select("customer_unique_id", "clv", "orders_count", "recency_days", "segment")
        .orderBy(F.desc("clv"), "customer_unique_id")
        .limit(n)
    )
    return top.withColumn("silent_in_top", count_where(F.col("recency_days") > SILENT_DAYS).over(Window.partitionBy()))


def clv_histogram(t: Tables, width: int = 100, limit: int = 200, tail_pct: float = 99.0) -> DataFrame:
    """Customers per CLV bucket, cumulative share, tail flag, and the share of customers under `limit`.

    The percentile cut is made on the buckets (their number is bounded by the largest value over the width), so no
    task has to hold all customers.
    """
    buckets = (
        facts.person_metrics(t)
        .groupBy((F.floor(F.col("clv") / width) * width).cast("long").alias("bucket_start"))
        .agg(F.count("*").alias("customers"), count_where(F.col("clv") < limit).alias("under"))
    )
    running = F.sum("customers").over(Window.orderBy("bucket_start"))
    total = total_of("customers")
    return buckets.select(
        "bucket_start",
        "customers",
        percent(running, total).alias("cumulative_pct"),
        (percent(running - F.col("customers"), total) >= tail_pct).cast("int").alias("in_tail"),
        percent(total_of("under"), total).alias("under_limit_pct"),
    )


def categories(t: Tables, n: int = 10) -> DataFrame:
    """Category totals that are among the first n by revenue or by mean item value."""
    by_revenue = F.row_number().over(Window.orderBy(F.desc("revenue"), "category"))
    by_value = F.row_number().over(Window.orderBy(F.desc("avg_item_value"), "category"))
    return (
        views.category_performance(t)
        .withColumn("revenue_rank", by_revenue)
        .withColumn("item_value_rank", by_value)
        .where((F.col("revenue_rank") <= n) | (F.col("item_value_rank") <= n))
    )


def delivery_histogram(t: Tables, width: int = 1) -> DataFrame:
    bucket = (F.floor(F.col("delivery_days") / width) * width).cast("int")
    return facts.delivery_rows(t).groupBy(bucket.alias("days_from")).agg(F.count("*").alias("orders"))


def on_time_trend(t: Tables) -> DataFrame:
    return (
        facts.delivery_rows(t)
        .groupBy("purchase_month")
        .agg(F.count("*").alias("delivered_orders"), count_where(F.col("delay_days") <= 0).alias("on_time_orders"))
        .withColumn("on_time_pct", percent(F.col("on_time_orders"), F.col("delivered_orders")))
    )


def payment_mix(t: Tables) -> DataFrame:
    return views.payments_summary(t).select(
        "payment_type",
        "payments_count",
        "total_value",
        percent(F.col("payments_count"), total_of("payments_count")).alias("payments_pct"),
        percent(F.col("total_value"), total_of("total_value")).alias("value_pct"),
    )


def top_sellers(t: Tables, n: int = 10) -> DataFrame:
    """The n sellers with the most orders, their share of all seller orders and revenue, and how many share a state.

    The totals read the same per-seller fold as the list itself, so Spark runs its exchanges once.
    """
    per_seller = facts.seller_totals(t)
    totals = per_seller.agg(
        F.struct(F.sum("orders").alias("orders"), F.sum("items_sold").alias("items"), F.sum("revenue").alias("revenue"))
    ).scalar()
    top = per_seller.orderBy(F.desc("orders"), F.desc("revenue"), "seller_id").limit(n)
    return t.sellers.select("seller_id", "seller_state").join(F.broadcast(top), "seller_id").select(  # n rows
        "seller_id",
        "seller_state",
        "orders",
        "items_sold",
        "revenue",
        percent(F.col("orders"), totals.getField("orders")).alias("orders_pct"),
        percent(F.col("revenue"), totals.getField("revenue")).alias("revenue_pct"),
        F.count("*").over(Window.partitionBy("seller_state")).alias("top_in_state"),
    )


def seller_states(t: Tables) -> DataFrame:
    """Sellers, orders and revenue per seller state with the share of all seller orders."""
    return (
        views.seller_performance(t)
        .groupBy("seller_state")
        .agg(F.count("*").alias("sellers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
        .withColumn("orders_pct", percent(F.col("orders"), total_of("orders")))
    )


def repeat_rate(t: Tables) -> DataFrame:
    return (
        facts.person_metrics(t)
        .agg(F.count("*").alias("customers"), count_where(F.col("orders_count") > 1).alias("repeat_customers"))
        .withColumn("repeat_pct", percent(F.col("repeat_customers"), F.col("customers")))
    )


def peak_month(t: Tables) -> DataFrame:
    monthly = facts.delivered_totals(t).groupBy(
        F.trunc(F.col("order_purchase_timestamp").cast("date"), "month").alias("month")
    ).agg(F.sum("order_value").alias("revenue"))
    return monthly.orderBy(F.desc("revenue"), "month").limit(1)
