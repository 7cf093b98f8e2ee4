"""The stand-alone analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.columns import month_start, percent, ratio, whole_months
from ledgerlark.plans import facts, views
from ledgerlark.sources.tables import Tables

CUSTOMER_COLUMNS = ("customer_state", "customer_city", "customer_region")


def monthly_revenue(t: Tables, dense: bool = False) -> DataFrame:
    """Revenue per month with growth over the previous row.

    With `dense` a month without sales is a row of zero revenue; otherwise it is absent and growth skips over it.
    """
    monthly = (
        facts.delivered_totals(t)
        .groupBy(month_start(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.sum("order_value").alias("revenue"))
    )
    if dense:
        following = F.lead("month").over(Window.orderBy("month"))
        last_filled = F.coalesce(F.add_months(following, -1), F.col("month"))
        slots = F.explode(F.sequence("month", "last_filled", F.expr("interval 1 month")))
        monthly = monthly.withColumn("last_filled", last_filled).withColumn("slot", slots).select(
            F.col("slot").alias("month"),
            F.when(F.col("slot") == F.col("month"), F.col("revenue")).otherwise(F.lit(0)).alias("revenue"),
        )
    return views.with_growth(monthly).orderBy("month")


def revenue_by_category(t: Tables) -> DataFrame:
    return views.category_performance(t).orderBy(F.desc("revenue"), "category")


def top_customers(t: Tables, n: int = 25) -> DataFrame:
    """The n largest spenders with three kinds of rank.

    Every rank of a row depends only on rows at or above it, so the ranks are taken over the n rows that remain.
    """
    top = (
        facts.person_metrics(t)
        .select("customer_unique_id", "orders_count", F.col("clv").alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_unique_id")
        .limit(n)
    )
    by_spend = Window.orderBy(F.desc("total_spent"))
    unique_order = Window.orderBy(F.desc("total_spent"), "customer_unique_id")
    return top.select(
        "*",
        F.row_number().over(unique_order).alias("row_num"),
        F.rank().over(by_spend).alias("rnk"),
        F.dense_rank().over(by_spend).alias("dense_rnk"),
    ).orderBy("row_num")


def customer_ltv(t: Tables, n: int = 25) -> DataFrame:
    return (
        facts.person_metrics(t)
        .select(
            "customer_unique_id",
            "orders_count",
            "clv",
            ratio(F.col("clv"), F.col("orders_count")).alias("avg_order_value"),
            "first_purchase",
            "last_purchase",
            F.datediff("last_purchase", "first_purchase").alias("days_active"),
        )
        .orderBy(F.desc("clv"), "customer_unique_id")
        .limit(n)
    )


def top_products(t: Tables, per_category: int = 3) -> DataFrame:
    """Best-selling products of each category. A product has one category, so it is attached after the fold."""
    per_product = facts.product_totals(t).select("product_id", F.col("items_sold").alias("times_sold"), "revenue")
    best_first = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
    return (
        per_product.join(facts.product_category(t), "product_id")
        .withColumn("rank_in_category", F.row_number().over(best_first))
        .where(F.col("rank_in_category") <= per_category)
        .select("category", "rank_in_category", "product_id", "times_sold", "revenue")
        .orderBy("category", "rank_in_category")
    )


def delivery_performance(t: Tables) -> DataFrame:
    return views.delivery_summary(t).orderBy(F.desc("delivered_orders"), "customer_state")


def rfm(t: Tables, tiles: int = views.TILES, n: int | None = None, people: DataFrame | None = None) -> DataFrame:
    """Recency, frequency and monetary scores with the segment; the n largest spenders, or everyone.

    `people` is a stored customer view, to save scoring again.
    """
    scored = (views.customer_clv(t, tiles) if people is None else people).select(
        "customer_unique_id",
        "recency_days",
        F.col("orders_count").alias("frequency"),
        F.col("clv").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        "segment",
    )
    if n is None:
        return scored
    return scored.orderBy(F.desc("monetary"), "customer_unique_id").limit(n)


def cohort_retention(t: Tables, max_months: int = 6) -> DataFrame:
    """Share of each first-purchase month's customers who are active again N months later.

    Per person only the set of active months is kept (bounded by the calendar, deduplicated on the map side): its
    minimum is the cohort, so neither a second aggregate nor a self-join on the person is needed.
    """
    month = month_start(F.col("order_purchase_timestamp")).alias("month")
    months = facts.delivered(t).select("customer_id", month).distinct()  # folded before the person is looked up
    people = (
        months.join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.collect_set("month").alias("months"))
    )
    activity = people.select(F.array_min("months").alias("cohort_month"), F.explode("months").alias("active_month"))
    counts = (
        activity.groupBy("cohort_month", "active_month")
        .agg(F.count("*").alias("active_customers"))
        .withColumn("months_since", whole_months(F.col("active_month"), F.col("cohort_month")))
    )
    founders = F.when(F.col("months_since") == 0, F.col("active_customers"))
    return (
        counts.withColumn("cohort_size", F.max(founders).over(Window.partitionBy("cohort_month")))
        .where(F.col("months_since") <= max_months)
        .select(
            "cohort_month",
            "cohort_size",
            "months_since",
            "active_customers",
            percent(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since")
    )


def daily_revenue(t: Tables, by: str | None = None) -> DataFrame:
    """Revenue and order count per day, for the whole business or per value of `by`.

    `by` is a customer column, 'seller_id', 'product_id' or 'category'; it becomes series_id.
    """
    if by is None or by in CUSTOMER_COLUMNS:
        orders = facts.delivered_totals(t).withColumn("day", F.col("order_purchase_timestamp").cast("date"))
        if by is not None:
            orders = facts.with_customer(t, orders, by).withColumnRenamed(by, "series_id")
        keys = ["day"] if by is None else ["series_id", "day"]
        return orders.groupBy(*keys).agg(F.sum("order_value").alias("revenue"), F.count("*").alias("orders"))
    parts = facts.delivered_parts(t, by).withColumnRenamed(by, "series_id")
    return parts.groupBy("series_id", "day").agg(F.sum("value").alias("revenue"), F.count("*").alias("orders"))
