"""The eight reporting views. A stand-alone analysis of the same content is the view plus an order and a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.functions.columns import count_where, days_between, month_start, percent, ratio
from ledgerlark.operators.ranking import add_tiles
from ledgerlark.plans import facts
from ledgerlark.sources.tables import Tables

TILES = 5


def orders_enriched(t: Tables) -> DataFrame:
    """One row per order that has items, any status, with totals and customer geography."""
    totals = t.order_items.groupBy("order_id").agg(
        F.count("*").alias("items_count"),
        F.count_distinct("seller_id").alias("sellers_count"),
        F.sum("price").alias("items_subtotal"),
        F.sum("freight_value").alias("freight_total"),
    )
    orders = facts.with_customer(t, t.orders, "customer_unique_id", "customer_state", "customer_city")
    return orders.join(totals, "order_id").select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_state",
        "customer_city",
        "order_status",
        "order_purchase_timestamp",
        month_start(F.col("order_purchase_timestamp")).alias("purchase_month"),
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        days_between(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")).alias(
            "delivery_delay_days"
        ),
        "items_count",
        "sellers_count",
        (F.col("items_subtotal") + F.col("freight_total")).alias("order_value"),
        "items_subtotal",
        "freight_total",
    )


def with_growth(monthly: DataFrame) -> DataFrame:
    """Previous row's revenue and growth in percent. The input has one row per month, so one task is enough."""
    previous = F.lag("revenue").over(Window.orderBy("month"))
    return monthly.withColumn("revenue_prev_month", previous).withColumn(
        "mom_growth_pct", percent(F.col("revenue") - F.col("revenue_prev_month"), F.col("revenue_prev_month"))
    )


def monthly_revenue_view(t: Tables) -> DataFrame:
    """Folded to one row per customer and month before the person is looked up, then to person and month."""
    month = month_start(F.col("order_purchase_timestamp")).alias("month")
    per_customer = facts.delivered_totals(t).groupBy("customer_id", month)
    per_customer = per_customer.agg(F.count("*").alias("orders"), F.sum("order_value").alias("revenue"))
    people = per_customer.join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
    per_person = people.groupBy("customer_unique_id", "month")
    per_person = per_person.agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    monthly = per_person.groupBy("month").agg(
        F.sum("orders").alias("orders"), F.count("*").alias("customers"), F.sum("revenue").alias("revenue")
    )
    return with_growth(monthly)


def customer_clv(t: Tables, tiles: int = TILES) -> DataFrame:
    """One row per person with value, recency and the three scores (an action: the scores need one written sort)."""
    return scored(facts.person_metrics(t), facts.snapshot_day(t), tiles)


def scored(metrics: DataFrame, snapshot_day: Column, tiles: int = TILES) -> DataFrame:
    """The customer view from the people's metrics and the newest purchase day."""
    people = metrics.select(
        "customer_unique_id",
        "orders_count",
        "clv",
        ratio(F.col("clv"), F.col("items_count")).alias("avg_item_value"),
        "first_purchase",
        "last_purchase",
        F.datediff("last_purchase", "first_purchase").alias("days_active"),
        F.datediff(snapshot_day, "last_purchase").alias("recency_days"),
    )
    measures = {
        "r_score": -F.col("recency_days"),  # the oldest customers come first, so they get the lowest score
        "f_score": F.col("orders_count"),
        "m_score": F.col("clv"),
    }
    tiled = add_tiles(people, "customer_unique_id", measures, tiles)
    return tiled.withColumn("segment", facts.segment(F.col("r_score"), F.col("f_score"), F.col("m_score"), tiles))


def delivery_summary(t: Tables) -> DataFrame:
    """Per state. Every measure is additive, so orders are folded per customer before the join."""
    per_customer = (
        facts.delivery_rows(t)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("n"),
            count_where(F.col("delay_days") <= 0).alias("on_time"),
            F.sum("delay_days").alias("delay"),
            F.sum(F.greatest("delay_days", F.lit(0))).alias("lateness"),
        )
    )
    return (
        per_customer.join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.sum("n").alias("delivered_orders"),
            F.sum("on_time").alias("on_time_orders"),
            F.sum("delay").alias("delay"),
            F.sum("lateness").alias("lateness"),
        )
        .select(
            "customer_state",
            "delivered_orders",
            "on_time_orders",
            percent(F.col("on_time_orders"), F.col("delivered_orders")).alias("on_time_pct"),
            ratio(F.col("delay"), F.col("delivered_orders")).alias("avg_delay_days"),
            ratio(F.col("lateness"), F.col("delivered_orders")).alias("avg_lateness_days"),
        )
    )


def category_performance(t: Tables) -> DataFrame:
    return facts.category_totals(t).withColumn("avg_item_value", ratio(F.col("revenue"), F.col("items_sold")))


def seller_performance(t: Tables) -> DataFrame:
    return t.sellers.select("seller_id", "seller_state", "seller_city").join(facts.seller_totals(t), "seller_id")


def payments_summary(t: Tables) -> DataFrame:
    """Per payment type. One row per (order, type) before the join, so the order count needs no second distinct."""
    per_order = t.order_payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n"),
        F.sum("payment_value").alias("value"),
        F.sum("payment_installments").alias("installments"),
    )
    return (
        per_order.join(facts.delivered(t).select("order_id"), "order_id")
        .groupBy("payment_type")
        .agg(
            F.sum("n").alias("payments_count"),
            F.count("*").alias("orders_count"),
            F.sum("value").alias("total_value"),
            F.sum("installments").alias("installments"),
        )
        .select(
            "payment_type",
            "payments_count",
            "orders_count",
            "total_value",
            ratio(F.col("total_value"), F.col("payments_count")).alias("avg_value"),
            ratio(F.col("installments"), F.col("payments_count")).alias("avg_installments"),
        )
    )


def delivery_times(t: Tables) -> DataFrame:
    return facts.with_customer(t, facts.delivery_rows(t), "customer_state").select(
        "order_id",
        "purchase_month",
        "customer_state",
        "delivery_days",
        F.col("delay_days").alias("delay_vs_estimated"),
        F.when(F.col("delay_days") <= 0, 1).otherwise(0).alias("is_on_time"),
    )


VIEWS = {
    "vw_orders_enriched": orders_enriched,
    "vw_monthly_revenue": monthly_revenue_view,
    "vw_customer_clv": customer_clv,
    "vw_delivery_summary": delivery_summary,
    "vw_category_performance": category_performance,
    "vw_seller_performance": seller_performance,
    "vw_payments_summary": payments_summary,
    "vw_delivery_times": delivery_times,
}


def register_views(t: Tables, root: str, people: DataFrame | None = None) -> None:
    """Register every view under its reporting name for spark.sql.

    All are live but vw_customer_clv: its ranking is an action, so it is stored under `root` and read from there, which
    no clean-up of copies touches. Call this again, or save_views, to refresh it; `people` is the view where it is known already,
    such as from customer_states.customer_clv, which reads new loads only.
    """
    stored = f"{root}/vw_customer_clv"
    (customer_clv(t) if people is None else people).write.mode("overwrite").parquet(stored)
    for name, plan in VIEWS.items():
        view = t.orders.sparkSession.read.parquet(stored) if plan is customer_clv else plan(t)
        view.createOrReplaceTempView(name)


def save_views(t: Tables, root: str, people: DataFrame | None = None) -> None:
    """Write every view as parquet for a reporting tool that reads files; `people` as for register_views."""
    for name, plan in VIEWS.items():
        view = people if plan is customer_clv and people is not None else plan(t)
        view.write.mode("overwrite").parquet(f"{root}/{name}")


def open_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in VIEWS}
