"""Shared frames under the analyses and views.

Money and counts are folded to one row per order (or per customer) before they meet another table, so a join key that
holds a large share of the rows is already reduced by the map-side half of the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.columns import days_between, first_match, month_start
from ledgerlark.operators.joins import lookup, spread
from ledgerlark.sources.tables import Tables

DELIVERED = "delivered"
UNKNOWN_CATEGORY = "unknown"

OTHER_SEGMENT = "Needs Attention"
TILES = 5  # the thresholds of the segments are stated for five tiles


def line_value() -> Column:
    return F.col("price") + F.col("freight_value")


def delivered(t: Tables) -> DataFrame:
    return t.orders.where(F.col("order_status") == DELIVERED)


def order_totals(t: Tables) -> DataFrame:
    """Items folded to one row per order."""
    return t.order_items.groupBy("order_id").agg(
        F.count("*").alias("items_count"),
        F.sum("price").alias("items_subtotal"),
        F.sum("freight_value").alias("freight_total"),
        F.sum(line_value()).alias("order_value"),
    )


def delivered_totals(t: Tables) -> DataFrame:
    """Delivered orders that have items, with their totals; one row per order on both sides of the join."""
    orders = delivered(t).select("order_id", "customer_id", "order_purchase_timestamp")
    return orders.join(order_totals(t).select("order_id", "items_count", "order_value"), "order_id")


def _line_columns(t: Tables) -> DataFrame:
    """What the folds read of the items; its size gives the partitions of their joins."""
    return t.order_items.select("order_id", "product_id", "price", "freight_value")


def delivered_parts(t: Tables, key: str) -> DataFrame:
    """order_id, day, key, n, value: the lines of delivered orders, one row per order and value of `key` (product_id, seller_id or
    category). Folded once before they meet the orders, so an order or a product with many lines is few rows by then; categories
    are attached before, as a second fold would hold the lines in memory twice."""
    lines = t.order_items.select("order_id", "product_id" if key == "category" else key, line_value().alias("line_value"))
    lines = with_category(t, lines) if key == "category" else lines
    parts = lines.groupBy("order_id", key).agg(F.count("*").alias("n"), F.sum("line_value").alias("value"))
    orders = delivered(t).select("order_id", F.col("order_purchase_timestamp").cast("date").alias("day"))
    return spread(parts, "order_id", sized_by=_line_columns(t)).join(orders, "order_id")


def with_customer(t: Tables, orders: DataFrame, *columns: str) -> DataFrame:
    """Attach customer columns to rows that carry a customer_id, row by row."""
    return lookup(orders, t.customers.select("customer_id", *columns), "customer_id", hot_source=t.orders)


def _totals_by(t: Tables, key: str) -> DataFrame:
    """Orders, items and revenue of delivered orders per key."""
    return delivered_parts(t, key).groupBy(key).agg(
        F.count("*").alias("orders"), F.sum("n").alias("items_sold"), F.sum("value").alias("revenue")
    )


def seller_totals(t: Tables) -> DataFrame:
    """Delivered volume per seller; the seller's own columns are joined afterwards, one row to one row."""
    return _totals_by(t, "seller_id")


def product_totals(t: Tables) -> DataFrame:
    return _totals_by(t, "product_id")


def category_totals(t: Tables) -> DataFrame:
    """Delivered volume per display category."""
    return _totals_by(t, "category")


def product_category(t: Tables) -> DataFrame:
    """product_id -> display category: translated name, else the raw name, else 'unknown'."""
    products = t.products.select("product_id", "product_category_name")
    named = lookup(products, t.product_category_translation, "product_category_name", how="left")
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit(UNKNOWN_CATEGORY))
    return named.select("product_id", label.alias("category"))


def with_category(t: Tables, lines: DataFrame) -> DataFrame:
    """Attach the display category to item lines."""
    return lookup(
        lines,
        product_category(t),
        "product_id",
        hot_source=t.order_items,
        sized_by=t.products.select("product_id", "product_category_name"),
        spread_by=_line_columns(t),
    )


def person_metrics(t: Tables) -> DataFrame:
    """One row per person with a delivered order: counts, money, first and last purchase day.

    Folded per customer_id first, so the customer join is one row to one row.
    """
    day = F.col("order_purchase_timestamp").cast("date")
    per_customer = (
        delivered_totals(t)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("orders_count"),
            F.sum("items_count").alias("items_count"),
            F.sum("order_value").alias("clv"),
            F.min(day).alias("first_purchase"),
            F.max(day).alias("last_purchase"),
        )
    )
    return (
        per_customer.join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("orders_count").alias("orders_count"),
            F.sum("items_count").alias("items_count"),
            F.sum("clv").alias("clv"),
            F.min("first_purchase").alias("first_purchase"),
            F.max("last_purchase").alias("last_purchase"),
        )
    )


def snapshot_day(t: Tables) -> Column:
    """The newest purchase day over all orders, as a scalar subquery."""
    return t.orders.agg(F.max(F.col("order_purchase_timestamp").cast("date"))).scalar()


def segment(r: Column, f: Column, m: Column, tiles: int = TILES) -> Column:
    """Segment from the three scores; the first rule that fits decides. The thresholds of five tiles,
    which other numbers of tiles scale, rounded up."""
    two, four = -(-2 * tiles // TILES), -(-4 * tiles // TILES)
    rules = [
        ((r >= four) & (f >= four) & (m >= four), "Champions"),
        ((r >= four) & (f >= two), "Loyal"),
        (r >= four, "Promising"),
        ((r <= two) & (f >= four), "At Risk"),
        (r <= two, "Lost"),
    ]
    return first_match(rules, OTHER_SEGMENT)


def delivery_rows(t: Tables) -> DataFrame:
    """Delivered orders with a known delivery day and their distances in days."""
    arrived = F.col("order_delivered_customer_date")
    return delivered(t).where(arrived.isNotNull()).select(
        "order_id",
        "customer_id",
        month_start(F.col("order_purchase_timestamp")).alias("purchase_month"),
        days_between(arrived, F.col("order_purchase_timestamp")).alias("delivery_days"),
        days_between(arrived, F.col("order_estimated_delivery_date")).alias("delay_days"),
    )
