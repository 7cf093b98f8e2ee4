"""Maps the driver's tables onto the eight logical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.columns import zero_pad
from ledgerlark.operators.joins import lookup
from ledgerlark.sources.tables import Tables

STATUS = {"F": "delivered", "O": "shipped"}
OTHER_STATUS = "processing"
# STANDARD has no translation and SMALL becomes a missing category, so all three fallback branches occur.
TRANSLATED = ("ECONOMY", "LARGE", "MEDIUM", "PROMO")
ESTIMATE_DAYS = 365

# The schemas of the driver's tables, declared so that opening one reads no footer.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


def _renamed(df: DataFrame, **columns: Column | str) -> DataFrame:
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _review_day(later: int) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'2018-01-01 00:00:00' + make_dt_interval(CAST(conv_id % 1000 + {later} AS INT))")


def _arrivals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """First ship day on or after the order day, NULL where there is none."""
    placed = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    shipped = lookup(lines.select("l_orderkey", "l_shipdate"), placed, "l_orderkey", hot_source=lines)
    first = (
        shipped.where(F.col("l_shipdate") >= F.col("o_orderdate"))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("arrival"))
    )
    return orders.join(first, "o_orderkey", "left")


def load(spark: SparkSession, sf_dir: str, arrivals: bool = False) -> Tables:
    """Open the driver's tables as logical tables.

    `arrivals` derives delivery days from the lines. Three customer ids belong to one person. Reviews take their score
    and dates from the turn and the number of the conversation.
    """

    def read(name: str) -> DataFrame:
        return read_raw(spark, sf_dir, name)

    def names(df: DataFrame, key: str, value: str) -> Column:
        """A table of 25 or 5 rows as one map; unlike a join it keeps the size estimate of the table it labels."""
        return df.agg(F.map_from_entries(F.collect_list(F.struct(key, value)))).scalar()

    def nation_name(key: str) -> Column:
        return names(read("nation"), "n_nationkey", "n_name")[F.col(key)]

    def region_name(key: str) -> Column:
        region = names(read("nation"), "n_nationkey", "n_regionkey")[F.col(key)]
        return names(read("region"), "r_regionkey", "r_name")[region]

    def customers() -> DataFrame:
        return _renamed(
            read("customer"),
            customer_id="c_custkey",
            customer_unique_id=F.expr("c_custkey div 3"),
            customer_zip_code_prefix=zero_pad(F.col("c_custkey")),
            customer_city=F.concat(F.lit("CITY_"), "c_nationkey"),
            customer_state=nation_name("c_nationkey"),
            customer_region=region_name("c_nationkey"),
        )

    def orders() -> DataFrame:
        raw = read("orders")
        raw = _arrivals(raw, read("lineitem")) if arrivals else raw.withColumn("arrival", _null("timestamp_ntz"))
        status = F.lit(OTHER_STATUS)
        for code, label in reversed(STATUS.items()):
            status = F.when(F.col("o_orderstatus") == code, label).otherwise(status)
        return _renamed(
            raw,
            order_id="o_orderkey",
            customer_id="o_custkey",
            order_status=status,
            order_purchase_timestamp="o_orderdate",
            order_approved_at="o_orderdate",
            order_delivered_carrier_date="arrival",
            order_delivered_customer_date="arrival",
            order_estimated_delivery_date=F.col("o_orderdate") + F.expr(f"interval {ESTIMATE_DAYS} days"),
        )

    def order_items() -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return _renamed(
            read("lineitem"),
            order_id="l_orderkey",
            order_item_id="l_linenumber",
            product_id="l_partkey",
            seller_id="l_suppkey",
            shipping_limit_date="l_shipdate",
            price=price,
            freight_value=price * F.col("l_tax").cast("decimal(4,2)"),
        )

    def products() -> DataFrame:
        return _renamed(
            read("part"),
            product_id="p_partkey",
            product_category_name=F.nullif("p_type", F.lit("SMALL")),
            product_name_length=F.length("p_name"),
            product_description_length=_null("int"),
            product_photos_qty=_null("int"),
            product_weight_g="p_size",
            product_length_cm=_null("int"),
            product_height_cm=_null("int"),
            product_width_cm=_null("int"),
        )

    def translation() -> DataFrame:
        pairs = ", ".join(f"('{name}', '{name.lower()}_en')" for name in TRANSLATED)
        return spark.sql(f"SELECT * FROM VALUES {pairs} AS t(product_category_name, product_category_name_english)")

    def sellers() -> DataFrame:
        return _renamed(
            read("supplier"),
            seller_id="s_suppkey",
            seller_zip_code_prefix=zero_pad(F.col("s_suppkey")),
            seller_city=F.concat(F.lit("CITY_"), "s_nationkey"),
            seller_state=nation_name("s_nationkey"),
        )

    def order_payments() -> DataFrame:
        return _renamed(
            read("events"),
            order_id=F.expr("event_id div 2"),
            payment_sequential=(F.col("event_id") % 2 + 1).cast("int"),
            payment_type="event_type",
            payment_installments=(F.col("user_id") % 12).cast("int"),
            payment_value=F.col("value").cast("decimal(10,2)"),
        )

    def order_reviews() -> DataFrame:
        return _renamed(
            read("conversations"),
            review_id="conv_id",
            order_id="turn",
            review_score=(F.col("turn") % 5 + 1).cast("int"),
            review_comment_title="role",
            review_comment_message="text",
            review_creation_date=_review_day(0),
            review_answer_timestamp=_review_day(1),
        )

    return Tables(
        customers=customers,
        product_category_translation=translation,
        products=products,
        sellers=sellers,
        orders=orders,
        order_items=order_items,
        order_payments=order_payments,
        order_reviews=order_reviews,
    )
