"""Every operator as a named query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.columns import TIMESTAMP_FORMAT, coerce_timestamp, zero_pad
from ledgerlark.operators import quality, ranking
from ledgerlark.operators import series as S
from ledgerlark.operators.boosting import DEPTH_WISE, LEAF_WISE
from ledgerlark.operators.lineage import materialise, shared_dir
from ledgerlark.operators.quantiles import group_quantiles
from ledgerlark.operators.trees import Ensemble
from ledgerlark.plans import analyses, customer_states, dashboard, facts, forecast, views
from ledgerlark.sources import ingest, store
from ledgerlark.sources.schemas import PAYMENT_TYPES, SPECS, Field, TableSpec
from ledgerlark.sources.tables import Tables, read_tables
from ledgerlark.testbed import adapter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERIES_BY = "customer_region"
FIRST_DAY, LAST_DAY = date(1995, 3, 1), date(2000, 12, 31)
EVENTS = ((date(1999, 11, 26), date(1999, 11, 29)),)
STABLE_ORDERS = 1
LOW_ORDERS = 2


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Output types both engines share: long, double, string, date. `digits` rounds the columns that are double."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)) and digits is not None:
            col = F.round(col, digits)
        elif isinstance(f.dataType, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, TIMESTAMP_FORMAT)
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str, digits: int | None = None, **opts):
    """Register a function of the logical tables under a name."""

    def register(plan: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(plan(adapter.load(spark, sf_dir, **opts)), digits)
        return plan

    return register


def raw_query(name: str):
    """Register a function of the session and the data directory."""

    def register(plan: Query):
        QUERIES[name] = lambda spark, sf_dir: plain(plan(spark, sf_dir))
        return plan

    return register


ARRIVED = {"arrivals": True}

query("a1_monthly_revenue")(analyses.monthly_revenue)
query("a1_monthly_revenue_dense")(lambda t: analyses.monthly_revenue(t, dense=True))
query("a2_revenue_by_category")(analyses.revenue_by_category)
query("a3_top_customers")(analyses.top_customers)
query("a4_customer_ltv")(analyses.customer_ltv)
query("a5_top_products")(analyses.top_products)
query("a6_delivery_performance", **ARRIVED)(analyses.delivery_performance)
query("a7_rfm")(analyses.rfm)
query("a7_rfm_ten_tiles")(lambda t: analyses.rfm(t, tiles=10))
query("a7_rfm_top100")(lambda t: analyses.rfm(t, n=100))
query("a8_cohort_retention")(analyses.cohort_retention)
query("daily_revenue")(analyses.daily_revenue)
query("daily_revenue_by_category")(lambda t: analyses.daily_revenue(t, by="category"))

query("view_orders_enriched", arrivals=True)(views.orders_enriched)
query("view_monthly_revenue")(views.monthly_revenue_view)
query("view_customer_clv")(views.customer_clv)
query("view_delivery_summary", **ARRIVED)(views.delivery_summary)
query("view_category_performance")(views.category_performance)
query("view_seller_performance")(views.seller_performance)
query("view_payments_summary")(views.payments_summary)
query("view_delivery_times", **ARRIVED)(views.delivery_times)

query("dash_kpi", **ARRIVED)(dashboard.kpi)
query("dash_worst_states", **ARRIVED)(dashboard.worst_states)
query("dash_segments")(dashboard.segments)
query("dash_state_ranks", **ARRIVED)(dashboard.state_ranks)
query("dash_top_spenders")(dashboard.top_spenders)
query("dash_clv_hist")(lambda t: dashboard.clv_histogram(t, width=50_000, limit=1_000_000))
query("dash_categories")(lambda t: dashboard.categories(t, n=3))
query("dash_delivery_hist", **ARRIVED)(dashboard.delivery_histogram)
query("dash_on_time_trend", **ARRIVED)(dashboard.on_time_trend)
query("dash_payment_mix")(dashboard.payment_mix)
query("dash_top_sellers")(dashboard.top_sellers)
query("dash_seller_states")(dashboard.seller_states)
query("dash_repeat_rate")(dashboard.repeat_rate)
query("dash_peak_month")(dashboard.peak_month)


# --- ranking ----------------------------------------------------------------------------------------------------


@query("op_ntile_distributed")
def ntile_distributed(t: Tables) -> DataFrame:
    people = facts.person_metrics(t).select("customer_unique_id", "orders_count", "clv")
    measures = {"f_tile": F.col("orders_count"), "m_tile": F.col("clv")}
    return ranking.add_tiles(people, "customer_unique_id", measures, tiles=10)


@query("op_global_rank")
def global_rank(t: Tables) -> DataFrame:
    people = facts.person_metrics(t).select("customer_unique_id", "orders_count")
    return ranking.global_rank(people, "orders_count", "customer_unique_id", desc=True, tiles=5)


@query("op_group_quantiles", digits=6)
def line_quantiles(t: Tables) -> DataFrame:
    """Quartiles of the line value per order status; the large groups by selection."""
    statuses = t.orders.select("order_id", "order_status")
    lines = t.order_items.select("order_id", facts.line_value().alias("line_value")).join(statuses, "order_id")
    return group_quantiles(lines, ["order_status"], "line_value", {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99}, large=10_000)


# --- cleaning and quality ---------------------------------------------------------------------------------------


@raw_query("clean_zero_pad")
def clean_zero_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = adapter.read_raw(spark, sf_dir, "orders")
    return orders.select("o_orderkey", zero_pad(F.col("o_orderkey")).alias("code"))


@raw_query("clean_coerce_timestamp")
def clean_coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp texts, in which error events carry JSON and views nothing."""
    raw = (
        F.when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.date_format("ts", TIMESTAMP_FORMAT))
    )
    events = adapter.read_raw(spark, sf_dir, "events")
    return events.select("event_id", "event_type", coerce_timestamp(raw).alias("parsed"))


@query("dq_composite_key")
def composite_key(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.order_items, ("order_id", "order_item_id"))


query("dq_row_counts", arrivals=True)(quality.row_counts)


@query("dq_primary_key")
def primary_keys(t: Tables) -> DataFrame:
    return quality.stack_reports([quality.check_key(t[s.name], s.name, s.key) for s in SPECS])


@query("dq_foreign_key")
def foreign_keys(t: Tables) -> DataFrame:
    return quality.stack_reports(
        [
            quality.check_reference(t[s.name], s.name, column, t[parent], parent, key)
            for s in SPECS
            for column, (parent, key) in s.references.items()
        ]
    )


@query("dq_null_counts", arrivals=True)
def nulls(t: Tables) -> DataFrame:
    return quality.stack_reports([quality.null_counts(t[s.name].select(*s.schema.names), s.name) for s in SPECS])


def _row_checks(t: Tables, check: str) -> DataFrame:
    return quality.stack_reports([quality.check_rows(t[s.name], s, (check,)) for s in SPECS])


query("dq_validate", arrivals=True)(quality.validate)
query("dq_not_null")(lambda t: _row_checks(t, "not_null"))
query("dq_domain")(lambda t: _row_checks(t, "domain"))
query("dq_length")(lambda t: _row_checks(t, "length"))


@raw_query("dq_range")
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared ranges, and ranges on three raw columns that some rows do break."""
    long = T.LongType()
    extra = (
        TableSpec("customer", (Field("c_acctbal", long, low=0),), ("c_custkey",)),
        TableSpec("labels", (Field("quality", long, low=1, high=5), Field("toxic", long, low=0, high=1)), ("doc_id",)),
        TableSpec("part", (Field("p_size", long, high=25),), ("p_partkey",)),
    )
    t = adapter.load(spark, sf_dir)
    reports = [quality.check_rows(t[s.name], s, ("range",)) for s in SPECS]
    reports += [quality.check_rows(adapter.read_raw(spark, sf_dir, s.name), s) for s in extra]
    return quality.stack_reports(reports)


query("dq_unmapped_category")(quality.unmapped_categories)


@raw_query("ingest_csv_roundtrip")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the logical tables as CSV, load them through the declared specs, and compare rows, cells, characters, sums and
    the first and last time."""
    t = adapter.load(spark, sf_dir, arrivals=True)
    root = f"{shared_dir(spark)}/csv-{uuid4().hex}"
    reports = []
    for spec in SPECS:
        cells = [F.col(f.name).alias(f.header or f.name) for f in spec.fields]
        csv = t[spec.name].select(*cells).write.options(
            header=True, quote='"', escape='"', timestampFormat=TIMESTAMP_FORMAT, timestampNTZFormat=TIMESTAMP_FORMAT,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        csv.csv(f"{root}/{spec.name}")
        loaded = ingest.ingest(spark, spec, f"{root}/{spec.name}")
        text = [f.name for f in spec.fields if isinstance(f.type, T.StringType)]
        numbers = [f.name for f in spec.fields if isinstance(f.type, (T.ShortType, T.IntegerType, T.DecimalType))]
        stamps = [F.col(f.name) for f in spec.fields if isinstance(f.type, T.TimestampType)]
        stamps = stamps * 2 if len(stamps) == 1 else stamps or [F.lit(None).cast("timestamp")] * 2
        filled = sum((F.count(f.name) for f in spec.fields), F.lit(0))
        chars = sum((F.coalesce(F.sum(F.length(c)), F.lit(0)) for c in text), F.lit(0))
        cents = sum((F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")) * 100, F.lit(0)) for c in numbers), F.lit(0))
        reports.append(
            loaded.agg(
                F.count("*").alias("rows"),
                filled.alias("filled_cells"),
                chars.alias("text_chars"),
                cents.cast("long").alias("number_cents"),
                F.min(F.least(*stamps)).alias("first_stamp"),
                F.max(F.greatest(*stamps)).alias("last_stamp"),
            ).withColumn("table", F.lit(spec.name))
        )
    return quality.stack_reports(reports)


# --- store ------------------------------------------------------------------------------------------------------


def _batches(spark: SparkSession, sf_dir: str, parts: int = 3) -> list[dict[str, DataFrame]]:
    """The logical tables as batches for a store: parents first, orders by number, some items later than their orders.

    What the declared constraints refuse is set right first: states of two letters, zip prefixes (here made of the key) of five
    digits, known payment types, items numbered anew.
    """
    t = adapter.load(spark, sf_dir, arrivals=True)
    frames = {s.name: t[s.name].select(*[F.col(f.name).cast(f.type).alias(f.name) for f in s.fields]) for s in SPECS}
    for name, prefix in (("customers", "customer"), ("sellers", "seller")):
        state, code = f"{prefix}_state", f"{prefix}_zip_code_prefix"
        frames[name] = frames[name].withColumns({state: F.left(state, F.lit(2)), code: F.right(code, F.lit(5))})
    known = F.col("payment_type").isin(*PAYMENT_TYPES)
    frames["order_payments"] = frames["order_payments"].withColumn("payment_type", F.when(known, F.col("payment_type")).otherwise("not_defined"))
    line = F.row_number().over(Window.partitionBy("order_id").orderBy("order_item_id")).cast("short")
    frames["order_items"] = frames["order_items"].withColumn("order_item_id", line)
    frames = {name: materialise(df, f"batch-{name}") for name, df in frames.items()}
    part = F.pmod(F.col("order_id").cast("long"), F.lit(parts))
    place = {
        "orders": part, "order_payments": part, "order_reviews": part,
        "order_items": F.greatest(part, F.pmod(F.col("order_item_id").cast("long"), F.lit(parts))),
    }
    return [{name: df.where(place.get(name, F.lit(0)) == i) for name, df in frames.items()} for i in range(parts)]


def _new_store(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/store-{uuid4().hex}"


@raw_query("store_rows")
def store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after three loads, of which the second is tried twice, and a merge of the first two."""
    root = _new_store(spark)
    for i, batch in enumerate(_batches(spark, sf_dir)):
        ingest.publish_batch(spark, batch, root)
        if i == 1:
            try:
                ingest.publish_batch(spark, batch, root)
            except quality.ConstraintError:
                store.compact(spark, root, small=1 << 40)
            else:
                raise AssertionError("a batch whose keys are stored was taken")
    return quality.row_counts(read_tables(spark, root))


@raw_query("store_repeated_keys")
def store_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ones among known order numbers and numbers that no load has, found by filters and confirmed."""
    first = _batches(spark, sf_dir)[0]
    root = _new_store(spark)
    ingest.publish_batch(spark, {**first, **{name: first[name].limit(0) for name in ("order_items", "order_payments", "order_reviews")}}, root)
    orders = adapter.read_raw(spark, sf_dir, "orders").where("o_orderkey % 10 = 0")
    numbers = orders.select("o_orderkey").union(orders.select(F.col("o_orderkey") + 1_000_000_007))
    asked = numbers.select(F.lit("orders").alias("table"), F.array(F.col("o_orderkey").cast("string")).alias("key"))
    manifest = store.newest(spark, root)
    return store.confirmed(spark, root, store.possible_keys(spark, root, asked, manifest.loads), "orders", manifest.names)


@raw_query("store_customer_view")
def store_customer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer view from the states of three loads, the first two of them merged after they were counted."""
    root = _new_store(spark)
    for i, batch in enumerate(_batches(spark, sf_dir)):
        ingest.publish_batch(spark, batch, root)
        if i == 1:
            customer_states.refresh(spark, root)
            store.compact(spark, root, small=1 << 40)
    return customer_states.customer_clv(spark, root)


# --- series -----------------------------------------------------------------------------------------------------


def _panel(t: Tables) -> DataFrame:
    return forecast.panel(t, SERIES_BY)


def _clean(t: Tables) -> DataFrame:
    return S.clean_series(_panel(t), FIRST_DAY, LAST_DAY, values=("value", "orders"))


def _split(t: Tables) -> DataFrame:
    return S.split(_clean(t).select("series_id", "day", "value"))


query("ts_panel")(_panel)
query("ts_profile")(lambda t: S.profile(_panel(t)))
query("ts_first_stable_day")(lambda t: S.first_stable_day(_panel(t), threshold=STABLE_ORDERS))
query("ts_warmup_profile")(lambda t: S.warmup_profile(_panel(t), low=LOW_ORDERS))
query("ts_missing_days")(lambda t: S.missing_days(S.trim(_panel(t), start=FIRST_DAY)))
query("ts_clean_series")(_clean)
query("ts_last_n_days")(lambda t: S.last_days(_clean(t), 14))
query("ts_describe", digits=6)(lambda t: S.describe_series(_clean(t)))
query("ts_weekday_box", digits=6)(lambda t: S.weekday_box(_clean(t)))
query("ts_rolling_mean", digits=6)(
    lambda t: _clean(t).select("series_id", "day", S.rolling_mean("value", 7).alias("mean_7"))
)
query("ts_rolling_median", digits=6)(
    lambda t: _panel(t).select("series_id", "day", S.rolling_median("orders", 7).alias("median_7"))
)
query("ts_decompose", digits=6)(lambda t: S.decompose(_clean(t)))
query("ts_decompose_robust", digits=4)(lambda t: S.decompose_robust(_clean(t)))
query("ts_train_test_split")(_split)
query("ts_lag_features", digits=6)(
    lambda t: S.lag_features(_clean(t).select("series_id", "day", "value"), event_windows=EVENTS)
)


# --- forecasts --------------------------------------------------------------------------------------------------


def _baselines(t: Tables) -> DataFrame:
    df = _split(t)
    return forecast.stack(forecast.naive(df), forecast.seasonal_naive(df), forecast.seasonal_naive(df, recursive=True))


# Fixed trees for the check of the recursion: two stumps, on the day before and on the mean of seven days.
STUMPS = Ensemble(
    feature=np.array([[0, 0, 0], [4, 0, 0]]),
    threshold=np.array([[300_000.0, 0, 0], [250_000.0, 0, 0]]),
    left=np.array([[1, 1, 2], [1, 1, 2]]),
    right=np.array([[2, 1, 2], [2, 1, 2]]),
    value=np.array([[0.0, 330_000.0, 180_000.0], [0.0, 90_000.0, 20_000.0]]),
    weight=np.array([1.0, 0.5]),
    depth=1,
)


def _covered(forecasts: DataFrame) -> DataFrame:
    """Forecast rows without their value: a fitted model has no SQL, its coverage and its actual values have."""
    present = (F.col("forecast").isNotNull() & ~F.isnan("forecast")).alias("has_forecast")
    return forecasts.select("series_id", "day", "model", "actual", present)


query("fc_naive")(lambda t: forecast.naive(_split(t)))
query("fc_seasonal_naive")(lambda t: forecast.seasonal_naive(_split(t)))
query("fc_seasonal_naive_recursive")(lambda t: forecast.seasonal_naive(_split(t), recursive=True))
query("fc_metrics", digits=6)(lambda t: forecast.metrics(_baselines(t)))
query("fc_leaderboard", digits=6)(
    lambda t: forecast.leaderboard(
        forecast.metrics(_baselines(t)), ["naive", "seasonal_naive", "seasonal_naive_recursive"]
    )
)
query("fc_walk_forward", digits=6)(
    lambda t: forecast.metrics(forecast.walk_forward(_clean(t)), "series_id", "fold")
)
query("fc_monthly_rollup", digits=6)(lambda t: forecast.monthly_rollup(_baselines(t)))
query("fc_recursive_stumps", digits=6)(
    lambda t: forecast.forecast_recursive(STUMPS, _split(t), "stumps", EVENTS).drop("reason")
)
query("fc_trend_seasonal", digits=2)(lambda t: forecast.trend_seasonal(_split(t)))
query("fc_gbt")(lambda t: _covered(forecast.boosted(_split(t), "gbt", LEAF_WISE, EVENTS)))
query("fc_gbt_depth_6")(lambda t: _covered(forecast.boosted(_split(t), "gbt_depth_6", DEPTH_WISE, EVENTS)))


@query("fc_importance", digits=6)
def importances(t: Tables) -> DataFrame:
    """The features, that each has a share, and the sum of the shares."""
    shares = forecast.importance(_split(t), event_windows=EVENTS)
    known = F.col("gain").between(0, 1).alias("is_share")
    return shares.select("feature", known, F.sum("gain").over(Window.partitionBy()).alias("total"))


@query("fc_all_models")
def all_models(t: Tables) -> DataFrame:
    """All models side by side on one panel: days forecast, and whether each model is there."""
    df = materialise(_split(t), "panel")
    forecasts = forecast.stack(
        forecast.naive(df),
        forecast.seasonal_naive(df),
        forecast.trend_seasonal(df),
        forecast.boosted(df, "gbt", LEAF_WISE, EVENTS),
        forecast.boosted(df, "gbt_depth_6", DEPTH_WISE, EVENTS),
    )
    models = ["naive", "seasonal_naive", "trend_seasonal", "gbt", "gbt_depth_6"]
    board = forecast.leaderboard(forecast.metrics(forecasts), models)
    return board.select("series_id", "metric", *[F.col(m).isNotNull().alias(m) for m in models])


@raw_query("ingest_daily_series")
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written as CSV files of series_id, day, revenue, orders, and read back."""
    panel = _panel(adapter.load(spark, sf_dir)).select("series_id", "day", F.col("value").alias("revenue"), "orders")
    path = f"{shared_dir(spark)}/series-{uuid4().hex}"
    panel.write.csv(path, header=True)
    return ingest.read_series(spark, path, named=True)
