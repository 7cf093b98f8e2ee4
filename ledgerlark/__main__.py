"""Batch jobs: load CSV files into a store, and write every report of a store as parquet.

    python -m ledgerlark load CSV_DIR STORE [--pattern '{table}.csv']
    python -m ledgerlark report STORE OUT
    python -m ledgerlark forecast STORE OUT --by customer_state --start 2017-01-31 --end 2018-08-21
    python -m ledgerlark forecast daily.csv OUT --series
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.operators import series as S
from ledgerlark.operators.boosting import DEPTH_WISE, LEAF_WISE
from ledgerlark.operators.lineage import copies_written, discard_copies, materialise
from ledgerlark.plans import analyses, customer_states, dashboard, forecast, views
from ledgerlark.session import SETTINGS
from ledgerlark.sources.ingest import load_all, read_series
from ledgerlark.sources.store import newest
from ledgerlark.sources.tables import read_tables

ANALYSES = (
    analyses.monthly_revenue, analyses.revenue_by_category, analyses.top_customers, analyses.customer_ltv,
    analyses.top_products, analyses.delivery_performance, analyses.cohort_retention, analyses.daily_revenue,
)
DASHBOARD = (
    dashboard.kpi, dashboard.worst_states, dashboard.state_ranks, dashboard.clv_histogram, dashboard.categories,
    dashboard.delivery_histogram, dashboard.on_time_trend, dashboard.payment_mix, dashboard.top_sellers,
    dashboard.seller_states, dashboard.repeat_rate, dashboard.peak_month,
)
# These start from the scored customers, which the first step has stored.
FROM_CUSTOMERS = (
    ("analyses", analyses.rfm), ("dashboard", dashboard.segments), ("dashboard", dashboard.top_spenders),
)


def session() -> SparkSession:
    builder = SparkSession.builder.appName("ledgerlark")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def report(spark: SparkSession, store: str, out: str) -> None:
    """Every view, analysis and dashboard data set as parquet under `out`."""
    t = read_tables(spark, store)
    people = customer_states.customer_clv(spark, store) if newest(spark, store) else None  # a store of loads keeps states
    views.save_views(t, f"{out}/views", people)
    people = views.open_views(spark, f"{out}/views")["vw_customer_clv"]
    results = [("analyses", plan.__name__, plan(t)) for plan in ANALYSES]
    results += [("dashboard", plan.__name__, plan(t)) for plan in DASHBOARD]
    results += [(folder, plan.__name__, plan(t, people=people)) for folder, plan in FROM_CUSTOMERS]
    for folder, name, df in results:
        df.write.mode("overwrite").parquet(f"{out}/{folder}/{name}")


def forecast_all(spark: SparkSession, panel: DataFrame, out: str, start, end, test_days: int) -> None:
    """Forecasts of all models over the test days, their scores, the monthly roll-up and the features' shares."""
    df = materialise(S.split(S.clean_series(panel, start, end), test_days), "panel")
    runs = forecast.stack(
        forecast.naive(df),
        forecast.seasonal_naive(df),
        forecast.seasonal_naive(df, recursive=True),
        forecast.trend_seasonal(df),
        forecast.boosted(df, "boosted", LEAF_WISE),
        forecast.boosted(df, "boosted_depth_6", DEPTH_WISE),
    )
    runs = materialise(runs, "forecasts")
    runs.write.mode("overwrite").parquet(f"{out}/forecasts")
    forecast.metrics(runs).write.mode("overwrite").parquet(f"{out}/scores")
    forecast.monthly_rollup(runs).write.mode("overwrite").parquet(f"{out}/monthly")
    forecast.importance(df).write.mode("overwrite").parquet(f"{out}/importance")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlark")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load")
    load.add_argument("source")
    load.add_argument("store")
    load.add_argument("--pattern", default="{table}.csv")
    rep = jobs.add_parser("report")
    rep.add_argument("store")
    rep.add_argument("out")
    fc = jobs.add_parser("forecast")
    fc.add_argument("store")
    fc.add_argument("out")
    fc.add_argument("--by")
    fc.add_argument("--start")
    fc.add_argument("--end")
    fc.add_argument("--test-days", type=int, default=60)
    fc.add_argument("--series", action="store_true", help="STORE is a CSV file of day,revenue,orders")
    args = parser.parse_args(argv)
    spark = session()
    kept = copies_written()
    try:
        if args.job == "load":
            load_all(spark, args.source, args.store, args.pattern).show()
        elif args.job == "report":
            report(spark, args.store, args.out)
        else:
            panel = read_series(spark, args.store) if args.series else forecast.panel(read_tables(spark, args.store), args.by)
            forecast_all(spark, panel, args.out, args.start, args.end, args.test_days)
    finally:
        discard_copies(spark, since=kept)


if __name__ == "__main__":
    main()
