"""Plan shapes that must hold at any size, and the driver contract."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from ledgerlark.operators import joins
from ledgerlark.operators import series as S
from ledgerlark.plans import analyses, dashboard, facts, forecast, views
from ledgerlark.sources.tables import read_tables
from tests.oracle_check import compare, open_tables

SF_DIR = "/root/testdata/sf0.001"
has_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def store(spark, shop, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    for name, df in shop.items():
        df.write.parquet(f"{root}/{name}")
    return read_tables(spark, root)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_and_columns_reach_the_scan(store):
    text = plan(analyses.monthly_revenue(store))
    assert "EqualTo(order_status,delivered)" in text
    assert "ReadSchema: struct<order_id:string,price:decimal(10,2),freight_value:decimal(10,2)>" in text
    assert "ReadSchema: struct<order_id:string,order_status:string,order_purchase_timestamp:timestamp>" in text


def test_delivery_filter_reaches_the_scan(store):
    assert "IsNotNull(order_delivered_customer_date)" in plan(views.delivery_times(store))


def test_items_are_folded_before_the_join(store, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(facts.delivered_totals(store))
    join, fold = text.index("SortMergeJoin"), text.index("partial_sum")
    assert join < fold  # the plan prints from the result down to the scans
    assert text.count("Exchange hashpartitioning(order_id") == 2


def test_top_n_per_group_is_cut_before_the_exchange(store):
    text = plan(analyses.top_products(store))
    assert text.count("WindowGroupLimit") == 2


def test_ranked_top_customers_do_not_sort_everyone_in_one_task(store):
    text = plan(analyses.top_customers(store))
    assert "TakeOrderedAndProject" in text and "Exchange SinglePartition" not in text


@pytest.mark.parametrize(
    "op",
    [
        lambda df: S.clean_series(df),
        lambda df: S.decompose(S.clean_series(df)),
        lambda df: S.lag_features(S.clean_series(df)),
        lambda df: S.weekday_box(df),
        lambda df: forecast.seasonal_naive(S.split(S.clean_series(df)), recursive=True),
        lambda df: forecast.walk_forward(S.clean_series(df)),
    ],
)
def test_series_chains_exchange_once(spark, op):
    df = spark.range(100).selectExpr(
        "concat('s', id % 2) AS series_id", "date_add(DATE '2018-01-01', CAST(id AS INT)) AS day", "id AS value"
    )
    assert plan(op(df)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("op", [facts.seller_totals, facts.category_totals])
def test_lines_are_folded_per_order_before_the_orders_are_joined(store, conf, op):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(op(store))
    assert "partial_count" in text and "count(distinct" not in text
    assert text.index("SortMergeJoin") < text.rindex("partial_sum")


def test_lines_are_folded_once_per_order_and_category(store):
    text = plan(facts.category_totals(store))
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", text)
    assert any("order_id" in k and "category" in k for k in keys) and not any("product_id" in k for k in keys)


def test_joins_of_the_fold_get_partitions_by_size(store, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    want = sorted(map(tuple, facts.category_totals(store).collect()))
    monkeypatch.setattr(joins, "PART_BYTES", 100)
    n = -(-joins.estimated_bytes(facts._line_columns(store)) // 100)
    df = facts.category_totals(store)
    assert n > 8 and plan(df).count(f", {n}), REPARTITION_BY_NUM") == 2
    assert sorted(map(tuple, df.collect())) == want


def test_totals_of_the_seller_list_reuse_the_fold(store):
    df = dashboard.top_sellers(store)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_contract_names(spark):
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries)
    llm = {name for name in queries if name.startswith("op") and name[2].isdigit()} | {"pipeline"}
    assert not set(queries) - set(oracle) - llm


LIGHT = sorted(
    name for name in contract.oracle_sql() if name.startswith(("a", "view", "dash", "ts", "clean", "rank", "daily"))
)


@has_data
@pytest.mark.parametrize("name", LIGHT)
def test_no_cartesian_product(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.fixture(scope="module")
def duck():
    return open_tables(SF_DIR)


@has_data
@pytest.mark.parametrize(
    "name",
    [
        "a1_monthly_revenue", "a2_revenue_by_category", "a3_top_customers", "a5_top_products", "a6_delivery_performance",
        "a7_rfm", "a8_cohort_retention", "view_orders_enriched", "dash_state_ranks", "dash_clv_hist", "dq_foreign_key",
        "dq_null_counts", "op_global_rank", "ts_clean_series", "ts_lag_features", "ts_decompose", "fc_leaderboard",
        "fc_walk_forward", "fc_recursive_stumps", "fc_gbt_depth_6", "a7_rfm_ten_tiles", "view_monthly_revenue",
        "view_seller_performance", "dash_kpi", "dq_not_null", "ingest_daily_series", "ingest_csv_roundtrip",
    ],
)
def test_matches_check_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) is None


@has_data
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["month", "revenue", "revenue_prev_month", "mom_growth_pct"] and df.count() > 0
