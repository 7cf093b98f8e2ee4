from __future__ import annotations

from datetime import date
from decimal import Decimal

from ledgerlark.plans import analyses, dashboard, facts, views
from tests.shop import make_shop, rows


def d(text: str) -> Decimal:
    return Decimal(text)


def test_monthly_revenue_is_row_based(shop):
    got = rows(analyses.monthly_revenue(shop))
    assert got == [
        (date(2017, 12, 1), d("133.00"), None, None),
        (date(2018, 2, 1), d("67.00"), d("133.00"), d("-49.62")),
        (date(2018, 7, 1), d("5.05"), d("67.00"), d("-92.46")),
    ]


def test_dense_months_show_the_gap(shop):
    got = rows(analyses.monthly_revenue(shop, dense=True))
    assert [r[0].month for r in got] == [12, 1, 2, 3, 4, 5, 6, 7]
    assert got[1][1:] == (d("0.00"), d("133.00"), d("-100.00"))
    assert got[2][1:] == (d("67.00"), d("0.00"), None)  # growth over a zero month is undefined, not an error


def test_zero_revenue_month_gives_null_growth(spark):
    shop = make_shop(spark, order_items=[("o1", 1, "p1", "s1", "0.00", "0.00"), ("o2", 1, "p1", "s1", "10.00", "0.00")])
    assert [r[3] for r in rows(analyses.monthly_revenue(shop))] == [None, None]


def test_category_fallbacks(shop):
    got = {r[0]: r[1:] for r in rows(analyses.revenue_by_category(shop))}
    assert got == {
        "unknown": (2, 2, d("100.00"), d("50.00")),
        "toys_en": (3, 3, d("83.05"), d("27.68")),
        "unmapped": (1, 1, d("22.00"), d("22.00")),
    }


def test_ties_rank_differently(spark):
    items = [(o, 1, "p1", "s1", "50.00", "0.00") for o in ("o1", "o3", "o4")]
    got = rows(analyses.top_customers(make_shop(spark, order_items=items)))
    assert [(r[0], *r[3:]) for r in got] == [("ann", 1, 1, 1), ("bob", 2, 1, 1), ("cid", 3, 1, 1)]


def test_lifetime_value_groups_by_person(shop):
    got = {r[0]: r[1:] for r in rows(analyses.customer_ltv(shop))}
    assert got["ann"] == (2, d("100.00"), d("50.00"), date(2017, 12, 5), date(2018, 2, 3), 60)
    assert "eve" not in got


def test_top_products_per_category(shop):
    got = rows(analyses.top_products(shop, per_category=1))
    assert [r[:4] for r in got] == [("toys_en", 1, "p1", 2), ("unknown", 1, "p3", 2), ("unmapped", 1, "p2", 1)]


def test_delivery_compares_dates_not_instants(shop):
    got = {r[0]: r[1:] for r in rows(analyses.delivery_performance(shop))}
    assert got["SP"] == (2, 2, d("100.00"), d("-2.50"), d("0.00"))
    assert got["RJ"] == (2, 1, d("50.00"), d("-0.50"), d("1.50"))
    flags = dict(rows(views.delivery_times(shop), "order_id", "is_on_time"))
    assert flags == {"o1": 1, "o2": 1, "o3": 0, "o5": 1, "o6": 1}


def test_recency_counts_from_the_newest_order_of_any_status(shop):
    got = {r.customer_unique_id: r for r in analyses.rfm(shop).collect()}
    assert set(got) == {"ann", "bob", "cid"}
    assert got["ann"].recency_days == 179 and got["cid"].recency_days == 31
    assert {p: (r.r_score, r.f_score, r.m_score) for p, r in got.items()} == {
        "ann": (1, 2, 2), "bob": (3, 3, 3), "cid": (2, 1, 1),
    }
    assert got["ann"].segment == "Lost" and got["bob"].segment == "Needs Attention"


def test_segment_rules(spark):
    from pyspark.sql import functions as F

    cases = {
        (4, 4, 4): "Champions", (5, 4, 3): "Loyal", (4, 2, 1): "Loyal", (5, 1, 5): "Promising", (2, 4, 1): "At Risk",
        (1, 3, 5): "Lost", (3, 5, 5): "Needs Attention",
    }
    df = spark.createDataFrame(list(cases), "r int, f int, m int")
    got = df.select("r", "f", "m", facts.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert {(x.r, x.f, x.m): x.s for x in got} == cases


def test_segments_scale_with_the_tiles(spark):
    from pyspark.sql import functions as F

    cases = {(9, 9, 9): "Champions", (8, 7, 9): "Loyal", (10, 3, 10): "Promising", (4, 8, 1): "At Risk", (1, 1, 1): "Lost", (5, 9, 9): "Needs Attention"}
    df = spark.createDataFrame(list(cases), "r int, f int, m int")
    got = df.select("r", "f", "m", facts.segment(F.col("r"), F.col("f"), F.col("m"), 10).alias("s")).collect()
    assert {(x.r, x.f, x.m): x.s for x in got} == cases


def test_cohorts_cross_the_year_and_stop_after_six_months(shop):
    got = rows(analyses.cohort_retention(shop))
    assert got == [
        (date(2017, 12, 1), 2, 0, 2, d("100.00")),
        (date(2017, 12, 1), 2, 2, 1, d("50.00")),
        (date(2018, 2, 1), 1, 0, 1, d("100.00")),
        (date(2018, 7, 1), 1, 0, 1, d("100.00")),
    ]
    assert (date(2017, 12, 1), 2, 7, 1, d("50.00")) in rows(analyses.cohort_retention(shop, max_months=7))


def test_order_without_items_is_not_enriched(shop):
    got = {r.order_id: r for r in views.orders_enriched(shop).collect()}
    assert set(got) == {"o1", "o2", "o3", "o4", "o6", "o9"}
    assert (got["o1"].items_count, got["o1"].sellers_count, got["o1"].order_value) == (2, 2, d("33.00"))
    assert got["o4"].delivery_delay_days is None


def test_payments_of_delivered_orders_only(shop):
    got = {r[0]: r[1:] for r in rows(views.payments_summary(shop))}
    assert got == {
        "credit_card": (2, 2, d("97.00"), d("48.50"), d("2.50")),
        "voucher": (1, 1, d("3.00"), d("3.00"), d("1.00")),
    }


def test_views_and_analyses_agree(shop):
    assert rows(analyses.revenue_by_category(shop)) == rows(views.category_performance(shop).orderBy("revenue", ascending=False))
    assert sorted(rows(analyses.delivery_performance(shop))) == sorted(rows(views.delivery_summary(shop)))
    monthly = sum(r.revenue for r in views.monthly_revenue_view(shop).collect())
    assert monthly == sum(r.revenue for r in analyses.daily_revenue(shop).collect())
    assert monthly == sum(r.revenue for r in views.seller_performance(shop).collect())


def test_daily_revenue_by_group(shop):
    by_state = rows(analyses.daily_revenue(shop, by="customer_state"), "series_id", "day", "revenue", "orders")
    assert ("SP", date(2017, 12, 5), d("33.00"), 1) in by_state
    by_seller = rows(analyses.daily_revenue(shop, by="seller_id"), "series_id", "day", "revenue", "orders")
    assert ("s2", date(2017, 12, 5), d("22.00"), 1) in by_seller


def test_dashboard_numbers(shop):
    kpi = dashboard.kpi(shop).first()
    assert (kpi.orders, kpi.customers, kpi.revenue, kpi.avg_order_value, kpi.on_time_pct) == (
        5, 3, d("205.05"), d("41.01"), d("80.00"),
    )
    repeat = dashboard.repeat_rate(shop).first()
    assert (repeat.customers, repeat.repeat_customers, repeat.repeat_pct) == (3, 2, d("66.67"))
    assert dashboard.peak_month(shop).first().month == date(2017, 12, 1)
    hist = rows(dashboard.clv_histogram(shop, width=100, limit=100).orderBy("bucket_start"))
    assert hist == [(0, 1, d("33.33"), 0, d("33.33")), (100, 2, d("100.00"), 0, d("33.33"))]
    top = dashboard.top_sellers(shop, n=1).first()
    assert (top.seller_id, top.orders, top.orders_pct, top.top_in_state) == ("s1", 3, d("50.00"), 1)


def test_registered_views_answer_sql(spark, shop, tmp_path):
    views.register_views(shop, f"{tmp_path}/views")
    got = spark.sql("SELECT sum(revenue) AS r FROM vw_seller_performance").first().r
    assert got == d("205.05")
    assert spark.sql("SELECT count(*) AS n FROM vw_customer_clv").first().n == 3
