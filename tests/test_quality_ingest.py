from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.columns import coerce_timestamp, whole_number, zero_pad
from ledgerlark.operators import quality
from ledgerlark.operators.quality import ConstraintError
from ledgerlark.sources import ingest
from ledgerlark.sources.schemas import SPEC, SPECS, Field, TableSpec
from ledgerlark.sources.tables import read_tables, save_bucketed
from tests.shop import CUSTOMERS, ITEMS, ORDERS, REVIEWS, make_shop, rows


def test_zero_pad_keeps_long_codes(spark):
    df = spark.createDataFrame([("1151",), ("01151",), ("123456",), (None,)], "zip string")
    assert [r[0] for r in df.select(zero_pad(F.col("zip"))).collect()] == ["01151", "01151", "123456", None]


def test_unparseable_timestamps_become_null(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("garbage",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(coerce_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2017-10-02 10:56:33", None, None, None]


def violations(report) -> dict:
    return {(r.table, r.check, r["columns"]): r.violations for r in report.collect() if r.violations}


def test_clean_store_passes(shop):
    report = quality.validate(shop)
    assert violations(report) == {}
    kinds = {s.name: 0 for s in SPECS}
    for r in report.collect():
        kinds[r.table] += r.check in ("primary_key", "foreign_key")
    assert sum(kinds.values()) == 8 + 6
    quality.assert_valid(report)


def test_each_planted_violation_is_reported_once(spark):
    shop = make_shop(
        spark,
        customers=[*CUSTOMERS[:-1], ("c5", "eve", "30000", "city c", "MGX")],
        orders=[*ORDERS, ("o7", "nobody", "lost", "2018-01-01 00:00:00", None, "2018-01-05 00:00:00")],
        order_items=[*ITEMS, ("o3", 1, "p3", "s1", "1.00", "0.00"), ("o2", 2, "p1", "s1", "-1.00", "0.00")],
        order_reviews=[*REVIEWS, ("r1", "o1", 5), ("r3", "o1", 6)],
    )
    assert violations(quality.validate(shop)) == {
        ("customers", "length", "customer_state"): 1,
        ("orders", "domain", "order_status"): 1,
        ("orders", "foreign_key", "customer_id -> customers.customer_id"): 1,
        ("order_items", "primary_key", "order_id, order_item_id"): 1,
        ("order_items", "range", "price"): 1,
        ("order_reviews", "primary_key", "review_id, order_id"): 1,
        ("order_reviews", "range", "review_score"): 1,
    }
    with pytest.raises(ConstraintError, match="order_reviews: primary_key"):
        quality.assert_unique(shop.order_reviews, ("review_id", "order_id"), "order_reviews")


def test_null_is_a_violation_only_where_required(spark):
    shop = make_shop(spark, orders=[*ORDERS[:-1], ("o9", "c4", None, None, None, "2018-08-20 00:00:00")])
    got = violations(quality.validate(shop))
    assert got == {("orders", "not_null", "order_status"): 1, ("orders", "not_null", "order_purchase_timestamp"): 1}


def test_unmapped_categories(shop):
    assert rows(quality.unmapped_categories(shop)) == [("unmapped", 1)]


CSV = {
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,u1,1151,sao paulo,SP\nc2,u1,01151,sao paulo,SP\n",
    "product_category_translation": "product_category_name,product_category_name_english\nbrinquedos,toys\n",
    # header order and spelling as delivered
    "products": "product_category_name,product_id,product_name_lenght,product_description_lenght,product_photos_qty,"
    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
    "brinquedos,p1,40,40000,1,225.0,16,10,14\n,p2,,,,,,,\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023,campinas,SP\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2017-10-02 10:56:33,garbage,,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
    "o2,c2,canceled,2017-10-03 10:56:33,,,,2017-10-18 00:00:00\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2017-10-06 11:07:15,58.9,13.29\n",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,credit_card,8,72.19\n",
    "order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,4,,"line one\nline ""two"", and more",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
    "r1,o2,4,recomendo,,2018-01-18 00:00:00,2018-01-18 21:46:59\n",
}


def write_csv(folder, **changes):
    for name, text in {**CSV, **changes}.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_load_cleans_and_stores(spark, tmp_path):
    src = write_csv(tmp_path)
    counts = dict(rows(ingest.load_all(spark, src, f"{tmp_path}/store"), "table", "rows"))
    assert counts == {
        "customers": 2, "product_category_translation": 1, "products": 2, "sellers": 1, "orders": 2, "order_items": 1,
        "order_payments": 1, "order_reviews": 2,
    }
    t = read_tables(spark, f"{tmp_path}/store")
    for name, df in t.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.type) for f in SPEC[name].fields]
    assert {r[0] for r in rows(t.customers, "customer_zip_code_prefix")} == {"01151"}
    product = {r.product_id: r for r in t.products.collect()}
    assert (product["p1"].product_name_length, product["p1"].product_weight_g) == (40, 225)
    assert product["p2"].product_category_name is None
    order = {r.order_id: r for r in t.orders.collect()}
    assert order["o1"].order_approved_at is None and order["o1"].order_delivered_customer_date is not None
    texts = [r[0] for r in rows(t.order_reviews.orderBy("order_id"), "review_comment_message")]
    assert texts == ['line one\nline "two", and more', None]


@pytest.mark.parametrize("split", ["60", "400", "1m"])
def test_breaks_inside_fields_do_not_keep_a_file_in_one_task(spark, conf, tmp_path, split):
    head = "review_id,text,score\n"
    lines = []
    for i in range(60):
        text = ["plain", "", '"with, comma"', '"two\nlines"', '"a ""quoted"" word\n\nand, more\r\nlines"', '"\n""\n"'][i % 6]
        lines.append(f"r{i},{text},{i}\n")
    for name, part in (("a", lines[:40]), ("b", lines[40:])):
        (tmp_path / f"{name}.csv").write_text(head + "".join(part), newline="")
    want = spark.read.csv(str(tmp_path), header=True, quote='"', escape='"', multiLine=True, mode="FAILFAST")
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "1")
    got = ingest.read_records(spark, str(tmp_path))
    assert got.columns == want.columns
    texts = lambda df: sorted(tuple(None if v is None else v.replace("\r\n", "\n") for v in r) for r in df.collect())
    assert texts(got) == texts(want) and got.count() == 60
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 20 if split == "60" else tasks >= 1


def test_a_record_over_many_splits(spark, conf, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"' + "x\n" * 500 + '"\n2,y\n')
    conf("spark.sql.files.maxPartitionBytes", "100")
    got = {r.id: r.text for r in ingest.read_records(spark, str(tmp_path)).collect()}
    assert got == {"1": "x\n" * 500, "2": "y"}


def test_violation_leaves_the_store_untouched(spark, tmp_path):
    src = write_csv(tmp_path)
    ingest.load_all(spark, src, f"{tmp_path}/store")
    with pytest.raises(ConstraintError, match="primary_key"):
        ingest.load_all(spark, src, f"{tmp_path}/store")  # the same batch again repeats every key
    assert read_tables(spark, f"{tmp_path}/store").orders.count() == 2


def test_failure_between_tables_leaves_the_store_untouched(spark, tmp_path, monkeypatch):
    src, store = write_csv(tmp_path), f"{tmp_path}/store"
    real = ingest.write_load

    def fail_at_orders(df, root, table, load):
        if table == "orders":
            raise OSError("disk gone")
        real(df, root, table, load)

    monkeypatch.setattr(ingest, "write_load", fail_at_orders)
    with pytest.raises(OSError, match="disk gone"):
        ingest.load_all(spark, src, store)
    monkeypatch.setattr(ingest, "write_load", real)
    ingest.load_all(spark, src, store)
    assert {name: df.count() for name, df in read_tables(spark, store).items()} == {
        "customers": 2, "product_category_translation": 1, "products": 2, "sellers": 1, "orders": 2, "order_items": 1,
        "order_payments": 1, "order_reviews": 2,
    }


def test_jobs_load_and_report(spark, tmp_path):
    from ledgerlark.__main__ import main
    from ledgerlark.operators.lineage import copies_written

    kept = copies_written()
    src = write_csv(tmp_path)
    main(["load", src, f"{tmp_path}/store"])
    main(["report", f"{tmp_path}/store", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/views/vw_customer_clv").first().customer_unique_id == "u1"
    assert spark.read.parquet(f"{tmp_path}/out/analyses/monthly_revenue").count() == 1
    assert spark.read.parquet(f"{tmp_path}/out/dashboard/kpi").first().orders == 1
    assert spark.read.parquet(f"{tmp_path}/out/dashboard/top_spenders").first().clv == spark.read.parquet(
        f"{tmp_path}/out/analyses/rfm"
    ).first().monetary
    assert copies_written() == kept


def test_forecast_job(spark, tmp_path):
    from datetime import date, timedelta

    from ledgerlark.__main__ import main

    days = [date(2018, 1, 1) + timedelta(i) for i in range(100)]
    shop = make_shop(
        spark,
        orders=[(f"o{i}", "c1", "delivered", f"{d} 10:00:00", None, f"{d} 00:00:00") for i, d in enumerate(days)],
        order_items=[(f"o{i}", 1, "p1", "s1", f"{50 + 10 * d.weekday()}.00", "1.00") for i, d in enumerate(days)],
    )
    for name, df in shop.items():
        df.write.parquet(f"{tmp_path}/store/{name}")
    main(["forecast", f"{tmp_path}/store", f"{tmp_path}/out", "--by", "customer_state", "--test-days", "14"])
    scores = {r.model: r for r in spark.read.parquet(f"{tmp_path}/out/scores").collect()}
    assert set(scores) == {
        "naive", "seasonal_naive", "seasonal_naive_recursive", "trend_seasonal", "boosted", "boosted_depth_6",
    }
    assert all(r.days == 14 for r in scores.values())
    assert scores["seasonal_naive"].mae == 0 and scores["trend_seasonal"].mae < 5 and scores["boosted_depth_6"].mae < scores["naive"].mae
    months = spark.read.parquet(f"{tmp_path}/out/monthly").where("model = 'naive'").count()
    assert months == 2


@pytest.mark.parametrize("cell", ["40.7", "-0.9"])
def test_a_fraction_in_a_whole_number_fails(spark, cell):
    df = spark.createDataFrame([(cell,)], "t string")
    with pytest.raises(Exception, match="not a whole number"):
        df.select(whole_number(F.col("t"), T.IntegerType())).collect()
    good = spark.createDataFrame([("40.0",), ("-3",), (None,)], "t string")
    assert [r[0] for r in good.select(whole_number(F.col("t"), T.IntegerType())).collect()] == [40, -3, None]


@pytest.mark.parametrize("cell", ["2017-10-02T11:07:00", "2017-10-02 11:07", "2017-10-02 11:07:00", "2017-10-02 11:07:00.000"])
def test_other_spellings_of_a_time(spark, cell):
    df = spark.createDataFrame([(cell,)], "t string")
    assert df.select(coerce_timestamp(F.col("t")).cast("string")).first()[0] == "2017-10-02 11:07:00"


def test_unreadable_times_are_counted(spark, tmp_path):
    spec = TableSpec("stamps", (Field("a", T.TimestampType()), Field("b", T.TimestampType())), ("a",))
    (tmp_path / "stamps.csv").write_text("a,b\n2017-10-02,never\n,2017-10-02T11:07:00\nsoon,\n")
    got = ingest.coerced_cells(spark, spec, f"{tmp_path}/stamps.csv")
    assert sorted(map(tuple, got.collect())) == [("stamps", "a", 1), ("stamps", "b", 1)]


def test_series_file_is_read(spark, tmp_path):
    (tmp_path / "d.csv").write_text("day,revenue,orders\n2018-01-01,10.50,3\n2018-01-03,7,1\n")
    got = [tuple(map(str, r)) for r in ingest.read_series(spark, f"{tmp_path}/d.csv").orderBy("day").collect()]
    assert got == [("all", "2018-01-01", "10.5000", "3"), ("all", "2018-01-03", "7.0000", "1")]


def test_bad_number_fails_the_load(spark, tmp_path):
    src = write_csv(tmp_path, order_payments=CSV["order_payments"].replace("72.19", "much"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest.load_all(spark, src, f"{tmp_path}/store")


def test_bucketed_store_joins_orders_without_an_exchange(spark, shop, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_db")
    try:
        t = save_bucketed(shop, "shop_db", 4)
        totals = t["order_items"].groupBy("order_id").agg(F.sum("price").alias("v"))
        joined = t["orders"].join(totals, "order_id")
        assert joined.count() == 6
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.sql("DROP DATABASE shop_db CASCADE")
