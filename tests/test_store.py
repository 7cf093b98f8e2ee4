"""Loads at once, key filters, merging, and the customer view that follows the loads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.quality import ConstraintError
from ledgerlark.plans import customer_states, views
from ledgerlark.sources import ingest, store
from ledgerlark.sources.schemas import SPEC, SPECS
from ledgerlark.sources.tables import read_tables
from tests.shop import make_shop, rows

NONE = {"customers": [], "product_category_translation": [], "products": [], "sellers": [], "orders": [], "order_items": [], "order_payments": [], "order_reviews": []}


def batch(spark, **changes) -> dict:
    """Frames of one load: the given rows, nothing else."""
    shop = make_shop(spark, **{name: given for name, given in changes.items()})
    return {name: shop[name] if name in changes else shop[name].limit(0) for name in NONE}


def base(spark) -> dict:
    shop = make_shop(spark)
    return {name: shop[name] for name in NONE}


def order(i: str, customer: str = "c1", day: str = "2018-08-10") -> tuple:
    return (i, customer, "delivered", f"{day} 10:00:00", f"{day} 12:00:00", f"{day} 00:00:00")


def test_manifests_are_numbered_and_created_once(spark, tmp_path):
    root = str(tmp_path)
    assert store.newest(spark, root) is None
    ingest.publish_batch(spark, base(spark), root)
    ingest.publish_batch(spark, batch(spark, orders=[order("n1")]), root)
    now = store.newest(spark, root)
    assert now.number == 2 and len(now.loads) == 2
    assert not store.create_file(spark, f"{root}/manifests/0000000002.json", "[]") and store.newest(spark, root) == now
    assert store.Manifest.parse(2, now.text()) == now
    assert {r.order_id for r in read_tables(spark, root).orders.collect()} == {"o1", "o2", "o3", "o4", "o5", "o6", "o9", "n1"}


@pytest.mark.parametrize("others", [["n1"], ["x1"]])
def test_of_two_loads_at_once_the_second_is_checked_against_the_first(spark, tmp_path, monkeypatch, others):
    root, real = str(tmp_path), ingest.write_load
    ingest.publish_batch(spark, base(spark), root)
    inner = []

    def interrupted(df, folder, table, load):
        real(df, folder, table, load)
        if table == "order_reviews" and not inner:  # the first load is written and not yet published
            inner.append(load)
            ingest.publish_batch(spark, batch(spark, orders=[order(i, "c2") for i in others]), root)

    monkeypatch.setattr(ingest, "write_load", interrupted)
    mine = batch(spark, orders=[order("n1"), order("n2")])
    if others == ["n1"]:
        with pytest.raises(ConstraintError, match="orders: primary_key"):
            ingest.publish_batch(spark, mine, root)
    else:
        ingest.publish_batch(spark, mine, root)
    got = rows(read_tables(spark, root).orders.where("order_id like 'n%' or order_id like 'x%'").orderBy("order_id"), "order_id", "customer_id")
    assert got == ([("n1", "c2")] if others == ["n1"] else [("n1", "c1"), ("n2", "c1"), ("x1", "c2")])
    manifest = store.newest(spark, root)
    assert manifest.number == len(manifest.loads) == (2 if others == ["n1"] else 3)


def test_filters_admit_every_key_and_few_others(spark, tmp_path):
    root, n = str(tmp_path), 6_000
    frames = batch(spark)
    ids = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("order_id"))
    filler = spark.sql("SELECT 'c' customer_id, 'delivered' order_status").crossJoin(ids)
    frames["orders"] = filler.select(*[(F.col(f.name) if f.name in filler.columns else F.lit(None)).cast(f.type).alias(f.name) for f in SPEC["orders"].fields])
    stats = store.stats_of(frames)
    assert stats["orders"] == store.TableStats(n, 3, "k0", "k999")
    store.write_filters(frames, stats, root, "load-a")
    load = store.Load("load-a", stats)
    wanted = ids.union(ids.select(F.concat("order_id", F.lit("z")))).select(F.lit("orders").alias("table"), F.array("order_id").alias("key"))
    found = {r.key[0] for r in store.possible_keys(spark, root, wanted, [load]).collect()}
    assert {f"k{i}" for i in range(n)} <= found and len(found) < n + 60
    far = wanted.limit(0).union(spark.sql("SELECT 'orders', array('a1')"))
    assert store.possible_keys(spark, root, far, [load]).count() == 0


def test_only_loads_that_may_hold_a_key_are_read(spark, tmp_path):
    root = str(tmp_path)
    ingest.publish_batch(spark, base(spark), root)
    for i in range(3):
        ingest.publish_batch(spark, batch(spark, orders=[order(f"{c}{i}") for c in "pqr"], order_items=[(f"p{i}", 1, "p1", "s1", "1.00", "0.00")]), root)
    loads = store.newest(spark, root).loads
    late = batch(spark, orders=[order("q1", "c3"), order("o35", "c3")], order_items=[("p2", 1, "p1", "s1", "1.00", "0.00"), ("q1", 1, "p1", "s1", "1.00", "0.00")])
    stored = store.stored_keys(spark, root, late, loads)
    assert rows(stored["orders"].orderBy("order_id")) == [("p2",), ("q1",)]  # repeated or referred to
    read = {path.split("/orders/")[1].split("/")[0] for path in stored["orders"].inputFiles() if "/orders/" in path}
    assert read == {loads[2].name, loads[3].name}
    assert rows(stored["order_items"]) == [("p2", 1)] and "order_reviews" not in stored
    with pytest.raises(ConstraintError, match=r"orders: primary_key\(order_id \(stored\)\) 1; order_items: primary_key\(order_id, order_item_id \(stored\)\) 1"):
        ingest.publish_batch(spark, late, root)
    with pytest.raises(ConstraintError, match="foreign_key"):
        ingest.publish_batch(spark, batch(spark, order_items=[("never", 1, "p1", "s1", "1.00", "0.00")]), root)


def test_merged_loads_keep_rows_filters_and_old_readers(spark, tmp_path):
    root = str(tmp_path)
    ingest.publish_batch(spark, base(spark), root)
    for i in range(3):
        ingest.publish_batch(spark, batch(spark, orders=[order(f"n{i}")]), root)
    before = store.newest(spark, root)
    old = read_tables(spark, root)
    merged = store.compact(spark, root)
    assert merged.number == 5 and len(merged.loads) == 1 and [name for _, name in merged.loads[0].merged] == before.names
    new = read_tables(spark, root)
    for spec in SPECS:
        assert sorted(rows(new[spec.name]), key=str) == sorted(rows(old[spec.name]), key=str)
    assert len({f.rsplit("/", 2)[1] for f in new.orders.inputFiles()}) == 1 < len({f.rsplit("/", 2)[1] for f in old.orders.inputFiles()})
    with pytest.raises(ConstraintError, match="stored"):
        ingest.publish_batch(spark, batch(spark, orders=[order("n2")]), root)
    assert store.compact(spark, root) == merged  # one load is left


def test_a_merge_and_a_load_at_once(spark, tmp_path, monkeypatch):
    root, real = str(tmp_path), store.write_filters
    ingest.publish_batch(spark, base(spark), root)
    ingest.publish_batch(spark, batch(spark, orders=[order("n1")]), root)
    inner = []

    def interrupted(tables, stats, folder, load):
        real(tables, stats, folder, load)
        if not inner:
            inner.append(load)
            ingest.publish_batch(spark, batch(spark, orders=[order("n2")]), root)

    monkeypatch.setattr(store, "write_filters", interrupted)
    store.compact(spark, root)
    manifest = store.newest(spark, root)
    assert [len(load.merged) for load in manifest.loads] == [2, 0] and manifest.number == 4
    assert read_tables(spark, root).orders.where("order_id like 'n%'").count() == 2


# --- the customer view that follows the loads ---------------------------------------------------------------------


def view_rows(df) -> list[tuple]:
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


def test_states_equal_a_full_rebuild_after_each_load(spark, tmp_path):
    root = str(tmp_path)
    steps = [
        base(spark),
        # an item of an old order that has none, one of an old order that counts already, an old customer's new order
        batch(
            spark,
            customers=[("c6", "ann", "01151", "city a", "SP"), ("c7", "fay", "30000", "city c", "MG")],
            orders=[order("n1", "c3"), order("n2", "c6", "2018-08-21"), ("n3", "c7", "shipped", "2018-09-01 10:00:00", None, "2018-09-05 00:00:00")],
            order_items=[("o5", 1, "p1", "s1", "7.00", "0.50"), ("o1", 3, "p1", "s1", "2.00", "0.00"), ("n1", 1, "p2", "s1", "30.00", "1.00"),
                         ("n3", 1, "p2", "s1", "30.00", "1.00")],
        ),
        batch(spark, order_items=[("n2", 1, "p3", "s2", "11.00", "0.00"), ("o5", 2, "p1", "s1", "1.00", "0.00"), ("n1", 2, "p1", "s1", "1.00", "0.00")]),
    ]
    for i, frames in enumerate(steps):
        ingest.publish_batch(spark, frames, root)
        if i == 1:
            continue  # two loads at once have no state yet
        got = view_rows(customer_states.customer_clv(spark, root))
        assert got == view_rows(views.customer_clv(read_tables(spark, root)))
    assert [r for r in got if r[0] == "eve"][0][1:4] == ("1", "8.50", "4.25")
    store.compact(spark, root)
    assert customer_states.refresh(spark, root) == [] and view_rows(customer_states.customer_clv(spark, root)) == got
    ingest.publish_batch(spark, batch(spark, order_items=[("n1", 3, "p1", "s1", "9.00", "0.00")]), root)
    assert view_rows(customer_states.customer_clv(spark, root)) == view_rows(views.customer_clv(read_tables(spark, root)))


def test_a_refresh_reads_no_items_of_older_loads(spark, tmp_path, monkeypatch):
    root, opened = str(tmp_path), []
    ingest.publish_batch(spark, base(spark), root)
    assert len(customer_states.refresh(spark, root)) == 1
    ingest.publish_batch(spark, batch(spark, orders=[order("n1", "c2")], order_items=[("n1", 1, "p1", "s1", "1.00", "0.00")]), root)
    real = customer_states._open
    monkeypatch.setattr(customer_states, "_open", lambda spark, root, table, loads: opened.append((table, *loads)) or real(spark, root, table, loads))
    (new,) = customer_states.refresh(spark, root)
    first = store.newest(spark, root).names[0]
    assert [o for o in opened if first in o] == [("customers", first)] and ("order_items", new) in opened
    assert "order_items" not in str(customer_states.people_of(spark, root).inputFiles())


def test_states_of_an_empty_store(spark, tmp_path):
    assert customer_states.customer_clv(spark, str(tmp_path)).collect() == []


def raw_tables(spark, folder, customers: list[int], sellers: list[int]) -> str:
    """The driver's tables with the given customer and seller numbers: an order per customer, a line per order."""
    day = "TIMESTAMP_NTZ'1998-01-01 00:00:00'"
    orders = [(10 * i, c, sellers[i % len(sellers)]) for i, c in enumerate(customers)]
    sold = spark.createDataFrame(orders, "o long, c long, s long")
    frames = {
        "region": spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name"),
        "nation": spark.sql("SELECT 0 AS n_nationkey, 'NATION' AS n_name, 0 AS n_regionkey"),
        "customer": sold.selectExpr("c AS c_custkey", "'C' AS c_name", "0 AS c_nationkey", "1D AS c_acctbal", "'M' AS c_mktsegment"),
        "supplier": sold.selectExpr("s AS s_suppkey", "'S' AS s_name", "0 AS s_nationkey", "1D AS s_acctbal").distinct(),
        "part": spark.sql("SELECT 1L AS p_partkey, 'p' AS p_name, 'b' AS p_brand, 'LARGE' AS p_type, 1 AS p_size, 1D AS p_retailprice"),
        "orders": sold.selectExpr(
            "o AS o_orderkey", "c AS o_custkey", "'F' AS o_orderstatus", "1D AS o_totalprice", f"{day} AS o_orderdate", "'1' AS o_orderpriority"
        ),
        "lineitem": sold.selectExpr(
            "o AS l_orderkey", "1L AS l_partkey", "s AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "10D AS l_extendedprice",
            "0D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", f"{day} AS l_shipdate",
        ),
        "events": sold.selectExpr("2 * o AS event_id", f"{day} AS ts", "c AS user_id", "'view' AS event_type", "1D AS value", "'' AS props"),
        "conversations": sold.selectExpr("o AS conv_id", "o AS turn", "'user' AS role", "'t' AS text"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_keys_of_more_than_five_digits_enter_the_store(spark, tmp_path):
    from ledgerlark.testbed.catalog import _batches

    folder = raw_tables(spark, tmp_path, [7, 99_999, 100_000, 1_234_567], [3, 360_000])
    first = _batches(spark, folder)[0]
    codes = {r.customer_id: r.customer_zip_code_prefix for r in first["customers"].collect()}
    assert codes == {"7": "00007", "99999": "99999", "100000": "00000", "1234567": "34567"}
    assert {r.seller_zip_code_prefix for r in first["sellers"].collect()} == {"00003", "60000"}
    rows_of = {r["table"]: r["rows"] for r in ingest.publish_batch(spark, first, str(tmp_path / "store")).collect()}
    assert (rows_of["customers"], rows_of["sellers"], rows_of["orders"]) == (4, 2, 2)
