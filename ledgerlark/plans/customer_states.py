"""The customer view of a store that grows: partial states per person and load.

A load's state says what the load adds to each person: orders that count for the first time, items, money, first and last
purchase day. States add up, so a refresh reads the new loads alone; of older loads it looks up single orders and customers that the new
rows refer to, in the loads whose filters admit them. Tiles are ranks over everybody and are made from the added states.

    root/states/<load>/people/   one row per person that the load adds something to
    root/states/<load>/counted/  the orders that count since this load
    root/states/<load>.json      written last: the state is whole; the newest purchase day of the load's orders
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.lineage import copies_written, discard_copies, materialise
from ledgerlark.plans import facts, views
from ledgerlark.sources import store
from ledgerlark.sources.schemas import SPEC

STATES = "states"
PEOPLE = (
    "customer_unique_id string, orders_count long, items_count long, clv decimal(38,2), first_purchase date, last_purchase date"
)


def _open(spark: SparkSession, root: str, table: str, loads: list[str]) -> DataFrame:
    schema = SPEC[table].schema
    return spark.read.schema(schema).parquet(*[f"{root}/{table}/{n}" for n in loads]) if loads else spark.createDataFrame([], schema)


def finished_states(spark: SparkSession, root: str) -> dict[str, str | None]:
    """The loads whose state is whole, with the newest purchase day of each: one small file per load."""
    try:
        found = spark.read.schema("load string, newest string").json(f"{root}/{STATES}/*.json").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {row["load"]: row["newest"] for row in found}


def _looked_up(spark: SparkSession, root: str, table: str, ids: DataFrame, loads: tuple[store.Load, ...]) -> DataFrame:
    """Stored rows of the table for the ids (distinct, one column named as the key), from the loads that may hold them."""
    key = SPEC[table].key[0]
    wanted = ids.select(F.lit(table).alias("table"), F.array(key).alias("key"))
    found = materialise(store.possible_keys(spark, root, wanted, loads), "wanted")
    names = [row["load"] for row in found.select("load").distinct().collect()]  # at most one row per load
    return _open(spark, root, table, sorted(names)).join(ids, key, "left_semi")


def _state_of(spark: SparkSession, root: str, name: str, loads: tuple[store.Load, ...], before: list[str]) -> tuple[DataFrame, DataFrame, str | None]:
    """(people, counted orders, newest purchase day) of one load. Orders and customers that it refers to and does not hold are
    looked up in `loads`, orders that counted before in the states of `before`."""
    own = {table: _open(spark, root, table, [name]) for table in ("customers", "orders", "order_items")}
    totals = own["order_items"].groupBy("order_id").agg(F.count("*").alias("items_count"), F.sum(facts.line_value()).alias("clv"))
    totals = materialise(totals, "new-totals")
    columns = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    old_ids = totals.join(own["orders"], "order_id", "left_anti").select("order_id")
    old = _looked_up(spark, root, "orders", old_ids, loads).select(*columns)
    orders = own["orders"].select(*columns).withColumn("old", F.lit(False)).union(old.withColumn("old", F.lit(True)))
    day = F.col("order_purchase_timestamp").cast("date").alias("day")
    sold = orders.where(F.col("order_status") == facts.DELIVERED).join(totals, "order_id")
    sold = materialise(sold.select("order_id", "customer_id", "old", day, "items_count", "clv"), "new-orders")
    again = spark.createDataFrame([], "order_id string")
    if before and sold.where("old").limit(1).count():
        counted = spark.read.schema("order_id string").parquet(*[f"{root}/{STATES}/{n}/counted" for n in before])
        again = counted.join(sold.where("old").select("order_id"), "order_id", "left_semi")
    sold = sold.join(again.withColumn("again", F.lit(True)), "order_id", "left").withColumn("first", F.col("again").isNull())
    per_customer = sold.groupBy("customer_id").agg(
        F.count_if("first").alias("orders_count"),
        F.sum("items_count").alias("items_count"),
        F.sum("clv").alias("clv"),
        F.min("day").alias("first_purchase"),
        F.max("day").alias("last_purchase"),
    )
    per_customer = materialise(per_customer, "new-customers")
    people = own["customers"].select("customer_id", "customer_unique_id")
    missing = per_customer.join(people, "customer_id", "left_anti").select("customer_id")
    people = people.union(_looked_up(spark, root, "customers", missing, loads).select("customer_id", "customer_unique_id"))
    newest = own["orders"].agg(F.max(F.col("order_purchase_timestamp").cast("date")).cast("string")).first()[0]
    return _added_up(per_customer.join(people, "customer_id")), sold.where("first").select("order_id"), newest


def _added_up(states: DataFrame) -> DataFrame:
    return states.groupBy("customer_unique_id").agg(
        F.sum("orders_count").alias("orders_count"),
        F.sum("items_count").alias("items_count"),
        F.sum("clv").cast("decimal(38,2)").alias("clv"),
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
    )


def refresh(spark: SparkSession, root: str) -> list[str]:
    """Bring the states of a store up to its newest manifest (an action); the loads that were new, in the order of their publication.

    A merged load counts as the loads it took over, whose files and states stay. A state that was left half written is
    written anew. One refresh at a time may run.
    """
    manifest = store.newest(spark, root) or store.Manifest()
    members = [name for _, name in sorted(m for load in manifest.loads for m in load.members())]
    done = finished_states(spark, root)
    new = [name for name in members if name not in done]
    for name in new:
        kept, folder = copies_written(), f"{root}/{STATES}/{name}"
        try:
            before = members[: members.index(name)]
            people, counted, newest = _state_of(spark, root, name, manifest.loads, before)
            people.write.mode("overwrite").parquet(f"{folder}/people")
            counted.write.mode("overwrite").parquet(f"{folder}/counted")
            store.create_file(spark, f"{folder}.json", json.dumps({"load": name, "newest": newest}))
        finally:
            discard_copies(spark, since=kept)
    return new


def people_of(spark: SparkSession, root: str) -> DataFrame:
    """One row per person with a delivered order, as facts.person_metrics gives them, from the states of the newest manifest."""
    manifest = store.newest(spark, root) or store.Manifest()
    names = [name for load in manifest.loads for _, name in load.members()]
    if not names:
        return spark.createDataFrame([], PEOPLE)
    missing = set(names) - finished_states(spark, root).keys()
    if missing:
        raise RuntimeError(f"refresh first: {len(missing)} loads have no state")
    return _added_up(spark.read.schema(PEOPLE).parquet(*[f"{root}/{STATES}/{name}/people" for name in names]))


def customer_clv(spark: SparkSession, root: str, tiles: int = views.TILES) -> DataFrame:
    """views.customer_clv of a store, after a refresh, without a scan of its items (an action)."""
    refresh(spark, root)
    manifest = store.newest(spark, root) or store.Manifest()
    names, days = {name for load in manifest.loads for _, name in load.members()}, finished_states(spark, root)
    newest = max((days[name] for name in names if days[name] is not None), default=None)
    return views.scored(people_of(spark, root), F.lit(newest).cast("date"), tiles)
