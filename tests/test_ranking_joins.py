from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.operators.joins import broadcastable, hot_keys, lookup, salted_join
from ledgerlark.operators.lineage import materialise, shared_dir
from ledgerlark.operators.quantiles import group_quantiles
from ledgerlark.operators.ranking import add_tiles, global_rank
from tests.shop import rows


def people(spark, n: int):
    """A third of the rows share one value; the rest repeat a few."""
    v = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 17)
    return spark.range(n).select(F.col("id").alias("key"), v.cast("decimal(12,2)").alias("value"))


@pytest.mark.parametrize("n", [3, 7, 1001])
@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("desc", [False, True])
def test_global_rank_equals_window_functions(spark, conf, n, parts, desc):
    conf("spark.sql.shuffle.partitions", str(parts))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = people(spark, n)
    by_value = F.desc("value") if desc else F.asc("value")
    unique, tied = Window.orderBy(by_value, "key"), Window.orderBy(by_value)
    want = df.select(
        "*",
        F.row_number().over(unique), F.rank().over(tied), F.dense_rank().over(tied), F.ntile(5).over(unique),
    )
    assert sorted(rows(global_rank(df, "value", "key", desc))) == sorted(rows(want))


def test_ranks_take_one_exchange(spark):
    """What comes after the written copy joins offsets only."""
    plan = global_rank(people(spark, 500), "value", "key")._jdf.queryExecution().executedPlan().toString()
    rows_side = "\n".join(line for line in plan.split("BroadcastExchange")[0].splitlines())
    assert "Exchange" not in rows_side and "Window" not in rows_side and "Sort" not in rows_side


@pytest.mark.parametrize("kind", ["double", "string", "date", "boolean"])
def test_ranks_of_other_types_with_nulls_and_nan(spark, conf, kind):
    conf("spark.sql.shuffle.partitions", "5")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    value = {
        "double": F.when(F.col("id") % 5 == 0, float("nan")).otherwise((F.col("id") % 7) / 2),
        "string": F.concat(F.lit("v"), F.col("id") % 6),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 9).cast("int")),
        "boolean": F.col("id") % 2 == 0,
    }[kind]
    df = spark.range(300).select(F.col("id").alias("key"), F.when(F.col("id") % 4 != 0, value).alias("value"))
    tied = Window.orderBy(F.asc("value"))
    want = df.select("*", F.row_number().over(Window.orderBy("value", "key")), F.rank().over(tied), F.dense_rank().over(tied))
    got = global_rank(df, "value", "key").drop("tile")
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(want)))


@pytest.mark.parametrize("n", [0, 3, 7, 1001])
def test_tiles_equal_ntile(spark, conf, n):
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = people(spark, n).withColumn("other", F.col("key") * 7 % 11)
    want = df.select(
        "*",
        F.ntile(5).over(Window.orderBy(F.desc("value"), "key")),
        F.ntile(5).over(Window.orderBy("other", "key")),
    )
    got = add_tiles(df, "key", {"a": -F.col("value"), "b": F.col("other")}, 5)
    assert got.columns == ["key", "value", "other", "a", "b"]
    assert sorted(rows(got)) == sorted(rows(want))


def test_three_and_seven_rows_into_five_tiles(spark):
    def tiles(n):
        return [r[0] for r in rows(global_rank(spark.range(n).selectExpr("id AS k", "id AS v"), "v", "k").orderBy("k"), "tile")]

    assert tiles(3) == [1, 2, 3]
    assert tiles(7) == [1, 1, 2, 2, 3, 4, 5]


def test_no_task_receives_all_rows(spark, conf):
    """The ranked rows are numbered without a window that has no partition key."""
    df = add_tiles(people(spark, 1000), "key", {"a": F.col("value")}, 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    above_the_offsets = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in above_the_offsets


def skewed(spark):
    """40 % key 7, 10 % NULL, the rest unique."""
    key = F.when(F.col("id") % 10 < 4, 7).when(F.col("id") % 10 == 4, None).otherwise(F.col("id") + 1000)
    return spark.range(0, 20000, 1, 8).select(key.alias("k"), "id")


def test_hot_keys_are_found_and_others_are_not(spark):
    assert set(hot_keys(skewed(spark), "k")) == {7, None}
    assert hot_keys(spark.range(100_000).withColumnRenamed("id", "k"), "k") == []


def test_many_hot_keys_are_all_found(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "200")  # what a shuffle starts with
    df = spark.range(0, 90_000, 1, 4).select((F.col("id") % 300).alias("k"))
    assert set(hot_keys(df, "k")) == set(range(300))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = skewed(spark)
    dim = spark.range(0, 15000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    want = sorted(rows(fact.join(dim, "k", how)), key=repr)
    assert sorted(rows(lookup(fact, dim, "k", how)), key=repr) == want
    assert sorted(rows(salted_join(fact, dim, "k", how, [7, None])), key=repr) == want


def test_salting_spreads_a_hot_key(spark, conf):
    """Also when all its rows are copies of one another."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    fact = spark.range(0, 8000, 1, 8).select(F.lit(7).cast("long").alias("k"))
    dim = spark.range(10).withColumnRenamed("id", "k")
    per_task = salted_join(fact, dim, "k", "inner", [7]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 4000
    assert sum(r["count"] for r in per_task) == 8000


def test_broadcast_is_left_to_sparks_size_limit(spark, conf):
    dim = spark.range(1000).withColumnRenamed("id", "k")
    assert broadcastable(dim)
    conf("spark.sql.autoBroadcastJoinThreshold", "100")
    assert not broadcastable(dim)


def test_materialise_uses_the_configured_folder(spark):
    df = materialise(spark.range(5), "t")
    assert df.inputFiles()[0].split("/t-")[0].endswith(shared_dir(spark).split(":")[-1])
    assert df.count() == 5


@pytest.mark.parametrize("large", [10, 1 << 40])
def test_quantiles_of_groups_of_any_size(spark, conf, large):
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    group = F.when(F.col("id") % 2 == 0, "half").when(F.col("id") % 4 == 1, None).when(F.col("id") % 100 == 3, "few").otherwise(F.concat(F.lit("g"), F.col("id") % 300))
    value = F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 1000) / 8).otherwise(F.when(F.col("id") % 3 == 0, 5.0))
    df = spark.range(0, 5_000, 1, 7).select(group.alias("g"), value.alias("v"), F.lit("x").alias("n"))
    probabilities = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = group_quantiles(df, ["g"], "v", probabilities, large)
    want = df.groupBy("g").agg(F.count("v").alias("n"), *[F.percentile("v", F.lit(p)).alias(k) for k, p in probabilities.items()])
    assert got.columns == want.columns
    assert [(r[0], r[1], *[round(x, 9) if x is not None else x for x in r[2:]]) for r in sorted(rows(got), key=str)] == [
        (r[0], r[1], *[round(x, 9) if x is not None else x for x in r[2:]]) for r in sorted(rows(want), key=str)
    ]
    assert rows(group_quantiles(df.limit(0), ["g"], "v", probabilities, large)) == []


def test_one_group_of_all_rows_is_spread(spark, conf, monkeypatch):
    from ledgerlark.operators import quantiles

    written = {}
    real = quantiles.materialise
    monkeypatch.setattr(quantiles, "materialise", lambda df, label: written.setdefault(label, real(df, label)))
    conf("spark.sql.shuffle.partitions", "6")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(30_000).select(F.lit(1).alias("g"), (F.col("id") * 31 % 30_000).alias("v"))
    assert rows(group_quantiles(df, ["g"], "v", {"m": 0.5}, 100)) == [(1, 30_000, 14_999.5)]
    sizes = [r["count"] for r in written["group-order"].groupBy("part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 10_000
