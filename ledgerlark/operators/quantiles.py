"""Exact quantiles of groups of any size.

percentile() gathers a group's values in one task. Groups of more than `large` rows, of which there are at most rows / large,
are selected instead: their rows are range-partitioned on (group, value), so one group spreads over many partitions; the
partitions' row counts per group give every row its place in its group, and only the rows at the wanted places are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.lineage import materialise
from ledgerlark.operators.ranking import ROW_BITS

LARGE = 1_000_000


def _wanted(n: Column, p: float) -> tuple[Column, Column, Column]:
    """Places (from 0) of the two values that a quantile lies between, and how far it is from the first."""
    at = (n - 1) * F.lit(float(p))
    return F.floor(at), F.ceil(at), at - F.floor(at)


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], large: int = LARGE) -> DataFrame:
    """(keys, n, one column per probability): linearly interpolated quantiles of the non-null values as doubles (an action).

    Equal to percentile(). Null keys are a group of their own; a group without values has n 0 and null quantiles; NaN comes after all
    numbers. An empty table gives an empty result.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("q_value"))
    counts = materialise(rows.groupBy(*keys).agg(F.count("q_value").alias("n")), "group-sizes")
    big = counts.where(F.col("n") > large)  # at most rows / large groups
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]

    def all_of(conditions: list[Column]) -> Column:
        out = F.lit(True)
        for one in conditions:
            out = out & one
        return out

    small = rows.alias("r").join(F.broadcast(big.select(*keys)).alias("b"), all_of(same("r", "b")), "left_anti")
    plain = small.groupBy(*keys).agg(F.count("q_value").alias("n"), *[F.percentile("q_value", F.lit(float(p))).alias(name) for name, p in probabilities.items()])
    if big.isEmpty():
        return plain

    hot = rows.where(F.col("q_value").isNotNull()).alias("r").join(F.broadcast(big).alias("b"), all_of(same("r", "b")))
    order = [*keys, "q_value"]
    placed = hot.select(*[F.col(f"r.{k}").alias(k) for k in keys], "q_value", "n").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("position", F.monotonically_increasing_id()).withColumn("part", F.shiftright("position", ROW_BITS))
    placed = materialise(placed, "group-order")
    along = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part", *keys).agg(F.count("*").alias("rows"), F.min("position").alias("start"))
    parts = parts.withColumn("before", F.coalesce(F.sum("rows").over(along), F.lit(0))).drop("rows")
    met = placed.alias("r").join(F.broadcast(parts).alias("p"), (F.col("r.part") == F.col("p.part")) & all_of(same("r", "p")))  # partitions + groups rows
    place = F.col("p.before") + F.col("r.position") - F.col("p.start")
    indexed = met.select(*[F.col(f"r.{k}").alias(k) for k in keys], "q_value", "n", place.alias("place"))
    ends = {name: _wanted(F.col("n"), p) for name, p in probabilities.items()}
    kept = indexed.where(F.array_contains(F.array(*[F.col("place") == x for low, high, _ in ends.values() for x in (low, high)]), True))
    columns = []
    for name, (low, high, share) in ends.items():
        a, b = (F.max(F.when(F.col("place") == x, F.col("q_value"))) for x in (low, high))
        columns.append((a + (b - a) * F.max(share)).alias(name))
    return plain.unionByName(kept.groupBy(*keys, "n").agg(*columns))
