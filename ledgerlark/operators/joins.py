"""Attaching attributes of a keyed table to rows whose key may be heavily skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import shuffle_partitions

PART_BYTES = 4 << 20  # of a table's estimated size per partition; sorted or hashed, its rows take some 50 times that

_hot: dict[tuple, list] = {}  # by plan, key and number of partitions; only load balance depends on it


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own size estimate."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcastable(df: DataFrame) -> bool:
    """True when the optimizer's own size estimate lets it broadcast this side."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= int(limit)


def spread(df: DataFrame, *keys: str, sized_by: DataFrame) -> DataFrame:
    """Deal the rows out by `keys` for the join that follows, over as many partitions as the size of the table `sized_by` asks for.

    A table that the session's shuffle partitions hold in small pieces stays as it is. With too few of them a task's share,
    and so the memory of its sort, would grow with the table.
    """
    partitions = -(-estimated_bytes(sized_by) // PART_BYTES)
    return df.repartition(partitions, *keys) if partitions > shuffle_partitions(df.sparkSession) else df


def hot_keys(df: DataFrame, key: str) -> list:
    """All values of the key, NULL among them, with more than a quarter of an average partition's rows (an action).

    Counted exactly with a map-side fold of the key column alone; by arithmetic there are at most four per partition.
    Counted once per table and key. Only the load balance of a join depends on the list, never its result; it is
    fetched so that both sides of the join use the same one.
    """
    partitions = shuffle_partitions(df.sparkSession)
    known = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), key, partitions)
    if known not in _hot:
        counts = df.groupBy(F.col(key).alias("item")).agg(F.count("*").alias("n"))
        floor = df.count() / (4 * partitions)
        _hot[known] = [row["item"] for row in counts.where(F.col("n") > floor).collect()]
    return _hot[known]


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str, hot: list, spread_by: DataFrame | None = None) -> DataFrame:
    """Shuffle join that spreads the rows of each hot key over all shuffle partitions.

    The salt is the number of the task that read the row: free, stable when a task is repeated, and able to separate
    identical rows. Only the rows of `dim` that belong to hot keys are repeated, once per salt.
    """
    salts = shuffle_partitions(fact.sparkSession)
    column, values = F.col(key), [v for v in hot if v is not None]
    is_hot = column.isin(values) if values else F.lit(False)
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    left = fact.withColumn("salt", F.when(is_hot | column.isNull(), F.spark_partition_id() % salts).otherwise(0))
    right = dim.withColumn("salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
    left = left if spread_by is None else spread(left, key, "salt", sized_by=spread_by)
    return left.join(right, [key, "salt"], how).drop("salt")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    hot_source: DataFrame | None = None,
    sized_by: DataFrame | None = None,
    spread_by: DataFrame | None = None,
) -> DataFrame:
    """Join `fact` to `dim`, which is unique on `key`.

    A dimension within spark.sql.autoBroadcastJoinThreshold is broadcast. For a larger one the hot keys are looked up
    (in `hot_source`, the base table, when `fact` is itself derived), and the shuffle join is salted if there are any.
    `sized_by` is the table that `dim` has one row per row of, when `dim` is a join: the optimizer multiplies the sizes
    of joined tables, which says nothing about a lookup. `spread_by` is the table whose size gives the partitions of a
    shuffle join, see `spread`.
    """
    if broadcastable(dim if sized_by is None else sized_by):
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact if hot_source is None else hot_source, key)
    if hot:
        return salted_join(fact, dim, key, how, hot, spread_by)
    return (fact if spread_by is None else spread(fact, key, sized_by=spread_by)).join(dim, key, how)
