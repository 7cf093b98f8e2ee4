"""Row numbers, ranks and tiles over a whole table without sending it through one task.

A window without PARTITION BY moves every row to a single partition. Here the rows are range-partitioned on
(value, key), sorted locally and numbered per partition; the per-partition counts (one small row each) give every
partition its offset. The tie-break on the key makes the order total, so a value shared by a third of all rows is
still split over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.lineage import materialise

NUMBERS = ("part", "row_in", "rank_in", "dense_in")
ROW_BITS = 33  # monotonically_increasing_id() = partition id << 33 | row within partition


def _partition_of(position: Column) -> Column:
    return F.shiftright(position, ROW_BITS)


def tile_of(row_num: Column, total: Column, tiles: int) -> Column:
    """NTILE from a row number: the first `total mod tiles` tiles hold one row more than the others."""
    base = F.floor(total / tiles)
    extra = total % tiles
    wide = extra * (base + 1)
    in_wide = F.ceil(row_num / (base + 1))
    in_narrow = extra + F.ceil((row_num - wide) / F.greatest(base, F.lit(1)))
    return F.when(row_num <= wide, in_wide).otherwise(in_narrow).cast("int")


def add_tiles(df: DataFrame, key: str, measures: dict[str, Column], tiles: int) -> DataFrame:
    """NTILE(tiles) columns for several numeric measures, each ascending with the key as tie-break (an action).

    All measures share one sort: each row is stacked once per measure, and only the first copy carries the other
    columns along. One range exchange, one written copy and one exchange on the key, whatever the number of measures.
    """
    nothing = F.lit(None).cast(df.select(F.struct("*").alias("s")).schema["s"].dataType)
    copies = [
        F.struct(
            F.lit(i).alias("measure"),
            value.cast("decimal(38,6)").alias("value"),
            (F.struct(*df.columns) if i == 0 else nothing).alias("row"),
        )
        for i, value in enumerate(measures.values())
    ]
    order = ["measure", "value", key]
    placed = (
        df.select(key, F.explode(F.array(*copies)).alias("c"))
        .select(key, "c.*")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(key, "measure", "row", F.monotonically_increasing_id().alias("position"))
        .withColumn("part", _partition_of(F.col("position")))
    )
    placed = materialise(placed, "tiles")
    in_order = Window.partitionBy("measure").orderBy("part")
    offsets = (
        placed.groupBy("measure", "part")
        .agg(F.count("*").alias("n"), F.min("position").alias("start"))
        .withColumn("before", F.sum("n").over(in_order) - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy("measure")))
        .drop("n")
    )
    row_num = F.col("before") + F.col("position") - F.col("start") + 1
    numbered = placed.join(F.broadcast(offsets), ["measure", "part"]).select(  # partitions x measures rows
        key, "measure", "row", tile_of(row_num, F.col("total"), tiles).alias("tile")
    )
    return (
        numbered.groupBy(key)
        .agg(
            F.any_value("row", ignoreNulls=True).alias("row"),
            *[F.max(F.when(F.col("measure") == i, F.col("tile"))).alias(name) for i, name in enumerate(measures)],
        )
        .select("row.*", *measures)
    )


def _changes(column: pa.ChunkedArray | pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """For sorted values: where one differs from the value before it; nulls are equal, and so are NaNs."""
    own = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    first = pa.array([before.as_py()], own.type) if before is not None else pa.nulls(1, own.type)
    earlier = pa.concat_arrays([first, own.slice(0, len(own) - 1)])
    differs = pc.fill_null(pc.not_equal(own, earlier), False).to_numpy(zero_copy_only=False)
    differs = differs | (own.is_null().to_numpy(zero_copy_only=False) != earlier.is_null().to_numpy(zero_copy_only=False))
    if pa.types.is_floating(own.type):
        differs &= ~(pc.fill_null(pc.is_nan(own), False).to_numpy(zero_copy_only=False) & pc.fill_null(pc.is_nan(earlier), False).to_numpy(zero_copy_only=False))
    if before is None and len(differs):
        differs[0] = True
    return differs


def number_partitions(ordered: DataFrame, value: str) -> DataFrame:
    """Rows of sorted partitions with part, row_in, rank_in and dense_in: the partition, and the three numbers inside it by
    `value`. One pass over the rows in their order, batch by batch; no exchange and no second sort."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, rank, dense, last = TaskContext.get().partitionId(), 0, 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = _changes(batch.column(value), last)
            row_in = np.arange(seen + 1, seen + n + 1)
            rank_in = np.maximum.accumulate(np.where(starts, row_in, rank))
            dense_in = dense + np.cumsum(starts)
            seen, rank, dense, last = seen + n, int(rank_in[-1]), int(dense_in[-1]), batch.column(value)[n - 1]
            numbers = [np.full(n, part, dtype=np.int64), row_in, rank_in, dense_in]
            columns = [*batch.columns, *[pa.array(x, pa.int64()) for x in numbers]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *NUMBERS])

    schema = T.StructType([*ordered.schema.fields, *[T.StructField(name, T.LongType()) for name in NUMBERS]])
    return ordered.mapInArrow(number, schema)


def global_rank(df: DataFrame, value: str, key: str, desc: bool = False, tiles: int = 5) -> DataFrame:
    """ROW_NUMBER, RANK, DENSE_RANK and NTILE of the whole table as row_num, rnk, dense_rnk, tile (an action).

    One range exchange: the sorted partitions are numbered as they are written, and only the partitions' offsets, one small
    row each, are joined to them afterwards.
    """
    by_value = F.col(value).desc() if desc else F.col(value).asc()
    ordered = df.repartitionByRange(by_value, F.col(key).asc()).sortWithinPartitions(by_value, F.col(key).asc())
    placed = materialise(number_partitions(ordered, value), "rank")

    # One row per partition: how many rows and distinct values it holds, and the values at its two ends.
    parts = placed.groupBy("part").agg(
        F.count("*").alias("n"),
        F.max("dense_in").alias("distinct_n"),
        F.max("rank_in").alias("last_rank"),
        F.min_by(F.struct(value), "row_in").alias("head"),
        F.max_by(F.struct(value), "row_in").alias("tail"),
    )
    along = Window.orderBy("part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    continued = (F.lag("part").over(along).isNotNull()) & F.col("head")[value].eqNullSafe(F.lag("tail").over(along)[value])
    parts = (
        parts.withColumn("continues", F.coalesce(continued, F.lit(False)).cast("int"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
        .withColumn("dense_before", F.coalesce(F.sum(F.col("distinct_n") - F.col("continues")).over(earlier), F.lit(0)))
        .withColumn("tail_rank", F.when((F.col("distinct_n") > 1) | (F.col("continues") == 0), F.col("before") + F.col("last_rank")))
        .withColumn("carried_rank", F.last("tail_rank", ignorenulls=True).over(earlier))
        .select("part", "continues", "before", "total", "dense_before", "carried_rank")
    )
    carried = (F.col("continues") == 1) & (F.col("dense_in") == 1)
    row_num = F.col("before") + F.col("row_in")
    return placed.join(F.broadcast(parts), "part").select(  # one row per partition
        *df.columns,
        row_num.alias("row_num"),
        F.when(carried, F.col("carried_rank")).otherwise(F.col("before") + F.col("rank_in")).alias("rnk"),
        (F.col("dense_before") + F.col("dense_in") - F.col("continues")).alias("dense_rnk"),
        tile_of(row_num, F.col("total"), tiles).alias("tile"),
    )
