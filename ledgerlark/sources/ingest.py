"""CSV files -> cleaned, validated parquet tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.columns import coerce_timestamp, whole_number, zero_pad
from ledgerlark.operators import quality
from ledgerlark.operators.lineage import copies_written, discard_copies, materialise
from ledgerlark.sources import store
from ledgerlark.sources.schemas import SPECS, Field, TableSpec
from ledgerlark.sources.tables import Tables

# Texts that a CSV cell may hold for "no value".
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, matched by header name. Files with line breaks inside fields are split too, see read_records."""
    if multiline:
        return read_records(spark, path)
    return spark.read.csv(path, header=True, inferSchema=False, **CSV)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV files whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

    A line begins a record if the quotes before it in its file are even in number; quotes stand around fields only, and those
    inside are doubled. Quotes are summed per split first, so every split knows how it begins. Lines that are a record
    of their own go straight to the parser; the others are put together. All files have the columns of the first.
    """
    header = spark.read.csv(path, header=True, inferSchema=False, **CSV).columns
    lines = spark.read.text(path, lineSep="\n").select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),  # orders the lines of a split
    )
    lines = lines.withColumn("quotes", (F.length("line") - F.length(F.replace("line", F.lit('"')))).cast("long"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("total"))
    splits = splits.select("file", "split", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("file", "split").orderBy("at")
    before = F.col("first") + F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(F.broadcast(splits), ["file", "split"]).withColumn("before", before)  # one row per split
    placed = placed.withColumn("begins", F.col("before") % 2 == 0).withColumn("ends", (F.col("before") + F.col("quotes")) % 2 == 0)
    placed = placed.withColumn("is_header", (F.col("split") == 0) & (F.row_number().over(inside) == 1)).where(~F.col("is_header"))
    whole = placed.where(F.col("begins") & F.col("ends")).select(F.col("line").alias("record"))
    # The rest: a record's lines share the place of its first line, which may stand in an earlier split.
    torn = placed.where(~(F.col("begins") & F.col("ends"))).withColumn("start", F.when(F.col("begins"), F.struct("split", "at")))
    carried = torn.groupBy("file", "split").agg(F.max("start").alias("last"))
    carried = carried.select("file", "split", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    torn = torn.withColumn("own", F.last("start", ignorenulls=True).over(so_far)).join(F.broadcast(carried), ["file", "split"])
    torn = torn.withColumn("head", F.coalesce("own", "carried"))
    joined = torn.groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("split", "at", "line"))).alias("lines"))
    joined = joined.select(F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    schema = ", ".join(f"`{name}` string" for name in header)
    records = whole.union(joined).where(F.col("record") != "")
    return records.select(F.from_csv("record", schema, CSV).alias("row")).select("row.*")


def clean_field(field: Field) -> Column:
    """Source text -> typed column. Timestamps that do not parse become NULL; any other bad value fails the job."""
    text = F.col(f"`{field.header or field.name}`")
    present = F.when(~text.isin(*NULL_TEXTS), text)
    if isinstance(field.type, T.TimestampType):
        value = coerce_timestamp(present)
    elif field.pad:
        value = zero_pad(present, field.pad)
    elif isinstance(field.type, (T.ShortType, T.IntegerType)):
        value = whole_number(present, field.type)
    else:
        value = present.cast(field.type)
    return value.alias(field.name)


def ingest(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return read_csv(spark, path, spec.multiline).select(*[clean_field(f) for f in spec.fields])


def coerced_cells(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """(table, column, cells): how many filled timestamp cells of a file are unreadable and become NULL."""
    stamps = [f for f in spec.fields if isinstance(f.type, T.TimestampType)]
    schema = "`table` string, `column` string, cells bigint"
    if not stamps:
        return spark.createDataFrame([], schema)
    text = {f.name: F.col(f"`{f.header or f.name}`") for f in stamps}
    lost = [
        F.count_if(~c.isin(*NULL_TEXTS) & coerce_timestamp(c).isNull()).alias(name) for name, c in text.items()
    ]
    cells = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("cells")) for f in stamps])
    counted = read_csv(spark, path, spec.multiline).agg(*lost)
    return counted.select(F.lit(spec.name).alias("table"), F.inline(cells))


def read_series(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """A daily series file with the columns day, revenue and orders, as series_id, day, value, orders. With `named` the
    file has a series_id before them and may hold many series."""
    columns = "day date, revenue decimal(18,4), orders bigint"
    rows = spark.read.csv(path, header=True, schema=f"series_id string, {columns}" if named else columns, mode="FAILFAST")
    series = F.col("series_id") if named else F.lit("all").alias("series_id")
    return rows.select(series, "day", F.col("revenue").alias("value"), "orders")


def write_load(df: DataFrame, root: str, table: str, load: str) -> None:
    store.write_table(df, root, table, load)


def load_all(
    spark: SparkSession,
    src_dir: str,
    dst_dir: str,
    file_pattern: str = "{table}.csv",
    files: dict[str, str] | None = None,
) -> DataFrame:
    """Load the eight CSV tables into the store (an action). Returns the row counts of the batch.

    Each file is parsed once into a parquet copy in the shared folder, and the constraints of the batch are checked
    against itself and the store; of the stored rows only the keys that its filters admit are read. Then every table is
    written to a directory of this load, and last the load is published by the next manifest. Readers see published
    loads only, so a violation or a failure half-way changes nothing for them; what a failed load left is never read.
    Another load that was published meanwhile is checked too before this one can be, so two loads at once cannot
    both bring the same key.
    """
    kept, load = copies_written(), f"load-{uuid4().hex}"
    try:
        batch = {}
        for spec in SPECS:
            name = (files or {}).get(spec.name) or file_pattern.format(table=spec.name)
            batch[spec.name] = materialise(ingest(spark, spec, f"{src_dir}/{name}"), f"load-{spec.name}")
        return publish_batch(spark, batch, dst_dir, load)
    finally:
        discard_copies(spark, since=kept)


def publish_batch(spark: SparkSession, batch: dict[str, DataFrame], dst_dir: str, load: str | None = None) -> DataFrame:
    """The part of load_all after parsing, for eight frames of the declared schemas that can be read repeatedly (an action)."""
    kept, load = copies_written(), load or f"load-{uuid4().hex}"
    try:
        seen = store.newest(spark, dst_dir) or store.Manifest()
        tables = Tables(**batch)
        quality.assert_valid(quality.validate_batch(tables, store.stored_keys(spark, dst_dir, batch, seen.loads)))
        stats = store.stats_of(batch)
        for spec in SPECS:
            write_load(batch[spec.name], dst_dir, spec.name, load)
        store.write_filters(batch, stats, dst_dir, load)

        def recheck(fresh: list[store.Load]) -> None:
            if stored := store.stored_keys(spark, dst_dir, batch, fresh, references=False):
                quality.assert_valid(quality.repeated_keys(tables, stored))

        store.publish(spark, dst_dir, seen, store.added(store.Load(load, stats)), recheck)
        return spark.createDataFrame([(name, s.rows) for name, s in stats.items()], "table string, rows long")
    finally:
        discard_copies(spark, since=kept)
