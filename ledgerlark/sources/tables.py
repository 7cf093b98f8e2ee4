"""The eight logical tables as one value that every plan takes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.sources.schemas import SPEC
from ledgerlark.sources.store import newest


class Tables:
    """customers, orders, order_items, products, product_category_translation, sellers, order_payments, order_reviews.

    A table is given as a DataFrame, or as a function that opens it on first use, so that a plan only touches the
    files of the tables it names.
    """

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        if sources.keys() != SPEC.keys():
            raise ValueError(f"expected the tables {sorted(SPEC)}, got {sorted(sources)}")
        self._sources = sources

    def __getitem__(self, name: str) -> DataFrame:
        source = self._sources[name]
        if not isinstance(source, DataFrame):
            self._sources[name] = source = source()
        return source

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(name)
        return self[name]

    def items(self):
        return [(name, self[name]) for name in self._sources]


def read_tables(spark: SparkSession, root: str) -> Tables:
    """Open a store: one parquet directory per table, schemas declared rather than read from footers.

    A store that load_all has written keeps one directory per load under each table, and only the loads of its newest
    manifest are read; any other store is read whole.
    """
    manifest = newest(spark, root)
    loads = None if manifest is None else manifest.names

    def table(name: str) -> DataFrame:
        paths = [f"{root}/{name}"] if loads is None else [f"{root}/{name}/{load}" for load in loads]
        schema = SPEC[name].schema
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    return Tables(**{name: table(name) for name in SPEC})


def save_bucketed(tables: Tables, database: str, buckets: int) -> dict[str, DataFrame]:
    """Write orders, items and payments bucketed and sorted on order_id as catalog tables.

    The order-level joins and the per-order aggregates of the plans then read matching buckets and skip the
    exchange of the largest tables. Takes the place of the secondary indexes a row store would keep for these joins.
    """
    spark = tables.orders.sparkSession
    out = {}
    for name in ("orders", "order_items", "order_payments"):
        table = f"{database}.{name}"
        (
            tables[name]
            .repartition(buckets, "order_id")
            .write.mode("overwrite")
            .bucketBy(buckets, "order_id")
            .sortBy("order_id")
            .saveAsTable(table)
        )
        out[name] = spark.table(table)
    return out
