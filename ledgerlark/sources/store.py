"""A store of loads: published by numbered manifests, checked by key filters, merged now and then.

    root/manifests/0000000007.json   the loads that readers see after the seventh change, all of them
    root/<table>/<load>/             the rows of one load, sorted by the table's key within each file
    root/filters/<load>/             Bloom filters of the load's keys, one row per table and block

A change writes its files first and then creates the next manifest, which fails if that number is taken. Whoever comes
second checks its rows against the loads that came in between and tries the number after. Readers take the newest
manifest once and keep its list, so what they read does not change under them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.lineage import materialise
from ledgerlark.sources.schemas import SPEC, SPECS, TableSpec

MANIFESTS, FILTERS = "manifests", "filters"
BLOCK_BITS = 1 << 15  # a block of a filter is one row of Spark's bitmap functions
KEYS_PER_BLOCK = 1 << 11  # 16 bits a key
PROBES = 6  # bits set per key: about one of 2,000 foreign keys finds all of them set


@dataclass(frozen=True)
class TableStats:
    """What a manifest tells of one table of a load: rows, blocks of its filter, ends of the first key column."""

    rows: int
    blocks: int
    low: str | None
    high: str | None


@dataclass(frozen=True)
class Load:
    name: str
    tables: dict[str, TableStats]
    number: int = 0  # the manifest that published it
    merged: tuple[tuple[int, str], ...] = ()  # number and name of the loads whose rows it took over

    def members(self) -> tuple[tuple[int, str], ...]:
        """The loads that it stands for, as they were published."""
        return self.merged or ((self.number, self.name),)

    def covers(self) -> set[str]:
        return {self.name, *(name for _, name in self.merged)}


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    loads: tuple[Load, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [load.name for load in self.loads]

    def text(self) -> str:
        return json.dumps([asdict(load) for load in self.loads])

    @staticmethod
    def parse(number: int, text: str) -> Manifest:
        loads = json.loads(text)
        return Manifest(
            number,
            tuple(
                Load(x["name"], {k: TableStats(**v) for k, v in x["tables"].items()}, x["number"], tuple((n, name) for n, name in x["merged"]))
                for x in loads
            ),
        )


# --- manifests --------------------------------------------------------------------------------------------------


def newest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest; None if the folder keeps none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    try:
        last = files.load(f"{root}/{MANIFESTS}").agg(F.max("path")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if last is None:
        return None
    number = int(last.rsplit("/", 1)[1].removesuffix(".json"))
    return Manifest.parse(number, spark.read.text(last, wholetext=True).first()[0])


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, or not at all if the name is taken. As atomic as the file system's rename without overwriting
    (HDFS: entirely). Spark's own API has no such call, so this one goes to the file system below it."""
    jvm = spark._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, target, options)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def publish(spark: SparkSession, root: str, seen: Manifest, change: Callable[[Manifest], Manifest], recheck: Callable[[list[Load]], None]) -> Manifest:
    """Make `change` to the newest list of loads the next manifest. `seen` is the manifest that the change was checked
    against; whenever others came in between, `recheck` gets their loads first and raises if the change no longer holds."""
    known = {name for load in seen.loads for name in load.covers()}
    while True:
        now = newest(spark, root) or Manifest()
        fresh = [load for load in now.loads if not {name for _, name in load.members()} <= known]
        if fresh:
            recheck(fresh)
            known |= {name for load in fresh for name in load.covers()}
        following = change(now)
        if create_file(spark, f"{root}/{MANIFESTS}/{now.number + 1:010d}.json", following.text()):
            return Manifest(now.number + 1, following.loads)


def added(load: Load) -> Callable[[Manifest], Manifest]:
    return lambda now: Manifest(now.number, (*now.loads, replace(load, number=now.number + 1)))


# --- key filters ------------------------------------------------------------------------------------------------


def _hash(keys: list[Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *keys)


def _block(keys: list[Column], blocks: Column) -> Column:
    return F.pmod(_hash(keys, -1), blocks)


def _bits(keys: list[Column]) -> list[Column]:
    return [F.pmod(_hash(keys, i), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def _keys(spec: TableSpec) -> list[Column]:
    return [F.col(k).cast("string") for k in spec.key]


def table_stats(df: DataFrame, spec: TableSpec) -> DataFrame:
    first = F.col(spec.key[0]).cast("string")
    return df.agg(F.count("*").alias("rows"), F.min(first).alias("low"), F.max(first).alias("high")).select(F.lit(spec.name).alias("table"), "*")


def stats_of(tables: dict[str, DataFrame]) -> dict[str, TableStats]:
    """The stats of eight tables in one small result."""
    frames = [table_stats(tables[spec.name], spec) for spec in SPECS]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return {r["table"]: TableStats(r["rows"], max(1, -(-r["rows"] // KEYS_PER_BLOCK)), r["low"], r["high"]) for r in whole.collect()}


def key_filter(df: DataFrame, spec: TableSpec, blocks: int) -> DataFrame:
    """(table, block, bits): PROBES bits of every key in the block that its hash names."""
    keys = _keys(spec)
    bits = df.select(_block(keys, F.lit(blocks)).alias("block"), F.explode(F.array(*_bits(keys))).alias("bit"))
    return bits.groupBy(F.lit(spec.name).alias("table"), "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def write_filters(tables: dict[str, DataFrame], stats: dict[str, TableStats], root: str, load: str) -> None:
    whole = None
    for spec in SPECS:
        if stats[spec.name].rows:
            one = key_filter(tables[spec.name], spec, stats[spec.name].blocks)
            whole = one if whole is None else whole.union(one)
    if whole is not None:
        whole.select(F.lit(load).alias("load"), "*").write.parquet(f"{root}/{FILTERS}/{load}")


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def probes(batch: dict[str, DataFrame], specs: Iterable[TableSpec] = SPECS, references: bool = True) -> DataFrame:
    """(table, key): the distinct keys of each table that the batch adds or refers to."""
    out = []
    for spec in specs:
        out.append(batch[spec.name].select(F.lit(spec.name).alias("table"), F.array(*_keys(spec)).alias("key")))
        for column, (parent, _) in spec.references.items() if references else ():
            value = F.col(column).cast("string")
            own = batch[spec.name].where(value.isNotNull())
            out.append(own.select(F.lit(parent).alias("table"), F.array(value).alias("key")))
    whole = out[0]
    for one in out[1:]:
        whole = whole.union(one)
    return whole.distinct()


def possible_keys(spark: SparkSession, root: str, wanted: DataFrame, loads: Iterable[Load]) -> DataFrame:
    """(table, key, load): the wanted keys that a load may hold, by its key range and its filter. None that it does hold is missing."""
    loads = list(loads)
    known = [
        (table, load.name, s.blocks, s.low, s.high) for load in loads for table, s in load.tables.items() if s.rows and s.low is not None
    ]
    ends = spark.createDataFrame(known, "table string, load string, blocks long, low string, high string")  # eight small rows per load
    first = F.col("key")[0]
    near = wanted.join(F.broadcast(ends), "table").where((first >= F.col("low")) & (first <= F.col("high")))
    folders = [f"{root}/{FILTERS}/{load.name}" for load in loads if any(s.rows for s in load.tables.values())]
    if not folders:
        return near.select("table", "key", "load")
    sizes = sorted({len(spec.key) for spec in SPECS})

    def of_size(make: Callable[[list[Column]], Column]) -> Column:
        """An expression of a key's columns, by how many it has."""
        cases = [(F.size("key") == n, make([F.get("key", F.lit(i)) for i in range(n)])) for n in sizes]
        out = F.when(*cases[0])
        for case in cases[1:]:
            out = out.when(*case)
        return out

    placed = near.withColumn("block", of_size(lambda keys: _block(keys, F.col("blocks"))))
    for i in range(PROBES):
        placed = placed.withColumn(f"bit{i}", of_size(lambda keys, i=i: _bits(keys)[i]))
    filters = spark.read.schema("load string, table string, block long, bits binary").parquet(*folders)
    met = placed.join(filters, ["table", "load", "block"])
    for i in range(PROBES):
        met = met.where(_is_set(F.col("bits"), F.col(f"bit{i}")))
    return met.select("table", "key", "load")


def stored_keys(spark: SparkSession, root: str, batch: dict[str, DataFrame], loads: Iterable[Load], references: bool = True) -> dict[str, DataFrame]:
    """The stored keys among those that the batch adds or refers to, of every table that may hold some (an action).

    Only loads whose range and filter admit a key are read, by their key columns; the keys that are asked for are
    joined to them, so a filter's false alarms are found out.
    """
    loads = list(loads)
    if not loads:
        return {}
    candidates = materialise(possible_keys(spark, root, probes(batch, references=references), loads), "candidates")
    where: dict[str, list[str]] = {}
    for row in candidates.groupBy("table", "load").count().collect():  # at most eight rows per load
        where.setdefault(row["table"], []).append(row["load"])
    return {table: confirmed(spark, root, candidates, table, names) for table, names in where.items()}


def confirmed(spark: SparkSession, root: str, candidates: DataFrame, table: str, names: list[str]) -> DataFrame:
    """The key columns of those candidates that the loads do hold."""
    spec = SPEC[table]
    schema = T.StructType([spec.schema[k] for k in spec.key])
    held = spark.read.schema(schema).parquet(*[f"{root}/{table}/{name}" for name in sorted(names)])
    asked = candidates.where(F.col("table") == table)
    asked = asked.select(*[F.col("key")[i].cast(spec.schema[k].dataType).alias(k) for i, k in enumerate(spec.key)])
    return held.join(asked.distinct(), list(spec.key), "left_semi")


# --- merging ----------------------------------------------------------------------------------------------------


def write_table(df: DataFrame, root: str, table: str, load: str) -> None:
    """The rows of one load, sorted by key inside each file, so that a search for keys reads few pages."""
    df.sortWithinPartitions(*SPEC[table].key).write.parquet(f"{root}/{table}/{load}")


def compact(spark: SparkSession, root: str, small: int = 1_000_000) -> Manifest | None:
    """Merge the loads of fewer than `small` rows into one and publish it in their place (an action).

    The merged loads' files stay, so readers of older manifests are not disturbed. Nothing happens with fewer than two such
    loads. If another merge was first, this one gives up; loads that came in between stay as they are.
    """
    now = newest(spark, root)
    few = [] if now is None else [load for load in now.loads if sum(s.rows for s in load.tables.values()) < small]
    if len(few) < 2:
        return now
    name, names = f"load-{uuid4().hex}", [load.name for load in few]
    tables = {
        spec.name: spark.read.schema(spec.schema).parquet(*[f"{root}/{spec.name}/{n}" for n in names]) for spec in SPECS
    }
    for spec in SPECS:
        write_table(tables[spec.name], root, spec.name, name)
    tables = {spec.name: spark.read.schema(spec.schema).parquet(f"{root}/{spec.name}/{name}") for spec in SPECS}
    stats = stats_of(tables)
    write_filters(tables, stats, root, name)
    merged = Load(name, stats, max(load.number for load in few), tuple(sorted(m for load in few for m in load.members())))

    def change(current: Manifest) -> Manifest:
        if not set(names) <= set(current.names):
            raise RuntimeError("another merge has replaced these loads")
        at = current.names.index(names[0])
        kept = [load for load in current.loads if load.name not in names]
        return Manifest(current.number, (*kept[:at], merged, *kept[at:]))

    return publish(spark, root, now, change, lambda fresh: None)
