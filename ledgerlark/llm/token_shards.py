"""Token ids of all documents as wavelet matrices, one compressed file per shard.

Documents are range-partitioned by id and sorted; every task encodes its range and closes a shard whenever it holds
SHARD_TOKENS ids. A shard is one Parquet file of one row: its place in the order, its documents and their starts, and
the packed bit-planes with their rank counts. Readers get tokens, counts and occurrences from that file alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import blocks_for, small_batches
from ledgerlark.llm.wavelet import WaveletMatrix
from ledgerlark.llm.wordpieces import Encoder, word_wise
from ledgerlark.operators.lineage import materialise

RANGE_BYTES = 64 << 20  # text per range of documents
SHARD_TOKENS = 1 << 21
SHARD = (
    "range int, shard int, n_tokens long, doc_ids array<long>, starts array<long>, symbols binary, zeros array<long>, "
    "bits array<binary>, ones array<binary>"
)


class _Shard:
    """The ids of consecutive documents until they become one row."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.starts: list[int] = []
        self.ids: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray) -> None:
        self.ids.append(ids.astype(np.uint32))
        self.n += len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        matrix = WaveletMatrix.build(np.concatenate([np.zeros(0, np.uint32), *self.ids]))
        columns = [
            pa.array([TaskContext.get().partitionId()], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([self.n], pa.int64()),
            pa.array([self.docs], pa.list_(pa.int64())),
            pa.array([self.starts], pa.list_(pa.int64())),
            pa.array([matrix.symbols.astype("<u4").tobytes()], pa.binary()),
            pa.array([matrix.zeros], pa.list_(pa.int64())),
            pa.array([[b.tobytes() for b in matrix.bits]], pa.list_(pa.binary())),
            pa.array([[o.astype("<u4").tobytes() for o in matrix.ones]], pa.list_(pa.binary())),
        ]
        names = ["range", "shard", "n_tokens", "doc_ids", "starts", "symbols", "zeros", "bits", "ones"]
        return pa.RecordBatch.from_arrays(columns, names)


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode all documents in ascending id order, `end_id` after each, and write the shards to `path` (an action).

    A null text is empty: its document is the end id alone. Null ids come first; rows with equal ids follow each other
    by text. A document of any length stays in one shard. An empty table writes no shard. Other columns are ignored.
    """
    by_word = word_wise(tokenizer)
    rows = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(blocks_for(rows, "text", RANGE_BYTES), "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], dtype=np.uint32)

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, number = Encoder(tokenizer, by_word), _Shard(), 0
        for part in parts:
            ids = part.column("doc_id").to_pylist()
            at = 0
            for n, tokens in own.tokens(part.column("text")):
                done = 0
                for k in n.tolist():
                    if shard.n >= SHARD_TOKENS:
                        yield shard.row(number)
                        shard, number = _Shard(), number + 1
                    shard.docs.append(ids[at])
                    shard.starts.append(shard.n)
                    shard.add(tokens[done : done + k])
                    shard.add(end)
                    done, at = done + k, at + 1
        if shard.docs:
            yield shard.row(number)

    written = ordered.mapInArrow(encode, SHARD).write.option("maxRecordsPerFile", 1).option("compression", "zstd")
    written.mode("error").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def matrices(part: pa.RecordBatch) -> Iterator[tuple[dict, WaveletMatrix]]:
    """The shards of an Arrow batch, one after the other."""
    for i in range(part.num_rows):
        row = {name: part.column(name)[i] for name in part.schema.names}
        yield (
            {k: row[k].as_py() for k in ("range", "shard", "n_tokens", "doc_ids", "starts") if k in row},
            WaveletMatrix(
                row["n_tokens"].as_py(),
                np.frombuffer(row["symbols"].as_buffer(), dtype="<u4"),
                row["zeros"].as_py(),
                [np.frombuffer(b.as_buffer(), dtype=np.uint8) for b in row["bits"].values],
                [np.frombuffer(b.as_buffer(), dtype="<u4") for b in row["ones"].values],
            ),
        )


def shard_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(range, shard, before): ids in all earlier shards. Ranges are summed first, so no window sees every shard."""
    shards = read_shards(spark, path).select("range", "shard", "n_tokens")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shards.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("range_before"))
    inside = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = shards.withColumn("in_range", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(ranges, "range").select("range", "shard", (F.col("range_before") + F.col("in_range")).alias("before"))


def _per_shard(spark: SparkSession, path: str, of: Callable, schema: str, where=None) -> DataFrame:
    rows = read_shards(spark, path)
    return (rows if where is None else rows.where(where)).mapInArrow(of, schema)


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files: where its ids begin among all,
    how many they are with the end id, and the unsigned crc32 of the ids as little-endian 32-bit integers."""

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, matrix in matrices(part):
                ids = matrix.decode().astype("<u4")
                starts = np.array([*row["starts"], row["n_tokens"]])
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                columns = [
                    pa.array(np.full(len(crc), row["range"], np.int32)),
                    pa.array(np.full(len(crc), row["shard"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts[:-1]),
                    pa.array(np.diff(starts)),
                    pa.array(crc, pa.int64()),
                ]
                names = ["range", "shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names)

    decoded = _per_shard(
        spark, path, decode, "range int, shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long"
    )
    offsets = materialise(shard_offsets(spark, path), "shard-offsets")
    start = (F.col("before") + F.col("in_shard")).alias("start")
    return decoded.join(offsets, ["range", "shard"]).select("doc_id", start, "n_tokens", "ids_crc32")


def token_totals(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences of the given tokens, from rank alone; a token that is nowhere has n = 0."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, matrix in matrices(part):
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array([matrix.count(t) for t in tokens])], ["token", "n"])

    wanted = spark.createDataFrame([(t, 0) for t in tokens], "token long, n long")
    found = _per_shard(spark, path, count, "token long, n long").union(wanted)
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, position): every occurrence of a token, by its place inside the document, from select."""

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, matrix in matrices(part):
                at, starts = matrix.positions(token), np.array(row["starts"])
                doc = np.searchsorted(starts, at, "right") - 1
                ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids, pa.array(at - starts[doc])], ["doc_id", "position"])

    return _per_shard(spark, path, find, "doc_id long, position long")


def tokens_at(spark: SparkSession, path: str, doc_id: int, first: int, last: int) -> DataFrame:
    """(position, token) for positions first..last of one document, by access; reads only shards that hold it."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, matrix in matrices(part):
                starts = [*row["starts"], row["n_tokens"]]
                for i in (i for i, d in enumerate(row["doc_ids"]) if d == doc_id):
                    where = range(starts[i] + first, min(starts[i] + last + 1, starts[i + 1]))
                    columns = [pa.array([p - starts[i] for p in where], pa.int64()), pa.array([matrix.access(p) for p in where], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["position", "token"])

    holds = F.array_contains("doc_ids", F.lit(doc_id).cast("long"))
    return _per_shard(spark, path, read, "position long, token long", holds)
