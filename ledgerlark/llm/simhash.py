"""SimHash fingerprints and the search for all within a Hamming radius.

The terms of a text are its pairs of neighbouring words; each votes, with a weight that grows with the logarithm of its
count, for or against every bit of the fingerprint. For the search the fingerprint is cut into blocks; whichever bits
differ, some blocks agree, so each choice of that many blocks is a table keyed by them in front, and fingerprints meet
where a key is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import Words, blocks_for, shingle_sets, slices, small_batches
from ledgerlark.operators.lineage import materialise

BITS = 64
RANGE_BYTES = 16 << 20
SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1  # byte -> its 8 votes


def fingerprints(column: pa.Array, words: Words) -> np.ndarray:
    """A 64-bit fingerprint for every text; a text without words has 0."""
    keys, first, _, _ = words(column)
    terms, starts = shingle_sets(keys, first, 2)
    out = np.zeros(len(starts) - 1, dtype=np.uint64)
    for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        if b == a:
            continue
        one = np.sort(terms[a:b])
        begin = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1], [True]]))
        weight, distinct = 1 + np.log(np.diff(begin)), one[begin[:-1]].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes = [np.bincount(distinct[:, byte], weights=weight, minlength=256) @ SIGNS for byte in range(8)]
        out[i] = np.packbits(np.concatenate(votes) > 0).view(">u8")[0]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b) / BITS


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many first characters of the next one, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


ROW = "doc_id {id}, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str], words: Words) -> pa.RecordBatch:
    """The result rows of texts with the texts that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, other, after = (fingerprints(pa.array(x, pa.large_string()), words) for x in (texts, changed, following))
    columns = [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(own.view(np.int64)),
        pa.array(other.view(np.int64)),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, after)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"])


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row compared with its own edited text and with the next row by descending id (an action).

    Rows are range-partitioned and sorted once. A task pairs the neighbours it holds, and hands on its first and last
    row; the last row of each partition then meets the first row of the next one, and the very last the very first.
    """
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(blocks_for(rows, "text", RANGE_BYTES), *order).sortWithinPartitions(*order)
    schema = ROW.format(id=rows.schema["doc_id"].dataType.simpleString())
    wide = f"part int, edge string, {schema}, text string"

    def pair(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, held = Words(), TaskContext.get().partitionId(), None

        def edge(name: str, row: pa.RecordBatch, like: pa.RecordBatch) -> pa.RecordBatch:
            columns = [pa.array([at], pa.int32()), pa.array([name]), row.column("doc_id")]
            columns += [pa.nulls(1, f.type) for f in list(like.schema)[1:]] + [row.column("text").cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["part", "edge", *like.schema.names, "text"])

        empty = _compared(pa.nulls(0, pa.int64()), [], [], words)
        for part in parts:
            for piece in slices(part, "text"):
                ids, texts = piece.column("doc_id"), piece.column("text").to_pylist()
                if held is None:
                    yield edge("first", piece.slice(0, 1), empty)
                else:
                    ids, texts = pa.concat_arrays([held.column("doc_id"), ids]), [held.column("text")[0].as_py(), *texts]
                done = _compared(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:], words)
                n = done.num_rows
                columns = [pa.array(np.full(n, at, np.int32)), pa.nulls(n, pa.string()), *done.columns, pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "edge", *done.schema.names, "text"])
                held = piece.slice(piece.num_rows - 1, 1)
        if held is not None:
            yield edge("last", held, empty)

    found = materialise(ordered.mapInArrow(pair, wide), "fingerprints")
    inner = found.where("edge is null").drop("part", "edge", "text")
    first = found.where("edge = 'first'").select("part", F.col("text").alias("following"))
    along = Window.orderBy("part")  # one row per partition, without its text
    places = first.select("part").withColumn("after", F.lead("part").over(along)).withColumn("start", F.min("part").over(Window.partitionBy()))
    last = found.where("edge = 'last'").select("part", "doc_id", "text").join(places, "part")
    borders = last.join(first.withColumnRenamed("part", "next"), F.coalesce("after", "start") == F.col("next"))

    def close(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part in parts:
            yield _compared(part.column("doc_id"), part.column("text").to_pylist(), part.column("following").to_pylist(), words)

    return inner.union(borders.select("doc_id", "text", "following").mapInArrow(close, schema))


def _masks(radius: int, blocks: int) -> list[int]:
    """For every choice of blocks - radius blocks, the bits they cover, as signed 64-bit numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    of = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [sum(c) for c in combinations(of, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def within_radius(queries: DataFrame, known: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs (fp, near) of a fingerprint of `queries` and one of `known` that differ in at most `radius` bits.

    Both are frames of one column fp; equal fingerprints are taken once. `blocks` > radius; more blocks give more
    tables with longer keys.
    """
    masks = F.array(*[F.lit(m) for m in _masks(radius, blocks)])
    tables = F.sequence(F.lit(1), F.lit(len(_masks(radius, blocks))))
    key = F.col("fp").bitwiseAND(F.element_at(masks, F.col("table")))
    side = lambda df: df.where("fp is not null").distinct().select("fp", F.explode(tables).alias("table")).withColumn("key", key)
    pairs = side(queries).join(side(known).withColumnRenamed("fp", "near"), ["table", "key"])
    return pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("near"))) <= radius).select("fp", "near").distinct()


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def simhash(docs: DataFrame, radius: int = 3, every: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within) of every row
    (an action).

    n_within is given for the rows whose id is divisible by `every`: how many other rows have a fingerprint within
    `radius` bits. A null text is empty; texts without words share the fingerprint 0. Null ids come last, rows of equal
    ids are ordered by their text's hash. With one row the next row is itself. Other columns are ignored. An empty
    table gives an empty result.
    """
    found = materialise(with_next(docs, doc_id, text), "simhash")
    sizes = found.groupBy("fp").agg(F.count("*").alias("rows"))
    asked = found.where(F.col("doc_id") % every == 0).select("fp")
    near = within_radius(asked, found.select("fp"), radius).join(sizes.withColumnRenamed("fp", "near"), "near")
    near = materialise(near.groupBy("fp").agg((F.sum("rows") - 1).alias("within")), "within")
    is_query = F.col("doc_id") % every == 0
    joined = found.join(near.withColumnRenamed("fp", "of"), is_query & (F.col("fp") == F.col("of")), "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _hex("fp").alias("fingerprint"),
        _hex("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.col("within").alias("n_within"),
    )
