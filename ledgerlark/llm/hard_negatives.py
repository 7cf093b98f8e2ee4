"""Hard negatives by exact integer scores from packed products.

Components become integers. Several candidates' components, biased to be non-negative, are put into separated fields of
one wide integer, so that one multiplication by an anchor's (biased) component serves all of them, and the sum over the
components holds their exact scores in its fields. Fields are as wide as the largest sum of the cell needs. While a field fits
into the 53 bits that a double holds exactly, doubles carry the wide integers and the matrix library multiplies; wider
components go through integers of any length.

Anchors meet all rows in cells of a block of anchors and a block of rows; what a cell finds is cut to the few best before it
travels. First the positives are found among rows of the same label, then the negatives by the positives' scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.lineage import materialise

CELL_ROWS, CELL_ANCHORS = 1 << 16, 1 << 14  # the most rows and anchors of a cell, on average
CELL_BYTES = 64 << 20  # and the most bytes of their components
SPREAD = 64  # small tables are dealt over up to so many cells, of SMALL rows each
SMALL = 1 << 12
BUCKETS = 16  # labels are hashed to so many groups of cells when positives are looked for
TILE = 1 << 22  # scores in memory at a time
EXACT = 53  # bits of an integer that a double holds
LIMIT = 2**63 - 1


def integers(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): as doubles where they hold it exactly, else as integers of any length."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat.astype(np.float64) * scale)
    if not len(scaled) or np.abs(scaled).max() < 2.0**EXACT:
        return scaled
    exact = [math.floor(v) if math.isfinite(v) else int(x) * scale for v, x in zip(scaled.tolist(), flat.tolist(), strict=True)]
    return np.array(exact, dtype=object)


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products of two matrices of integers as 64-bit integers; what is beyond them becomes the nearest end."""
    k = anchors.shape[1]
    if not k or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    shift_a, shift_c = int(np.abs(anchors).max()), int(np.abs(rows).max())  # the biases
    bits = max(1, (4 * k * shift_a * shift_c).bit_length())
    fields = EXACT // bits
    if not fields or anchors.dtype == object or rows.dtype == object:
        return _wide_products(anchors, rows, shift_a, shift_c, bits)
    each = -(-len(rows) // fields)
    biased = np.zeros((each * fields, k))
    biased[: len(rows)] = rows + shift_c
    wide = np.zeros((each, k))
    for f in range(fields):
        wide += biased[f * each : (f + 1) * each] * 2.0 ** (bits * f)
    sums = ((anchors + shift_a) @ wide.T).astype(np.int64)
    out = np.empty((len(anchors), each * fields), dtype=np.int64)
    for f in range(fields):
        out[:, f * each : (f + 1) * each] = (sums >> (bits * f)) & ((1 << bits) - 1)
    out = out[:, : len(rows)]
    out -= (shift_c * anchors.sum(axis=1)).astype(np.int64)[:, None] + k * shift_a * shift_c
    out -= (shift_a * rows.sum(axis=1)).astype(np.int64)
    return out


def _wide_products(anchors: np.ndarray, rows: np.ndarray, shift_a: int, shift_c: int, bits: int) -> np.ndarray:
    """The same with one integer for all rows: a field is a whole number of bytes."""
    size, k = bits // 8 + 1, anchors.shape[1]
    own, others = ([[int(x) for x in row] for row in m.tolist()] for m in (anchors, rows))
    wide = [int.from_bytes(b"".join((row[j] + shift_c).to_bytes(size, "little") for row in others), "little") for j in range(k)]
    sums = [sum(row) for row in others]
    out = np.empty((len(own), len(others)), dtype=np.int64)
    for i, anchor in enumerate(own):
        total = sum((x + shift_a) * w for x, w in zip(anchor, wide, strict=True)).to_bytes(size * len(others), "little")
        base = shift_c * sum(anchor) + k * shift_a * shift_c
        for j, s in enumerate(sums):
            score = int.from_bytes(total[j * size : (j + 1) * size], "little") - base - shift_a * s
            out[i, j] = max(-LIMIT, min(LIMIT, score))
    return out


class _Side:
    """One side of a cell: rows in the order of their ids (null last), with their vectors by length."""

    def __init__(self, table: pa.Table, scale: int) -> None:
        table = table.sort_by([("vec_id", "ascending"), ("at", "ascending")]).combine_chunks()
        self.table, self.n = table, table.num_rows
        self.at = table.column("at").to_numpy()
        self.labels = table.column("label")
        vectors = table.column("vector").combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) and vectors.num_chunks else vectors
        starts = vectors.offsets.to_numpy() if self.n else np.zeros(1, dtype=np.int32)
        flat = vectors.values.to_numpy(zero_copy_only=False) if self.n else np.zeros(0)
        size = np.diff(starts)
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []  # places and matrix of the vectors of one length
        for length in np.unique(size).tolist():
            places = np.flatnonzero(size == length)
            values = integers(flat[(starts[places][:, None] + np.arange(length)).ravel()], scale)
            self.groups.append((places, values.reshape(len(places), length)))


def _tiles(anchors: _Side, rows: _Side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of some anchors, their scores with all rows); missing components of the shorter vector count as 0."""
    step = max(1, TILE // max(rows.n, 1))
    for places, matrix in anchors.groups:
        for i in range(0, len(places), step):
            part = matrix[i : i + step]
            scores = np.empty((len(part), rows.n), dtype=np.int64)
            for columns, others in rows.groups:
                k = min(part.shape[1], others.shape[1])
                scores[:, columns] = packed_products(part[:, :k], others[:, :k])
            yield places[i : i + step], scores


def _best(scores: np.ndarray, columns: np.ndarray, k: int) -> np.ndarray:
    """The k of the columns (ascending) with the highest scores, highest first, equal ones in the order of columns."""
    own = scores[columns]
    if len(columns) > k:
        least = np.partition(own, len(own) - k)[len(own) - k]
        above = columns[own > least]
        columns = np.concatenate([above, columns[own == least][: k - len(above)]])
        own = scores[columns]
    return columns[np.lexsort((columns, -own))]


def _codes(anchors: _Side, rows: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Labels of both sides as numbers that are equal for equal labels."""
    both = pa.chunked_array([*anchors.labels.chunks, *rows.labels.chunks], type=rows.labels.type)
    codes = pc.rank(both, tiebreaker="min").to_numpy()
    return codes[: anchors.n], codes[anchors.n :]


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchors` holds.

    Every component x becomes floor(scale * x); a score is the integer inner product with the anchor. An anchor's positives are its
    first `positives` other rows of the same label, highest score first, then smaller id. For each of them come the first `negatives`
    rows of another label whose score s keeps low * p <= 100 * s <= high * p, p being the positive's score.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A null id comes last among ties; such a row
    is an anchor only if `anchors` says so. Rows with equal ids are rows of their own, repeated rows too, so an anchor's copy may be
    its positive. Vectors of different lengths are compared as if the shorter one ended in zeros. Scores beyond 64 bits
    count as the nearest 64-bit number. An anchor without positives, or a positive without negatives, has no rows. Other
    columns are ignored; an empty table gives an empty result.
    """
    element = vectors.schema[embedding].dataType.elementType.simpleString()
    vector = F.col(embedding) if element == "float" else F.col(embedding).cast("array<double>")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), vector.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    )
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = materialise(rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.coalesce(F.sum(F.size("vector").cast("long")), F.lit(0)).alias("components")
    ).first()
    bytes_of_rows = 8 * size["components"]
    row_blocks = max(-(-size["n"] // CELL_ROWS), min(SPREAD, -(-size["n"] // SMALL)), -(-bytes_of_rows // CELL_BYTES), 1)
    anchor_blocks = max(-(-size["anchors"] // CELL_ANCHORS), -(-(bytes_of_rows * size["anchors"] // max(size["n"], 1)) // CELL_BYTES), 1)

    def dealt(df: DataFrame, blocks: int, to: int, name: str, other: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        own = F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int").alias(name)
        return df.select("*", own, F.explode(F.sequence(F.lit(0), F.lit(to - 1))).alias(other))

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            own, others = _Side(left, scale), _Side(right, scale)
            mine, theirs = _codes(own, others)
            ids = others.table.column("vec_id").to_pylist()
            for places, scores in _tiles(own, others):
                for place, line in zip(places.tolist(), scores, strict=True):
                    fitting = np.flatnonzero((theirs == mine[place]) & (others.at != own.at[place]))
                    best = _best(line, fitting, positives)
                    out[0] += [own.at[place]] * len(best)
                    out[1] += [ids[j] for j in best.tolist()]
                    out[2] += others.at[best].tolist()
                    out[3] += line[best].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["anchor_at", "positive_id", "positive_at", "positive_score"])

    bucket = F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).alias("bucket")
    ours = rows.where("anchor").toDF(*rows.columns)  # attributes of its own, apart from those of the rows it meets
    keep = ours.withColumn("bucket", bucket)
    groups = -(-row_blocks // 4)  # fewer blocks of rows, as each is dealt over the buckets
    found = (
        dealt(keep, anchor_blocks, groups, "a", "c").groupBy("bucket", "a", "c")
        .cogroup(dealt(rows.withColumn("bucket", bucket), groups, anchor_blocks, "c", "a").groupBy("bucket", "a", "c"))
        .applyInArrow(find_positives, "anchor_at long, positive_id long, positive_at long, positive_score long")
    )
    first = Window.partitionBy("anchor_at").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_at")
    chosen = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    listed = chosen.groupBy("anchor_at").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    listed = materialise(listed, "positives")
    pairs = ours.join(listed, F.col("at") == F.col("anchor_at")).drop("anchor_at")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], [], []]
        if left.num_rows and right.num_rows:
            own, others = _Side(left, scale), _Side(right, scale)
            mine, theirs = _codes(own, others)
            ids, anchor_ids = others.table.column("vec_id").to_pylist(), own.table.column("vec_id").to_pylist()
            given = own.table.column("positives").to_pylist()
            for places, scores in _tiles(own, others):
                for place, line in zip(places.tolist(), scores, strict=True):
                    ends = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in given[place]]
                    inside = (line >= min(a for a, _ in ends)) & (line <= max(b for _, b in ends)) & (theirs != mine[place])
                    fitting = np.flatnonzero(inside)
                    for p, (a, b) in zip(given[place], ends, strict=True):
                        own_scores = line[fitting]
                        best = _best(line, fitting[(own_scores >= a) & (own_scores <= b)], negatives)
                        n = len(best)
                        out[0] += [own.at[place]] * n
                        out[1] += [anchor_ids[place]] * n
                        out[2] += [p["place"]] * n
                        out[3] += [p["positive_id"]] * n
                        out[4] += [p["positive_score"]] * n
                        out[5] += [ids[j] for j in best.tolist()]
                        out[6] += line[best].tolist()
        names = ["anchor_at", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(x, pa.int64()) for x in out], names=names)

    met = (
        dealt(pairs, anchor_blocks, row_blocks, "a", "c").groupBy("a", "c")
        .cogroup(dealt(rows, row_blocks, anchor_blocks, "c", "a").groupBy("a", "c"))
        .applyInArrow(
            find_negatives,
            "anchor_at long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
        )
    )
    order = Window.partitionBy("anchor_at", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
