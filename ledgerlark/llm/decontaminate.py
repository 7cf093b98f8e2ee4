"""Training passages that copy benchmark items, found by rare n-gram seeds and scored by local alignment.

Items are cut into pieces of at most PIECE words. The texts are read once: wherever an n-gram of a piece occurs, the
surrounding window of words is written out with the piece's n-grams it holds. How many windows of the whole corpus hold
an n-gram tells the rare ones from the common ones; windows joined by a rare one are aligned with their piece. Words are lower case, and parted by white space and ASCII
punctuation, so that marks and capitals do not hide a copy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import PUNCTUATED, Words, grams, slices, small_batches, text_key
from ledgerlark.operators.lineage import materialise

PARTING = "[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+"
MASK = np.uint64((1 << 20) - 1)


@dataclass(frozen=True)
class Leaks:
    """An item shorter than `least` words is looked for as a whole: every word in its order, and shorter than `n` words only as the
    whole of a text, because such words stand in any text. An n-gram is rare if it is no more frequent than the
    median of its piece, or occurs in at most `rare` windows. Scores: match 2, mismatch -1, gap -1; a passage is a copy
    if it reaches `share` of its piece's full score, or the full score of `long` words."""

    n: int = 3
    least: int = 8
    piece: int = 400
    rare: int = 10
    share: float = 0.6
    long: int = 25
    block_words: int = 400_000  # of benchmark text looked for in one pass over the texts


def pieces_of(benchmark: DataFrame, how: Leaks, item_id: str, text: str) -> DataFrame:
    """(item_id, piece, words): the benchmark in pieces; a last piece shorter than `least` joins the one before."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), PARTING), lambda w: w != "")
    n = F.size("words")
    count = F.greatest(F.floor((n - how.least) / how.piece) + 1, F.lit(1))
    cut = F.sequence(F.lit(0), count.cast("int") - 1)
    return (
        benchmark.select(F.col(item_id).alias("item_id"), words.alias("words"))
        .where(n >= how.n)
        .select("item_id", "words", count.alias("pieces"), F.explode(cut).alias("piece"))
        .select(
            "item_id",
            "piece",
            F.slice("words", F.col("piece") * how.piece + 1, F.when(F.col("piece") + 1 == F.col("pieces"), F.size("words")).otherwise(how.piece)).alias("words"),
        )
    )


class Seeds:
    """The n-grams of a block of pieces, ready to be looked up."""

    def __init__(self, pieces: list[list[str]], n: int) -> None:
        keys, first, _, _ = Words(PUNCTUATED)(pc.utf8_lower(pa.array([" ".join(p) for p in pieces], pa.string())))
        found, starts = grams(keys, first, n)
        piece = np.repeat(np.arange(len(pieces)), np.diff(starts))
        order = np.argsort(found, kind="stable")
        self.keys, self.piece, self.at = found[order], piece[order], (np.arange(len(found)) - starts[:-1][piece])[order]
        self.length = np.diff(first)
        self.some = np.zeros(int(MASK) + 1, dtype=bool)
        self.some[self.keys & MASK] = True

    def hits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every occurrence of a piece's n-gram: place in `found`, piece, place in the piece."""
        maybe = np.flatnonzero(self.some[found & MASK])
        low, high = (np.searchsorted(self.keys, found[maybe], side) for side in ("left", "right"))
        n = high - low
        of = np.arange(n.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else np.zeros(0, np.int64)
        return np.repeat(maybe, n), self.piece[of], self.at[of]


def _windows(texts: pa.Array, seeds: Seeds, words: Words, n: int) -> list[tuple]:
    """(row, piece, n-grams of the piece, first byte, last byte) of every window around hits."""
    keys, first, begins, ends = words(texts)
    found, starts = grams(keys, first, n)
    place, piece, at = seeds.hits(found)
    row = np.searchsorted(starts, place, "right") - 1
    position = place - starts[row]
    start = position - at  # where the piece would begin in the text
    order = np.lexsort((start, piece, row))
    row, piece, at, start = row[order], piece[order], at[order], start[order]
    length, out, i = seeds.length, [], 0
    same = np.concatenate([(row[1:] == row[:-1]) & (piece[1:] == piece[:-1]), [False]]) if len(row) else []
    while i < len(row):
        long, j = int(length[piece[i]]), i + 1
        while j < len(row) and same[j - 1] and start[j] - start[j - 1] <= long and start[j] - start[i] <= 2 * long:
            j += 1
        slack = long // 4 + 2
        low = max(int(start[i]) - slack, 0)
        high = min(int(start[j - 1]) + long + slack, int(first[row[i] + 1] - first[row[i]]))
        base = int(first[row[i]])
        out.append((int(row[i]), int(piece[i]), sorted(set(at[i:j].tolist())), int(begins[base + low]), int(ends[base + high - 1])))
        i = j
    return out


def align(piece: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of one piece with each of many windows (rows of word numbers, padded with -1).

    Row by row of the piece; a gap of any length within a row is a running maximum, because gaps cost 1 a word.
    """
    n, width = windows.shape
    along = np.arange(width, dtype=np.int32)
    above = np.zeros((n, width + 1), dtype=np.int32)
    best = np.zeros(n, dtype=np.int32)
    for word in piece:
        step = np.where(windows == word, 2, -1).astype(np.int32)
        here = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] - 1), 0)
        here = np.maximum.accumulate(here + along, axis=1) - along
        above = np.concatenate([np.zeros((n, 1), dtype=np.int32), here], axis=1)
        best = np.maximum(best, here.max(axis=1, initial=0))
    return best


def _scores(pieces: list[list[str]], windows: list[list[str]]) -> list[int]:
    """Alignment scores of pairs; pairs with the same piece are aligned together."""
    number: dict[str, int] = {}
    code = lambda words: [number.setdefault(w, len(number)) for w in words]
    together: dict[tuple, list[int]] = {}
    for k, piece in enumerate(pieces):
        together.setdefault(tuple(code(piece)), []).append(k)
    out = [0] * len(pieces)
    for piece, members in together.items():
        members = sorted(members, key=lambda k: len(windows[k]))
        for at in range(0, len(members), 256):
            some = members[at : at + 256]
            table = np.full((len(some), max(1, max(len(windows[k]) for k in some))), -1, dtype=np.int32)
            for r, k in enumerate(some):
                table[r, : len(windows[k])] = code(windows[k])
            for k, score in zip(some, align(np.array(piece), table).tolist(), strict=True):
                out[k] = score
    return out


WINDOW = "text_key long, doc_id {id}, piece_no int, grams array<int>, passage string"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    how: Leaks = Leaks(),
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(text_key, doc_id, item_id, score, share, passage) for every document and item of which it holds a copy.

    score is the best alignment score, share its part of the item piece's full score, passage the words aligned. Null
    and empty texts and items without words give no row; for items of fewer than `least` words see Leaks. Repeated rows and repeated items each give theirs;
    rows with equal id and text share a text_key and give one row. A row without id is found by its text_key. Other
    columns are ignored; an empty table on either side gives an empty result. A benchmark of more than block_words is
    looked for in several passes, each against all texts (an action).
    """
    spark = docs.sparkSession
    pieces = materialise(pieces_of(benchmark, how, item_id, item_text), "pieces")
    blocks = 1 + int(pieces.agg(F.sum(F.size("words"))).first()[0] or 0) // how.block_words
    rows = small_batches(docs).select(text_key(doc_id, text), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = WINDOW.format(id=rows.schema["doc_id"].dataType.simpleString())
    found = None
    for block in range(blocks):
        mine = pieces.where(F.pmod(F.xxhash64("item_id", "piece"), F.lit(blocks)) == block).collect()  # about block_words words
        if not mine:
            continue
        seeds = Seeds([p["words"] for p in mine], how.n)
        windows = materialise(rows.mapInArrow(_finder(seeds, how.n), schema), "windows")
        numbered = [(i, p["item_id"], p["piece"], p["words"]) for i, p in enumerate(mine)]
        kind = f"piece_no int, item_id {pieces.schema['item_id'].dataType.simpleString()}, piece int, words array<string>"
        one = _aligned(windows, spark.createDataFrame(numbered, kind), how)
        found = one if found is None else found.union(one)
    whole = _whole_texts(rows, benchmark, how, item_id, item_text)
    if whole is not None:
        found = whole if found is None else found.union(whole)
    if found is None:
        columns = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", pieces.schema["item_id"].dataType), ("score", "int"), ("share", "double"), ("passage", "string"))]
        return rows.select("text_key", "doc_id", *columns).where(F.lit(False))
    best = F.max_by(F.struct("score", "share", "passage"), F.struct("share", "score", "passage"))
    return found.groupBy("text_key", "doc_id", "item_id").agg(best.alias("best")).select("text_key", "doc_id", "item_id", "best.*")


def _whole_texts(rows: DataFrame, benchmark: DataFrame, how: Leaks, item_id: str, item_text: str) -> DataFrame | None:
    """Texts that are an item of fewer than `n` words and nothing else; None if there is no such item."""
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), PARTING), lambda w: w != "")
    items = benchmark.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("words"))
    items = items.where(F.size("words").between(1, how.n - 1)).distinct()
    if items.isEmpty():
        return None
    texts = rows.select("text_key", "doc_id", F.col("text").alias("passage"), words(F.col("text")).alias("words"))
    score = 2 * F.size("words")
    met = texts.where(F.size("words").between(1, how.n - 1)).join(items, "words")
    return met.select("text_key", "doc_id", "item_id", score.alias("score"), F.lit(1.0).alias("share"), "passage")


def _finder(seeds: Seeds, n: int):
    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(PUNCTUATED)
        for part in parts:
            for piece in slices(part, "text"):
                texts = pc.utf8_lower(piece.column("text").fill_null("").cast(pa.large_string()))
                rows = _windows(texts, seeds, words, n)
                raw = texts.buffers()[2]
                index = pa.array([r[0] for r in rows], pa.int64())
                columns = [
                    piece.column("text_key").take(index),
                    piece.column("doc_id").take(index),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                    pa.array([raw[r[3] : r[4]].to_pybytes().decode() for r in rows], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "doc_id", "piece_no", "grams", "passage"])

    return find


def _aligned(windows: DataFrame, pieces: DataFrame, how: Leaks) -> DataFrame:
    """The windows that a rare n-gram joins to their piece and whose alignment reaches the share."""
    frequency = windows.select("piece_no", F.explode("grams").alias("gram")).groupBy("piece_no", "gram").agg(F.count("*").alias("df"))
    listed = frequency.groupBy("piece_no").agg(F.collect_list(F.struct("gram", "df")).alias("all"), F.percentile_approx("df", 0.5, 10_000).alias("middle"))
    rare = F.filter("all", lambda g: g["df"] <= F.greatest("middle", F.lit(how.rare)))
    seeds = materialise(pieces.join(listed.select("piece_no", F.transform(rare, lambda g: g["gram"]).alias("rare")), "piece_no"), "seeds")
    joined = windows.join(seeds, "piece_no").where(F.arrays_overlap("grams", "rare")).drop("grams", "rare", "piece_no")

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parting = re.compile(PARTING)
        for part in parts:
            pieces = part.column("words").to_pylist()
            passages = [[w for w in parting.split(p) if w] for p in part.column("passage").to_pylist()]
            scores = _scores(pieces, passages)
            share = [s / (2 * len(p)) for s, p in zip(scores, pieces, strict=True)]
            columns = [part.column(c) for c in ("text_key", "doc_id", "item_id")] + [pa.array(scores, pa.int32()), pa.array(share, pa.float64()), part.column("passage")]
            yield pa.RecordBatch.from_arrays(columns, ["text_key", "doc_id", "item_id", "score", "share", "passage"])

    ids = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    kind = f"text_key long, doc_id {ids['doc_id']}, item_id {ids['item_id']}, score int, share double, passage string"
    # A short item's full score is below that of `least` words.
    short = F.round(F.try_divide("score", "share")) < 2 * how.least
    copied = (F.col("share") > 0) & F.when(short, F.col("share") == 1).otherwise((F.col("share") >= how.share) | (F.col("score") >= 2 * how.long))
    return joined.select("text_key", "doc_id", "item_id", "words", "passage").mapInArrow(score, kind).where(copied)
