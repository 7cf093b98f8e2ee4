"""Document quality by an additive model over surface features of the whole text.

Features are shares of byte classes and of word and line shapes, counted over Arrow buffers. The model is fitted on a
bounded sample of labelled rows and scores every text in the same pass that counts its features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.additive import AdditiveModel, Boosting, fit
from ledgerlark.llm.common import BROADCAST_ROWS, Words, crc_fold, slices, small_batches, utf8

SAMPLE = 20_000  # labelled rows that the model is fitted on, those with the smallest hash of their id
CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "comma", "bang", "pipe", "symbol", "other", "lead", "inner")


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    for name, chars in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t"), ("newline", b"\n\r"),
        ("stop", b".?"), ("comma", b",;:"), ("bang", b"!"), ("pipe", b"|"), ("symbol", b"#$%&*+=<>@^_~{}[]\\/"),
        ("lead", range(192, 256)), ("inner", range(128, 192)),
    ):
        table[list(chars)] = CLASSES.index(name)
    return table


CLASS_OF = _classes()
FEATURES = (
    "log_words", "word_bytes", "word_spread", "distinct_words", "top_word", "short_words", "long_words", "words_per_line",
    "distinct_lines", "again", "stops_per_word", "commas_per_word", *(f"share_{name}" for name in CLASSES),
)


class Features:
    def __init__(self) -> None:
        newline = np.zeros(256, dtype=bool)
        newline[[10, 13]] = True
        self.words, self.lines = Words(), Words(newline)

    def __call__(self, column: pa.Array) -> np.ndarray:
        """One row of features for every text; a text without bytes has zeros throughout."""
        data, offsets = utf8(column)
        n, size = len(offsets) - 1, np.diff(offsets)
        data = data[offsets[0] : offsets[-1]]
        of_doc = np.repeat(np.arange(n), size)
        classes = np.bincount(of_doc * len(CLASSES) + CLASS_OF[data], minlength=n * len(CLASSES)).reshape(n, -1)
        keys, first, begins, ends = self.words(column)
        line_keys, line_first, _, _ = self.lines(column)
        count, lines, length = np.diff(first), np.diff(line_first), ends - begins
        of_word = np.repeat(np.arange(n), count)
        per_doc = lambda v: np.bincount(of_word, weights=v, minlength=n)
        per_word = lambda v: v / np.maximum(count, 1)
        mean = per_word(per_doc(length))
        distinct, top = _repeats(keys, first)
        distinct_lines, _ = _repeats(line_keys, line_first)
        same = np.flatnonzero(keys[1:] == keys[:-1]) + 1  # a word that repeats the one before it
        again = np.bincount(of_word[same[of_word[same] == of_word[same - 1]]], minlength=n)
        stop = classes[:, CLASSES.index("stop")] + classes[:, CLASSES.index("bang")]
        columns = [
            np.log1p(count),
            mean,
            np.sqrt(np.maximum(per_word(per_doc(length.astype(float) ** 2)) - mean**2, 0)),
            per_word(distinct),
            per_word(top),
            per_word(per_doc(length <= 3)),
            per_word(per_doc(length >= 14)),
            count / np.maximum(lines, 1),
            distinct_lines / np.maximum(lines, 1),
            per_word(again),
            per_word(stop),
            per_word(classes[:, CLASSES.index("comma")]),
        ]
        return np.concatenate([np.stack(columns, axis=1), classes / np.maximum(size, 1)[:, None]], axis=1)


def _repeats(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of distinct keys and the count of the most frequent one."""
    distinct, top = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b - a:
            one = np.sort(keys[a:b])
            begin = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1], [True]]))
            distinct[i], top[i] = len(begin) - 1, np.diff(begin).max()
    return distinct, top


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    how: Boosting = Boosting(),
    sample: int = SAMPLE,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> AdditiveModel:
    """Fit on at most `sample` labelled rows of `docs` (an action; only their features reach the driver).

    Null labels are left out, of several labels of an id the greatest counts. Ids without a document and documents
    without a label are not learned from.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id"))
    known = known.agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(min(sample, BROADCAST_ROWS))
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features()
        for part in parts:
            for piece in slices(part, "text"):
                x = own(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, label int, x array<double>")
    found = counted.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).collect()
    x = np.array([row["x"] for row in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([row["label"] for row in found], dtype=float), how)


def score_quality(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text", folds: int = 3, held_out_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`.

    A null text is scored as an empty one. Rows with null or repeated ids are scored one by one, equal texts get equal
    scores. Other columns are ignored. An empty table gives an empty result.
    """
    held_out = (crc_fold(F.col(doc_id), folds) == held_out_fold).alias("held_out")
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), held_out, F.col(text).alias("text"))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features()
        for part in parts:
            for piece in slices(part, "text"):
                p = model.probability(own(piece.column("text")))
                columns = [piece.column("doc_id"), piece.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that the model does not reject (score of 1/2 or more)."""

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features()
        for part in parts:
            for piece in slices(part, text):
                yield piece.filter(pa.array(model.probability(own(piece.column(text))) >= 0.5))

    return small_batches(docs).mapInArrow(keep, docs.schema)
