"""Language of whole texts by a string kernel.

The kernel of two texts is the number of character n-grams that both contain, over the geometric mean of how many each
contains; all lengths in N are blended. A bounded number of labelled texts are landmarks: the kernel values with them,
whitened by the landmarks' own kernel matrix (Nystroem), are features of a one-versus-rest ridge regression. Whole
batches are scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import crc_fold, rows_of, small_batches, text_key
from ledgerlark.operators.lineage import materialise

N = (2, 3)
SAMPLE = 200  # labelled texts per language that the model is fitted on
LANDMARKS = 32  # per language
LONG = 20_000  # longer texts are sampled only where there are not enough others
RIDGE = 0.1
BATCH = 256  # texts scored by one product
WINDOW = 1 << 20  # characters of a text handled at a time
NO_LANGUAGE = "und"


class Grams:
    """Sets of n-grams of a text: lower case, runs of anything but letters as one blank, a blank at both ends."""

    def __init__(self) -> None:
        self.letter = np.array([chr(i).isalpha() for i in range(0x10000)])

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
        low = codes < 0x10000
        letter = low.copy()
        letter[low] = self.letter[codes[low]]
        if not low.all():
            letter[~low] = [chr(c).isalpha() for c in codes[~low].tolist()]
        codes[~letter] = 0
        return codes + np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted codes of the n-grams that occur; none without a letter."""
        found, text = np.zeros(0, dtype=np.uint64), (text or "").lower()
        for at in range(0, len(text), WINDOW):
            codes = self._codes(text[max(at - max(N), 0) : at + WINDOW])
            blank = np.ones(1, dtype=np.uint64)
            codes = np.concatenate([blank[at > 0 :], codes, blank[at + WINDOW < len(text) :]])
            keep = np.concatenate([[True], (codes[1:] != 1) | (codes[:-1] != 1)])
            codes, parts = codes[keep], [found]
            if len(codes) < 2:
                continue
            for n in N:
                gram = codes[: len(codes) - n + 1].copy()
                for k in range(1, n):
                    gram = (gram << np.uint64(21)) | codes[k : len(codes) - n + 1 + k]
                parts.append(gram)
            found = np.sort(np.concatenate(parts))
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        return found


@dataclass(frozen=True)
class StringKernel:
    languages: list[str]
    vocabulary: np.ndarray  # sorted n-grams of the landmarks
    landmarks: np.ndarray  # presence, one column per landmark
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages, whitening included

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        present = np.zeros((len(sets), len(self.vocabulary)), dtype=np.float32)
        for i, one in enumerate(sets):
            at = np.searchsorted(self.vocabulary, one)
            at[at == len(self.vocabulary)] = 0
            present[i, at[self.vocabulary[at] == one]] = 1
        size = np.array([max(len(s), 1) for s in sets], dtype=np.float32)
        return (present @ self.landmarks) / np.sqrt(size[:, None] * self.sizes)

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """For each text and language a value from 0 to 1."""
        return np.clip((self.kernel(sets) @ self.weights + 1) / 2, 0, 1)


def fit_kernel(sets: list[np.ndarray], labels: list[str]) -> StringKernel | None:
    """Landmarks are the first texts of each language, those of at most median size before the others."""
    languages = sorted(set(labels))
    if not languages:
        return None
    chosen: list[int] = []
    for language in languages:
        mine = [i for i, x in enumerate(labels) if x == language]
        middle = np.median([len(sets[i]) for i in mine])
        chosen += sorted(mine, key=lambda i: (len(sets[i]) > middle, i))[:LANDMARKS]
    vocabulary = np.sort(np.concatenate([sets[i] for i in chosen]))
    vocabulary = vocabulary[np.concatenate([[True], vocabulary[1:] != vocabulary[:-1]])]
    landmarks = np.zeros((len(vocabulary), len(chosen)), dtype=np.float32)
    for column, i in enumerate(chosen):
        landmarks[np.searchsorted(vocabulary, sets[i]), column] = 1
    sizes = landmarks.sum(axis=0)
    own = (landmarks.T @ landmarks) / np.sqrt(sizes[:, None] * sizes)
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    empty = StringKernel(languages, vocabulary, landmarks, sizes, np.zeros((len(chosen), len(languages))))
    features = np.concatenate([empty.kernel(sets[a : a + BATCH]) for a in range(0, len(sets), BATCH)]) @ whiten
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    ridge = np.linalg.solve(features.T @ features + RIDGE * np.eye(features.shape[1]), features.T @ target)
    return StringKernel(languages, vocabulary, landmarks, sizes, (whiten @ ridge).astype(np.float32))


def fit_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> StringKernel | None:
    """Fit on at most SAMPLE texts of each language of `docs` (an action; only their n-gram sets reach the driver).

    Rows without a language or without a letter are not learned from. Without any the result is None. The number of
    languages must fit the driver; the number of rows need not.
    """
    labelled = small_batches(docs).where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    long = (F.length(text) > LONG).alias("long")
    keyed = labelled.select(text_key(doc_id, text), F.col(lang).cast("string").alias("lang"), long)
    first = Window.partitionBy("lang").orderBy("long", "text_key")
    chosen = keyed.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE)
    chosen = materialise(chosen.select("text_key").distinct(), "language-sample")
    rows = labelled.select(text_key(doc_id, text), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    rows = rows_of(rows, chosen, "text_key").dropDuplicates(["text_key", "lang"])

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams()
        for part in parts:
            found = [own(t).astype(np.int64) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("text_key"), part.column("lang"), pa.array(found, pa.list_(pa.int64()))], ["text_key", "lang", "grams"])

    found = rows.mapInArrow(sets, "text_key long, lang string, grams array<long>").where(F.size("grams") > 0)
    found = sorted(found.collect(), key=lambda row: (row["lang"], row["text_key"]))
    return fit_kernel([np.array(row["grams"], dtype=np.uint64) for row in found], [row["lang"] for row in found])


def predict_languages(
    docs: DataFrame, model: StringKernel | None, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held_out_fold: int = 0
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of `docs`.

    A text that is null or has no letter is `und` with score 0, and so is every text without a model. Rows with null or
    repeated ids are predicted one by one, equal texts alike; a tie goes to the first language in order. Other columns
    are ignored. An empty table gives an empty result.
    """
    held_out = (crc_fold(F.col(doc_id), folds) == held_out_fold).alias("held_out")
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), held_out, F.col(text).alias("text"))

    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams()
        for whole in parts:
            for at in range(0, whole.num_rows, BATCH):
                part = whole.slice(at, BATCH)
                sets = [own(t) for t in part.column("text").to_pylist()]
                languages, score = [NO_LANGUAGE] * len(sets), np.zeros(len(sets))
                some = [i for i, s in enumerate(sets) if len(s)] if model else []
                if some:
                    scores = model.scores([sets[i] for i in some])
                    best = scores.argmax(axis=1)
                    score[some] = scores[np.arange(len(some)), best]
                    for i, b in zip(some, best.tolist(), strict=True):
                        languages[i] = model.languages[b]
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(languages, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
