"""What several operators share: words and n-grams as 64-bit keys, blocks of rows, size-checked broadcasts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z lowered. Keys are computed for whole Arrow
buffers at once; a key is a sum over the word's bytes, each times a number drawn for its place in the word, so it does not
depend on the batch or the document. Two different words share a key with a chance of at most 2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 2_000_000  # a broadcast set of 8-byte ids stays near 50 MB; larger sets take the shuffle join
WINDOW = 1 << 19  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xC2B2AE3D27D4EB4F)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    code = np.arange(1, 257, dtype=np.uint64)  # never 0, so that a word differs from its beginnings
    code[65:91] = code[97:123]
    gap = np.zeros(256, dtype=bool)
    gap[9:14] = gap[32] = True
    return code, gap


CODE, GAP = _tables()
PUNCTUATED = GAP.copy()  # gaps where all of ASCII but letters and digits parts words
PUNCTUATED[:48] = PUNCTUATED[58:65] = PUNCTUATED[91:97] = PUNCTUATED[123:128] = True


def place_numbers(n: int) -> np.ndarray:
    """A number of 64 bits for each of the first n places in a word, drawn by a counter-based generator with a fixed seed."""
    return np.random.Philox(key=20_240_229).random_raw(n)


class Words:
    """Word keys of Arrow string columns; one instance per task keeps the numbers of the places."""

    def __init__(self, gap: np.ndarray = GAP) -> None:
        self.gap = gap
        self.places = place_numbers(1 << 10)

    def _keys(self, part: np.ndarray, word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Keys of the words of a window, from its word bytes and where words begin and end."""
        if not len(begin):
            return np.zeros(0, dtype=np.uint64)
        length = end - begin
        if (longest := int(length.max())) > len(self.places):
            self.places = place_numbers(longest)
        first = np.cumsum(length) - length
        place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
        return mix(np.add.reduceat(CODE[part[word]] * self.places[place], first))

    def _windows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of about WINDOW bytes that cut no word."""
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            to = at + WINDOW
            if to < end:
                border = int(offsets[np.searchsorted(offsets, to)])
                while to < border and not (gaps := np.flatnonzero(self.gap[data[to : min(to + WINDOW, border)]])).size:
                    to = min(to + WINDOW, border)
                to = to + int(gaps[0]) if to < border else border
            yield at, min(to, end)
            at = min(to, end)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of all words in order, the first word of each text (one more entry at the end), byte begin and end of
        each word in the column's buffer. A null is an empty text."""
        data, offsets = utf8(column)
        keys, begins, ends = [], [], []
        for lo, hi in self._windows(data, offsets):
            part = data[lo:hi]
            word = ~self.gap[part]
            begin, end = word.copy(), word.copy()
            begin[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            inner = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
            begin[inner] = word[inner]
            end[inner - 1] = word[inner - 1]
            b, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
            keys.append(self._keys(part, word, b, e))
            begins.append(b + lo)
            ends.append(e + lo)
        none = np.zeros(0, dtype=np.int64)
        begins = np.concatenate([none, *begins])
        first = np.searchsorted(begins, offsets)
        return np.concatenate([none.astype(np.uint64), *keys]), first, begins, np.concatenate([none, *ends])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each text in them; a null becomes an empty text."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8), offsets


def grams(keys: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-word grams inside the texts, in order, and the first gram of each text (one more at the end)."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    starts = np.concatenate([[0], np.cumsum(counts)])
    if len(keys) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(first), dtype=np.int64)
    rolled = keys[: len(keys) - n + 1].copy()
    for k in range(1, n):
        rolled = mix(rolled + keys[k : len(keys) - n + 1 + k] * np.uint64(2 * k + 1))
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], counts)
    return rolled[at], starts


def shingle_sets(keys: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Like grams, but a text with fewer than n words has its whole sequence as its one gram; without words, none."""
    full, starts = grams(keys, first, n)
    words = np.diff(first)
    short = np.flatnonzero((words > 0) & (words < n))
    if not len(short):
        return full, starts
    whole = keys[first[short]] + np.uint64(n)
    for k in range(1, n - 1):
        more = words[short] > k
        whole[more] = mix(whole[more] + keys[first[short][more] + k] * np.uint64(2 * k + 1))
    whole = mix(whole + words[short].astype(np.uint64))
    return np.insert(full, starts[short], whole), np.concatenate([[0], np.cumsum(np.diff(starts) + np.isin(np.arange(len(words)), short))])


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def blocks_for(docs: DataFrame, text: str, target: int) -> int:
    """How many blocks of about `target` bytes the texts make (an action: one sum)."""
    return 1 + int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // target


def rows_of(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose key is in `ids` (distinct, one column, an already written table).

    Up to BROADCAST_ROWS ids the set is broadcast and the texts stay where they are; beyond it, a shuffle join.
    """
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_semi")


def without(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of `docs`, all columns, whose text_key is not in `keys` (distinct, one column, an already written table)."""
    return _by_key(docs, keys, doc_id, text, "left_anti")


def only(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The other rows: those whose text_key is in `keys`."""
    return _by_key(docs, keys, doc_id, text, "left_semi")


def _by_key(docs: DataFrame, keys: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = keys.withColumnRenamed(keys.columns[0], "_gone")
    same = F.xxhash64(docs[doc_id], F.coalesce(docs[text], F.lit(""))) == own["_gone"]
    return docs.join(F.broadcast(own) if few else own.hint("merge"), same, how)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds




BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, after bounding what its session sends to a Python worker at a time: both sides hold whole batches outside
    the heap, and the default sizes are meant for short rows. Smaller settings stay."""
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    size = (conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) or "").rstrip("b")
    if not (size.isdigit() and 0 < int(size) <= BATCH_BYTES):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_key(doc_id: str, text: str) -> Column:
    """Finds the text of a row again; rows of equal id and text share it."""
    return F.xxhash64(F.col(doc_id), F.coalesce(text, F.lit(""))).alias("text_key")


def slices(part: pa.RecordBatch, text: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(part.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(lengths) - lengths) // size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [part.num_rows]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield part.slice(a, b - a)
