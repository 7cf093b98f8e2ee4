"""Encoding with a fixed tokenizer file, one white-space word at a time.

For tokenizers that split at white space before merging and drop it, the tokens of a text are those of its words in
order. The words of an Arrow buffer are found as 64-bit keys; only words with a new key become strings, and their
letters and trailing punctuation, which are separate to such a tokenizer, are encoded by the library once per task.
Any other tokenizer, and texts that hold one of its special strings, get whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

from ledgerlark.llm.common import Words, slices, utf8

MEMO = 600_000  # words remembered per task, then the memo starts again
JOINED = 64  # runs of letters encoded at a time
SLICE = 1 << 20  # bytes of text looked up at a time
PUNCTUATION = ".,;:!?\"()[]{}*%&$#|-_/<>=+~^`@\\"
LATIN = "\u0130"  # letters below stay letters when the tokenizer normalises them


def _library(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoder(path: str):
    """A function from a list of texts to a list of id lists, without begin, end or added special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1)
    tokenizer = _library(path)
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def word_wise(path: str) -> bool:
    """Whether the tokenizer file lowers case, drops white space before it merges, and marks the last piece of a run of
    letters, so that words can be encoded apart."""
    if path.endswith(".model"):
        return False
    tokenizer = _library(path)
    first, then = repr(tokenizer.normalizer), repr(tokenizer.pre_tokenizer)
    shape = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in then and "behavior=Removed" in then and "add_prefix_space=False" in then
    return shape and "Lowercase" in first and bool(getattr(tokenizer.model, "end_of_word_suffix", None))


class Encoder:
    """Ids of the texts of string columns, in order."""

    def __init__(self, path: str, by_word: bool) -> None:
        self.by_word = by_word
        if not by_word:
            self.encode = encoder(path)
            return
        tokenizer = _library(path)
        self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)  # ids that end a run
        for piece, i in tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = piece.endswith(tokenizer.model.end_of_word_suffix)
        self.special = sorted(t.content.lower() for t in tokenizer.get_added_tokens_decoder().values())
        self.words = Words()
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, dtype=np.uint64)
        self.keys, self.core, self.tail = none, none.astype(np.int32), none.astype(np.int32)  # words seen, and their parts
        self.part_keys, self.part_at = none, none.astype(np.int32)  # parts by the hash of their text, and their places
        self.ids, self.first = none.astype(np.int32), np.zeros(2, dtype=np.int64)  # ids by place; place 0 is no part

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember new words by their keys (sorted)."""
        if len(self.keys) + len(keys) > MEMO and len(self.keys):
            raise MemoryError
        cores, tails, tailed = [], [], []
        for i, word in enumerate(words):
            letters = word.rstrip(PUNCTUATION)
            if letters.isalpha() and (len(letters) == len(word) or letters[-1] < LATIN):
                cores.append(letters.lower() if letters.isascii() else letters)
                if len(letters) < len(word):
                    tails.append(word[len(letters) :])
                    tailed.append(i)
            else:
                cores.append(word)
        places = self._part_places(cores + tails)
        core, tail = places[: len(cores)], np.zeros(len(cores), dtype=np.int32)
        tail[tailed] = places[len(cores) :]
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.core, self.tail = np.concatenate([self.core, core])[order], np.concatenate([self.tail, tail])[order]

    def _part_places(self, parts: list[str]) -> np.ndarray:
        """Where the ids of the parts are kept, after encoding those that are new."""
        hashed = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
        order = np.argsort(hashed, kind="stable")
        ordered = hashed[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(parts) else order
        distinct, spots = ordered[begin], order[begin]
        unknown = ~_in_sorted(distinct, self.part_keys)
        if unknown.any():
            ids, n = self._encode_parts([parts[i] for i in spots[unknown].tolist()])
            places = len(self.first) - 1 + np.arange(len(n), dtype=np.int32)
            self.ids, self.first = np.concatenate([self.ids, ids]), np.concatenate([self.first, self.first[-1] + np.cumsum(n)])
            merged = np.concatenate([self.part_keys, distinct[unknown]])
            order = np.argsort(merged, kind="stable")
            self.part_keys, self.part_at = merged[order], np.concatenate([self.part_at, places])[order]
        return self.part_at[np.searchsorted(self.part_keys, hashed)]

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after the other, and how many each has. Runs of letters go to the library together, and
        the pieces that end a run tell them apart again; if there are not as many ends as runs, each goes alone."""
        letters = [i for i, part in enumerate(parts) if part.isalpha()]
        groups = [letters[i : i + JOINED] for i in range(0, len(letters), JOINED)]
        found = self.encode([" ".join([parts[i] for i in group]) for group in groups])
        n, order, flat = np.zeros(len(parts), dtype=np.int64), [], []
        alone = [i for i, part in enumerate(parts) if not part.isalpha()]
        for group, ids in zip(groups, found, strict=True):
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(group) and ends[-1] == len(ids) - 1:
                n[group] = np.diff(ends, prepend=-1)
                order += group
                flat.append(ids)
            else:
                alone += group
        for i, ids in zip(alone, self.encode([parts[i] for i in alone]), strict=True):
            n[i] = len(ids)
            order.append(i)
            flat.append(ids)
        flat = np.fromiter(chain.from_iterable(flat), np.int32, int(n.sum()))
        order = np.array(order, dtype=np.int64)
        begin = np.zeros(len(parts), dtype=np.int64)
        begin[order] = np.cumsum(n[order]) - n[order]
        return _gathered(flat, begin, n, np.arange(len(parts))), n

    def _places(self, piece: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two parts of every word of the texts, and the first word of each text."""
        keys, first, begins, ends = self.words(piece)
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
        distinct = ordered[new]
        unknown = ~_in_sorted(distinct, self.keys)
        if unknown.any():
            data, offsets = utf8(piece)
            spots, raw = order[np.flatnonzero(new)[unknown]], data[offsets[0] : offsets[-1]].tobytes()
            begins, ends = begins[spots] - offsets[0], ends[spots] - offsets[0]
            words = [raw[b:e].decode() for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            try:
                self._learn(distinct[unknown], words)
            except MemoryError:  # start again with the words of this slice alone
                self._forget()
                return self._places(piece)
        at = np.searchsorted(self.keys, distinct)
        word = np.empty(len(keys), dtype=np.int64)
        word[order] = at[np.cumsum(new) - 1]
        return self.core[word], self.tail[word], first

    def _whole(self, piece: pa.Array) -> bool:
        """Whether the slice must be encoded as whole texts."""
        if not self.by_word:
            return True
        texts = pc.ascii_lower(piece)
        return any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special)

    def tokens(self, column: pa.Array, ids: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """For the texts in order, in groups: the number of tokens of each, and all their tokens."""
        batch = pa.RecordBatch.from_arrays([column.fill_null("").cast(pa.large_string())], ["text"])
        for part in slices(batch, "text", SLICE if self.by_word else 1 << 20):
            piece = part.column("text")
            if self._whole(piece):
                found = self.encode(piece.to_pylist())
                yield np.array([len(x) for x in found]), np.fromiter(chain.from_iterable(found), np.int32) if ids else None
                continue
            core, tail, first = self._places(piece)
            length = np.diff(self.first)
            total = np.concatenate([[0], np.cumsum(length[core] + length[tail])])
            where = np.stack([core, tail], axis=1).ravel() if ids else None
            yield np.diff(total[first]), _gathered(self.ids, self.first[:-1], length, where) if ids else None

    def counts(self, column: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=np.int64), *[n for n, _ in self.tokens(column, ids=False)]])


def _in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    at = np.searchsorted(among, values)
    found = np.zeros(len(values), dtype=bool)
    inside = at < len(among)
    found[inside] = among[at[inside]] == values[inside]
    return found


def _gathered(ids: np.ndarray, begin: np.ndarray, length: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The id lists at the places `where`, one after the other."""
    n = length[where]
    total = np.cumsum(n)
    return ids[np.arange(total[-1] if len(n) else 0) + np.repeat(begin[where] - (total - n), n)]
