"""Byte-level BPE by backtracking, and decoding by an offset table.

A text is cut into pieces as the tokenizer's splitter does. In a piece the longest token that matches at the current
byte is taken (an Aho-Corasick automaton over the tokens finds it); it stands if it may follow the token before it,
which a table of pairs says, else the next shorter token that matches is tried, and where none is left the token before
is given up. A border that failed once is never tried again, so a piece costs time in proportion to its bytes. A chain
of tokens in which every pair may stand is what the merges give, so the ids are exact. Pieces met before are remembered.

A pair (a, b) may stand if the merges, run over the bytes of both, join nothing across the border. Every symbol that
touches the border lives from the merge that made it to the merge that used it up; a merge across happens if its rank
comes before both ends. Among equal ranks the merge further left comes first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import slices, small_batches, utf8

REMEMBERED = 600_000  # pieces remembered per task, then the memory starts again
IN_STEP = 64  # bytes (their borders are the bits of one integer) up to which pieces are encoded in step
AT_ONCE = 200_000  # pieces in memory at a time
STRETCH = 1 << 17  # characters that are cut into pieces at a time
NEVER = 1 << 60
# The splitter's pattern, and characters whose class is the same in every version of Unicode in use. Texts
# with other characters are split by the tokenizer's own library, whose tables may be older or newer.
PIECE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = (
    (0x0000, 0x0557), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x214F), (0x2190, 0x2BFF),
    (0x3000, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFE00, 0xFE0F), (0xFF01, 0xFFDC), (0x1F300, 0x1F6FF),
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the tokenizer's file: itself if it can be seen, else the next from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


def read_model(path: str) -> dict:
    """What the operator needs of a tokenizer file; an error if the file asks for more than it does."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and model["type"] == "BPE" and split.get("type") == "ByteLevel"
    plain = plain and split["use_regex"] and not split["add_prefix_space"] and (spec["decoder"] or {}).get("type") == "ByteLevel"
    plain = plain and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not plain:
        raise ValueError("a byte-level BPE file without normalizer, prefixes or special handling is expected")
    vocab = {token: i for token, i in model["vocab"].items()}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"vocab": vocab, "merges": merges, "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class PairTable:
    """Which token may follow which; every answer is kept."""

    def __init__(self, merges: np.ndarray, n: int) -> None:
        """`merges`: left, right and joined token by rank; `n`: tokens."""
        self.n = n
        self.made, self.left, self.right = (np.full(n, -1, dtype=np.int64) for _ in range(3))
        a, b, c = merges.T
        self.made[c], self.left[c], self.right[c] = np.arange(len(merges)), a, b
        if len(np.unique(c)) < len(c) or (np.arange(len(merges)) <= np.maximum(self.made[a], self.made[b])).any():
            raise ValueError("every token must have one merge, and its parts must be made before it")
        codes = a * n + b
        self.rank = np.argsort(codes)
        self.codes = codes[self.rank]
        self.known = np.zeros(0, dtype=np.int64)
        self.answer = np.zeros(0, dtype=bool)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = a * self.n + b
        at, found = _place(self.known, pairs)
        if not found.all():
            new = np.unique(pairs[~found])
            known, answer = np.concatenate([self.known, new]), np.concatenate([self.answer, self.apart(new // self.n, new % self.n)])
            order = np.argsort(known, kind="stable")
            self.known, self.answer = known[order], answer[order]
            at = np.searchsorted(self.known, pairs)
        return self.answer[at]

    def apart(self, a: np.ndarray, b: np.ndarray, merged: bool = False) -> np.ndarray:
        """Walks back in time from the finished pairs, undoing the merge that was made last on either side. With `merged`
        the pairs themselves are joined, and the question is whether their parts meet so."""
        out = np.ones(len(a), dtype=bool)
        open_, until_a, until_b = np.arange(len(a)), np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(open_):
            if not merged:
                at, found = _place(self.codes, a * self.n + b)
                rank = np.where(found, self.rank[at], NEVER)
                joined = (rank < until_a) & (rank <= until_b) & found
                out[open_[joined]] = False
            else:
                joined, merged = np.zeros(len(a), dtype=bool), False
            made_a, made_b = self.made[a], self.made[b]
            on = ~joined & ((made_a >= 0) | (made_b >= 0))
            open_, a, b, until_a, until_b, made_a, made_b = (x[on] for x in (open_, a, b, until_a, until_b, made_a, made_b))
            later = made_a > made_b
            until_a, until_b = np.where(later, made_a, until_a), np.where(later, until_b, made_b)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return out


def _place(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values would stand in an ordered array (inside it), and whether they do."""
    if not len(ordered):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return at, ordered[at] == values


class Backtracking:
    """Ids of byte strings. Many short ones go in step, each at its own byte; long ones go alone."""

    def __init__(self, model: dict) -> None:
        vocab, byte = model["vocab"], {letter: i for i, letter in enumerate(byte_letters())}
        n = max(vocab.values()) + 1
        merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]], dtype=np.int64).reshape(-1, 3)
        self.fits = fits = PairTable(merges, n)
        # A token that its own bytes do not merge to never occurs: its two parts must be able to meet.
        whole = np.ones(n, dtype=bool)
        whole[merges[:, 2]] = fits.apart(merges[:, 0], merges[:, 1], merged=True)
        usable = {bytes(byte[c] for c in t): i for t, i in vocab.items() if whole[i] and (len(t) == 1 or fits.made[i] >= 0)}
        self.tokens, self.span = usable, max(map(len, usable))
        self.size, self.shorter = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        steps: dict[int, int] = {}  # the automaton's goto function: node and byte to node
        token = [-1]
        for text, i in sorted(usable.items()):
            node, before = 0, -1
            for c in text:
                node = steps.setdefault(node << 8 | c, len(token))
                if node == len(token):
                    token.append(-1)
                if token[node] >= 0:
                    before = token[node]
            token[node] = i
            self.size[i], self.shorter[i] = len(text), before  # beginnings come first in this order
        self.token = np.array(token, dtype=np.int64)
        inner = sorted({key >> 8 for key in steps})
        row = np.zeros(len(token), dtype=np.int64)  # nodes without steps share row 0
        row[inner] = np.arange(1, len(inner) + 1)
        self.step = np.zeros((len(inner) + 1, 256), dtype=np.int32)  # 0: no step
        keys = np.fromiter(steps, np.int64, len(steps))
        self.step[row[keys >> 8], keys & 255] = np.fromiter(steps.values(), np.int64, len(steps))
        self.row, self.automaton = row, None

    def _longest(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that matches at each place."""
        found = np.full(len(at), -1, dtype=np.int64)
        on, node, at = np.arange(len(at)), np.zeros(len(at), dtype=np.int64), at.copy()
        while len(on):
            node = self.step[self.row[node], data[at]]
            here = self.token[node]
            matched = (node > 0) & (here >= 0)
            found[on[matched]] = here[matched]
            at += 1
            go = (node > 0) & (at < end[on])
            on, node, at = on[go], node[go], at[go]
        return found

    def many(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the strings data[begin:end], none of them empty, and how many each has."""
        length = end - begin
        on = np.flatnonzero(length <= IN_STEP)
        width = int(length[on].max()) if len(on) else 0
        done, depth, at = np.zeros((len(begin), width), dtype=np.int32), np.zeros(len(begin), dtype=np.int64), begin.copy()
        failed = np.zeros(len(begin), dtype=np.uint64)  # bit k: no rest can be encoded from the border at byte k + 1
        token = self._longest(data, at[on], end[on])
        while len(on):
            border = at[on] + self.size[token] - begin[on]
            fits = (failed[on] >> (border - 1).astype(np.uint64)) & np.uint64(1) == 0
            check = np.flatnonzero(fits & (depth[on] > 0))
            fits[check] = self.fits(done[on[check], depth[on[check]] - 1].astype(np.int64), token[check])
            taken, rest = on[fits], on[~fits]
            done[taken, depth[taken]] = token[fits]
            depth[taken] += 1
            at[taken] = begin[taken] + border[fits]
            more, shorter = taken[at[taken] < end[taken]], self.shorter[token[~fits]]
            while len(back := np.flatnonzero(shorter < 0)):  # nothing matches from here: the token before has to be another one
                who = rest[back]
                failed[who] |= np.uint64(1) << (at[who] - begin[who] - 1).astype(np.uint64)
                depth[who] -= 1
                before = done[who, depth[who]]
                at[who] -= self.size[before]
                shorter[back] = self.shorter[before]
            on, token = np.concatenate([more, rest]), np.concatenate([self._longest(data, at[more], end[more]), shorter])
        alone = np.flatnonzero(length > IN_STEP)
        each = [self(data[begin[i] : end[i]].tobytes()) for i in alone.tolist()]
        depth[alone] = [len(x) for x in each]
        total = np.cumsum(depth)
        ids = np.empty(total[-1] if len(total) else 0, dtype=np.int32)
        short = depth.copy()
        short[alone] = 0
        ids[np.repeat(length <= IN_STEP, depth)] = done[np.arange(width) < short[:, None]]
        for i, found in zip(alone.tolist(), each, strict=True):
            ids[total[i] - depth[i] : total[i]] = found
        return ids, depth

    def __call__(self, text: bytes) -> np.ndarray:
        """Ids of one string, in time that grows with its length alone."""
        if self.automaton is None:
            import ahocorasick

            self.automaton, self.follows = ahocorasick.Automaton(), {}
            for one, i in self.tokens.items():
                self.automaton.add_word(one.decode("latin-1"), i)
            self.automaton.make_automaton()
            self.sizes, self.shorts = self.size.tolist(), self.shorter.tolist()
        piece, size, shorter, longest, follows = text.decode("latin-1"), self.sizes, self.shorts, self.automaton.iter_long, self.follows
        n, at, done, span = len(piece), 0, [], self.span  # the automaton sees no more than the longest token needs
        failed = bytearray(n + 1)  # borders behind which no rest can be encoded
        token = next(longest(piece[:span]))[1]
        while True:
            end = at + size[token]
            if not failed[end] and (not done or self._fits(done[-1], token, follows)):
                done.append(token)
                if end == n:
                    return np.array(done, dtype=np.int64)
                at, token = end, next(longest(piece[end : end + span]))[1]
                continue
            token = shorter[token]
            while token < 0:  # nothing matches from here: the token before has to be another one
                failed[at] = 1
                token = done.pop()
                at -= size[token]
                token = shorter[token]

    def _fits(self, a: int, b: int, follows: dict[tuple[int, int], bool]) -> bool:
        if (found := follows.get((a, b))) is None:
            found = follows[a, b] = bool(self.fits.apart(np.array([a]), np.array([b]))[0])
        return found


class ByteEncoder:
    """Ids of texts, like the library without added begin and end tokens; special strings are their own tokens."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        model = read_model(path)
        self.encode, self.added = Backtracking(model), model["added"]
        names = sorted(self.added, key=lambda s: (-len(s), s))
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pieces = regex.compile(PIECE).findall
        self.border = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}])(?=\s)")
        self.unsettled = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED).replace("\\", "\\\\") + "]")
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self._forget()

    def _forget(self) -> None:
        """Pieces have places in `flat`: their ids begin at `first` and are `size` many. A special string's piece is its id."""
        self.known: dict[str | int, int] = {i: k for k, i in enumerate(self.added.values())}
        self.flat = np.array(list(self.added.values()), dtype=np.int32)
        self.first, self.size = np.arange(len(self.flat)), np.ones(len(self.flat), dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        data, offsets = utf8(pa.array(new, pa.large_string()))
        ids, size = self.encode.many(data, offsets[:-1], offsets[1:])
        self.known.update(zip(new, range(len(self.first), len(self.first) + len(new)), strict=True))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, size])

    def _places(self, pieces: list[str | int]) -> np.ndarray:
        distinct = set(pieces)
        if len(self.known) + len(distinct) > REMEMBERED or len(self.flat) > 10 * REMEMBERED:
            self._forget()
        if new := [piece for piece in distinct if piece not in self.known]:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _stretches(self, text: str) -> Iterator[str]:
        """The text in stretches of about STRETCH characters that end where the splitter always cuts."""
        at = 0
        while len(text) - at > STRETCH:
            cut = self.border.search(text, at + STRETCH)
            if cut is None or cut.start() >= len(text):
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _pieces(self, text: str) -> Iterator[list[str | int]]:
        """The pieces of a text, some at a time."""
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                yield [self.added[part]]
            elif self.unsettled.search(part):
                yield [part[a:b] for _, (a, b) in self.library.pre_tokenize_str(part)]
            elif part:
                yield from map(self.pieces, self._stretches(part))

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each has."""
        counts, out, pieces, owners = np.zeros(len(texts), dtype=np.int64), [np.zeros(0, dtype=np.int32)], [], []

        def flush() -> None:
            at = self._places(pieces)
            size = self.size[at]
            total = np.cumsum(size)
            out.append(self.flat[np.arange(total[-1]) + np.repeat(self.first[at] - (total - size), size)])
            text, n = np.array(owners, dtype=np.int64).T
            np.add.at(counts, text, np.add.reduceat(size, np.cumsum(n) - n))
            pieces.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for some in self._pieces(text):
                if some:
                    pieces += some
                    owners.append((i, len(some)))
                if len(pieces) > AT_ONCE:
                    flush()
        if pieces:
            flush()
        return np.concatenate(out), counts

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]


class OffsetTable:
    """The bytes of all tokens one after the other, and where each begins."""

    def __init__(self, path: str) -> None:
        model, letters = read_model(path), byte_letters()
        byte = {letter: i for i, letter in enumerate(letters)}
        tokens = {i: bytes(byte[c] for c in token) for token, i in model["vocab"].items()}
        tokens.update({i: text.encode() for text, i in model["added"].items()})
        n = max(tokens) + 1
        sizes = np.fromiter((len(tokens.get(i, b"")) for i in range(n)), np.int64, n)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(n)), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens; ids that the file does not know give none."""
        ids = ids[(ids >= 0) & (ids < len(self.first) - 1)]
        begin, size = self.first[ids], self.first[ids + 1] - self.first[ids]
        total = np.cumsum(size)
        return self.bytes[np.arange(total[-1] if len(ids) else 0) + np.repeat(begin - (total - size), size)].tobytes()


def encode_texts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row of `docs`: the ids of its whole text.

    A null or empty text has no ids. Rows with null or repeated ids each give their own row; other columns are ignored.
    An empty table gives an empty result. A text of any length is encoded in stretches; its ids are one row.
    `tokenizer` is a file that every executor can read.
    """
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for whole in parts:
            own = own or ByteEncoder(tokenizer)
            for part in slices(whole, "text"):
                flat, counts = own.many(part.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return rows.mapInArrow(encode, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """`encoded` (doc_id, ids) with the text that the ids stand for. Null ids are an empty text; an id that the tokenizer does not
    know stands for nothing; bytes that are no UTF-8 become the replacement character."""
    rows = small_batches(encoded).select("doc_id", "ids")

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for part in parts:
            table = table or OffsetTable(tokenizer)
            ids = part.column("ids")
            starts = ids.offsets.to_numpy()
            flat = ids.values.fill_null(-1).to_numpy(zero_copy_only=False)
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            texts = [
                table(flat[a:b]).decode("utf-8", "replace") if ok else ""
                for a, b, ok in zip(starts[:-1].tolist(), starts[1:].tolist(), valid.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.mapInArrow(decode, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")


def reference_merges(piece: str, merges: dict[tuple[str, str], int]) -> list[str]:
    """The plain rule, for tests: join the leftmost pair of the lowest rank until none is left."""
    parts = list(piece)
    while len(parts) > 1:
        rank, at = min((merges.get(pair, NEVER), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts
