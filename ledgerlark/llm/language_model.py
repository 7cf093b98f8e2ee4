"""Scores of whole texts under a deleted-interpolation n-gram model of the corpus.

Texts are dealt into blocks by hash. A block lists its distinct n-grams once, as sorted keys of 56 or 48 bits with their
training counts; the lists are cut into hash ranges, every range is summed over all blocks, and the totals go back to
the blocks that asked. So a frequent n-gram travels once per block, whatever its count. One block in DELETED is left
out of the maximum-likelihood counts to learn the mixture weights from it by expectation-maximisation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Words, blocks_for, crc_fold, mix, small_batches
from ledgerlark.operators.lineage import materialise

BLOCK_BYTES = 16 << 20
LEAST_BLOCKS = 20  # so that a small corpus has blocks to leave out
DELETED = 10
STEPS = 8  # probabilities are binned at 2**(1/STEPS) for the held-out table
ROUNDS = 60
END, BOS = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
WORD_BITS, GRAM_BITS = 56, 48  # of the hash that are kept as key: words are counted exactly, longer n-grams may be fewer


def bits_of(order: int) -> int:
    return WORD_BITS if order == 1 else GRAM_BITS


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view("<u8")


class Block:
    """The n-grams of a block of texts: for each order the distinct keys, and for each token where its key stands."""

    def __init__(self, table: pa.Table, order: int) -> None:
        words, first, _, _ = Words()(table.column("text"))
        n = np.diff(first) + 1  # with the end
        self.starts = np.concatenate([[0], np.cumsum(n)])
        self.train = ~np.asarray(table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False)).astype(bool)
        token = np.full(self.starts[-1], END)
        inside = np.ones(len(token), dtype=bool)
        inside[self.starts[1:] - 1] = False
        token[inside] = words
        of_doc = np.repeat(np.arange(len(n)), n)
        in_train = self.train[of_doc]
        place = np.arange(len(token)) - self.starts[of_doc]
        gram, start = mix(token), mix(np.full(1, BOS))
        self.keys, self.counts, self.where, self.start_at = [], [], [], []
        for k in range(1, order + 1):
            if k > 1:
                earlier = np.full(len(token), BOS)
                earlier[k - 1 :] = token[: max(len(token) - k + 1, 0)]
                earlier[place < k - 1] = BOS
                gram = mix(gram * np.uint64(2 * k + 1) + earlier)
                start = mix(start * np.uint64(2 * k + 1) + BOS)
            every = np.concatenate([gram, np.repeat(start, len(n))]) >> np.uint64(64 - bits_of(k))  # the start counts once per text
            weight = np.concatenate([in_train, self.train])
            by_key = np.argsort(every, kind="stable")
            ordered = every[by_key]
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
            at = np.empty(len(every), dtype=np.int64)
            at[by_key] = np.cumsum(new) - 1
            self.keys.append(ordered[new])
            self.counts.append(np.bincount(at, weights=weight, minlength=int(new.sum())).astype(np.int64))
            self.where.append(at[: len(token)])
            self.start_at.append(int(at[-1]) if len(n) else -1)

    def token_counts(self, totals: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order, every token's n-gram count and the count of its context."""
        found = [t[w] for t, w in zip(totals, self.where, strict=True)]
        out = [(found[0], np.zeros(0))]
        for k in range(1, len(found)):
            context = np.concatenate([[0], found[k - 1][:-1]])
            context[self.starts[:-1]] = totals[k - 1][self.start_at[k - 1]]
            out.append((found[k], context))
        return out


def start_key(order: int) -> int:
    start = mix(np.full(1, BOS))
    for k in range(2, order + 1):
        start = mix(start * np.uint64(2 * k + 1) + BOS)
    return int(start[0] >> np.uint64(64 - bits_of(order)))


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Context-frequency bucket: 0 for an unseen context, then one per power of two."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def ratio(count: np.ndarray, context: np.ndarray) -> np.ndarray:
    return np.divide(count, context, out=np.zeros(len(count)), where=context > 0)


def mixture(block: Block, totals: list[np.ndarray], tokens: int, vocabulary: int, weights: list[np.ndarray]) -> np.ndarray:
    """Probability of every token under as many orders as there are weights."""
    counts = block.token_counts(totals)
    p = np.full(len(counts[0][0]), 1.0 / (vocabulary + 1))
    for k, weight in enumerate(weights):
        count, context = counts[k][0], counts[k][1] if k else np.full(len(p), tokens)
        share = weight[bucket_of(context)]
        p = share * ratio(count, context) + (1 - share) * p
    return p


def learn_weights(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Expectation-maximisation over (bucket, binned estimate, binned lower-order probability, tokens).

    Bucket 0 is an unseen context: its weight is 0. A bucket without held-out tokens takes its lower neighbour's weight.
    """
    weight = np.full(66, np.nan)
    weight[0] = 0.0
    table = np.array(cells, dtype=np.int64).reshape(-1, 4)
    for b in np.unique(table[:, 0][table[:, 0] > 0]):
        _, high, low, n = table[table[:, 0] == b].T
        f, p, w = np.where(high == NONE, 0.0, 2.0 ** (high / STEPS)), 2.0 ** (low / STEPS), 0.5
        for _ in range(ROUNDS):
            w = float((n * w * f / (w * f + (1 - w) * p)).sum() / n.sum())
            w = min(max(w, 1e-6), 1 - 1e-6)  # a weight of 1 would give an unseen n-gram no probability
        weight[b] = w
    for b in range(1, len(weight)):
        if np.isnan(weight[b]):
            weight[b] = weight[b - 1] if b > 1 else 0.5
    return weight


NONE = -(1 << 20)


def _binned(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300)) * STEPS), NONE).astype(np.int64)


def score_texts(
    docs: DataFrame, order: int = 3, folds: int = 7, held_out_fold: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs` (an action).

    The model learns from rows outside the held-out fold. A null text is empty: its only token is the end. Rows with
    null or repeated ids are scored one by one; equal texts get equal scores. Other columns are ignored. An empty table
    gives an empty result. Without training tokens every token has probability 1.
    """
    blocks = LEAST_BLOCKS + blocks_for(docs, text, BLOCK_BYTES) - 1
    held_out = crc_fold(F.col(doc_id), folds) == held_out_fold
    rows = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), held_out.alias("held_out"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        block, out = Block(table, order), []
        for k, (keys, counts) in enumerate(zip(block.keys, block.counts, strict=True)):
            part = ((keys >> np.uint64(bits_of(k + 1) - 32)) * np.uint64(blocks)) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(blocks + 1, dtype=np.uint64))
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                mine = keys[cuts[r] : cuts[r + 1]]
                steps = np.concatenate([mine[:1], np.diff(mine)])
                out.append((k + 1, r, key[0].as_py(), len(mine), pack(steps), pack(counts[cuts[r] : cuts[r + 1]])))
        return _table(out, ASKED)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        lists = table.to_pylist()
        keys = np.concatenate([np.cumsum(unpack(x["keys"], x["n"]), dtype=np.uint64) for x in lists])
        counts = np.concatenate([unpack(x["counts"], x["n"]) for x in lists]).astype(np.int64)
        gone = np.concatenate([np.full(x["n"], x["block"] % DELETED == 0) for x in lists])
        by_key = np.argsort(keys, kind="stable")
        ordered = keys[by_key]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        at = np.empty(len(keys), dtype=np.int64)
        at[by_key] = np.cumsum(new) - 1
        total = np.bincount(at, weights=counts).astype(np.int64)
        deleted = np.bincount(at, weights=np.where(gone, counts, 0)).astype(np.int64)
        out, done = [], 0
        for x in lists:
            mine = at[done : done + x["n"]]
            done += x["n"]
            less = pack(deleted[mine]) if x["block"] % DELETED == 0 else None
            out.append((x["order"], x["bucket"], x["block"], x["n"], pack(total[mine]), less, None, None, None))
        word = ordered[new] != start_key(1)
        sums = (int(total[word].sum()), int(deleted[word].sum()), int((total[word] > 0).sum()))
        out.append((lists[0]["order"], lists[0]["bucket"], -1, 0, None, None, *sums))
        return _table(out, ANSWERED)

    asked = rows.groupBy("block").applyInArrow(ask, ASKED)
    answers = materialise(asked.groupBy("order", "bucket").applyInArrow(answer, ANSWERED), "gram-counts")
    sums = answers.where("block = -1 and order = 1").agg(F.sum("tokens"), F.sum("deleted"), F.sum("types")).first()
    tokens, gone, vocabulary = (int(x or 0) for x in sums)
    answers = answers.where("block >= 0").select("order", "bucket", "block", "n", "total", "less")

    def totals_of(table: pa.Table, less: bool) -> list[np.ndarray]:
        lists = sorted(table.to_pylist(), key=lambda x: (x["order"], x["bucket"]))
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(order)]
        for x in lists:
            total = unpack(x["total"], x["n"]).astype(np.int64)
            out[x["order"] - 1].append(total - unpack(x["less"], x["n"]).astype(np.int64) if less else total)
        return [np.concatenate(x) for x in out]

    def held_out_cells(k: int, weights: list[np.ndarray]):
        def of(table: pa.Table, counted: pa.Table) -> pa.Table:
            block, totals = Block(table, order), totals_of(counted, less=True)
            lower = mixture(block, totals, tokens - gone, vocabulary, weights)
            counts = block.token_counts(totals)[k]
            context = counts[1] if k else np.full(len(lower), tokens - gone)
            learn = np.repeat(block.train, np.diff(block.starts))
            cells = np.stack([bucket_of(context), _binned(ratio(counts[0], context)), _binned(lower)], axis=1)[learn]
            found, n = _distinct(cells)
            return pa.table({"b": found[:, 0], "high": found[:, 1], "low": found[:, 2], "n": n})

        return of

    weights: list[np.ndarray] = []
    deleted_rows, deleted_answers = (x.where(F.col("block") % DELETED == 0).groupBy("block") for x in (rows, answers))
    for k in range(order):
        cells = deleted_rows.cogroup(deleted_answers).applyInArrow(held_out_cells(k, weights), "b long, high long, low long, n long")
        cells = cells.groupBy("b", "high", "low").agg(F.sum("n").alias("n"))  # as many cells as bins at most
        weights.append(learn_weights([tuple(row) for row in cells.collect()]))

    def score(table: pa.Table, counted: pa.Table) -> pa.Table:
        block, totals = Block(table, order), totals_of(counted, less=False)
        c = block.token_counts(totals)[0][0]
        base = np.log10((c + 1) / (tokens + vocabulary + 1))
        model = np.log10(mixture(block, totals, tokens, vocabulary, weights))
        at = block.starts[:-1]
        n = len(at)
        per_doc = lambda x: np.add.reduceat(x, at) if n else np.zeros(0)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": np.diff(block.starts),
                "n_known": per_doc((c > 0).astype(np.int64)).astype(np.int64),
                "train_tokens": np.full(n, tokens),
                "base_score": per_doc(base),
                "score": per_doc(model),
            }
        )

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


ASKED = "order int, bucket int, block int, n long, keys binary, counts binary"
ANSWERED = "order int, bucket int, block int, n long, total binary, less binary, tokens long, deleted long, types long"
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [pa.field(name, ARROW[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of an integer table and how often each occurs."""
    if not len(cells):
        return cells, np.zeros(0, dtype=np.int64)
    ordered = cells[np.lexsort(cells.T)]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    at = np.flatnonzero(new)
    return ordered[at], np.diff(np.append(at, len(ordered)))
