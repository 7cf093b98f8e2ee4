"""The trie of conversation prefixes, and what sharing their prefixes saves.

A turn becomes a fixed-width id of WIDTH bytes; a conversation's key is its ids one after the other, so keys sort like their
turns. Equal conversations are folded to one key. Keys are dealt in ranges, so a prefix that a third of all conversations share
spreads over many tasks; every task puts its range into an adaptive radix tree and walks it in key order. Only byte
depths that are whole turns make nodes. Nodes on the way to a range's first or last key may go on in a neighbour: they leave the task as
parts, and one streaming pass over these parts (two paths per range) closes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import small_batches
from ledgerlark.llm.radix import RadixTree
from ledgerlark.operators.lineage import materialise

WIDTH = 16  # bytes of a turn id
RANGE_BYTES = 16 << 20  # keys of one tree
SPREAD, SMALL = 16, 1 << 12  # small tables are dealt over up to so many ranges, of so many keys each
PIECE = 1 << 18  # bytes of a list of ids that travel as one row
NOTHING = hashlib.sha256(b"").hexdigest()
PARTS = (
    "open boolean, shard int, path int, depth long, turn_id binary, chars long, conv_id long, parent_conv_id long, up_path int, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, as structs of place, id and chars (code points of the text).

    Turns are ordered by turn (null first), ties by role and text; null roles and texts are empty. Rows without a conv_id
    belong to no conversation. An id is a digest of role and text, so texts go no further than the sort; one conversation's ids are one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = rows.select(
        "conv_id", F.row_number().over(order).alias("place"), F.substring(digest, 1, 2 * WIDTH).alias("id"), F.length("text").alias("chars")
    )
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, turns): each conversation c with its first h turns replaced by those of conversation c - c % every, where
    h is the crc32 of the decimal c modulo `most`; all of them if that one is shorter, none if it is absent."""
    lists = turn_lists(conversations)
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = turn_lists(conversations.where(F.col("conv_id").cast("long") % every == 0))
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    both = lists.withColumn("base", base).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    return both.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _ends(members: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the members' decimal ids, ascending, joined by commas.

    Members are sorted by (digest, id) in ranges, so the copies of one conversation are spread, and leave as pieces of
    text; the pieces of a digest are hashed in a stream. No list of ids is ever whole in memory.
    """
    ordered = small_batches(members).repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, now, text, size, out = TaskContext.get().partitionId(), 0, None, [], 0, []

        def batch() -> pa.RecordBatch:
            digests, numbers, pieces = zip(*out, strict=True) if out else ((), (), ())
            columns = [pa.array(digests, pa.string()), pa.array([shard] * len(digests), pa.int32()), pa.array(numbers, pa.int64()), pa.array(pieces, pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["digest", "shard", "number", "piece"])

        for part in parts:
            for digest, conv_id in zip(part.column("digest").to_pylist(), part.column("conv_id").to_pylist(), strict=True):
                if text and (digest != now or size >= PIECE):
                    out.append((now, number, ",".join(text)))
                    number, text, size = number + 1, [], 0
                now = digest
                text.append(str(conv_id))
                size += len(text[-1]) + 1
            yield batch()
        if text:
            out.append((now, number, ",".join(text)))
        yield batch()

    pieces = ordered.mapInArrow(listed, "digest string, shard int, number long, piece string")
    streamed = pieces.repartition("digest").sortWithinPartitions("digest", "shard", "number")

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for part in parts:
            out = []
            for digest, piece in zip(part.column("digest").to_pylist(), part.column("piece"), strict=True):
                if digest == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = digest, hashlib.sha256()
                sha.update(piece.as_buffer())
            yield _rows(out, ("digest", "ends_sha256"), (pa.string(), pa.string()))
        if now is not None:
            yield _rows([(now, sha.hexdigest())], ("digest", "ends_sha256"), (pa.string(), pa.string()))

    return streamed.mapInArrow(hashed, "digest string, ends_sha256 string")


def _rows(rows: list[tuple], names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))


PART_NAMES = tuple(c.split()[0] for c in PARTS.split(", "))
PART_TYPES = tuple(
    {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in PARTS.split(", ")
)
NODE_NAMES = ("path_shard", "path", *(c.split()[0] for c in NODES.split(", ")))
NODE_TYPES = (pa.int32(), pa.int32(), *([pa.int64()] * 7), pa.string())


class _Node:
    """A turn-aligned node while the walk is below it: what its finished children have given, and their rows."""

    __slots__ = ("chars", "n", "least", "children", "leaves", "saved", "ends", "first", "turn_id", "rows", "parts")

    def __init__(self, chars: int) -> None:
        self.chars, self.n, self.least, self.children, self.leaves, self.saved = chars, 0, None, 0, 0, 0
        self.ends, self.first, self.turn_id, self.rows, self.parts = None, False, None, [], []

    def end_here(self, n: int, least: int, ends: str) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)
        self.ends = ends

    def finish(self) -> None:
        """The totals of its subtree."""
        if not self.children:
            self.leaves = 1
        self.saved += (self.n - 1) * self.chars

    def take(self, child: _Node) -> None:
        self.n += child.n
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved


def keys_in_order(tree: RadixTree) -> Iterator[tuple[int, int, object]]:
    """For every key in ascending order: how many bytes it shares with the key before it, its length and its value."""
    stack = [(tree.root, 0, 0)] if tree.root is not None else []
    while stack:
        node, start, shared = stack.pop()
        end = start + len(node.prefix)
        if node.value is not None:
            yield shared, end, node.value
            shared = end
        children = list(node.items())
        for i in range(len(children) - 1, -1, -1):
            stack.append((children[i][1], end + 1, end if i else shared))


def _walk(tree: RadixTree, first: bytes, last: bytes, shard: int) -> Iterator[tuple]:
    """PARTS of one range: finished nodes, and parts of those on the way to its first or last key."""
    stack: list[_Node] = []

    def turn(key: bytes, depth: int) -> bytes:
        return key[(depth - 1) * WIDTH : depth * WIDTH] if depth else b""

    def close(path: int | None) -> Iterator[tuple]:
        """Take the deepest node off; `path` 1 at the end of the range."""
        node, depth = stack.pop(), len(stack)
        if node.first or path is not None:
            path, key = (0, first) if node.first else (1, last)
            for row in node.rows:
                yield (False, shard, path, row[1], None, None, row[0], None, depth, *row[2:])
            yield (True, shard, path, depth, turn(key, depth), node.chars, node.least, None, None, node.n, node.children, node.leaves, node.saved, node.ends)
            return
        node.finish()
        for row in node.rows:
            yield (False, shard, None, row[1], None, None, row[0], node.least, None, *row[2:])
        parent = stack[-1]
        parent.take(node)
        parent.rows.append((node.least, depth, node.n, node.children, node.leaves, node.saved, node.ends or NOTHING))

    for shared, length, (n, least, ends, chars) in keys_in_order(tree):
        keep = 1 + shared // WIDTH if stack else 0
        while len(stack) > keep:
            yield from close(None)
        begin, lengths = not stack, np.frombuffer(chars, dtype=np.int32)
        while len(stack) <= length // WIDTH:
            stack.append(_Node(int(lengths[len(stack) - 1]) if stack else 0))
            stack[-1].first = begin
        stack[-1].end_here(n, least, ends)
    while stack:
        yield from close(1)


def _merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The finished nodes of the parts, which come in the order of shard, path and depth: for each of its parts
    (shard, path, conv_id, depth, null...), and once the node itself without a shard."""
    stack: list[_Node] = []

    def close() -> Iterator[tuple]:
        node, depth = stack.pop(), len(stack)
        node.finish()
        for shard, path in node.parts:
            yield (shard, path, node.least, depth, *[None] * 6)
        for row in node.rows:
            yield (None, None, row[0], row[1], node.least, *row[2:])
        row = (node.least, depth, node.n, node.children, node.leaves, node.saved, node.ends or NOTHING)
        if stack:
            stack[-1].take(node)
            stack[-1].rows.append(row)
        else:
            yield (None, None, row[0], row[1], None, *row[2:])

    for shard, path, depth, turn_id, chars, n, least, children, leaves, saved, ends in rows:
        if len(stack) <= depth or stack[depth].turn_id != turn_id:
            while len(stack) > depth:
                yield from close()
            stack.append(_Node(chars))
            stack[-1].turn_id = turn_id
        node = stack[depth]
        node.parts.append((shard, path))
        node.n += n
        if least is not None:
            node.least = least if node.least is None else min(node.least, least)
        node.children, node.leaves, node.saved, node.ends = node.children + children, node.leaves + leaves, node.saved + saved, node.ends or ends
    while stack:
        yield from close()


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, from the root without turns (depth 0): conv_id, the smallest member;
    depth; parent_conv_id, that of the node above; n_convs, its members; n_children; n_leaves, the childless nodes of its
    subtree; saved_tokens, the code points that its subtree need not repeat; ends_sha256 of the members that end there.

    `lists` holds (conv_id, turns) as turn_lists gives them, one row per conversation; a null conv_id is left out, null or empty turns
    end at the root. Turns are equal if role and text are. Other columns are ignored. Without conversations there is no node.
    """
    ids = F.transform("turns", lambda t: t["id"])
    found = lists.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.coalesce(F.unhex(F.array_join(ids, "")), F.lit(b"")).alias("key"),
        F.coalesce(F.transform("turns", lambda t: t["chars"].cast("int")), F.array().cast("array<int>")).alias("chars"),
    )
    found = materialise(found.withColumn("digest", F.sha2("key", 256)), "sequences")
    folded = found.groupBy("digest", "key", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    keys = materialise(folded.join(_ends(found.select("digest", "conv_id")), "digest").drop("digest"), "prefix-keys")
    size = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("key").cast("long")), F.lit(0)).alias("bytes")).first()
    ranges = max(size["bytes"] // RANGE_BYTES + 1, min(SPREAD, -(-size["n"] // SMALL)))

    def grow(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, first, last = RadixTree(), None, None
        for part in parts:
            lengths = part.column("chars")
            at, flat = lengths.offsets.to_numpy(), lengths.values.to_numpy(zero_copy_only=False).astype(np.int32)
            columns = (part.column(c).to_pylist() for c in ("key", "n", "least", "ends_sha256"))
            for i, (key, n, least, ends) in enumerate(zip(*columns, strict=True)):
                tree.insert(key, (n, least, ends, flat[at[i] : at[i + 1]].tobytes()))
                first = key if first is None else min(first, key)
                last = key if last is None else max(last, key)
        if first is None:
            return
        out = []
        for row in _walk(tree, first, last, TaskContext.get().partitionId()):
            out.append(row)
            if len(out) == 5_000:
                yield _rows(out, PART_NAMES, PART_TYPES)
                out = []
        yield _rows(out, PART_NAMES, PART_TYPES)

    parts = materialise(small_batches(keys).repartitionByRange(ranges, "key").mapInArrow(grow, PARTS), "prefix-parts")
    opened = parts.where("open").select("shard", "path", "depth", "turn_id", "chars", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in batches for row in zip(*[c.to_pylist() for c in part.columns], strict=True))
        out = []
        for row in _merged(rows):
            out.append(row)
            if len(out) == 5_000:
                yield _rows(out, NODE_NAMES, NODE_TYPES)
                out = []
        yield _rows(out, NODE_NAMES, NODE_TYPES)

    borders = opened.repartition(1).sortWithinPartitions("shard", "path", "depth")  # two paths per range
    borders = materialise(borders.mapInArrow(close, f"path_shard int, path int, {NODES}"), "prefix-borders")
    names = [c.split()[0] for c in NODES.split(", ")]
    above = borders.where(F.col("path_shard").isNotNull()).select(
        F.col("path_shard").alias("shard"), "path", F.col("depth").cast("int").alias("up_path"), F.col("conv_id").alias("above")
    )
    closed = parts.where(~F.col("open"))
    waiting = closed.where(F.col("path").isNotNull()).join(above, ["shard", "path", "up_path"])
    return (
        closed.where(F.col("path").isNull()).select(names)
        .union(waiting.withColumn("parent_conv_id", F.col("above")).select(names))
        .union(borders.where(F.col("path_shard").isNull()).select(names))
    )
