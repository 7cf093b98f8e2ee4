"""Groups of near-duplicate documents: banded MinHash, odd sketches, exact confirmation, components.

One pass reduces every text to the size and digest of its shingle set, the keys of its MinHash bands and an odd sketch:
the parities of the hashed MinHash samples. Equal sets form one class, and only one row of a class goes on. In every
band bucket the members meet the bucket's first and last member; pairs whose sketches differ in too many bits are
dropped, the others are confirmed on their full sets, and linked classes are merged. In buckets that then still hold
several components every pair across components is compared, in pieces of bounded size: sketches first, then the full
sets of the pairs that pass; only links that join two components leave a piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import Words, mix, rows_of, shingle_sets, slices, small_batches, text_key
from ledgerlark.llm.components import components
from ledgerlark.operators.lineage import materialise


@dataclass(frozen=True)
class Linking:
    """A pair with Jaccard similarity `percent`/100 shares no band with probability (1 - (percent/100)**rows)**bands,
    about one in a million for the defaults, and less above. `slack` is five standard errors of the sketch estimate."""

    words: int = 5
    percent: int = 75
    bands: int = 50
    rows: int = 5
    bits: int = 1024
    slack: float = 0.16
    chunk: int = 1024  # members of a bucket compared in one piece of work


SKETCHED = "text_key long, doc_id {id}, n long, digest binary, bands array<long>, odd binary"


class Sketcher:
    def __init__(self, how: Linking) -> None:
        self.how, self.words = how, Words()
        seeds = mix(np.arange(1, 2 * how.bands * how.rows + 1, dtype=np.uint64))
        self.times = seeds[: how.bands * how.rows].astype(np.uint32) | np.uint32(1)
        self.plus = seeds[how.bands * how.rows :].astype(np.uint32)

    def sets(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct shingles of every text, one after the other, and where each set begins."""
        keys, first, _, _ = self.words(column)
        shingles, starts = shingle_sets(keys, first, self.how.words)
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            one = np.sort(shingles[a:b])
            out.append(one[np.concatenate([[True], one[1:] != one[:-1]])] if len(one) else one)
        return np.concatenate([np.zeros(0, np.uint64), *out]), np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)])

    def sketch(self, column: pa.Array) -> tuple[np.ndarray, list, list, list]:
        """Set sizes, set digests, band keys and odd sketches; a text without words has none of the last three."""
        how, (shingles, starts) = self.how, self.sets(column)
        sizes = np.diff(starts)
        some = np.flatnonzero(sizes)
        digests, bands, odd = [None] * len(sizes), [None] * len(sizes), [None] * len(sizes)
        if len(some):
            at = starts[:-1][some]
            sums = np.stack([np.add.reduceat(mix(shingles), at), np.add.reduceat(mix(~shingles), at)], axis=1)
            narrow = (shingles >> np.uint64(32)).astype(np.uint32)
            samples = np.empty((len(self.times), len(some)), dtype=np.uint32)
            work = np.empty_like(narrow)
            for k, (times, plus) in enumerate(zip(self.times, self.plus, strict=True)):
                np.multiply(narrow, times, out=work)
                np.add(work, plus, out=work)
                np.minimum.reduceat(work, at, out=samples[k])
            keys = np.zeros((how.bands, len(some)), dtype=np.uint64) + np.arange(1, how.bands + 1, dtype=np.uint64)[:, None]
            for row in range(how.rows):
                keys = mix(keys + samples[row :: how.rows])
            place = mix(samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64)[:, None] << np.uint64(32)))
            place = (place % np.uint64(how.bits)).astype(np.int64) + np.arange(len(some)) * how.bits
            parity = np.bincount(place.ravel(), minlength=how.bits * len(some)).reshape(len(some), how.bits) & 1
            packed, keys = np.packbits(parity.astype(np.uint8), axis=1), keys.T.astype(np.int64)
            for i, k in enumerate(some.tolist()):
                digests[k], bands[k], odd[k] = sums[i].tobytes(), keys[i], packed[i].tobytes()
        return sizes, digests, bands, odd


def estimate(differing: np.ndarray, bits: int, samples: int) -> np.ndarray:
    """Jaccard similarity from the number of differing bits of two odd sketches."""
    share = np.minimum(2 * differing / bits, 1 - 1e-9)
    return 1 + bits / (4 * samples) * np.log1p(-share)


def most_differing(how: Linking) -> int:
    """Bits by which two sketches of a linked pair may differ."""
    counts = np.arange(how.bits + 1)
    passing = estimate(counts, how.bits, how.bands * how.rows) >= how.percent / 100 - how.slack
    return int(counts[passing].max())


def sketches(docs: DataFrame, how: Linking, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One written row per document: row_id, doc_id, text_key, set size and digest, band keys, odd sketch."""
    rows = small_batches(docs).select(text_key(doc_id, text), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = SKETCHED.format(id=rows.schema["doc_id"].dataType.simpleString())

    def reduce(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketcher(how)
        for part in parts:
            for piece in slices(part, "text"):
                sizes, digests, bands, odd = own.sketch(piece.column("text"))
                columns = [
                    piece.column("text_key"),
                    piece.column("doc_id"),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(odd, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "doc_id", "n", "digest", "bands", "odd"])

    return materialise(rows.mapInArrow(reduce, schema).withColumn("row_id", F.monotonically_increasing_id()), "sketches")


def _confirmed(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, how: Linking, doc_id: str, text: str) -> DataFrame:
    """(a, b, linked) for the written pairs: the share of common shingles in the full sets, from the texts again."""
    keyed = nodes.select("row_id", "text_key", "n")
    wide = pairs.join(keyed.toDF("a", "key_a", "n_a"), "a").join(keyed.toDF("b", "key_b", "n_b"), "b")
    wide = materialise(wide, "pair-keys")
    texts = _texts(docs, wide.select(F.explode(F.array("key_a", "key_b")).alias("text_key")), doc_id, text)

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketcher(how)
        for part in parts:
            linked = []
            for at in range(0, part.num_rows, 256):
                piece = part.slice(at, 256)
                (left, i), (right, j) = own.sets(piece.column("text_a")), own.sets(piece.column("text_b"))
                for k in range(piece.num_rows):
                    x, y = left[i[k] : i[k + 1]], right[j[k] : j[k + 1]]
                    linked.append(_linked(x, y, how))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    full = wide.join(texts.toDF("key_b", "text_b"), "key_b").join(texts.toDF("key_a", "text_a"), "key_a")
    return materialise(full.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long, linked boolean"), "confirmed")


def _sketch_filter(pairs: DataFrame, nodes: DataFrame, how: Linking) -> DataFrame:
    """Pairs whose set sizes and odd sketches allow a link."""
    side = nodes.select("row_id", "n", _numbers("odd", how))
    both = pairs.join(side.toDF("a", "n_a", "odd_a"), "a").join(side.toDF("b", "n_b", "odd_b"), "b")
    differing = sum(
        (F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(how.bits // 48 + 1)), start=F.lit(0)
    )
    sized = 100 * F.least("n_a", "n_b") >= how.percent * F.greatest("n_a", "n_b")
    return both.where(sized & (differing <= most_differing(how))).select("a", "b")


def _numbers(odd: str, how: Linking) -> Column:
    """A packed sketch as numbers of 48 bits."""
    part = lambda i: F.conv(F.hex(F.substring(odd, 6 * i + 1, 6)), 16, 10).cast("long")
    return F.array(*[F.coalesce(part(i), F.lit(0)) for i in range(how.bits // 48 + 1)])


PIECE = ["bucket", "lo", "hi"]


def _chunked(open_buckets: DataFrame, how: Linking) -> DataFrame:
    """The members of each bucket in chunks of about how.chunk, repeated for every pair of chunks they belong to."""
    chunks = F.ceil(F.col("size") / how.chunk).cast("int")
    own = F.pmod(F.xxhash64("row_id"), chunks).cast("int")
    rows = open_buckets.withColumns({"chunks": chunks, "own": own})
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    lo, hi = F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    return rows.select("bucket", lo, hi, "own", "band", "row_id", "component", "text_key")


def _passing(group: pa.Table, how: Linking, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members of a piece that are of different components, share no earlier band, and may be linked by their
    sizes and sketches; with the number of differing bits."""
    component, n, own = (group.column(c).to_numpy() for c in ("component", "n", "own"))
    odd = np.frombuffer(b"".join(group.column("odd").to_pylist()), dtype=np.uint64).reshape(len(n), -1)
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(n), -1)[:, : group.column("band")[0].as_py()]
    two = group.column("lo")[0] != group.column("hi")[0]
    left = np.flatnonzero(own == own.min()) if two else np.arange(len(n))
    right = np.flatnonzero(own != own.min()) if two else left
    found = []
    for at in range(0, len(left), 256):
        x = left[at : at + 256]
        small, large = np.minimum(n[x][:, None], n[right]), np.maximum(n[x][:, None], n[right])
        passing = (100 * small >= how.percent * large) & (component[x][:, None] != component[right])
        if not two:
            passing &= x[:, None] < right
        i, j = np.nonzero(passing)
        i, j = x[i], right[j]
        differing = np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64)
        good = np.flatnonzero(differing <= limit)
        good = good[~(bands[i[good]] == bands[j[good]]).any(axis=1)]
        found.append((i[good], j[good], differing[good]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _links_across(open_buckets: DataFrame, docs: DataFrame, nodes: DataFrame, how: Linking, doc_id: str, text: str) -> DataFrame:
    """Links (a, b) that join the components of each bucket as far as its pairs are linked, confirmed on the full sets.

    A pair is compared in the first bucket it shares. Members with a pair that passes the sketches are found first, so
    that only their texts are sent.
    """
    limit, sketch = most_differing(how), nodes.select("row_id", "n", "odd", "bands")
    kept = ["bucket", "lo", "hi", "own", "band", "row_id", "component", "text_key"]

    def active(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(parts, PIECE):
            i, j, _ = _passing(group, how, limit)
            some = np.zeros(group.num_rows, dtype=bool)
            some[i] = some[j] = True
            if some.any():
                yield from group.filter(pa.array(some)).select(kept).to_batches()

    def link(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketcher(how)
        for group in whole_groups(parts, PIECE):
            i, j, differing = _passing(group, how, limit)
            sets, starts = own.sets(group.column("text").combine_chunks())
            row, component = group.column("row_id").to_numpy(), group.column("component").to_pylist()
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while x in root:
                    x = root[x]
                return x

            links = []
            for k in np.argsort(differing, kind="stable").tolist():
                x, y = int(i[k]), int(j[k])
                a, b = top(component[x]), top(component[y])
                if a != b and _linked(sets[starts[x] : starts[x + 1]], sets[starts[y] : starts[y + 1]], how):
                    root[max(a, b)] = min(a, b)
                    links.append((x, y))
            if links:
                x, y = row[np.array(links).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    rows = _chunked(open_buckets, how).join(sketch, "row_id").select(*kept, "n", "odd", "bands")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(kept).schema)
    found = materialise(rows.repartition(*PIECE).sortWithinPartitions(*PIECE).mapInArrow(active, kinds), "active")
    texts = _texts(docs, found.select("text_key"), doc_id, text)
    full = found.join(sketch, "row_id").join(texts, "text_key").select(*kept, "n", "odd", "bands", "text")
    return materialise(full.repartition(*PIECE).sortWithinPartitions(*PIECE).mapInArrow(link, "a long, b long").distinct(), "links")


def _linked(x: np.ndarray, y: np.ndarray, how: Linking) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= how.percent * (len(x) + len(y) - common)


def _texts(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(text_key, text), written, for the given keys."""
    needed = materialise(keys.distinct(), "needed-texts")
    rows = docs.select(text_key(doc_id, text), F.coalesce(text, F.lit("")).alias("text"))
    return materialise(rows_of(rows, needed, "text_key").dropDuplicates(["text_key"]), "texts")


def whole_groups(parts: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The groups of consecutive rows with equal keys in a sorted stream of batches."""
    rest: pa.Table | None = None
    for part in parts:
        table = pa.Table.from_batches([part])
        rest = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        columns = [rest.column(k).to_numpy() for k in key]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *change[:-1].tolist()], change.tolist(), strict=True) if len(change) else ():
            yield rest.slice(a, b - a)
        rest = rest.slice(change[-1]) if len(change) else rest
    if rest is not None and rest.num_rows:
        yield rest


def near_duplicates(docs: DataFrame, how: Linking = Linking(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) of every row of `docs` (an action).

    component_id is the smallest id that linked documents lead to, kept says that it is the row's own. A text without
    words (null, empty, white space) has an empty set and is linked with nothing. Rows of equal sets are linked, so a
    repeated row shares its component; rows that repeat the kept id are all kept. A row without id takes part in the
    linking: its component_id is that of the group, or null if no row of the group has an id, and only then it is kept.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows = sketches(docs, how, doc_id, text)
    classes = rows.where("n > 0").groupBy("digest", "n").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("least_id"))
    classes = materialise(classes, "set-classes")
    nodes = rows_of(rows, classes.select(F.col("node").alias("row_id")), "row_id")
    bucket = Window.partitionBy("bucket")
    members = nodes.select("row_id", "text_key", F.posexplode("bands").alias("band", "bucket"))
    ends = F.count("*").over(bucket).alias("size"), F.min("row_id").over(bucket).alias("head"), F.max("row_id").over(bucket).alias("tail")
    buckets = materialise(members.select("*", *ends).where("size > 1"), "buckets")

    to_head = buckets.where("row_id > head").select(F.col("head").alias("a"), F.col("row_id").alias("b"))
    to_tail = buckets.where("row_id > head and row_id < tail").select(F.col("row_id").alias("a"), F.col("tail").alias("b"))
    pairs = materialise(_sketch_filter(to_head.union(to_tail).distinct(), nodes, how), "pairs")
    labels = components(_confirmed(docs, pairs, nodes, how, doc_id, text).where("linked").select("a", "b"))

    mixed = F.min("component").over(bucket) < F.max("component").over(bucket)
    labelled = buckets.where("size > 2").join(labels.toDF("row_id", "component"), "row_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "row_id")).withColumn("mixed", mixed)
    more = _links_across(labelled.where("mixed"), docs, nodes, how, doc_id, text)
    if not more.isEmpty():
        labels = components(more.union(labels.toDF("a", "b")))

    grouped = classes.join(labels.toDF("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = grouped.join(least, "component").select("digest", "n", "component_id")
    joined = rows.select("doc_id", "digest", "n", "text_key").join(of_class, ["digest", "n"], "left")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    named = joined.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), "text_key")
    return named.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key")
