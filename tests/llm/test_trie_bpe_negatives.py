"""Conversation tries, byte-level BPE and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import byte_bpe, hard_negatives, prefix_trie
from ledgerlark.llm.radix import Full, Indexed, RadixTree, Small
from tests.llm.conftest import words

# --- radix tree and conversation trie -----------------------------------------------------------------------------


def test_tree_keeps_every_key_and_grows_its_nodes():
    rng, tree, want = random.Random(3), RadixTree(), {}
    for i in range(4000):
        key = bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 9))) + bytes(rng.sample(range(256), rng.randint(0, 1)))
        tree.insert(key, i)
        want[key] = i
    assert all(tree.get(key) == value for key, value in want.items())
    assert tree.get(b"never there") is None
    assert [value for *_, value in prefix_trie.keys_in_order(tree)] == [want[key] for key in sorted(want)]
    kinds, stack = set(), [tree.root]
    while stack:
        node = stack.pop()
        kinds.add((type(node), getattr(node, "room", 0)))
        stack += [child for _, child in node.items()]
    assert kinds >= {(Small, 4), (Small, 16), (Full, 0)}
    forty = RadixTree()
    for byte in range(40):
        forty.insert(bytes([byte]), byte + 1)
    assert isinstance(forty.root, Indexed) and forty.get(b"\x27") == 40


def test_paths_without_branches_are_one_prefix():
    tree = RadixTree()
    tree.insert(b"x" * 1000, 1)
    tree.insert(b"x" * 600 + b"y", 2)
    assert tree.root.prefix == b"x" * 600 and len(list(tree.root.items())) == 2
    assert [(s, n) for s, n, _ in prefix_trie.keys_in_order(tree)] == [(0, 1000), (600, 601)]


def brute_trie(rows: list[tuple]) -> list[tuple]:
    own: dict[int, list] = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    members: dict[tuple, list[int]] = {}
    whole = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + mine[h:])
        for d in range(len(whole[c]) + 1):
            members.setdefault(whole[c][:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = sum(len(n) == len(node) + 1 for n in below)
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = hashlib.sha256(",".join(map(str, sorted(c for c in convs if whole[c] == node))).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), above, len(convs), children, leaves, saved, ends))
    return sorted(out, key=str)


def conversations(seed: int, n: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for c in range(n):
        shape = rng.random()
        for turn in range(1 if shape < 0.1 else rng.randint(1, 8)):
            text = "same" if shape < 0.3 else rng.choice(["a", "b", "😀é", ""])
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("keys", [1 << 20, 5])
def test_trie_equals_brute_force_in_one_range_and_in_many(spark, monkeypatch, keys):
    monkeypatch.setattr(prefix_trie, "SMALL", keys)
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    odd = [
        (500, None, "user", "first"), (500, 0, "user", "first"), (500, 0, "user", "first"), (500, 0, None, "tie"), (501, 3, None, None),
        (777, 1, "user", "x" * 5000), (777, 2, "user", "y"), (-5, 0, "user", "a"), (-105, 0, "user", "a"), (-100, 0, "system", "base"),
        (None, 0, "user", "no id"), (None, None, None, None),
    ]
    rows = conversations(1, 330) + odd
    table = spark.createDataFrame([(*r, "e", 1) for r in rows], "conv_id long, turn long, role string, text string, chars string, place int")
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(table))
    assert got.columns == [c.split()[0] for c in prefix_trie.NODES.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)


def test_trie_of_one_deep_conversation_and_of_none(spark):
    rows = [(100, i, "user", f"t{i}") for i in range(3000)] + [(101, i, "user", f"t{i}") for i in range(2500)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(prefix_trie.turn_lists(table)).collect()
    assert len(got) == 3001 and {r.depth for r in got} == set(range(3001)) and {r.n_leaves for r in got} == {1}
    assert {r.n_convs for r in got if 0 <= r.depth <= 2500} == {2} and {r.n_convs for r in got if r.depth > 2500} == {1}
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(table.limit(0))).collect() == []


# --- byte-level BPE -----------------------------------------------------------------------------------------------

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    return byte_bpe.ByteEncoder(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def made_up_texts() -> list[str]:
    rng = random.Random(5)
    texts = ["a" * 3000, "ab" * 2000, " " * 2000, "<|endoftext|>a <|endoftext|>", "\n \n x", "'s 're 'LL'll", "\x1c\x85 ", "<|endoftext", ""]
    texts += ["".join(rng.choice("aaabbbc  \n'1. étöß😀漢՘\x1c\U00030000 ") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return texts


def test_ids_equal_the_library(own, library):
    texts = made_up_texts()
    assert [own(t).tolist() for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_merges_on_joined_tokens(own):
    """Tokens side by side are where greedy matching goes wrong; one by one and in step."""
    model, rng = byte_bpe.read_model(PATH), random.Random(8)
    ranks, vocab, byte = {pair: r for r, pair in enumerate(model["merges"])}, list(model["vocab"]), {c: i for i, c in enumerate(byte_bpe.byte_letters())}
    pieces = ["".join(rng.choice(vocab) for _ in range(rng.randint(2, 4)))[:40] for _ in range(3000)]
    want = [[model["vocab"][t] for t in byte_bpe.reference_merges(piece, ranks)] for piece in pieces]
    raw = [bytes(byte[c] for c in piece) for piece in pieces]
    assert [own.encode(r).tolist() for r in raw] == want
    ends = np.cumsum([len(r) for r in raw])
    ids, size = own.encode.many(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(r) for r in raw], ends)
    assert ids.tolist() == sum(want, []) and size.tolist() == [len(w) for w in want]


def test_stretches_do_not_change_ids(own, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 7)
    texts = made_up_texts()[:1500] + [" ".join(words(2, 300)), "1.1.1.1" * 20, "!? " * 30]
    assert [own(t).tolist() for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_settled_characters_have_the_librarys_classes(own, library):
    for low, high in byte_bpe.SETTLED:
        text = "".join("x" + chr(c) + "1!" + chr(c) + " " for c in range(low, high + 1))
        assert [o for _, o in library.pre_tokenizer.pre_tokenize_str(text)] == [m.span() for m in byte_bpe_pattern().finditer(text)]


def byte_bpe_pattern():
    import regex

    return regex.compile(byte_bpe.PIECE)


def test_a_full_memory_starts_again(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 7)
    small, texts = byte_bpe.ByteEncoder(PATH), [" ".join(words(s, 30)) + "<|endoftext|>" for s in range(5)]
    ids, counts = small.many(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_texts_come_back(spark, odd, odd_rows, nothing, library):
    both = byte_bpe.decode_ids(byte_bpe.encode_texts(odd, PATH), PATH)
    assert both.columns == ["doc_id", "ids", "text"]
    want = [(row[0], library.encode(row[1] or "", add_special_tokens=False).ids, row[1] or "") for row in odd_rows]
    assert sorted(map(str, map(tuple, both.collect()))) == sorted(map(str, want))
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(nothing, PATH), PATH).collect() == []
    ids = spark.createDataFrame([(1, [50256, 72, 99999, -1, None]), (2, None), (3, [127, 447])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in byte_bpe.decode_ids(ids, PATH).collect()}
    assert got == {1: library.decode([50256, 72], skip_special_tokens=False), 2: "", 3: library.decode([127, 447], skip_special_tokens=False)}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.read_model(public.path("word_bpe_49k.json"))


# --- hard negatives -----------------------------------------------------------------------------------------------


def plain(a, b) -> int:
    return max(-hard_negatives.LIMIT, min(hard_negatives.LIMIT, sum(int(x) * int(y) for x, y in zip(a, b, strict=False))))


@pytest.mark.parametrize("high", [0, 1, 200, 60_000, 2**25, 2**31, 2**53, 2**70])
def test_packed_products_are_exact(high):
    rng = random.Random(high)
    draw = lambda n, k: [[rng.randint(-high, high) for _ in range(k)] for _ in range(n)]
    for k in (0, 1, 7, 64):
        a, c = draw(5, k), draw(23, k)
        as_rows = lambda m: np.array(m, dtype=object if high >= 2**53 else float).reshape(len(m), k)
        assert hard_negatives.packed_products(as_rows(a), as_rows(c)).tolist() == [[plain(x, y) for y in c] for x in a]


def brute_negatives(rows: list[tuple], every: int = 10) -> list[tuple]:
    kept = [
        (v, [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in e], g)
        for v, e, g in rows
        if g is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    key = lambda s, v: (-s, v is None, v or 0)
    out = []
    for i, (v, e, g) in enumerate(kept):
        if v is None or v % every:
            continue
        scored = [(plain(e, f), w, h) for j, (w, f, h) in enumerate(kept) if j != i]
        for p, w, _ in sorted([s for s in scored if s[2] == g], key=lambda s: key(s[0], s[1]))[:5]:
            fitting = sorted([s for s in scored if s[2] != g and 30 * p <= 100 * s[0] <= 90 * p], key=lambda s: key(s[0], s[1]))
            out += [(v, w, r, n, p, s) for r, (s, n, _) in enumerate(fitting[:10], 1)]
    return sorted(out, key=str)


def vectors(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-2, 3) / 8 for _ in range(6)], rng.randint(0, 3)) for i in range(n)]
    rows += [rows[20], rows[20], (None, rows[5][1], 1), (30, [0.5, 0.5], 0), (31, [], 0), (40, None, 1), (41, [0.1, None], 1)]
    rows += [(50, [float("nan")], 1), (60, [float("inf")], 2), (70, [1.0] * 6, None), (80, [1e9, -3e8, 0.2], 2), (90, [1e307, 2.0], 3), (91, [2e150] * 2, 3)]
    return rows


@pytest.mark.parametrize("spread", [1 << 12, 16])
def test_negatives_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "SMALL", spread)
    monkeypatch.setattr(hard_negatives, "TILE", 100)
    rows = vectors(4, 130)
    table = spark.createDataFrame([(*r, 1, "a", 0) for r in rows], "vec_id long, embedding array<double>, label int, at int, a string, bucket int")
    got = hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label string")
    assert hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0], "x")], "vec_id long, embedding array<float>, label string")
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).collect() == []
