"""Operators on a whole corpus against brute force on small tables."""

from __future__ import annotations

import json
import random
import re
from collections import Counter
from dataclasses import replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlark.llm import chat, decontaminate, mixing, near_dup
from ledgerlark.llm.components import components
from ledgerlark.llm.queries import ORACLE, QUERIES
from ledgerlark.testbed import adapter  # noqa: F401  the rest of the library is there
from tests.llm.conftest import words
from tests.llm.test_text_operators import split

DOCS = "doc_id long, text string"


# --- near duplicates --------------------------------------------------------------------------------------------


def shingle_set(text: str | None) -> frozenset:
    w = split(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def grouped(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """Set size and smallest id of the component of every row with an id, by comparing all pairs."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            root[max(top(i), top(j))] = min(top(i), top(j))
    out = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids = [d for k, (d, _) in enumerate(rows) if d is not None and top(k) == top(i)]
            out[doc_id] = (len(sets[i]), min(ids))
    return out


def edited(rng: random.Random, text: list[str], changes: int) -> list[str]:
    out = list(text)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def copies(seed: int) -> list[tuple]:
    """Groups of edited copies from near to far, chains, exact copies, and texts that share a passage."""
    rng, rows = random.Random(seed), []
    for g in range(12):
        base = words(1000 * seed + g, rng.choice([6, 20, 60, 150]), 3000)
        chain = base
        for k in range(rng.choice([2, 8, 30])):
            chain = edited(rng, chain, 1) if g % 3 == 0 else edited(rng, base, rng.randrange(0, 1 + len(base) // 12))
            rows.append(" ".join(chain))
    passage = words(77, 60, 3000)
    rows += [" ".join(words(2000 + k, 15, 3000) + passage + words(3000 + k, rng.randrange(30), 3000)) for k in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, chunk", [(1, 1024), (2, 7)])
def test_components_equal_all_pairs(spark, seed, chunk):
    rows = copies(seed)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS), replace(near_dup.Linking(), chunk=chunk)).collect()
    want = grouped(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows_are_grouped(spark, odd, odd_rows):
    got = near_dup.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    want = grouped([r[:2] for r in odd_rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    alone = [r for r in got if r.doc_id is None]
    assert all(r.kept and r.component_id is None for r in alone)


def test_no_documents_no_groups(nothing):
    assert near_dup.near_duplicates(nothing).count() == 0


def test_sketches_estimate_similarity():
    how, rng = near_dup.Linking(), random.Random(9)
    base = words(5, 400, 5000)
    texts = [" ".join(base)] + [" ".join(edited(rng, base, c)) for c in (2, 8, 15, 30)]
    _, _, _, odd = near_dup.Sketcher(how).sketch(pa.array(texts))
    bits = [np.frombuffer(o, dtype=np.uint64) for o in odd]
    for text, one in zip(texts, bits, strict=True):
        a, b = shingle_set(texts[0]), shingle_set(text)
        differing = np.array([int(np.bitwise_count(bits[0] ^ one).sum())])
        assert near_dup.estimate(differing, how.bits, how.bands * how.rows)[0] == pytest.approx(len(a & b) / len(a | b), abs=0.12)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_stars_and_loops(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    root = {n: n for e in edges for n in e}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    got = dict(map(tuple, components(spark.createDataFrame(edges + edges[:9], "a long, b long")).collect()))
    assert {n: got.get(n, n) for n in root} == {n: top(n) for n in root}


# --- decontamination --------------------------------------------------------------------------------------------


def smith_waterman(x: list[str], y: list[str]) -> int:
    best, table = 0, [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            step = 2 if x[i - 1] == y[j - 1] else -1
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_equals_the_textbook():
    rng = np.random.default_rng(1)
    for n in (1, 5, 20):
        piece = rng.integers(0, 4, n)
        windows = rng.integers(0, 4, (6, 25))
        want = [smith_waterman(list(map(str, piece)), list(map(str, w))) for w in windows]
        assert decontaminate.align(piece, windows.astype(np.int32)).tolist() == want


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(3)
    items = {i: words(500 + i, rng.randint(12, 60), 4000) for i in range(30)}
    items[30] = ["too", "short"]
    docs, planted = [], {}
    for d in range(300):
        text = words(9000 + d, 80, 4000)
        if d % 5 == 0:
            i, at = rng.randrange(30), rng.randrange(len(text))
            copy = list(items[i])
            for _ in range(len(copy) // 10 if d % 10 else 0):
                copy[rng.randrange(len(copy))] = "changed"
            if d % 15 == 0:
                copy = [w.upper() + "," for w in copy]
            text[at:at] = copy
            planted[d] = i
        docs.append((d, " ".join(text)))
    docs += [(1000 + k, " ".join(words(1, 10) + items[7])) for k in range(100)]  # a passage in a third of the documents
    planted |= {1000 + k: 7 for k in range(100)}
    bench = [(i, " ".join(t)) for i, t in items.items()] + [(31, None), (32, "")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id long, text string"), docs, items, planted


@pytest.mark.parametrize("block_words", [400_000, 300])
def test_leaks_equal_an_alignment_of_everything(leaky, block_words):
    docs, bench, rows, items, planted = leaky
    how = decontaminate.Leaks(block_words=block_words)
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, bench, how).collect()}
    assert set(planted.items()) <= set(got)
    clean = lambda t: [w for w in re.split(decontaminate.PARTING, t.lower()) if w]
    for d, text in rows[:40] + rows[-2:]:
        for i, item in items.items():
            if len(item) >= how.least:
                score = smith_waterman(clean(" ".join(item)), clean(text))
                assert ((d, i) in got) == (score >= min(how.share * 2 * len(item), 2 * how.long))
                assert got.get((d, i), score) == score


def test_part_of_an_item_is_found(spark):
    item = words(12, 60, 4000)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = [(d, " ".join(words(700 + d, 40, 4000) + item[:n] + words(800 + d, 40, 4000))) for d, n in ((1, 26), (2, 10))]
    assert [r.doc_id for r in decontaminate.leaks(spark.createDataFrame(docs, DOCS), bench).collect()] == [1]


def test_long_items_are_looked_for_in_pieces(spark):
    long = words(4, 1000, 5000)
    bench = spark.createDataFrame([(1, " ".join(long))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(long[450:800])), (2, " ".join(words(8, 900, 5000)))], DOCS)
    pieces = decontaminate.pieces_of(bench, decontaminate.Leaks(piece=400), "item_id", "text").orderBy("piece").collect()
    assert [w for p in pieces for w in p.words] == long and [len(p.words) for p in pieces] == [400, 400, 200]
    assert [r.doc_id for r in decontaminate.leaks(docs, bench).collect()] == [1]


def test_odd_rows_leak_nothing_unplanted(spark, odd, odd_rows, nothing):
    bench = spark.createDataFrame([(1, " ".join(split(odd_rows[8][1])[5000:5030])), (2, None)], "item_id long, text string")
    got = decontaminate.leaks(odd, bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(8, 1)] and got[0].share == 1
    assert decontaminate.leaks(nothing, bench).count() == 0
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------------------------


def water(given: int, children: dict) -> dict:
    """Budgets of children (capacity, weight): fill up, round by round, those that cannot use their share."""
    paid: dict = {}
    while True:
        rest = {c: v for c, v in children.items() if c not in paid}
        left, weight = given - sum(paid.values()), sum(w for _, w in rest.values())
        full = {c: cap for c, (cap, w) in rest.items() if left * w > cap * weight}
        if not full:
            return paid | {c: min(cap, left * w // weight) for c, (cap, w) in rest.items()}
        paid |= full


def test_budgets_redistribute_among_siblings_first(spark):
    rng = random.Random(6)
    leaves = [(f"d{d}", f"l{m}", f"s{s}", rng.choice([0, 5, 50, 500, 5000])) for d in range(3) for m in range(3) for s in range(4)]
    for per_mille, epochs in ((300, 1), (900, 1), (1000, 1), (1500, 2)):
        mix = mixing.Mix(weights={"domain": {"d0": 5}, "lang": {"l1": 3}}, per_mille=per_mille, epochs=epochs)
        df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, mix).collect()}
        cap = lambda *path: epochs * sum(t for *p, t in leaves if tuple(p[: len(path)]) == path)
        total = sum(t for *_, t in leaves) * per_mille // 1000
        want = {}
        for d, given in water(total, {d: (cap(d), 5 if d == "d0" else 1) for d in ("d0", "d1", "d2")}).items():
            for m, part in water(given, {m: (cap(d, m), 3 if m == "l1" else 1) for m in ("l0", "l1", "l2")}).items():
                for s, one in water(part, {f"s{k}": (cap(d, m, f"s{k}"), 1) for k in range(4)}).items():
                    want[d, m, s] = one
        assert got == want


def test_leaves_take_seeded_prefixes(spark, odd, odd_rows):
    rows = [(i, " ".join(words(i, 1 + i % 9)), "en" if i % 3 else "de", f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", F.lit("d"))
    mix = mixing.Mix(per_mille=1300, epochs=2, seed=3)
    chosen = mixing.mixture(docs, mix).collect()
    leaf_tokens = Counter()
    for i, t, lang, source in rows:
        leaf_tokens[lang, source] += len(t.split())
    taken = Counter()
    for r in chosen:
        taken[r.lang, r.source] += r.mix_tokens
    leaves = spark.createDataFrame([("d", *k, v) for k, v in leaf_tokens.items()], "domain string, lang string, source string, tokens long")
    for b in mixing.budgets(leaves, mix).collect():
        assert taken[b.lang, b.source] <= b.budget < taken[b.lang, b.source] + 9
    seen = Counter((r.doc_id, r.mix_epoch) for r in chosen)
    assert max(seen.values()) == 1
    assert {(r.doc_id, r.mix_epoch) for r in mixing.mixture(docs.repartition(5), mix).collect()} == set(seen)
    named = odd.withColumn("domain", F.lit(None).cast("string"))
    whole = mixing.mixture(named, mixing.Mix(per_mille=1000))
    assert whole.columns == [*named.columns, "mix_epoch", "mix_tokens"]
    assert Counter(map(tuple, whole.select(*named.columns).collect())) == Counter(map(tuple, named.collect()))


def test_mix_of_nothing(nothing):
    assert mixing.mixture(nothing.withColumn("domain", F.lit("d")), mixing.Mix()).count() == 0


# --- chat -------------------------------------------------------------------------------------------------------


def test_formatting_can_be_undone(spark):
    texts = ["", None, "\\", "<|im_end|>\n", "a<|im_start|>assistant\nb", "\\<|", "<\\|", "é\n\n<|<|", "x\\\\n"]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "odd\nrole", "r\\<|", None]), rng.choice(texts), "x") for c in range(40) for t in range(6)]
    rows += [(None, 1, "assistant", "no id", "x"), (7, None, "user", "no turn", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.parse_formatted(chat.format_turns(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [tuple(t) for t in row.turns] == [(r[2] or "", r[3] or "") for r in mine]
        assert row.learned == [r[3] or "" for r in mine if r[2] == "assistant"]
    for r in chat.format_turns(df).collect():
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(got[r.conv_id].turns)


def test_layouts_are_told_by_their_fields(spark):
    records = [
        {"messages": [{"role": "system", "content": "s"}, {"content": 5, "role": "user"}]},
        {"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": None}]},
        {"output": "o", "instruction": "i", "input": "n"},
        {"instruction": "i", "output": "o"},
        {"prompt": "p", "completion": "c"},
        {"response": "r", "prompt": None},
        {"other": 1},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(7, "{broken"), (8, None)]
    turns = chat.turns_of_records(spark.createDataFrame(rows, "id long, record string"), "id", "record")
    got = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    lost = [(None, None)]
    assert got == {
        0: [("system", "s"), ("user", "5")], 1: [("user", "x"), ("assistant", "")], 2: [("user", "i\nn"), ("assistant", "o")],
        3: [("user", "i"), ("assistant", "o")], 4: [("user", "p"), ("assistant", "c")], 5: [("user", ""), ("assistant", "r")],
        6: lost, 7: lost, 8: lost,
    }


def test_tables_are_told_by_their_schema(spark):
    nested = spark.createDataFrame([(1, [("human", "q"), ("gpt", None)], 9)], "conv_id long, conversations array<struct<`from` string, value string>>, extra int")
    assert [(r.role, r.text) for r in chat.turns_of_table(nested).orderBy("turn").collect()] == [("user", "q"), ("assistant", "")]
    flat = spark.createDataFrame([(1, "p", "c")], "conv_id long, prompt string, completion string")
    assert [(r.role, r.text) for r in chat.turns_of_table(flat).orderBy("turn").collect()] == [("user", "p"), ("assistant", "c")]
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_of_table(spark.createDataFrame([(1, 2)], "conv_id long, x int"))
    assert chat.fingerprint(("a", "b")) == chat.fingerprint(("b", "a")) != chat.fingerprint(("a",))


# --- the pipeline -----------------------------------------------------------------------------------------------

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, has_tables):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), name)
        out.append((name, docs))
    return dict(out)


@pytest.fixture(scope="module")
def has_tables():
    import os

    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")


def test_stages_keep_the_columns_and_drop_rows(spark, stages):
    frames = list(stages.values())
    for before, after in zip(frames[:-2], frames[1:-1], strict=True):
        assert after.schema == before.schema
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert stages["shards"].count() == stages["mix"].count()


def test_each_stage_decides_by_its_input(spark, stages):
    texts = {name: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for name, df in stages.items() if name != "shards"}
    groups = grouped(list(texts["quality"].items()))
    assert set(texts["near_dup"]) == {d for d in texts["quality"] if groups[d][1] == d}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holds = {d for d, t in texts["near_dup"].items() if any(i in " ".join(t.lower().split()) for i in items)}
    assert holds and not holds & set(texts["decontaminate"])
    assert len(texts["near_dup"]) - len(texts["decontaminate"]) <= len(holds) + 1
    words_of = lambda docs: sum(len(split(t)) for t in docs.values())
    assert 0.8 * words_of(texts["decontaminate"]) <= words_of(texts["mix"]) <= 0.9 * words_of(texts["decontaminate"]) + 1
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = {d for d in texts["documents"] if labels.get(d) == 1}
    assert len(good & set(texts["quality"])) >= 0.97 * len(good)


def test_pipeline_survives_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (7, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing that occurs in any of these texts at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, has_tables, name):
    from tests.oracle_check import open_tables, sorted_rows

    df, result = QUERIES[name](spark, SF_DIR), open_tables(SF_DIR).execute(ORACLE[name])
    columns, want = [d[0] for d in result.description], result.fetchall()
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, want)
