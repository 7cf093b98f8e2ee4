"""Operators on single documents against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import language_id, quality, simhash, token_counts, wordpieces
from ledgerlark.llm.additive import Boosting, fit
from ledgerlark.llm.common import Words, shingle_sets
from ledgerlark.llm.language_model import score_texts
from ledgerlark.llm.token_shards import documents_of, occurrences, token_totals, tokens_at, write_shards
from ledgerlark.llm.wavelet import WaveletMatrix
from ledgerlark.operators.lineage import shared_dir
from tests.llm.conftest import words

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def library(texts: list[str]) -> list[list[int]]:
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def in_fold(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


# --- words ------------------------------------------------------------------------------------------------------


def test_word_keys_follow_the_words(odd_rows, monkeypatch):
    monkeypatch.setattr("ledgerlark.llm.common.WINDOW", 64)
    texts = [row[1] for row in odd_rows] + ["x" * 500, "A b", "a B", "\x1ca b"]
    keys, first, begins, ends = Words()(pa.array(texts, pa.string()))
    seen: dict[str, int] = {}
    for i, text in enumerate(texts):
        mine = split(text)
        assert first[i + 1] - first[i] == len(mine)
        for word, key in zip(mine, keys[first[i] : first[i + 1]].tolist(), strict=True):
            assert seen.setdefault(word, key) == key
    assert len(set(seen.values())) == len(seen) and (ends > begins).all()


def test_shingles_of_short_texts_are_their_whole_sequence():
    texts = pa.array(["a b c d e f", "a b c", "", None, "b c", "a b c"])
    keys, first, _, _ = Words()(texts)
    shingles, starts = shingle_sets(keys, first, 5)
    assert np.diff(starts).tolist() == [2, 1, 0, 0, 1, 1]
    assert shingles[2] == shingles[4] != shingles[3]


# --- tokens -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("memo", [20, 600_000])
def test_word_wise_encoding_equals_the_library(monkeypatch, memo):
    monkeypatch.setattr(wordpieces, "MEMO", memo)
    pieces = ["a", "Bé", "é", "́", "Σ", "ς", "'s", "'LL", "1", "２", "<|", "|>", " ", "\n", "\x1c", "\x85", "\xa0", " ",
              "​", "!!", "İ", "ﬁ", "한", "\x00", "יִ", "The", ".", "…", "×"]
    rng = np.random.default_rng(4)
    plain = ["".join(rng.choice(pieces, rng.integers(0, 9))) for _ in range(2000)]
    special = plain[:50] + ["<|endoftext|> a", "b<|ENDOFTEXT|>", None, ""]
    for texts in (plain, special):
        own = wordpieces.Encoder(PATH, wordpieces.word_wise(PATH))
        want = library([t or "" for t in texts])
        column = pa.array(texts, pa.string())
        assert own.counts(column).tolist() == [len(x) for x in want]
        got = np.concatenate([ids for _, ids in own.tokens(column)])
        assert got.tolist() == [i for x in want for i in x]


def test_other_tokenizers_get_whole_texts():
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        path = public.path(name)
        assert not wordpieces.word_wise(path)
        texts = ["Two  words", "", " x"]
        want = [len(x) for x in wordpieces.encoder(path)(texts)]
        assert wordpieces.Encoder(path, False).counts(pa.array(texts)).tolist() == want


def test_token_counts_and_their_cache(spark, odd, odd_rows, tmp_path):
    cache = f"{tmp_path}/cache"
    first = token_counts.token_counts(odd, PATH, cache, limit=20)
    want = Counter((r[0], len((r[1] or "").encode()), n, n > 20) for r, n in zip(odd_rows, map(len, library([r[1] or "" for r in odd_rows])), strict=True))
    assert Counter(map(tuple, first.collect())) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({re.sub("[ \t\n\r]+", " ", r[1] or "") for r in odd_rows})
    again = token_counts.token_counts(odd.limit(100), PATH, cache, limit=20)
    assert Counter(map(tuple, again.collect())) == want
    assert spark.read.parquet(cache).count() == stored  # nothing is encoded twice


def test_token_counts_of_nothing(nothing, tmp_path):
    out = token_counts.token_counts(nothing, PATH, f"{tmp_path}/cache")
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


@pytest.mark.parametrize("n, k", [(0, 3), (1, 1), (5000, 300), (9000, 2), (4096, 70_000)])
def test_wavelet_matrix(n, k):
    ids = np.random.default_rng(n).integers(0, k, n)
    matrix = WaveletMatrix.build(ids)
    assert (matrix.decode() == ids).all()
    for i in range(0, n, 97):
        assert matrix.access(i) == ids[i] and matrix.count(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
    for token in [*ids[:5].tolist(), k + 1]:
        at = np.flatnonzero(ids == token)
        assert matrix.positions(token).tolist() == at.tolist() and matrix.count(token) == len(at)
        assert [matrix.locate(token, j) for j in range(0, len(at), 7)] == at[::7].tolist()


@pytest.mark.parametrize("size", [1 << 21, 50])
def test_shards_hold_every_token_in_order(spark, odd, odd_rows, tmp_path, monkeypatch, size):
    monkeypatch.setattr("ledgerlark.llm.token_shards.SHARD_TOKENS", size)
    path = f"{tmp_path}/shards"
    write_shards(odd, path, PATH)
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [[*x, 1] for x in library([r[1] or "" for r in ordered])]
    want, start = [], 0
    for row, x in zip(ordered, ids, strict=True):
        want.append((row[0], start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    got = [tuple(r) for r in documents_of(spark, path).orderBy("start").collect()]
    assert got == want
    flat = Counter(i for x in ids for i in x)
    tokens = [1, ids[2][0], 49_000]
    assert dict(map(tuple, token_totals(spark, path, tokens).collect())) == {t: flat[t] for t in tokens}
    found = Counter(map(tuple, occurrences(spark, path, ids[-1][0]).collect()))
    assert found == Counter((r[0], i) for r, x in zip(ordered, ids, strict=True) for i, t in enumerate(x) if t == ids[-1][0])
    nine = next(x for r, x in zip(ordered, ids, strict=True) if r[0] == 9)
    assert sorted(map(tuple, tokens_at(spark, path, 9, 1, 3).collect())) == [(i, nine[i]) for i in (1, 2, 3)]


def test_shards_of_nothing(spark, nothing, tmp_path):
    write_shards(nothing, f"{tmp_path}/none", PATH)
    assert documents_of(spark, f"{tmp_path}/none").count() == 0


# --- language model ---------------------------------------------------------------------------------------------


def test_base_scores_and_counts(spark, odd, odd_rows):
    train = Counter(w for r in odd_rows if in_fold(r[0], 7) != 2 for w in [*split(r[1]), None])
    n, v = sum(train.values()), len(train)
    want = Counter()
    for r in odd_rows:
        tokens = [*split(r[1]), None]
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens)
        want[r[0], in_fold(r[0], 7) == 2, len(tokens), sum(train[w] > 0 for w in tokens), n, round(base, 6)] += 1
    got = score_texts(odd).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_model_scores_equal_a_plain_model(spark, monkeypatch):
    """The same mixture from dictionaries, with the weights that the operator learned."""
    from ledgerlark.llm import language_model as lm

    learned = []
    real = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda cells: learned.append(real(cells)) or learned[-1])
    texts = {i: " ".join(words(i % 40, 30, 60)) for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for order in (2, 3):
        learned.clear()
        got = {r.doc_id: r for r in score_texts(docs, order=order).collect()}
        sequences = {i: [*split(t), "</s>"] for i, t in texts.items()}
        count: Counter = Counter()
        for i, s in sequences.items():
            if in_fold(i, 7) != 2:
                padded = ["<s>"] * (order - 1) + s
                for k in range(1, order + 1):
                    count.update(tuple(padded[j - k + 1 : j + 1]) for j in range(order - 1, len(padded)))
                for k in range(1, order):
                    count[("<s>",) * k] += 1
        n = sum(c for g, c in count.items() if len(g) == 1 and g != ("<s>",))
        v = sum(1 for g in count if len(g) == 1 and g != ("<s>",))
        for i in (0, 7, 100):
            padded, total = ["<s>"] * (order - 1) + sequences[i], 0.0
            for j in range(order - 1, len(padded)):
                p = 1 / (v + 1)
                for k in range(1, order + 1):
                    gram = tuple(padded[j - k + 1 : j + 1])
                    context = n if k == 1 else count[gram[:-1]]
                    share = learned[k - 1][math.floor(math.log2(context)) + 1 if context else 0]
                    p = share * (count[gram] / context if context else 0) + (1 - share) * p
                total += math.log10(p)
            assert got[i].score == pytest.approx(total, abs=1e-6)


def test_interpolation_beats_the_base_on_held_out_text(spark):
    """Text in which every word is followed by one of two others."""
    rng = np.random.default_rng(0)
    after = {i: rng.integers(0, 50, 2) for i in range(50)}

    def walk():
        at, out = int(rng.integers(0, 50)), []
        for _ in range(60):
            out.append(f"w{at}")
            at = int(rng.choice(after[at]))
        return " ".join(out)

    docs = spark.createDataFrame([(i, walk()) for i in range(300)], "doc_id long, text string")
    held = score_texts(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.5 * held[1]


def test_scores_of_nothing(nothing):
    assert score_texts(nothing).count() == 0


# --- fingerprints -----------------------------------------------------------------------------------------------


def test_simhash_against_plain_loops(spark, odd, odd_rows):
    got = simhash.simhash(odd, every=2).collect()
    assert len(got) == len(odd_rows)
    ids = [r for r in odd_rows if r[0] is not None and r[0] != 2]
    by_id = {r.doc_id: r for r in got if r.doc_id in {x[0] for x in ids}}
    ordered = sorted({r[0]: r for r in odd_rows if r[0] is not None}.values(), key=lambda r: -r[0])
    for one, following in zip(ordered[:-1], ordered[1:], strict=True):
        if one[0] == 2:
            continue
        text, after = one[1] or "", following[1] or ""
        k = len(text) // 3
        changed = text[: len(text) - k] + after[:k]
        row = by_id[one[0]]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        fp = {t: f"{x:016x}" for t, x in zip((text, changed, after), simhash.fingerprints(pa.array([text, changed, after]), Words()).tolist(), strict=True)}
        assert (row.fingerprint, row.edited_fingerprint) == (fp[text], fp[changed])
        same = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
        assert row.near_edited == same(fp[text], fp[changed]) and row.near_next == same(fp[text], fp[after])
    fps = [int(r.fingerprint, 16) for r in got]
    for r in got:
        near = sum((int(r.fingerprint, 16) ^ x).bit_count() <= 3 for x in fps) - 1
        assert r.n_within == (near if r.doc_id is not None and r.doc_id % 2 == 0 else None)


def test_the_last_document_is_followed_by_the_first(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of some") for i in range(40)], "doc_id long, text string")
    last = simhash.with_next(docs).where("doc_id = 0").first()
    changed = simhash.edited("text number 0 of some", "text number 39 of some")
    assert last.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_all_fingerprints_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).tolist()
    near = [b ^ sum(1 << int(i) for i in rng.choice(63, k, replace=False)) for b in base for k in range(6)]
    frame = lambda x: spark.createDataFrame([(int(v),) for v in x], "fp long")
    for radius in (1, 3):
        got = set(map(tuple, simhash.within_radius(frame(base), frame(near + near[:9]), radius).collect()))
        assert got == {(a, b) for a in set(base) for b in set(near) if (a ^ b).bit_count() <= radius}


def test_simhash_of_nothing(nothing):
    assert simhash.simhash(nothing).count() == 0


# --- classifiers ------------------------------------------------------------------------------------------------


def test_additive_model_learns_main_effects_and_a_pair():
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # no main effect at all
    model = fit(x[:3000], y[:3000], Boosting(pairs=3))
    assert (0, 1) in model.pairs
    assert ((model.probability(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
    z = (x[:, 2] ** 2 > 0.3).astype(float)
    assert ((fit(x[:3000], z[:3000]).probability(x[3000:]) >= 0.5) == z[3000:]).mean() > 0.95
    row = fit(x[:100], y[:100])
    assert row.logit(x[:1])[0] == pytest.approx(
        row.intercept
        + sum(t[np.searchsorted(e, x[0, f], "right")] for f, (e, t) in enumerate(zip(row.edges, row.tables, strict=True)))
        + sum(t[np.searchsorted(row.pair_edges[i], x[0, i], "right"), np.searchsorted(row.pair_edges[j], x[0, j], "right")]
              for (i, j), t in zip(row.pairs, row.pair_tables, strict=True))
    )


def test_additive_model_without_two_labels():
    assert fit(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert fit(np.zeros((50, 3)), np.ones(50)).probability(np.zeros((1, 3)))[0] > 0.9


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, " ".join(words(i, 80)) + ".") for i in range(0, 400, 2)]
    bad = [(i, " ".join(w.upper() + "!!" for w in words(i, 80))) for i in range(1, 400, 2)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    return docs, docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))


def test_quality_is_learned_and_scored(spark, labelled, odd, odd_rows):
    docs, labels = labelled
    model = quality.fit_quality(docs, labels.union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")))
    scored = quality.score_quality(docs, model).join(labels, "doc_id")
    assert scored.where("predicted <> quality").count() == 0
    assert {r.doc_id for r in scored.where("held_out").collect()} == {i for i in range(400) if in_fold(i, 3) == 1}
    out = quality.score_quality(odd, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    kept = quality.keep_good(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 200


def test_quality_sample_is_bounded(labelled):
    docs, labels = labelled
    assert quality.fit_quality(docs, labels, sample=60).tables
    assert not quality.fit_quality(docs.limit(0), labels).tables


def test_quality_features_of_an_empty_text_are_zero():
    assert not quality.Features()(pa.array(["", None], pa.string())).any()


def test_languages_are_learned(spark, odd, odd_rows):
    seeds = {"xx": 1, "yy": 2, "zz": 3}
    rows = [(10 * i + s, " ".join(words(s, 3 + i % 60, 80)[: 3 + i % 60]), lang) for i in range(90) for lang, s in seeds.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = docs.where(language_id.crc_fold(F.col("doc_id"), 5) != 0)
    model = language_id.fit_languages(learn.union(spark.createDataFrame([(1, "no language", None), (2, "12 !", "xx")], learn.schema)))
    out = language_id.predict_languages(docs, model).join(docs, "doc_id")
    assert out.where("held_out and lang_pred = lang").count() >= 0.95 * out.where("held_out").count()
    got = language_id.predict_languages(odd, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter(r[0] for r in odd_rows if not any(c.isalpha() for c in r[1] or ""))


def test_kernel_is_the_share_of_common_ngrams():
    grams = language_id.Grams()
    a, b = grams("abc abd"), grams("Abc!")
    sets = [a, b]
    model = language_id.fit_kernel(sets, ["x", "y"])
    want = [[len(np.intersect1d(s, t)) / math.sqrt(len(s) * len(t)) for t in sets] for s in sets]
    assert np.allclose(model.kernel(sets), want)
    assert len(grams("1 2 ,")) == 0 and len(grams(None)) == 0
    long = "ab cd " * 400_000  # several windows
    assert grams(long).tolist() == grams("ab cd ab cd ").tolist()


def test_no_language_to_learn(nothing, odd):
    assert language_id.fit_languages(nothing) is None
    assert {r.lang_pred for r in language_id.predict_languages(odd, None).collect()} == {"und"}
