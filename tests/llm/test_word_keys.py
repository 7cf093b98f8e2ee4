"""Different words with equal letter counts: keys and the operators on them tell them apart."""

from __future__ import annotations

import pyarrow as pa
import pytest

from ledgerlark.llm.common import Words
from ledgerlark.operators.lineage import shared_dir

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def doubled(a: str, b: str, steps: int) -> tuple[str, str]:
    """Two words that agree in every sum of powers of their places up to the number of steps."""
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


PAIRS = [doubled("a", "n", k) for k in range(1, 14)] + [doubled("o", "n", 10), doubled("e", "a", 11), doubled("s", "t", 10)]


def test_keys_differ():
    keys, *_ = Words()(pa.array([w for pair in PAIRS for w in pair]))
    assert len(set(keys.tolist())) == 2 * len(PAIRS)
    every = Words()(pa.array([chr(97 + i) * n for i in range(26) for n in range(1, 60)] + ["x" * 3000, "x" * 3001]))[0]
    assert len(set(every.tolist())) == 26 * 59 + 2


@pytest.fixture(scope="module")
def docs(spark):
    texts = [w for pair in PAIRS if len(pair[0]) > 500 for w in pair]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tokens_and_counts(spark, docs):
    from ledgerlark.llm.token_counts import token_counts
    from ledgerlark.llm.token_shards import documents_of, write_shards

    encode = tokenizers.Tokenizer.from_file(PATH).encode
    want = {r.doc_id: len(encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    got = token_counts(docs, PATH, f"{shared_dir(spark)}/doubled-cache")
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want
    path = f"{shared_dir(spark)}/doubled-shards"
    write_shards(docs, path, PATH)
    assert {r.doc_id: r.n_tokens - 1 for r in documents_of(spark, path).collect()} == want


def test_near_duplicates_scores_and_fingerprints(spark, docs):
    from ledgerlark.llm.language_model import score_texts
    from ledgerlark.llm.near_dup import near_duplicates
    from ledgerlark.llm.simhash import simhash

    assert all(r.kept and r.component_id == r.doc_id for r in near_duplicates(docs).collect())
    prints = {r.doc_id: r.fingerprint for r in simhash(docs).collect()}
    assert len(set(prints.values())) == len(prints)
    scored = {r.doc_id: r for r in score_texts(docs).collect()}
    learned = {d for d, r in scored.items() if not r.held_out}
    assert all(r.n_known == (2 if d in learned else 1) for d, r in scored.items())


def test_a_changed_word_is_no_leak(spark, docs):
    from ledgerlark.llm.decontaminate import leaks

    first, second = PAIRS[10]
    words = " ".join(f"w{i}" for i in range(4))
    items = spark.createDataFrame([(1, f"{words} {first} {words[::-1]} {first}")], "item_id long, text string")
    texts = spark.createDataFrame([(1, f"{second} " * 9), (2, f"{words} {first} {words[::-1]} {first}")], "doc_id long, text string")
    assert [r.doc_id for r in leaks(texts, items).collect()] == [2]
