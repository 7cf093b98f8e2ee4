"""Rows that must not get lost, doubled or changed: short items, null levels, clashing names, repeats, layouts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import chat, mixing
from ledgerlark.llm.decontaminate import leaks
from tests.llm.conftest import words


def test_short_items_are_found_whole(spark):
    seven = "alpha beta gamma delta epsilon zeta eta"
    items = spark.createDataFrame([(1, seven), (2, "one two three"), (3, "yes indeed"), (4, "no"), (5, "|||"), (6, None)], "item_id long, text string")
    around = " ".join(words(3, 200))
    texts = [
        (1, f"{around} Alpha, beta gamma delta epsilon (zeta) eta. {around}"), (2, f"{around} alpha beta gamma delta epsilon zeta {around}"),
        (3, f"{around} one two three"), (4, "one two four"), (5, "Yes, indeed!"), (6, f"yes indeed {around}"), (7, "no"), (8, ""), (9, None), (None, "NO."),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in leaks(docs, items).collect()), key=str)
    assert got == sorted([(1, 1), (3, 2), (5, 3), (7, 4), (None, 4)], key=str)
    assert all(r.share == 1 for r in leaks(docs, items).collect())


def test_null_levels_are_not_the_text_that_stands_for_them(spark):
    rows = [(i, "a b c d", lang, source) for i, (lang, source) in enumerate([(None, "s"), ("\\N", "s"), ("\\\\N", "s"), ("en", None), ("en", "\\N")] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", F.lit("d"))
    got = mixing.mixture(docs, mixing.Mix(per_mille=500)).groupBy("lang", "source").count().collect()
    assert {(r.lang, r.source) for r in got} == {(None, "s"), ("\\N", "s"), ("\\\\N", "s"), ("en", None), ("en", "\\N")}


def test_columns_of_any_name_come_through(spark):
    names = ["mix_leaf", "mix_doc", "mix_tokens", "mix_epoch", "mix_takes", "mix_row", "mix_levels", "Mix_Epoch_"]
    docs = spark.range(6).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit("d").alias("domain"),
                                 *[F.concat(F.lit(f"{n}-"), "id").alias(n) for n in names])
    got = mixing.mixture(docs, mixing.Mix(per_mille=1000))
    assert got.columns == [*docs.columns, "mix_epoch__", "mix_tokens_"]
    assert sorted(map(tuple, got.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_budgets_beyond_doubles_are_whole(spark):
    leaves = spark.createDataFrame([("d", 2**53 + 1), ("e", 2**60 + 7)], "domain string, tokens long")
    got = {r.domain: r.budget for r in mixing.budgets(leaves, mixing.Mix(levels=("domain",), per_mille=999)).collect()}
    total = (2**53 + 1 + 2**60 + 7) * 999 // 1000
    assert got == {"d": 2**53 + 1, "e": total - (2**53 + 1)}


def test_one_of_fully_repeated_rows_stays(spark):
    import corpus_pipeline

    text = " ".join(words(5, 80))
    rows = [(1, text, "en")] * 3 + [(2, text, "en"), (3, " ".join(words(6, 80)), "en"), (None, text + " x", "de"), (4, None, None), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.distinct_documents(spark, docs, "")
    assert got.columns == docs.columns and sorted(map(str, (r.doc_id for r in got.collect()))) == ["1", "3", "4"]


def test_rows_are_a_layout_like_the_others(spark):
    table = spark.createDataFrame([(1, 0, "user", "hi", "x"), (1, 0, "user", "hi", "x"), (1, None, None, None, "x")], "conv_id long, turn long, role string, text string, extra string")
    got = chat.turns_of_table(table)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, "", "")]))
    assert chat.turns_of_table(table.drop("extra")).columns == ["conv_id", "turn", "role", "text"]
    others = tuple(one for one in chat.LAYOUTS if one.rows is None)
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_of_table(table, layouts=others)


def test_chat_of_nothing_of_long_texts_and_of_repeats(spark):
    schema = "conv_id long, turn long, role string, text string"
    nothing = chat.turns_of_table(spark.createDataFrame([], schema))
    assert chat.parse_formatted(chat.format_turns(nothing)).collect() == []
    long = "<|im_end|>\\" * 50_000
    rows = [(1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long)]
    one = chat.parse_formatted(chat.format_turns(chat.turns_of_table(spark.createDataFrame(rows, schema)))).first()
    assert [(t.role, t.text) for t in one.turns] == [r[2:] for r in rows] and one.learned == [long, long]
