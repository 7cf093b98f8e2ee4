from __future__ import annotations

import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(seed: int, n: int, size: int = 500) -> list[str]:
    """n words of a small made-up vocabulary."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 8))) for _ in range(size)]
    return [rng.choice(vocabulary) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every operator has to handle: nulls, nothing, blanks, ties, repeats, and one very long text."""
    long = " ".join(words(1, 60_000))
    same = "The same text, twice over; the same text, twice over."
    return [
        (1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, "", None, None), (4, None, "en", None),
        (5, " \n\t ", "de", "b"), (6, "one", "en", "b"), (7, "|||", "en", "b"), (8, long, "en", "a"),
        (None, "a row without an id but with some words in it", "fr", "a"), (None, None, None, None), (9, "Über Ärger 😀 groß", "de", "a"),
        (10, "<|endoftext|> said <|im_end|> \\ done", "en", "c"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows, with columns whose names an operator might use itself."""
    schema = "doc_id long, text string, lang string, source string, score string, n string, block string, row_id string"
    extra = [(*row, "s", "n", "b", "r") for row in odd_rows]
    return spark.createDataFrame(extra, schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
