"""Small documents that hold every awkward case, and helpers."""

import random

import pytest

from tidemark.llm.common import importable

SCHEMA = "doc_id long, text string, score string, rank int, key string, removed int, n_chars long"
PATH_NAME = "word_bpe_49k.json"


def documents(seed=0, words=400):
    """Nulls, empties, ties, repeated rows, near copies, shared passages, a long text, odd characters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(words)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = text(70)
    base = [text(rng.randint(1, 120)) for _ in range(25)]
    texts = [None, "", " \n\t ", "word", "Word", "a b c d", "A B  c\td", *base, base[3], base[3]]
    for n in (4, 5, 6):
        for _ in range(6):  # near copies
            parts = base[n].split(" ")
            parts[rng.randrange(len(parts))] = "changed"
            texts.append(" ".join(parts))
    texts += [f"{text(rng.randint(0, 40))} {passage} {text(rng.randint(0, 40))}" for _ in range(8)]
    texts += [text(3000), "x" * 900, "ab" * 500, "é" * 150 + passage, "日本 " * 120, passage[:199], passage[:210]]
    rows = [(i, t, "s", 1, "k", 2, len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[12], (5000, rows[12][1], None, None, None, None, None), (12, "another text of the same id", "s", 1, "k", 2, 3)]


def frame_of(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True)
def workers_import_the_package(spark):
    importable(spark)
