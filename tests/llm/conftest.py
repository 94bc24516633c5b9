"""Shared fixtures: a small corpus with every awkward case."""

from __future__ import annotations

import random

import pytest

AWKWARD = "doc_id long, text string, lang string, size string, shard int, bucket int, score string, spans string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(4)
    syllables = ["ta", "lo", "mi", "re", "ku", "sen", "do", "é", "st", "ing"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def make_text(words):
    def make(seed, lines=4, per_line=15):
        rng = random.Random(seed)
        return "\n".join(" ".join(rng.choices(words, k=per_line)).capitalize() + "." for _ in range(lines))

    return make


@pytest.fixture(scope="session")
def corpus(make_text):
    """(doc_id, text): nulls, empty and white texts, ties, repeated rows, copies, near copies, a long text."""
    base = make_text(1, 6)
    near = base.replace(base.split()[7], "changed", 1)
    rows = [(i, make_text(100 + i)) for i in range(12)]
    rows += [(20, base), (21, base), (22, near), (23, base + "\n" + make_text(2, 1))]
    rows += [(30, None), (31, ""), (32, " \n\t "), (33, "one"), (34, "ONE"), (35, "one two"), (36, "\n\n")]
    rows += [(40, make_text(40)), (40, make_text(40)), (41, make_text(40))]  # a repeated row, and a copy
    rows += [(50, make_text(3, 400, 20)), (51, "x" * 5000), (52, "日本語 テスト 🙂 " * 9)]
    rows += [(None, make_text(60)), (None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", "9", 7, 5, "s", "x") for i, t in corpus]
    return spark.createDataFrame(rows, AWKWARD).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
