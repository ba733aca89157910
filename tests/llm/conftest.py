"""Small tables for the text operators: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside themselves.
CLASHES = ("g", "rank", "first", "n", "rep", "block", "component", "score", "ids", "key", "held", "word", "code", "a", "b", "id")


def sentences(rng: random.Random, n: int) -> str:
    syllables = ["an", "er", "the", "on", "re", "é", "ti", "ou", "st", "ñ"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w.capitalize() + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    rng = random.Random(11)
    base = sentences(rng, 120)
    words = base.split()
    rows = [(i, sentences(rng, rng.randint(1, 60))) for i in range(40)]
    rows += [(100, base), (101, base), (102, base + " End here."), (103, " ".join(words[:60] + ["Changed"] + words[61:]))]
    rows += [(110 + i, " ".join(words[:i] + [f"Word{i}"] + words[i + 1 :])) for i in range(0, 40)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "word"), (204, "Word"), (205, "one two")]
    rows += [(300, "é" * 5000 + " " + base), (301, "x " * 4000), (302, "\n".join(["same line of eight words is right here now"] * 30))]
    rows += [(400, "repeated row text here"), (400, "repeated row text here"), (401, "one id first text"), (401, base)]
    rows += [(None, base), (None, None), (None, "no id")]
    rows += [(500, "Line one has got at least eight words here.\nLine two too has at least eight words here.\nshort\n" + words[0])]
    rows += [(501, "other start\nLine one has got at least eight words here.\nLine two too has at least eight words here.\nshort")]
    rows += [(502, "Under the MIT License and CC BY-NC 4.0, apache license version 2.0; it's they'll 's 12³ ½ 中文 😀")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in odd_rows], SCHEMA)
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES})
