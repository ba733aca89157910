"""Line dedup deletes whole repeated runs, whatever the words of their parts."""

from __future__ import annotations

import random

from flowledger.llm import line_dedup


def brute(texts: list[str], least: int) -> list[str]:
    lines = [(d, i) for d, t in enumerate(texts) for i in range(len(t.split("\n")))]
    docs = [t.split("\n") for t in texts]
    gone = set()
    for n, (d, i) in enumerate(lines):
        run = 0
        for e, j in lines[:n]:
            m = 0
            while i + m < len(docs[d]) and j + m < len(docs[e]) and docs[d][i + m] == docs[e][j + m]:
                m += 1
            run = max(run, m)
        if sum(len(x.split()) for x in docs[d][i : i + run]) >= least:
            gone.update((d, i + m) for m in range(run))
    return ["\n".join(x for i, x in enumerate(xs) if (d, i) not in gone) for d, xs in enumerate(docs)]


def cleaned(spark, texts: list[str]) -> list[str]:
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in line_dedup.remove_repeated_lines(df).orderBy("doc_id").collect()]


def test_words_count_for_the_whole_run(spark):
    three, ends = "a b c\nd e f\ng h i", "x y\np q r\n" + "w " * 50
    texts = ["one\n" + three, "two\n" + three + "\nend", ends, "more\n" + ends]
    assert cleaned(spark, texts)[1::2] == ["two\nend", "more"]


def test_equals_brute_force(spark):
    rng = random.Random(5)
    lines = ["a b c", "d e", "f", "g h i j", ""]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 14))) for _ in range(40)] + ["\n".join(["a b c", "f"] * 9)]
    assert cleaned(spark, texts) == brute(texts, line_dedup.MIN_WORDS)


def test_names_of_other_columns(spark):
    rows = [(1, "a b c d e f g h", 1, 2, "x"), (2, "a b c d e f g h", 3, 4, "y")]
    names = "doc_id bigint, text string, __deleted int, _key int, _Masked string"
    got = line_dedup.remove_repeated_lines(spark.createDataFrame(rows, names), counts=("before", "gone")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(*rows[0], 1, 0), (2, "", 3, 4, "y", 1, 1)]
