"""CSV folders: files are split at lines where that is safe, and read whole where it is not."""

from __future__ import annotations

import csv
from collections import Counter

import pytest

from flowledger.sources.files import read_csv

FILES = {
    "plain.csv": "a,b\n1,x\n2,\"y, z\"\n\n3,\"say \"\"so\"\"\"\n",
    "swapped.CSV": "b,a\r\nq,4\r\nr,5\r\n",
    "breaks.csv": "a,b\n6,\"two\nlines\"\n7,one\n",
    "blanks.csv": "a,b\n8,s\n9,t\n",
    "more.csv": "a,b,c\n10,u,v\n",
}


def expected(texts) -> Counter:
    out = Counter()
    for text in texts:
        for row in csv.DictReader(text.replace("\r\n", "\n").splitlines(keepends=True)):
            out[tuple(row.get(c) for c in "abc")] += 1
    return out


def test_both_ways_give_the_same_rows(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())
    got = read_csv(spark, str(tmp_path))
    assert Counter((r.a, r.b, r.c) for r in got.select("a", "b", "c").collect()) == expected(FILES.values())


def test_lines_of_blanks_are_rows_either_way(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n  \n2\n")
    assert read_csv(spark, str(tmp_path)).count() == 3


@pytest.mark.parametrize("text, split", [("plain", True), ('"a break\nin quotes"', False)])
def test_large_files_are_split_where_safe(spark, tmp_path, text, split):
    body = "n,t\n" + "".join(f'{i},"some ""quoted"" text {i}"\n' for i in range(20_000)) + f"20000,{text}\n"
    (tmp_path / "large.csv").write_text(body)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, "65536")
        got = read_csv(spark, str(tmp_path))
        assert (got.rdd.getNumPartitions() > 4) == split
        assert got.count() == 20_001 and got.select("n").distinct().count() == 20_001
    finally:
        spark.conf.set(key, before)
