"""Line dedup, near duplicates, components, vectors, chat and the pipeline against brute force, odd input included."""

from __future__ import annotations

import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowledger.llm import ann, chat, embed_dedup, line_dedup, minhash
from flowledger.llm.common import LOWER
from flowledger.llm.components import components

from .conftest import with_clashes


class Roots(dict):
    """Union-find whose roots are the smallest members."""

    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = x = self[self[x]]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(4000, 4300)] + [(7, 7), (8, None), (None, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    roots = Roots()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            roots.join(a, b)
    assert got == {x: roots.find(x) for x in list(roots)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_lines(rows, min_words):
    """(id, text) pairs to their texts after deletion; equal pairs are one document."""
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    seen, out = set(), {}
    for known, i, t in order:
        lines = t.split("\n")
        gone = [False] * len(lines)
        for p in range(len(lines)):
            longest = 0
            while p + longest < len(lines) and tuple(lines[p : p + longest + 1]) in seen:
                longest += 1
            if sum(bool(x) for line in lines[p : p + longest] for x in line.split(" ")) >= min_words:
                gone[p : p + longest] = [True] * longest
            seen.update(tuple(lines[p:q]) for q in range(p + 1, len(lines) + 1))
        out[i if known else None, t] = "\n".join(x for x, g in zip(lines, gone) if not g)
    return out


def line_docs():
    rng = random.Random(8)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(12)] + ["", " "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 14)))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1] + "\nunique last line"), (102, None), (103, ""), (None, rows[4][1]), (3, rows[3][1])]
    rows += [(200, "\n".join(["same line over and over"] * 33)), (201, "\n".join(f"line {i} of a long text" for i in range(300)))]
    return rows


@pytest.mark.parametrize("min_words", [1, 8])
def test_line_dedup(spark, min_words):
    rows = line_docs()
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    got = line_dedup.remove_repeated_lines(docs, min_words, counts=("n_lines", "n_removed")).collect()
    want = brute_lines(rows, min_words)
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, None if t is None else want[i, t]) for i, t in rows)
    assert all(r.a == "clash" for r in got)
    assert {r.doc_id: r.n_lines for r in got}[201] == 300 and {r.doc_id: r.n_lines for r in got}[102] == 0


def test_line_dedup_ranks_are_a_suffix_order(spark):
    lines = ["b", "a", "b", "a", "c", "b", "a"]
    sequence = line_dedup._sequence(spark.createDataFrame([(1, "\n".join(lines))], "doc_id bigint, text string").withColumns(
        {"t1": F.lit(1).cast("bigint"), "t2": F.lit(2).cast("bigint")}))
    rows = {r.g: r for r in sequence.collect()}
    assert [rows[g].left for g in sorted(rows)] == [6, 5, 4, 3, 2, 1, 0]
    windows = {r.g - min(rows): r.reach - min(rows) for r in line_dedup.repeated_runs(sequence, 1).collect()}
    assert windows == {2: 4, 3: 4, 5: 7, 6: 7}


def test_line_dedup_uses_no_python(spark, odd_docs):
    plan = line_dedup.op1_query(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_lines(no_docs):
    assert line_dedup.op1_query(no_docs).count() == 0


def brute_near(rows, size, percent=80):
    sets, of_id, roots = {}, defaultdict(list), Roots()
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().translate(LOWER).split()
        n = min(size, len(w))
        sets[k] = frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if w else frozenset()
        if i is not None and sets[k]:
            of_id[i].append(sets[k])
            roots.find(i)
    ids = sorted(of_id)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if any(100 * len(s & t) >= percent * len(s | t) for s in of_id[a] for t in of_id[b]):
                roots.join(a, b)
    return Counter((i, len(sets[k]), roots.find(i) if sets[k] and i is not None else i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(odd_docs, odd_rows, size):
    got = minhash.near_duplicates(with_clashes(odd_docs), size).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(odd_rows, size)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_crowds(spark, monkeypatch):
    """A small cap makes regions crowded, so that the exact rest has to find what they do not propose."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(0, 14)):
            words[at] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(minhash, "CROWD", 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = minhash.near_duplicates(docs, 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows, 2)


def test_no_near_duplicates(no_docs):
    assert minhash.op10_query(no_docs).count() == 0


def odd_vectors():
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 10))
    rows = [(i, base[i].tolist(), i % 3) for i in range(60)]
    rows += [(100 + i, (base[5] + rng.normal(size=10) * 0.05).tolist(), 2) for i in range(30)]
    rows += [(200 + i, base[7].tolist(), 1) for i in range(5)] + [(210, (base[7] * 3).tolist(), 1), (211, base[7].tolist(), 2)]
    rows += [(300, None, 1), (301, [0.0] * 10, 1), (302, [math.nan] + [1.0] * 9, 1), (303, [math.inf] + [1.0] * 9, 1)]
    rows += [(304, [None] + [1.0] * 9, 1), (305, [], 1), (306, base[8].tolist(), None), (307, base[8].tolist(), None)]
    rows += [(308, base[9][:4].tolist(), 0), (309, base[9][:4].tolist(), 0), (None, base[7].tolist(), 1), (-7, base[7].tolist(), 1)]
    return rows


VECTORS = "vec_id bigint, embedding array<double>, label int"


def fine(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_vectors(spark, monkeypatch):
    rows = odd_vectors()
    roots, links = Roots(), Counter()
    usable = [(i, v, c) for i, v, c in rows if i is not None and c is not None and fine(v)]
    for x, (i, v, c) in enumerate(usable):
        for j, w, d in usable[:x]:
            if c == d and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                roots.join(i, j)
                links[i] += 1
                links[j] += 1
    want = Counter((i, links[i], roots.find(i) if i is not None else None) for i, _, _ in rows)
    monkeypatch.setattr(embed_dedup, "TILE", 8)
    got = embed_dedup.op9_query(with_clashes(spark.createDataFrame(rows, VECTORS).repartition(3))).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert embed_dedup.op9_query(spark.createDataFrame([], VECTORS)).count() == 0


def test_compare_stops_early_and_loses_nothing():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(80, 40))
    b = np.concatenate([a[:20] + rng.normal(size=(20, 40)) * 0.1, rng.normal(size=(30, 40))])
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    i, j = embed_dedup.compare(a, b, axes, 0.98, False)
    cosine = a @ b.T / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
    assert set(zip(i, j)) == set(zip(*np.nonzero(cosine >= 0.98)))


def test_nearest(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 24))
    x = centres[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 24)) * 0.6
    x[500:540] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5020, [0.0] * 24), (5040, [math.nan] * 24), (None, x[0].tolist())]
    table = with_clashes(spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").repartition(4))
    got = ann.op4_query(table).toPandas()
    assert set(got["query_id"]) == set(range(0, 3000, 20))
    hits = 0
    for q, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        scores = x @ x[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        hits += len(set(best) & set(found["vec_id"]))
        assert list(found["rank"]) == list(range(1, 21)) and found["vec_id"].nunique() == 20
        assert np.allclose(found["score"], scores[found["vec_id"]], rtol=1e-12)
        order = list(zip(-found["score"], found["vec_id"]))
        assert order == sorted(order)
    assert hits / (20 * 150) >= 0.9


def test_nearest_of_few(spark):
    schema = "vec_id bigint, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 1.0]), (3, [0.5]), (20, [1.0, 1.0])], schema)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.op4_query(few).collect()}
    assert got == {(0, 1): (2, 2.0), (0, 2): (1, 1.0), (0, 3): (20, 1.0), (20, 1): (2, 3.0), (20, 2): (1, 2.0), (20, 3): (0, 1.0)}
    assert ann.op4_query(spark.createDataFrame([], schema)).count() == 0


def test_chi2():
    assert abs(ann.chi2(np.array(ann._stop_ratio())) - ann.CONFIDENCE) < 1e-9
    draws = (np.random.default_rng(1).normal(size=(200_000, ann.AXES)) ** 2).sum(axis=1)
    assert abs((draws <= 9.0).mean() - ann.chi2(np.array(9.0))) < 0.01


SCHEMAS = [
    ("add", "a", "integer", True, 0.0, 10.0), ("add", "note", "string", False, None, None), ("add", "deep", "object", False, None, None),
    ("add", "list", "array", False, None, None), ("add", "x", "number", False, None, 2.5), ("add", "on", "boolean", False, None, None),
]


def linked(spark, calls, results):
    calls = spark.createDataFrame(calls, "conv_id bigint, call_id string, turn bigint, tool string, arguments string, after string")
    results = spark.createDataFrame(results, "conv_id bigint, call_id string, content string")
    schemas = spark.createDataFrame(SCHEMAS, "tool string, field string, type string, required boolean, minimum double, maximum double")
    return chat.link_calls(with_clashes(calls), with_clashes(results), with_clashes(schemas)).collect()


def test_chat_links_orders_and_validates(spark):
    calls = [(1, f"c{i}", i, "add", '{"b": 1, "a": %d}' % i, f"c{i - 1}" if i else None) for i in range(20)]
    calls += [(2, "x", 1, "add", '{"a":1}', "y"), (2, "y", 2, "add", '{"a":1}', "x"), (2, "z", 3, "add", '{"a":1}', "x")]
    calls += [(3, "m", 1, "add", "not json", "gone"), (3, "n", 2, "other", "[1]", None), (3, None, 3, "add", None, "m")]
    calls += [(3, "p", 5, "add", '{"a":2}', None), (3, "p", 4, "add", '{"a":1}', None)]
    calls += [(4, "v", 1, "add", '{"a": "1", "note": 5, "deep": [], "list": {}, "x": 3.5, "on": 1}', None)]
    calls += [(4, "w", 2, "add", '{"deep": {"z": 1, "y": "\\u00e9\\n"}, "list": [2, 1], "x": 2, "on": true, "a": null}', "v")]
    results = [(1, "c3", "three"), (1, "c3", "also"), (9, "lost", "r"), (1, None, "nameless")]
    got = linked(spark, calls, results)
    by = {(r.conv_id, r.call_id): r for r in got}
    assert [by[1, f"c{i}"].depth for i in range(20)] == list(range(20))
    assert [by[1, f"c{i}"].errors for i in (0, 10, 11)] == [[], [], ["a: too large"]]
    assert by[1, "c3"].n_results == 2 and json.loads(by[1, "c3"].message)["result"] == "also"
    assert by[1, "c3"].message == '{"after":"c2","arguments":{"a":3,"b":1},"call_id":"c3","conv_id":1,"result":"also","tool":"add"}'
    assert all(by[2, c].errors == ["cycle"] and by[2, c].depth is None for c in "xyz")
    assert by[3, "m"].errors == ["no object", "unknown predecessor"] and by[3, "m"].depth == 0
    assert by[3, "n"].errors == ["no object", "unknown tool"] and by[3, None].errors == ["no identifier", "no object"]
    assert by[3, "p"].errors == ["repeated call"] and by[3, "p"].turn == 4
    assert by[4, "v"].errors == ["a: wrong type", "deep: wrong type", "list: wrong type", "note: wrong type", "on: wrong type", "x: wrong type"] or \
        by[4, "v"].errors == ["a: wrong type", "deep: wrong type", "list: wrong type", "note: wrong type", "on: wrong type", "x: too large"]
    assert by[4, "w"].errors == ["a: missing"]
    assert '"deep":{"y":"é\\n","z":1}' in by[4, "w"].message
    assert by[9, "lost"].errors == ["no call"] and by[1, None].errors == ["no call"]
    assert len(got) == len(calls) - 1 + 2
    assert linked(spark, [], []) == []


def test_pipeline(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int").withColumn("toxic", F.lit(0))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    odd_docs.withColumn("rank", F.lit("clash")).write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = docs
        step(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < 3:
            assert docs.columns == before.columns and docs.count() <= before.count()
            assert docs.where("rank != 'clash'").count() == 0
    lined = spark.read.parquet(str(tmp_path / "line_dedup"))
    left = spark.read.parquet(str(tmp_path / "near_dedup"))
    assert set(r.doc_id for r in left.collect() if r.doc_id is not None and 110 <= r.doc_id < 150) <= {110}
    assert left.where("doc_id = 400").count() <= 1 and lined.where("doc_id IN (101)").count() == 0
    assert docs.agg(F.sum("length")).first()[0] > 0
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, no_docs, str(tmp_path)).count() == 0
