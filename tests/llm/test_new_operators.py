"""Decontamination, importance resampling and spelling variants against brute force, odd input included."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowledger.llm import decontaminate, resample, spelling
from flowledger.llm.words import numbered, slices

from .conftest import sentences, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def lower(t: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def words(t: str | None) -> list[str]:
    return WORD.findall(lower(t or ""))


def test_slices_keep_every_byte():
    rng = random.Random(1)
    for _ in range(200):
        raw = "".join(rng.choices("ab ", k=rng.randint(0, 60))).encode()
        parts = list(slices(raw, 7))
        assert b"".join(parts) == raw and [w for p in parts for w in p.split()] == raw.split()


def test_positions_of_equal_and_different_rows(spark):
    rows = [(rng, None if rng % 7 == 0 else rng % 5) for rng in range(1000)]
    got = numbered(spark.createDataFrame(rows, "a bigint, b bigint").repartition(5), F.col("b"), F.desc("a")).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[0]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1000))


# Decontamination


def some_items(odd_rows):
    texts = [t for _, t in odd_rows if t]
    long = words(texts[7])[5:30]
    rows = [(1, " ".join(long)), (2, " ".join(words(texts[40])[3:13]).upper()), (2, "and a second text of item two"), (10, "Word!"),
            (3, None), (4, ""), (5, "?!"), (6, "one, two"), (None, " ".join(words(texts[9])[:12])), (7, " ".join(long)), (7, " ".join(long)),
            (8, texts[12]), (9, "not in any text " * 5), (11, "x " * 300), (12, " ".join(["same line of eight words is right"] * 3))]
    return rows


def brute_hits(text: str | None, items, window: int):
    w, hit, found = words(text), set(), set()
    for item, other in items:
        o = words(other)
        k = min(len(o), window)
        runs = {tuple(o[p : p + k]) for p in range(len(o) - k + 1)} if o else set()
        for p in range(len(w) - k + 1):
            if tuple(w[p : p + k]) in runs:
                hit.update(range(p, p + k))
                found.add(item)
    return len(w), hit, found


@pytest.mark.parametrize("window,block_words", [(10, decontaminate.BLOCK_WORDS), (10, 40), (3, 25), (1, 30)])
def test_hits(spark, odd_docs, odd_rows, window, block_words):
    rows = some_items(odd_rows)
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    got = decontaminate.scan_items(with_clashes(odd_docs), with_clashes(items), window, block_words)
    seen = Counter()
    for r in got.collect():
        hit = [k for s in r.spans for k in range(s["first"], s["last"] + 1)]
        assert hit == sorted(set(hit)) and r["items"] == sorted(r["items"])
        seen[r.doc_id, r.n_words, tuple(hit), tuple(r["items"])] += 1
    want = Counter()
    for i, t in odd_rows:
        n, hit, found = brute_hits(t, rows, window)
        want[i, n, tuple(sorted(hit)), tuple(sorted(str(x) for x in found - {None}))] += 1
    assert seen == want
    assert sum(bool(k[2]) for k in want) > 5


def test_long_items_are_read_in_pieces(spark):
    rng = random.Random(6)
    long = rng.choices([f"w{i}" for i in range(400)], k=3 * decontaminate.PIECE_WORDS + 7)
    texts = [(k, "x " + " ".join(long[p : p + 10]) + " y") for k, p in enumerate(range(0, len(long) - 9, 7))]
    docs = spark.createDataFrame([*texts, (-1, " ".join(long))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(long))], "item_id bigint, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 5000):
        got = {r.doc_id: r for r in decontaminate.scan_items(docs, items, 10, block_words).collect()}
        assert all(got[k].spans == [(1, 10)] for k, _ in texts)
        assert got[-1].spans == [(0, len(long) - 1)] and got[-1]["items"] == ["1"]


def test_longest_matches():
    rng = random.Random(5)
    items = tuple((str(i), tuple(w.encode() for w in rng.choices("abc", k=rng.randint(3, 25)))) for i in range(6))
    found = decontaminate.ItemAutomaton(items, 4)
    text = [w.encode() for w in rng.choices("abc", k=300)]
    inside = lambda run: any(tuple(run) == o[p : p + len(run)] for _, o in items for p in range(len(o)))
    state_runs = max(n for e in range(len(text)) for n in range(26) if n <= e and inside(text[e - n : e]))
    assert found.read(found.numbers(text).tolist(), 0)[2] == state_runs


def test_decontaminated_texts(spark, odd_docs, odd_rows):
    rows = some_items(odd_rows)
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = odd_docs.withColumns({c: F.lit("clash") for c in ("spans", "n_words", "first_lane", "__id", "__first")})
    got = decontaminate.decontaminate(docs, items, 10, 0.5)
    assert got.columns == docs.columns
    left = Counter((r.doc_id, tuple(words(r.text)), r.text if r.text is None else "") for r in got.collect())
    want = Counter()
    for i, t in odd_rows:
        n, hit, _ = brute_hits(t, rows, 10)
        if len(hit) <= n / 2:
            want[i, tuple(w for k, w in enumerate(words(t)) if k not in hit), t if t is None else ""] += 1
    assert left == want and len(left) < len(odd_rows)
    same = {r.text for r in got.collect()} & {t for _, t in odd_rows}
    assert {t for _, t in odd_rows if t and not brute_hits(t, rows, 10)[1]} <= same


def test_op11(spark, odd_docs, odd_rows, no_docs):
    rows = some_items(odd_rows)
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    got = Counter(tuple(r) for r in decontaminate.op11_query(odd_docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    want = Counter()
    for i, t in odd_rows:
        n, hit, found = brute_hits(t, rows, 10)
        ids = sorted(str(x) for x in found - {None})
        want[i, n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    assert got == want
    assert decontaminate.op11_query(no_docs, items).count() == 0
    assert not decontaminate.op11_query(odd_docs, items.limit(0)).where("contaminated OR n_items > 0").count()


# Importance resampling


def brute_scores(rows, target, low=1, high=1, buckets=resample.BUCKETS):
    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[p : p + k]).encode()) % buckets for k in range(low, high + 1) for p in range(len(w) - k + 1)]

    s, t = Counter(b for _, x in rows for b in features(x)), Counter(b for x in target for b in features(x))
    every, wanted = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * every / ((s[b] + 1) * wanted)))
    out = []
    for i, x in rows:
        f = features(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) for b in f)
        out.append((i, len(words(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


def brute_ranks(scores, percent=10, least=20):
    """Scores with ranks; rows equal in id, score and features may take each other's."""
    fit = sorted((r for r in scores if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = fit[: percent * len(fit) // 100]
    left = Counter(scores) - Counter(drawn)
    ranks = [*((r, k) for k, r in enumerate(drawn, 1)), *((r, None) for r in left.elements())]
    return Counter((r[0], r[2], r[3], r[4], k) for r, k in ranks)


@pytest.mark.parametrize("low,high", [(1, 1), (1, 3), (2, 2)])
def test_scores(spark, odd_docs, odd_rows, low, high):
    target = [odd_rows[3][1], None, "", "one two three"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.importance_scores(with_clashes(odd_docs), with_clashes(table), low, high)
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    want = Counter(brute_scores(odd_rows, [t or "" for t in target], low, high))
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want


def test_op12(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(9)
    rows = odd_rows + [(1000 + i, sentences(rng, 40)) for i in range(300)] + [(2000, sentences(rng, 30))] * 150
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    target = spark.createDataFrame([(rows[3][1],)], "text string")
    got = Counter(tuple(r) for r in resample.op12_query(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == brute_ranks(brute_scores(rows, [rows[3][1]]))
    assert resample.op12_query(no_docs, target).count() == 0
    assert resample.op12_query(odd_docs, target.limit(0)).count() == len(odd_rows)
    kept = resample.resample(with_clashes(docs.drop("rank")), target)
    assert kept.columns == with_clashes(docs).columns
    assert {r.doc_id for r in kept.collect()} == {k[0] for k in got if k[4] is not None}


@pytest.mark.parametrize("kind", ["wide", "two values", "one value", "skewed", "one id"])
def test_draw_of_any_distribution(spark, kind):
    rng = random.Random(kind)
    value = {"wide": lambda i: rng.randint(-10**12, 10**12), "two values": lambda i: rng.choice([5, 9]), "one value": lambda i: 7,
             "skewed": lambda i: int(math.exp(rng.uniform(0, 40))), "one id": lambda i: 3}[kind]
    rows = [(1 if kind == "one id" else rng.randint(0, 400), 20 + i % 2, rng.randint(0, 3), 0, value(i)) for i in range(3000)]
    scores = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint").repartition(6)
    for percent in (1, 10, 50, 100, 0):
        got = resample.draw(scores, percent, 20, enough=25).select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert Counter(map(tuple, got)) == brute_ranks(rows, percent)


def test_bracket_counts(spark):
    rng = random.Random(2)
    values = [rng.choice([1, 2, 3, rng.randint(0, 10**6)]) for _ in range(20_000)]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    order = sorted(values, reverse=True)
    for wanted in (1, 700, 9999, 20_000):
        low, high, above, inside = resample._narrowed(rows, "v", wanted, len(values), 100)
        assert low <= order[wanted - 1] <= high and above == sum(v > high for v in values)
        assert inside == sum(low <= v <= high for v in values) and (inside <= 100 or low == high)


# Spelling variants


def brute_counts(rows):
    counts = Counter()
    for i, t in rows:
        for run in LETTERS.findall(lower(t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_variants(counts):
    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_op13(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(4)
    common = ["".join(rng.choices("abcé", k=rng.randint(7, 9))) for _ in range(30)]
    rows = odd_rows + [(3000 + i, " ".join(rng.choices(common, k=60)) + " ÄÖÜ×÷ßÿ Ābcdefgh straßenname") for i in range(60)]
    rows += [(None, " ".join(common)), (7, "x1yzabcdefg " * 3), (8, "repeatedword\tREPEATEDWORD repeatedwörd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {tuple(r[c] for c in COLUMNS) for r in spelling.op13_query(with_clashes(docs)).collect()}
    want = brute_variants(brute_counts(rows))
    assert got == want and any(r[1] for r in want) and len(want) > 30
    assert spelling.op13_query(no_docs).count() == 0


def test_variants_of_dense_words(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choices("ab", k=rng.randint(7, 9))): 10 ** rng.randint(0, 5) * rng.randint(1, 3) for _ in range(400)}
    counts |= {"a" * k: 10**k for k in range(7, 12)} | {"é" * 8: 3, "é" * 7 + "e": 30}
    # Around the length from which rotations are digests, and far beyond it.
    for size in (62, 63, 64, 65, 66, 3000):
        base = "".join(rng.choices("abcdefgh", k=size))
        counts |= {base: 1000, base[:5] + base[6:]: 20, base[:40] + "z" + base[41:]: 1, "z" + base: 50, base + base[-1]: 7}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(7)
    got = {tuple(r[c] for c in COLUMNS) for r in spelling.spelling_variants(table).collect()}
    assert got == brute_variants(counts)


def test_chains_are_followed_to_the_end(spark):
    word = "abcdefghijklmnop"
    chain = {word[:k] + "q" * (16 - k): 10 ** (16 - k) for k in range(17)}
    table = spark.createDataFrame(list(chain.items()), "word string, n bigint")
    got = {r.word: r for r in spelling.spelling_variants(table).collect()}
    assert all(r.root == "q" * 16 for r in got.values()) and got[word].form == word[:15] + "q"


def test_digests_of_equal_rotations():
    for short, long in (("a" * 70, "a" * 71), ("ab" * 40, "ab" * 20 + "x" + "ab" * 20)):
        whole = {k for k, kind in zip(*spelling.rotations(short)) if kind == 0}
        cut = [k for k, kind in zip(*spelling.rotations(long)) if kind == 1]
        assert len(whole & set(cut)) == 1 and len(whole) == len(short) + 1
    by_key = defaultdict(set)
    words_of_one_place = ["x" * 40 + c + "y" * 40 for c in "abc"]
    for w in words_of_one_place:
        for key, kind in zip(*spelling.rotations(w)):
            if kind:
                by_key[key].add(w)
    assert sorted(map(len, by_key.values()))[-1] == 3 and sum(len(s) == 3 for s in by_key.values()) == 1
