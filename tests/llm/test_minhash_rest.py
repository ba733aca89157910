"""The exact way of the near-duplicate operator for what its forest does not propose, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowledger.llm import minhash
from flowledger.llm.common import stage
from flowledger.llm.components import components


def brute(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def table(spark, sets):
    rows = [(i, len(s), sorted(s), [int(x) for x in minhash._bitmap(minhash.np.array(sorted(s), "u8"))]) for i, s in sets.items()]
    return stage(spark.createDataFrame(rows, "rep bigint, n bigint, shingles array<bigint>, bits array<bigint>").repartition(3))


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_rest_links_all_similar_sets(spark, percent):
    rng = random.Random(percent)
    base = rng.sample(range(1 << 40), 60)
    sets = {}
    for i in range(150):
        # Around the limit: some are linked through others only.
        changed = dict(zip(rng.sample(range(60), rng.randint(0, 14)), rng.sample(range(1 << 40), 14)))
        sets[i] = {changed.get(k, x) for k, x in enumerate(base)}
    for i in range(150, 260):
        sets[i] = set(rng.sample(range(9), rng.randint(1, 6)))
    for i in range(260, 290):
        sets[i] = set(base[: rng.randint(5, 60)])
    none = spark.createDataFrame([], "id bigint, component bigint")
    edges = spark.createDataFrame([], "a bigint, b bigint")
    known = table(spark, sets)
    _, found = minhash._link_rest(known, stage(none), edges, percent)
    got = {r.id: r.component for r in found.collect()}
    assert {i: got.get(i, i) for i in sets} == brute(sets, percent)


def test_rest_meets_what_neighbours_miss(spark):
    """Pairs that share a shingle far apart in its order are found by the full meeting."""
    rng = random.Random(1)
    sets = {i: {7, *rng.sample(range(100, 1 << 40), 9)} for i in range(300)}
    sets[1000] = {7, *range(11, 20)}
    sets[1001] = {7, *range(11, 21)}
    known = table(spark, sets)
    tokens = minhash._rare_tokens(known, 80)
    none = spark.createDataFrame([], "id bigint, component bigint")
    pairs = minhash._all_left(stage(minhash._mixed(tokens, none)), known, 80)
    assert [tuple(r) for r in pairs.collect()] == [(1001, 1000)]
    joined = components(minhash.confirm(pairs, known, 80))
    assert {(r.id, r.component) for r in joined.collect()} == {(1000, 1000), (1001, 1000)}


def test_mixed_keeps_only_shingles_of_several_components(spark):
    tokens = spark.createDataFrame([(1, 5, 10), (2, 5, 10), (3, 5, 11), (4, 5, 11), (4, 5, 12)], "rep bigint, n bigint, h bigint")
    found = spark.createDataFrame([(2, 1), (1, 1)], "id bigint, component bigint")
    got = minhash._mixed(tokens, found).select("h", "rep", "component").orderBy("h", "rep")
    assert [tuple(r) for r in got.collect()] == [(11, 3, 3), (11, 4, 4)]
    assert not minhash._mixed(tokens.where(F.lit(False)), found).count()


def test_rest_meets_a_pair_few_times(spark, monkeypatch):
    """Variants of one text just below the limit share most of their rare shingles; each pair may pass at few of them."""
    rng, sets = random.Random(2), {}
    base = rng.sample(range(1 << 40), 400)
    for i in range(60):
        changed = set(rng.sample(range(400), 24))
        sets[i] = {rng.randrange(1 << 40) if k in changed else x for k, x in enumerate(base)}
    near = {rng.randrange(1 << 40) if k < 30 else x for k, x in enumerate(sorted(sets[7]))}
    known = table(spark, sets | {100: near})
    met, distinct = [], type(known).distinct

    def counted(df):
        if df.columns == ["a", "b"]:
            met.append(df.count())
        return distinct(df)

    none = spark.createDataFrame([], "id bigint, component bigint")
    tokens = stage(minhash._mixed(minhash._rare_tokens(known, 80), none))
    monkeypatch.setattr(type(known), "distinct", counted)
    pairs = {tuple(r) for r in minhash._all_left(tokens, known, 80).collect()}
    assert (100, 7) in pairs
    assert met[0] <= 61 * 60


def test_rest_keeps_sets_of_one_id_apart(spark):
    """Two sets under one id, as large and with shingles in common, each meet what is near them."""
    rng = random.Random(3)
    one = rng.sample(range(1 << 40), 40)
    two = one[:8] + rng.sample(range(1 << 40), 32)
    rows = [(5, one), (5, two), (6, [*one[:-2], 1 << 41, 1 << 42]), (7, [*two[2:], 1 << 43, 1 << 44])]
    rows = [(i, len(s), sorted(s), [int(x) for x in minhash._bitmap(minhash.np.array(sorted(s), "u8"))]) for i, s in rows]
    known = stage(spark.createDataFrame(rows, "rep bigint, n bigint, shingles array<bigint>, bits array<bigint>"))
    none = spark.createDataFrame([], "id bigint, component bigint")
    tokens = stage(minhash._mixed(minhash._rare_tokens(known, 80), none))
    pairs = {tuple(r) for r in minhash._all_left(tokens, known, 80).collect()}
    assert {(6, 5), (7, 5)} <= pairs


def test_proposals_are_ruled_out_before_sets_move(spark, monkeypatch):
    """Texts that share half of their words are proposed, but bitmaps keep them from the full sets; shuffles go step by step."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base + [f"x{rng.randrange(1 << 40)}" for _ in range(60)])) for i in range(60)]
    copy = rows[7][1].split()
    rows += [(100, " ".join(copy)), (101, " ".join([*copy[:-4], "a", "b", "c", "d"])), (102, " ".join([*copy[:-4], "a", "b", "c", "e"]))]
    rows += [(101, rows[-2][1]), (103, None), (None, rows[7][1])]
    proposed, sets, cleaned = [], [], []
    old_possible, old_sets, old_stage = minhash.possible, minhash.shingle_sets, minhash.stage

    def possible(pairs, bitmaps, percent):
        proposed.append(pairs.count())
        return old_possible(pairs, bitmaps, percent)

    def shingle_sets(docs, ids, size, whole=True):
        if whole:
            sets.append(ids.where("NOT crowded").count())
        return old_sets(docs, ids, size, whole)

    def kept(df):
        cleaned.append(df.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None))
        return old_stage(df)

    monkeypatch.setattr(minhash, "possible", possible)
    monkeypatch.setattr(minhash, "shingle_sets", shingle_sets)
    monkeypatch.setattr(minhash, "stage", kept)
    monkeypatch.setattr(minhash, "CROWD", 100)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, 2).collect()}
    near = {7, 100, 101, 102}
    assert got == {(i, 7 if i in near else i) for i, _ in rows}
    assert proposed[0] > 100 and sets[0] < 20
    assert set(cleaned) == {"true"}
