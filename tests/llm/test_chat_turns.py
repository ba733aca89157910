"""Every row of the conversations is in the formatted chats."""

from __future__ import annotations

import json
import random
from collections import Counter

import duckdb
from parity import difference

from flowledger.llm import chat

ROWS = [
    (1, 0, "system", "rules"), (1, 1, "user", "hello"), (1, 2, "assistant", "one two"), (1, 2, "assistant", "one two"),
    (1, 2, "assistant", "other"), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"), (2, 0, "user", "first"),
    (2, 1, "tool", "x"), (2, 2, None, "y"), (2, None, "user", "z"), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
    (None, 1, "assistant", "m"), (None, 2, "user", "k"), (None, 2, "user", "k"), (3, 0, "system", None),
]


def texts_of(rows) -> Counter:
    found = Counter()
    for r in rows:
        m = json.loads(r.message)
        found.update([m[k] for k in ("content", "result") if k in m] + [m["arguments"]["text"] for _ in "1" if "arguments" in m])
    return found


def test_every_row_is_in_the_result(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string")
    got = chat.op3_query(df).collect()
    assert sum(r.n_rows for r in got) == len(ROWS)
    assert texts_of(got) == Counter(t or "" for *_, t in ROWS)
    errors = Counter(r.errors for r in got if r.kind != "call" or "repeated" in r.errors)
    assert errors["unknown role"] == 2 and errors["repeated result"] == 3
    assert sum("repeated call" in r.errors for r in got) == 3
    assert chat.op3_query(df.limit(0)).count() == 0


def test_every_given_row(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.op3_query(df).collect()
    assert sum(r.n_rows for r in got) == df.count()
    assert texts_of(got) == Counter(r.text or "" for r in df.collect())


def brute(rows) -> dict:
    """(conv_id, turn) of assistant turns to depth and whether the turn two back is missing, one turn after the other."""
    calls = {(c, t) for c, t, role, _ in rows if role == "assistant" and c is not None}
    out = {}
    for c, t in sorted(calls):
        out[c, t] = (out[c, t - 2][0] + 1 if (c, t - 2) in calls else 0, t >= 2 and (c, t - 2) not in calls)
    return out


def many_rows() -> list[tuple]:
    rng = random.Random(21)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), " ".join(rng.choices(["a", "b\n", "c"], k=rng.choice([0, 3, 40, 90, 300]))))
            for c in range(1, 25) for t in range(rng.randint(0, 14)) for _ in range(rng.choice([1, 1, 1, 2]))]
    return rows + [(99, t, "assistant", "one two three four five") for t in range(0, 400, 2)]


def test_depths_errors_and_order_by_brute_force(spark):
    rows = many_rows()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = chat.op3_query(df).toPandas()
    want = brute(rows)
    first = got[(got.kind == "call") & got.depth.notna()]
    assert {(r.conv_id, int(r.turn)): (int(r.depth), "unknown predecessor" in r.errors) for r in first.itertuples()} == want
    # Sorted by depth, every call comes after the one it follows.
    after = first.sort_values(["conv_id", "depth", "turn"])
    for c, part in after.groupby("conv_id"):
        seen = set()
        for m in map(json.loads, part.message):
            assert m.get("after") is None or m["after"] in seen
            seen.add(m["call_id"])
    conversations = df.toPandas()  # noqa: F841  read by the SQL
    assert difference(got, duckdb.sql(chat.ORACLE).df()) is None
