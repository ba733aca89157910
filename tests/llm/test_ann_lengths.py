"""Nearest neighbours among vectors of very many lengths."""

from __future__ import annotations

import numpy as np

from flowledger.llm import ann


def test_every_length_is_searched(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=1 + i % 1300).tolist()) for i in range(3900)]
    rows += [(4000 + i, rng.normal(size=7).tolist()) for i in range(80)] + [(4000, [0.0] * 3), (4001, None)]
    got = ann.op4_query(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(6)).collect()
    lengths = {}
    for i, v in rows:
        if v and any(v):
            lengths.setdefault(len(v), []).append((i, np.array(v)))
    want = {}
    for same in lengths.values():
        for q, x in same:
            if q % 20 == 0:
                near = sorted((-float((x * y).sum()), i) for i, y in same if i != q)[:20]
                want |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(near, 1)}
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got}
    assert found.keys() == want.keys()
    assert sum(found[key][0] == want[key][0] for key in want) >= 0.9 * len(want)
    assert all(abs(found[key][1] - want[key][1]) < 1e-9 for key in want if found[key][0] == want[key][0])
