"""BPE, licence scan, quality, packing and byte model against libraries and brute force, odd input included."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from flowledger.llm import bpe, ctw, licenses, packing, quality
from flowledger.llm.common import LOWER

from .conftest import with_clashes

RANKS = public.path("byte_bpe_multi_50k.tiktoken")
WORDS = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.vocabulary(RANKS).ranks, special_tokens={})


def test_bpe_equals_library_on_random_text(library):
    rng = random.Random(1)
    alphabet = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "!", "-", "s", " '", "　", "中",
                "́", "Ⅷ", "'S", "😀", "\x1c", "​", "\x85"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(4000)] + ["ab" * 3000, "é" * 700, ""]
    for text, ids in zip(texts, bpe.vocabulary(RANKS).encode_texts(texts)):
        assert ids.tolist() == library.encode_ordinary(text)


def test_bpe_of_every_code_point(library):
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    for text, ids in zip(texts, bpe.vocabulary(RANKS).encode_texts(texts)):
        assert ids.tolist() == library.encode_ordinary(text)


def test_bpe_query(spark, odd_docs, odd_rows, no_docs, library):
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op2_query(with_clashes(odd_docs), RANKS).collect())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = Counter()
    for i, t in odd_rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert got == want
    assert bpe.op2_query(no_docs, RANKS).count() == 0


def test_bpe_offsets_decode_ranges(odd_docs):
    rows = bpe.bpe_encode(odd_docs, RANKS).where("size(ids) > 5").limit(5).collect()
    found = bpe.vocabulary(RANKS)
    for r in rows:
        whole = found.decode(r.ids)
        for token, at in zip(r.ids, r.offsets):
            assert whole[at : at + len(found.tokens[token])] == found.tokens[token]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def test_license_base(odd_docs, odd_rows, no_docs, spark):
    more = [(900 + i, f"some words {t} more words") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    more += [(950, "cc by nc cc BY-NC by nc"), (951, " ".join(["under the mit license"] * 300))]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.op6_query(with_clashes(docs)).collect())
    want = Counter()
    for i, t in [*odd_rows, *more]:
        w = WORD.findall(lower(t or ""))
        hits = [(k, label) for p, label in licenses.PHRASES.items() for q in [p.split()] for k in range(len(w)) if w[k : k + len(q)] == q]
        at = [k for k, _ in hits]
        want[i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))] += 1
    assert got == want
    labels = {r.doc_id: (r.labels, r.score) for r in licenses.op6_query(docs).collect()}
    for i, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in labels[900 + i][0].split(",") and labels[900 + i][1] == 1.0
    assert labels[0] == ("", labels[0][1]) and 0 <= labels[0][1] <= 1
    assert licenses.op6_query(no_docs).count() == 0


def test_license_spans_with_gaps():
    found = licenses.automaton()
    label, text = licenses.TEMPLATES[1]
    words = text.split()
    broken = " ".join(words[:30] + ["inserted", "words"] + words[32:])
    spans = [s for s in found.scan("before that " + broken)[2] if found.labels[s[0]] == label and s[3] > 0.8]
    assert spans and min(s[1] for s in spans) == 2


def test_matching_statistics():
    rng = random.Random(5)
    templates = [("x", " ".join(rng.choices("abcd", k=30))) for _ in range(3)]
    found = licenses.LicenseAutomaton(templates, {"a b": "p"})
    text = rng.choices("abcd", k=400)
    runs, phrases = [], []
    found.read([found.ids[w.encode()] for w in text], 0, runs, phrases)
    inside = [t.split() for _, t in templates] + [["a", "b"]]
    longest = lambda end: max(n for n in range(end + 1) if n == 0 or any(text[end - n : end] == t[k : k + n] for t in inside for k in range(len(t))))
    want = {(e, longest(e)) for e in range(1, 401) if longest(e) >= licenses.MIN_MATCH and (e == 400 or longest(e + 1) <= longest(e))}
    assert {(e, n) for e, n, _ in runs} == want
    assert sorted(i for i, _ in phrases) == [i for i in range(399) if text[i : i + 2] == ["a", "b"]]


def labelled(spark, n=1200):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choices(["an", "er", "the", "on", "re"], k=3)) for _ in range(40))
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = good()
        docs.append((i, text.upper().replace(" ", "!! ") if bad and i % 8 else " ".join([text.split()[0]] * 60) if bad else text))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality_learns_on_rows_not_held_out(spark, odd_docs, no_docs):
    docs, labels = labelled(spark)
    got = quality.op5_query(docs, labels).toPandas()
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]
    assert list(got["held_out"]) == held
    truth = (got["doc_id"] % 4 != 0).astype(int)
    assert (got["predicted"] == truth)[got["held_out"]].mean() > 0.9
    model = quality.fit_quality(docs, labels)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(model[0], quality.fit_quality(docs, flipped)[0])
    odd = quality.score_quality(with_clashes(odd_docs), model).toPandas()
    assert len(odd) == odd_docs.count() and odd["score"].between(0, 1).all()
    nothing = labels.limit(0)
    assert set(quality.op5_query(odd_docs, nothing).toPandas()["score"]) == {0.5}
    assert quality.op5_query(no_docs, labels).count() == 0
    kept = quality.keep_quality(docs.withColumn("x", F.lit(1)), model).toPandas()
    assert set(kept["doc_id"]) == set(got["doc_id"][got["predicted"] == 1])


def test_quality_blocks_do_not_matter(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "bb", "ccc", "é"], k=rng.randint(0, 30))).encode() for _ in range(50)] + [b"", b" ", b"x"]
    texts += ["\n ".join(rng.choices(["a", "a", "bb", "ccc", "é"], k=900)).encode(), b" " * 500 + b"a a a", b"a b a\n" + b" " * 500]
    table = np.random.default_rng(1).normal(size=quality.FEATURES).astype(np.float32)
    whole = quality.logits(texts, table, 0.3)
    assert np.allclose(whole, [quality.logits([t], table, 0.3)[0] for t in texts], atol=1e-9)
    weights = lambda: [dict(zip(*(c[0].as_py() for c in b.columns[:2]))) for t in texts for b in quality._sparse(
        [pa.RecordBatch.from_arrays([pa.array([t.decode()]), pa.array([1])], ["text", "label"])])]
    at_once = weights()
    for size in (64, 150, 1000):
        monkeypatch.setattr(quality, "BLOCK_BYTES", size)
        assert np.allclose(whole, quality.logits(texts, table, 0.3), atol=1e-9)
        for got, want in zip(weights(), at_once):
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_quality_of_a_very_long_text_takes_little_memory():
    import tracemalloc

    rng = random.Random(5)
    words = rng.choices(["alpha", "beta", "gamma", "délta"], k=10_000)
    text = " ".join(words * 340).encode()
    table = np.ones(quality.FEATURES, np.float32)
    assert len(text) > 20_000_000
    tracemalloc.start()
    for one in (text, b"x" * 3_000_000):
        assert abs(quality.logits([one], table, 0.3)[0] - 1.3) < 1e-9
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()


def test_quality_learns_from_one_text_of_an_id(spark):
    docs, labels = labelled(spark, 200)
    model = quality.fit_quality(docs, labels)
    again = docs.union(docs.withColumn("text", F.concat("text", F.lit(" zzz")))).union(docs)
    assert np.array_equal(model[0], quality.fit_quality(again, labels)[0])


def test_quality_learns_from_a_file_with_little_memory():
    import tracemalloc

    def batch(texts, labels):
        return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels, pa.int32())], ["text", "label"])

    rng = random.Random(9)
    texts = ["", "", "a b", "a b", "b a", "a b a b"] + [" ".join(rng.choices(["a", "bb", "é", "12"], k=rng.randint(1, 9))) for _ in range(60)]
    texts += [rng.randbytes(30_000).hex() for _ in range(150)]
    labels = [i % 2 for i in range(len(texts))]
    sparse = [s for b in quality._sparse([batch(texts, labels)]) for s in zip(*(c.to_pylist() for c in b.columns))]
    samples = sorted(((np.array(i, np.int32), np.array(w, np.float32), y) for i, w, y in sparse), key=lambda s: (s[2], len(s[0]), s[0].tobytes(), s[1].tobytes()))
    del sparse
    table, bias = quality.train(samples)
    size = sum(8 * len(i) for i, _, _ in samples)
    del samples
    for order in (list(range(len(texts))), rng.sample(range(len(texts)), len(texts))):
        packed = list(quality._packed([batch([texts[i] for i in order], [labels[i] for i in order])]))
        tracemalloc.start()
        (learned,) = quality._learn(iter(packed))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert learned.column(0)[0].as_py() == table.tobytes() and learned.column(1)[0].as_py() == bias
        # The vectors, their product with the output and one sample; not the sample as a whole.
        assert size > 50_000_000 and peak < 30_000_000


def test_quality_sample_comes_in_small_batches(spark, monkeypatch):
    def largest(batches):
        rows = [b.num_rows for b in batches]
        yield pa.RecordBatch.from_arrays([pa.array([bytes(4)]), pa.array([max(rows) + sum(rows) / 1000])], ["table", "bias"])

    monkeypatch.setattr(quality, "_learn", largest)
    docs, labels = labelled(spark, 200)
    usable = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert quality.fit_quality(docs.coalesce(1), labels)[1] == 16 + usable / 1000


def test_packing(spark, odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rows = packing.op8_query(with_clashes(odd_docs), WORDS).collect()
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    want = defaultdict(Counter)
    for i, t in odd_rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        for start, length, crc in set(pieces[i, len(ids)]):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            want[i, len(ids)][start, length] += zlib.crc32(part) == crc
    assert all(sum(n for _, n, _ in pieces[i, len([*tok.encode(t or "", add_special_tokens=False).ids, 2])]) >= 1 for i, t in odd_rows)
    assert sum(r.length for r in rows) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd_rows)
    assert all(sum(c.values()) >= len(c) - 1 for c in want.values())
    assert packing.op8_query(no_docs, WORDS).count() == 0


def test_best_cuts_against_all_cuts():
    rng = np.random.default_rng(7)
    for _ in range(30):
        lengths = rng.integers(1, 60, 5)
        places, penalty = packing.cut_places(lengths, [np.sort(rng.choice(60, 6, False)) for _ in lengths])
        window = 64
        best = [0.0] + [math.inf] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= window:
                    best[j] = min(best[j], best[i] + window - (places[j] - places[i]) + penalty[j])
        cuts = packing.best_cuts(places, penalty, window)
        cost, last = 0.0, 0
        where = {p: k for k, p in enumerate(places.tolist())}
        for c in cuts:
            assert c - last <= window
            cost += window - (c - last) + penalty[where[c]]
            last = c
        assert cuts[-1] == lengths.sum() and abs(cost - best[-1]) < 1e-9


def test_padding_is_small(spark):
    rng = random.Random(4)
    docs = [(i, ". ".join(" ".join(rng.choices(["alpha", "beta", "gamma"], k=12)) for _ in range(rng.randint(1, 60)))) for i in range(600)]
    rows = packing.op8_query(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), WORDS).toPandas()
    used = rows["length"].sum()
    assert rows["sequence_id"].nunique() * packing.WINDOW <= used * 1.03 + packing.WINDOW


def steps(text: str, depth: int):
    raw = b"\0" * depth + text.encode().translate(LOWER)
    for k in range(depth, len(raw)):
        node = 1
        for j in range(7, -1, -1):
            bit = raw[k] >> j & 1
            yield raw[k - depth : k], node, bit
            node = node * 2 + bit


def brute_ctw(train: list[str], depth: int):
    counts = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    for t in train:
        for context, node, bit in steps(t, depth):
            for d in range(depth + 1):
                counts[d][context[depth - d :], node][bit] += 1
    own = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    shares, below = [{} for _ in range(depth + 1)], defaultdict(float)
    for d in range(depth, -1, -1):
        above = defaultdict(float)
        for (context, node), (a, b) in counts[d].items():
            e = weighted = own(a, b)
            if d < depth:
                weighted = np.logaddexp(e, below[context, node]) + math.log(0.5)
                shares[d][context, node] = math.exp(e - weighted + math.log(0.5))
            above[context[1:], node] += weighted
        below = above

    def score(text: str) -> float:
        total = 0.0
        for context, node, bit in steps(text, depth):
            p, left = 0.0, 1.0
            for d in range(depth + 1):
                key = context[depth - d :], node
                a, b = counts[d].get(key, (0, 0))
                share = 1.0 if d == depth else shares[d].get(key, 0.5)
                p += left * share * (b + 0.5) / (a + b + 1)
                left *= 1 - share
            total += math.log10(p if bit else 1 - p)
        return total

    return score


def test_scores(odd_docs, odd_rows, no_docs):
    got = defaultdict(list)
    for r in ctw.op7_query(with_clashes(odd_docs)).collect():
        got[r.doc_id].append(r)
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = [t or "" for i, t in odd_rows if not out(i)]
    counts = Counter()
    for t in train:
        counts.update(t.encode().translate(LOWER).split())
        counts[None] += 1
    total, distinct = sum(counts.values()), len(counts)
    model = brute_ctw(train, ctw.DEPTH)
    for i in {i for i, _ in odd_rows}:
        want = []
        for t in (t or "" for k, t in odd_rows if k == i):
            w = [*t.encode().translate(LOWER).split(), None]
            base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
            want.append((len(w), sum(counts[x] > 0 for x in w), round(base, 6), round(model(t), 5)))
        assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 5)) for r in got[i]) == sorted(want)
        assert all(r.held_out == out(i) and r.train_tokens == total for r in got[i])
    assert all((r.bits_per_byte is None) == (r.score == 0) for rs in got.values() for r in rs)
    assert ctw.op7_query(no_docs).count() == 0


def test_deep_contexts_beat_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sums = ctw.op7_query(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 7.5, 100.5, 1e6 + 0.5, 1e12 + 0.5]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(ctw.log_gamma(F.col("x"))).collect()
    assert np.allclose([r[0] for r in got], [math.lgamma(x) for x in xs], rtol=1e-9, atol=1e-8)
