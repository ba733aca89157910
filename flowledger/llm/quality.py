"""Quality classifier: supervised subword embeddings.

Every text is a bag of hashed features of three kinds: character n-grams over its bytes, words with word
bigrams, and the repetition pattern of word triples (which of three neighbouring words are equal). A
document vector is the mean over the kinds of the mean of their learned vectors; a softmax over two
classes is trained by stochastic gradient descent in numpy. The model is linear in the document vector,
so for scoring each bucket needs one number: the table is FEATURES floats (1.5 MB) whatever the corpus.

Training reads at most `sample` labelled documents, those with the smallest hash of their id, each
reduced on the executors to its bucket weights (at most FEATURES entries), which travel compressed, SAMPLE_ROWS
at a time. The task that learns keeps them in a temporary file and reads one at a time, so its memory is that of
the bucket vectors, whatever the sample and the length of its texts. Of rows that share a labelled id
the smallest text teaches. Everything else covers whole texts of all rows. Texts are read in blocks of
BLOCK_BYTES; a longer one is cut at white space and its sums are carried, so memory does not depend on its
length and the score not on the cut (a word of more than half a block is read in pieces). Null text is empty text; texts without features get the score of the bias
alone (the prior of the labels). Without any usable label every score is 0.5. Repeated rows and null ids
are scored one by one; labels that are null or not 0 or 1 teach nothing. Other columns are not read.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator, Sequence
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, plain_text

BUCKETS = 1 << 17
KINDS = 3
FEATURES = KINDS * BUCKETS
GRAMS = (3, 4, 5)
BLOCK_BYTES = 1 << 17
SAMPLE_ROWS = 16
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(salt * 0x632BE59BD9B4E019 & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(47)).astype(np.int32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(_PRIME), -1, 2**64)
    up = np.full(n, _PRIME, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def features(
    texts: list[bytes], follows: list[bytes] | None = None, opens: bool = True, before: tuple[int, int] = (0, 0)
) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], tuple[int, int]]:
    """For every kind of feature: bucket ids of all texts in a row, where each text's ids begin and end.

    A part of a long text comes alone, with the bytes that follow it, whether it opens the text, and the
    hashes of the two words before it; those of its own last two words come back.
    """
    reach = max(GRAMS) - 1
    # Every text has a line break before it and, behind it, as many bytes as a gram reaches, so no gram of
    # one text sees another.
    follows = [f.ljust(reach, b"\n")[:reach] for f in follows or [b""] * len(texts)]
    joined = np.frombuffer(b"".join(x for t, f in zip(texts, follows) for x in (b"\n", t, f)) + b"\n" * reach, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = 1 + np.cumsum(sizes + 1 + reach) - sizes - 1 - reach
    codes = joined.astype(np.uint64) + np.uint64(1)

    grams, hashed = [], codes
    for n in range(2, max(GRAMS) + 1):
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in GRAMS:
            grams.append(_bucket(hashed, n)[: len(codes) - max(GRAMS) + 1])
    chars = np.stack(grams, axis=1).ravel()
    begins, ends = (starts - (opens & (sizes > 0))) * len(GRAMS), (starts + sizes) * len(GRAMS)

    white = (joined == 32) | ((joined >= 9) & (joined <= 13))
    white[(starts + sizes)[:, None] + np.arange(reach)] = True
    begin = np.flatnonzero(~white & np.append(True, white[:-1]))
    end = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    up, down = _powers(len(codes) + 1)
    sums = np.append(np.uint64(0), np.cumsum(codes * up[: len(codes)]))
    words = (sums[end] - sums[begin]) * down[begin]
    owner = np.searchsorted(starts, begin, side="right") - 1
    first = np.searchsorted(begin, np.append(starts, len(joined)))
    fresh = np.append(True, owner[1:] != owner[:-1]) if len(words) else np.zeros(0, bool)
    previous = np.where(fresh, np.uint64(before[0]), np.append(np.uint64(0), words[:-1]))
    pairs = np.stack([_bucket(words, 11), _bucket(words * np.uint64(3) + previous * _PRIME, 12)], axis=1).ravel()
    earlier = np.where(fresh, np.uint64(before[1]), np.append(np.uint64(0), previous[:-1]))
    pattern = (words == previous).astype(np.uint64) + np.uint64(2) * (words == earlier) + np.uint64(4) * (previous == earlier)
    last = (*(int(w) for w in words[:-3:-1]), *before)[:2]
    return [
        (chars, begins, ends),
        (BUCKETS + pairs, first[:-1] * 2, first[1:] * 2),
        (2 * BUCKETS + _bucket(pattern, 13), first[:-1], first[1:]),
    ], last


def _parts(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A long text in parts of at most BLOCK_BYTES, cut at white space (a longer word in its midst), with what follows."""
    at = 0
    while at < len(text):
        end = min(at + BLOCK_BYTES, len(text))
        if end < len(text):
            end = max(text.rfind(b" ", at + 1, end), text.rfind(b"\n", at + 1, end), at + BLOCK_BYTES // 2)
        yield text[at:end], text[end : end + max(GRAMS)]
        at = end


def _read(text: bytes) -> Iterator[list[np.ndarray]]:
    """Bucket ids of one text by kind, part by part."""
    before, opens = (0, 0), True
    for part, follow in _parts(text):
        found, before = features([part], [follow], opens, before)
        opens = False
        yield [ids[a[0] : b[0]] for ids, a, b in found]


def _sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.append(0.0, np.cumsum(values, dtype=np.float64))
    return sums[ends] - sums[begins]


def logits(texts: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of label 1 of each text; working memory is that of a block, however long a text is."""
    out = []
    for block in _blocks(texts):
        if len(block) == 1 and len(block[0]) > BLOCK_BYTES:
            total, count = np.zeros(KINDS), np.zeros(KINDS)
            for kinds in _read(block[0]):
                total += [table[ids].sum(dtype=np.float64) for ids in kinds]
                count += [len(ids) for ids in kinds]
            out.append([bias + (total / np.maximum(count, 1)).sum() / KINDS])
        else:
            means = (_sums(table[ids], a, b) / np.maximum(b - a, 1) for ids, a, b in features(block)[0])
            out.append(bias + sum(means) / KINDS)
    return np.concatenate(out) if out else np.zeros(0)


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in blocks of at most BLOCK_BYTES; a longer text is a block of its own."""
    block, size = [], 0
    for t in texts:
        if block and size + len(t) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def _encode(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in texts]


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that few texts at a time are held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket weights of each text: its document vector is the weighted sum of the buckets' vectors."""
    for batch in _small(batches):
        ids, weights = [], []
        for text in _encode(batch.column(0).to_pylist()):
            counts, sizes = np.zeros(0, np.int32), np.zeros(KINDS)
            unique = np.zeros(0, np.int32)
            for kinds in _read(text):
                more, at = np.unique(np.concatenate([unique, *kinds]), return_inverse=True)
                each = np.concatenate([counts, np.ones(sum(map(len, kinds)))])
                unique, counts = more, np.bincount(at, each, len(more))
                sizes += [len(k) for k in kinds]
            ids.append(unique.astype(np.int32))
            weights.append((counts / KINDS / sizes[unique // BUCKETS]).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32())), batch.column(1)],
            ["ids", "weights", "label"],
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's buckets and their weights as one compressed record, with their number and the label."""
    for batch in _small(batches, SAMPLE_ROWS):
        for sparse in _sparse(iter([batch])):
            records, sizes = [], []
            for i in range(sparse.num_rows):
                ids, weights = sparse.column(0)[i].values.to_numpy(), sparse.column(1)[i].values.to_numpy()
                # Steps between ascending ids, lowest bytes first: the upper bytes are nearly all zero.
                steps = np.diff(ids, prepend=np.int32(0)).view(np.uint8).reshape(-1, 4)
                records.append(zlib.compress(steps.T.tobytes() + weights.tobytes(), 1))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(records, pa.binary()), pa.array(sizes, pa.int32()), sparse.column(2)], ["record", "size", "label"]
            )


class _Samples(Sequence):
    """(ids, weights, label) of records kept in a temporary file, in an order that does not depend on their arrival."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.file = tempfile.TemporaryFile()
        self.places = []
        for batch in batches:
            for record, size, label in zip(*(c.to_pylist() for c in batch.columns)):
                self.places.append((label, size, self.file.tell(), len(record)))
                self.file.write(record)
        self.places.sort(key=cmp_to_key(self._compare))

    def _compare(self, a: tuple, b: tuple) -> int:
        # Only ties of label and size are read.
        one, other = a[:2], b[:2]
        if one == other:
            one, other = ([x.tobytes() for x in self._read(p)] for p in (a, b))
        return (one > other) - (one < other)

    def _read(self, place: tuple) -> tuple[np.ndarray, np.ndarray]:
        _, size, at, length = place
        self.file.seek(at)
        raw = np.frombuffer(zlib.decompress(self.file.read(length)), np.uint8)
        steps = np.ascontiguousarray(raw[: 4 * size].reshape(4, -1).T).view(np.int32).ravel()
        return np.cumsum(steps, dtype=np.int32), raw[4 * size :].view(np.float32)

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        return *self._read(self.places[i]), self.places[i][0]

    def close(self) -> None:
        self.file.close()


def train(
    samples: Sequence[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 4, rate: float = 0.5, seed: int = 7
) -> tuple[np.ndarray, float]:
    """One number per bucket and the bias of the log-odds of label 1; zeros without samples.

    A step moves a document's vector, not its buckets, by the rate times the gradient, so long and short
    texts learn alike.
    """
    if not samples:
        return np.zeros(FEATURES, np.float32), 0.0
    rng = np.random.default_rng(seed)
    vectors = np.empty((FEATURES, dim), np.float32)
    for part in np.array_split(vectors, KINDS * 8):
        part[:] = rng.uniform(-1, 1, part.shape)
    vectors /= dim
    out = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
    share = np.clip(np.mean([y for _, _, y in samples]), 1e-3, 1 - 1e-3)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            ids, weights, label = samples[i]
            step = np.float32(rate * (1 - done / steps))
            done += 1
            rows = vectors[ids]
            hidden = weights @ rows
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            error = (p / p.sum()).astype(np.float32)
            error[label] -= 1
            back = out @ error
            out -= step * 0.2 * np.outer(hidden, error)
            vectors[ids] = rows - (step / (weights @ weights) if len(ids) else step) * np.outer(weights, back)
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> tuple[np.ndarray, float]:
    """Model from at most `sample` labelled documents outside the held-out quarter."""
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    # At most `sample` rows of two numbers; one text (the smallest) of rows that share an id.
    chosen = plain_text(docs).join(F.broadcast(usable), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    chosen = chosen.select("text", "label")
    packed = chosen.mapInArrow(_packed, "record binary, size int, label int")
    # One task learns from the sample; its size does not depend on the corpus.
    with batches_of(docs.sparkSession, SAMPLE_ROWS):
        learned = packed.repartition(1).mapInArrow(_learn, "table binary, bias double").first()
    return (np.frombuffer(bytes(learned[0]), np.float32), learned[1]) if learned else train([])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    samples = _Samples(batches)
    table, bias = train(samples)
    samples.close()
    yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()]), pa.array([bias])], ["table", "bias"])


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, score of every row; the score depends on the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in _small(batches):
            z = logits(_encode(batch.column(1).to_pylist()), table, bias)
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return plain_text(docs).mapInArrow(run, "doc_id bigint, score double")


def keep_quality(docs: DataFrame, model: tuple[np.ndarray, float], least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores at least `least`, with all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    bound = np.log(least / (1 - least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for batch in _small(batches):
            z = logits(_encode([t or "" for t in batch.column(at).to_pylist()]), table, bias)
            yield batch.filter(pa.array(z >= bound))

    return docs.mapInArrow(run, docs.schema)


def op5_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
