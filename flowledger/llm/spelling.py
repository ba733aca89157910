"""Spelling variants: sorted permuterm rotations bring words together that differ by one code point.

A word marked by a terminator has one rotation per place. Words that differ in one code point share the
rotation that ends with it, but for that last code point; a word and a longer one share the whole rotation of
the first and the rotation of the second without its last code point. So every rotation is listed whole and
without its end; in sorted order equal keys stand together: at most one whole word, and one word for each code
point that can be skipped. Groups are bounded by the alphabet, whatever the number of words. A scan of the
sorted keys gives each member its near words in the group (number, most frequent one); pairs are never listed.
Words with a doubled letter are listed once per run of it, so each near pair meets in one group.

Rotations longer than LONG are replaced by 124-bit digests from prefix sums, so a word of a million letters
takes that many short keys, not their square.

Null texts have no words. Repeated rows and repeated ids count each time; a null id counts as an empty one.
Ties go to the smallest word in code-point order. Texts are read whole, in slices. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_text, release, stage
from .sqlparts import CRC_STEP, LOWER_SQL, crc32_sql
from .words import numbered, slices

MIN_LENGTH, MIN_COUNT, RATIO, DROP = 7, 2, 10, 31
LONG = 64
HELD_WORDS = 200_000

# Latin-1 bytes of letters (A-Z lower-cased, a-z and U+00C0 to U+00FF); the rest is a gap.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 0x20 for c in range(256))
_PRIME = 2**31 - 1
# Four bases of the digest, odd and far apart.
_BASES = (1103515245, 362436069, 69069069, 521288629)


def _varied(word: bytes, start: int, drop: int) -> bytes:
    """The word less the code point that its id and letters decide, where drop divides their checksum."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % drop:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop: int = DROP) -> DataFrame:
    """word, n: letter runs of all texts with one in `drop` occurrences varied, of the least length and count."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # One byte per code point; what is beyond U+00FF becomes a gap.
                for part in slices(text.encode("latin-1", "replace").translate(_LETTERS)):
                    for word, n in Counter([w for w in part.split() if len(w) >= min_length]).items():
                        word = _varied(word, start, drop)
                        if len(word) >= min_length:
                            counts[word] += n
                    if len(counts) > HELD_WORDS:
                        yield batch_of(counts)
                        counts = Counter()
        yield batch_of(counts)

    found = plain_text(docs).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * pow(base, have, _PRIME) % _PRIME
        have += more
    return out


def _digests(word: str) -> tuple[list[str], list[str]]:
    """Digests of the whole rotations that begin at 0, 1, ... and of those from 1 on without their last code point."""
    codes = np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.int64) + 1
    n, lanes = len(codes), []
    at = np.arange(n + 1)
    for base in _BASES:
        up, down = _powers(base, n + 2), _powers(pow(base, -1, _PRIME), n + 1)
        sums = np.append(0, np.cumsum(codes * up[:n] % _PRIME)) % _PRIME
        # Letters from j on, the terminator, letters before j or before j - 1.
        tail = (sums[n] - sums) % _PRIME * down % _PRIME + up[n - at]
        whole = (tail + sums * up[n - at + 1]) % _PRIME
        short = (tail[1:] + sums[:-1] * up[n - at + 1][1:]) % _PRIME
        lanes.append((whole, short))
    texts = [[("#" + "%08x" * len(_BASES)) % row for row in zip(*(lane[k].tolist() for lane in lanes))] for k in (0, 1)]
    return texts[0], texts[1]


def rotations(word: str) -> tuple[list[str], list[int]]:
    """Keys of a word and their kinds: 0 a whole rotation; 1 one without its last code point; 2 the same, where
    that code point repeats the one before it in the word."""
    n = len(word)
    turned = f"{word}$" + word
    whole = [turned[j : j + n + 1] for j in range(n + 1)] if n < LONG else None
    short = [turned[j : j + n] for j in range(1, n + 1)] if n <= LONG else None
    if whole is None or short is None:
        found = _digests(word)
        whole, short = whole or found[0], short or found[1]
    return whole + short, [0] * (n + 1) + [1, *(1 + (a == b) for a, b in zip(word, word[1:]))]


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, counts = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        keys, kinds, sizes, first = [], [], [], 0
        for row, word in enumerate(batch.column(1).to_pylist()):
            found = rotations(word)
            keys += found[0]
            kinds += found[1]
            sizes.append(len(found[0]))
            if len(keys) >= 50_000 or row == len(ids) - 1:
                upto = slice(first, row + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(kinds, pa.int8()), pa.array(np.repeat(ids[upto], sizes)),
                     pa.array(np.repeat(counts[upto], sizes))],
                    ["key", "kind", "id", "n"],
                )
                keys, kinds, sizes, first = [], [], [], row + 1


_NEAR = ["id", "near", "best_n", "best"]


def _near(starts: np.ndarray, rows: int, kind: np.ndarray, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Near words of each member of the groups that begin at starts; rows of a group are in order of n and id."""
    sizes = np.diff(np.append(starts, rows))
    group = np.repeat(np.arange(len(starts)), sizes)
    at, nowhere = np.arange(rows), rows
    firsts = lambda chosen: np.minimum.reduceat(np.where(chosen, at, nowhere), starts)
    skips, fresh = kind > 0, kind == 1
    first_skip = firsts(skips)[group]
    second_skip = firsts(skips & (at != first_skip))[group]
    first_fresh = firsts(fresh)[group]
    wholes = np.add.reduceat(~skips, starts)[group]
    freshes = np.add.reduceat(fresh, starts)[group]
    begin = starts[group]
    size = sizes[group]
    near = np.where(kind == 0, freshes, size - 1 - np.where(fresh, 0, wholes))
    other_skip = np.where(first_skip == at, second_skip, first_skip)
    best = np.where(kind == 0, first_fresh, np.where(fresh, np.where(begin == at, begin + 1, begin), other_skip))
    told = near > 0
    best = best[told]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[told], near[told], n[best], ids[best])], _NEAR)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None

    def found(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        keys = rows.column(0).combine_chunks()
        change = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        starts = np.append(0, np.flatnonzero(change) + 1)
        # The last group may go on in the next batch.
        end = len(rows) if last else int(starts[-1])
        starts = starts[starts < end]
        part = rows.slice(0, end)
        kind, ids, n = (part.column(c).to_numpy() for c in (1, 2, 3))
        if not len(starts):
            empty = [pa.array([], pa.int64())] * len(_NEAR)
            return pa.RecordBatch.from_arrays(empty, _NEAR), rows.slice(end)
        return _near(starts, end, kind, ids, n), rows.slice(end)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        out, held = found(table if held is None else pa.concat_tables([held, table]), False)
        yield out
    if held is not None and len(held):
        yield found(held, True)[0]


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) of links (id, form): pointers are doubled until all end at words without a form."""
    pointers, moved = stage(links.select("id", F.col("form").alias("root"))), True
    while moved:
        jump = pointers.select(F.col("id").alias("root"), F.col("root").alias("next"))
        joined = pointers.join(jump, "root", "left")
        further = stage(joined.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(pointers)
        moved = not further.where("moved").isEmpty()
        pointers = further.select("id", "root")
    return pointers


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of different words and their counts (word, n)."""
    known = stage(numbered(words.select("word", "n"), F.col("word")).select(F.col("position").alias("id"), "word", "n"))
    turned = known.mapInArrow(_rotated, "key string, kind tinyint, id bigint, n bigint")
    ordered = turned.repartitionByRange("key").sortWithinPartitions("key", F.desc("n"), "id")
    each = ordered.mapInArrow(_scan, "id bigint, near bigint, best_n bigint, best bigint")
    most = F.max(F.struct("best_n", (-F.col("best")).alias("best")))
    near = stage(each.groupBy("id").agg(F.sum("near").alias("n_near"), most.alias("most")))
    taken = F.col("most.best_n") >= ratio * F.col("n")
    told = known.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, -F.col("most.best")).alias("form_id"), F.when(taken, F.col("most.best_n")).alias("form_n"),
    )
    told = stage(told)
    roots = _roots(told.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    name = lambda key, out: known.select(F.col("id").alias(key), F.col("word").alias(out))
    linked = told.where("form_id IS NOT NULL").join(roots, "id").join(name("form_id", "form"), "form_id").join(name("root", "root_word"), "root")
    own = told.where("form_id IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n").unionByName(own)


def op13_query(docs: DataFrame) -> DataFrame:
    return spelling_variants(word_counts(docs))


ORACLE = f"""
WITH {CRC_STEP},
runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
marked AS (
  SELECT run, c, {crc32_sql("marked")} AS h
  FROM (SELECT run, count(*) AS c, doc_id::VARCHAR || ':' || run AS marked FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY doc_id, run), crc_step
),
varied AS (
  SELECT CASE WHEN h % {DROP} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
  FROM marked
),
words AS (SELECT word, sum(c)::BIGINT AS n FROM varied WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM places a JOIN places b ON a.i = b.i AND substr(a.word, 1, a.i - 1) = substr(b.word, 1, b.i - 1)
    AND substr(a.word, a.i + 1) = substr(b.word, b.i + 1) AND a.word != b.word
  UNION SELECT p.word, w.word, w.n FROM places p JOIN words w ON w.word = substr(p.word, 1, p.i - 1) || substr(p.word, p.i + 1)
  UNION SELECT w.word, p.word, p.n FROM places p JOIN words w ON w.word = substr(p.word, 1, p.i - 1) || substr(p.word, p.i + 1)
),
ordered AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM near),
told AS (
  SELECT w.word, w.n, coalesce(o.n_near, 0)::BIGINT AS n_near,
    CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form, CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ordered o ON w.word = o.word AND o.r = 1
),
chain AS (
  SELECT word, form AS place FROM told WHERE form IS NOT NULL
  UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.place WHERE t.form IS NOT NULL
),
last AS (SELECT c.word, c.place FROM chain c JOIN told t ON t.word = c.place WHERE t.form IS NULL)
SELECT t.word, t.form, coalesce(l.place, t.word) AS root, t.n, t.n_near, t.form_n
FROM told t LEFT JOIN last l ON l.word = t.word
""".replace("WITH crc", "WITH RECURSIVE crc", 1)
