"""Importance resampling towards a target: array-scored weights, then a bracketed cutoff.

Features of a text are its runs of `low` to `high` consecutive words, joined by one space, in `buckets` hashed
buckets. Two tables of bucket counts, of all documents and of all target texts, give one gain per bucket: an
array of fixed size that goes to every task and scores a text by one sum over its features. Adding a Gumbel
number that only the id decides makes the highest scores a draw without replacement by weight.

The cutoff of the draw is found without sorting the scores. A quantile sketch gives a bracket that should hold
it; the rows above and inside are counted exactly, and a bracket that misses is widened back to the last one
that held. Brackets shrink until SORTED rows or a single value is left; equal scores are told apart by the
smaller doc_id, then by fewer features, then by the place of the row, each bracketed alike. Only what is left
in the last bracket is sorted. Ranks of the drawn rows come from a sort by range and the sizes of its parts.

Null or wordless texts have no features and weight 0. Null ids come last among ties and have the Gumbel number
of an empty id. Repeated rows are scored and drawn one by one. Texts are read whole, in slices. Extra columns
are not read by the scores and are returned as they are by resample. Empty tables give no rows; an empty
target has uniform smoothed counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_lanes, plain_text, stage
from .sqlparts import CRC_STEP, WORDS_SQL, crc32_sql
from .words import numbered, word_slices

BUCKETS, SMOOTHING, SALT = 10000, 1000, 2024
SORTED = 1 << 16
SKETCH, MARGIN = 2048, 0.005
CACHE_WORDS = 300_000


class _Buckets(dict):
    """Bucket of a feature, remembered."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


def _features(text: str, low: int, high: int, known: _Buckets) -> tuple[int, list[np.ndarray]]:
    """Number of words of a text and the buckets of all its runs of low to high words."""
    n, before, out = 0, [], []
    for words in word_slices(text):
        n += len(words)
        if len(known) > CACHE_WORDS:
            known.clear()
        for k in range(low, high + 1):
            if k == 1:
                runs, size = words, len(words)
            else:
                # Runs that end in this slice; the slice before ends with their first words.
                joined = [*before[max(0, len(before) - k + 1) :], *words]
                size = max(0, len(joined) - k + 1)
                runs = (b" ".join(joined[i : i + k]) for i in range(size))
            out.append(np.fromiter(map(known.__getitem__, runs), np.int64, size))
        if high > 1:
            before = [*before, *words][1 - high :]
    return n, out


def bucket_counts(texts: DataFrame, low: int, high: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for found in _features(text, low, high, known)[1]:
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    # At most one row per bucket.
    for bucket, n in texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed ratio of target to corpus shares) per bucket."""
    every, wanted = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    each = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(SMOOTHING * math.log((t + 1.0) * every / ((s + 1.0) * wanted))) for s, t in each], np.int64)


def gumbel(doc_id: Column, salt: int = SALT) -> Column:
    """floor(1000 * a Gumbel number) that the id and the salt decide."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("bigint")


def importance_scores(
    docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS, salt: int = SALT,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """doc_id, lanes of the text, n_words, n_features, weight and score of every row of docs."""
    texts = plain_text(docs, id_col, text_col)
    wanted = target.select(F.coalesce(F.col(f"`{target_col}`").cast("string"), F.lit("")).alias("text"))
    table = gains(bucket_counts(texts.select("text"), low, high, buckets), bucket_counts(wanted, low, high, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = _Buckets(buckets), shared.value
        for batch in batches:
            words, counts, weights = [], [], []
            for text in batch.column(3).to_pylist():
                n, found = _features(text, low, high, known)
                words.append(n)
                counts.append(sum(map(len, found)))
                weights.append(sum(int(gain[f].sum()) for f in found))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(c, pa.int64()) for c in (words, counts, weights))],
                ["doc_id", "first_lane", "second_lane", "n_words", "n_features", "weight"],
            )

    lanes = (h.alias(n) for h, n in zip(hash_lanes(F.col("text")), ("first_lane", "second_lane")))
    scored = texts.select("doc_id", *lanes, "text").mapInArrow(
        run, "doc_id bigint, first_lane bigint, second_lane bigint, n_words bigint, n_features bigint, weight bigint"
    )
    return scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), salt))


def _narrowed(rows: DataFrame, key: str, wanted: int, within: int, enough: int) -> tuple[int, int, int, int]:
    """(low, high, above, inside): a bracket of key values that holds the wanted-th largest of `within` rows.

    above and inside are exact counts; the bracket is one value or has at most `enough` rows.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    above, inside = 0, within
    while inside > enough and low < high:
        part = rows.where(F.col(key).between(low, high))
        place = 1 - (wanted - above) / inside
        shares = F.array(*(F.lit(min(1.0, max(0.0, place + d))) for d in (-MARGIN, MARGIN)))
        sketch = F.kll_sketch_agg_bigint(key, F.lit(SKETCH))
        guess = part.agg(F.kll_sketch_get_quantile_bigint(sketch, shares).alias("at")).first()[0]
        below, top = max(low, min(guess)), min(high, max(guess))
        if (below, top) == (low, high):
            # Two heavy values: the sketch tells no more than the bracket, so its middle does.
            below = top = low + (high - low) // 2
            top_count = part.where(F.col(key) > below).count()
            if above + top_count >= wanted:
                low, inside = below + 1, top_count
            else:
                high, above, inside = below, above + top_count, inside - top_count
            continue
        counts = part.agg(
            F.count(F.when(F.col(key) > top, 1)).alias("over"), F.count(F.when(F.col(key) >= below, 1)).alias("least")
        ).first()
        if above + counts.over >= wanted:
            # The sketch set its upper end too low: what it left out above holds the cutoff.
            low, inside = top + 1, counts.over
        elif above + counts.least < wanted:
            high, above, inside = below - 1, above + counts.least, inside - counts.least
        else:
            low, high, above, inside = below, top, above + counts.over, counts.least - counts.over
    return low, high, above, inside


def _cutoff(rows: DataFrame, keys: list[str], wanted: int, enough: int) -> list[int]:
    """Key values of the wanted-th row, all keys descending; keys are not null and together unique."""
    inside, fixed = rows.count(), []
    for i, key in enumerate(keys):
        low, high, above, inside = _narrowed(rows, key, wanted, inside, enough)
        rows, wanted = rows.where(F.col(key).between(low, high)), wanted - above
        if low < high or inside <= enough:
            # At most `enough` rows are sorted.
            last = rows.orderBy(*(F.desc(k) for k in keys[i:])).offset(wanted - 1).limit(1).first()
            return fixed + [last[k] for k in keys[i:]]
        fixed.append(low)
    return fixed


def _ordered(scores: DataFrame) -> tuple[DataFrame, list[str]]:
    """Scores with keys whose descending order is that of the draw."""
    smallest = F.lit(-(2**63))
    keys = {
        "k_score": F.col("score"), "k_id": F.coalesce(F.bitwise_not("doc_id"), smallest),
        "k_features": F.bitwise_not("n_features"), "k_place": F.bitwise_not("place"),
    }
    return scores.withColumns(keys), list(keys)


def draw(scores: DataFrame, percent: int = 10, min_words: int = 20, enough: int = SORTED) -> DataFrame:
    """The rows of scores, rank added: 1, 2, ... for the floor(percent * N / 100) highest of the N rows with
    at least min_words words, null for all others."""
    # The place of a row in the stored table tells equal rows apart and stays the same when a task is repeated.
    stored = stage(scores.withColumn("place", F.monotonically_increasing_id()))
    rows, keys = _ordered(stored)
    fit = rows.where(F.col("n_words") >= min_words)
    wanted = percent * fit.count() // 100
    names = scores.columns
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return stored.select(*names, undrawn)
    inside, tied = F.lit(False), F.col("n_words") >= min_words
    for key, value in zip(keys, _cutoff(fit, keys, wanted, enough)):
        inside, tied = inside | (tied & (F.col(key) > value)), tied & (F.col(key) == value)
    inside = inside | tied
    ranked = numbered(rows.where(inside), *(F.desc(k) for k in keys))
    drawn = ranked.select(*names, (F.col("position") + 1).alias("rank"))
    return drawn.unionByName(rows.where(~inside).select(*names, undrawn))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, **options) -> DataFrame:
    """The drawn rows of docs with all their columns. Rows that repeat id and text stay together."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    ranked = draw(importance_scores(docs, target, **options), percent, min_words)
    drawn = ranked.where("rank IS NOT NULL").select("doc_id", "first_lane", "second_lane").distinct()
    first, second = hash_lanes(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")))
    same = (first == drawn["first_lane"]) & (second == drawn["second_lane"])
    return docs.join(drawn, same & docs[f"`{id_col}`"].cast("bigint").eqNullSafe(drawn["doc_id"]), "left_semi")


def op12_query(docs: DataFrame, target: DataFrame) -> DataFrame:
    return draw(importance_scores(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = f"""
WITH {CRC_STEP},
words AS (
  SELECT 0 AS side, doc_id, unnest({WORDS_SQL}) AS w FROM documents
  UNION ALL SELECT 1, item_id, unnest({WORDS_SQL}) FROM benchmark
),
known AS (SELECT w, ({crc32_sql("w")} % {BUCKETS})::INT AS bucket FROM (SELECT DISTINCT w FROM words), crc_step),
counts AS (
  SELECT b.bucket, count(*) FILTER (side = 0)::DOUBLE AS s, count(*) FILTER (side = 1)::DOUBLE AS t
  FROM words JOIN known b USING (w) GROUP BY b.bucket
),
totals AS (SELECT sum(s) + {BUCKETS} AS s_all, sum(t) + {BUCKETS} AS t_all FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * s_all / ((s + 1) * t_all)))::BIGINT AS g FROM counts, totals),
weights AS (
  SELECT doc_id, count(*) AS n_features, sum(g)::BIGINT AS weight
  FROM words JOIN known USING (w) JOIN gain USING (bucket) WHERE side = 0 GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('{SALT}:' || d.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, r AS rank
FROM scored s LEFT JOIN ranked k ON s.doc_id = k.doc_id AND r <= floor(10 * n / 100)
"""
