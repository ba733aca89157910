"""Training corpus from `documents`: quality filter, line dedup, near-duplicate removal, packing.

Every stage takes all that the one before kept; all but the last return the columns of documents.

- quality: documents that the classifier scores below 0.7 go. It learns from `labels` of the input.
- line_dedup: later copies of repeated line runs are cut out; a document of which nothing is left goes;
  n_chars follows the text.
- near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8) the smallest id stays.
  Rows that repeat id and text count once. Rows without an id stay.
- packing: what is left is cut into sequences of at most 4096 tokens.

Null and empty texts are scored like texts without words, have nothing to cut and are near no other text; packed,
they are their end token. Very long texts are handled whole in every stage. Between near duplicates the smallest
id decides, so there are no ties. An empty table gives an empty one, and columns of any further name go along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowledger.llm import line_dedup, minhash, packing, quality
from flowledger.llm.common import free_names, hash_lanes, read_table, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lines, removed = free_names(docs.columns, "lines", "removed")
    cut = line_dedup.remove_repeated_lines(docs, counts=(lines, removed)).where((F.col(removed) == 0) | (F.col("text") != ""))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col(removed) > 0, length).otherwise(F.col("n_chars"))).drop(lines, removed)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = minhash.near_duplicates(docs, size=5, percent=80).where("NOT kept").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    lanes = free_names(docs.columns, "first", "second")
    keyed = left.withColumns(dict(zip(lanes, hash_lanes(F.col("text")))))
    return keyed.dropDuplicates(["doc_id", *lanes]).drop(*lanes)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_words=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

# The classifier is learned and the tokenizer is a library, so no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
