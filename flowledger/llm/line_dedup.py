"""Line deduplication: repeated runs of lines from a suffix array built by prefix doubling.

All lines of all documents, in the order of their ids, form one sequence. Lines that occur once are set aside;
the others get ranks. In round k a suffix's first 2^k lines have a rank, equal for equal lines and in one
order for all suffixes; the rank of twice as many lines is the rank of the pair (rank here, rank 2^k lines
on). Suffixes of equal rank are an interval of the suffix array with a longest common prefix of at least
2^k lines. The rounds end when no two suffixes share a rank.

The stored ranks then give each suffix the length of its longest common prefix with an earlier one, from the
largest power of two down: suffixes with one common prefix are a node, those of a node that share the rank of the
2^k lines after it move on to a node that is 2^k lines longer, and the first of them stays behind in the node as
well, to be met by others in smaller steps. A node with one member left has nothing to compare; together nodes have
at most twice as many members as there are suffixes. Every member of a node but the first starts a copy as long as
the node; the longest at each place is the whole repeated run from there, and its lines are deleted if they have at
least min_words words together.

Only DataFrame operations run. Groups are pre-aggregated to their first member and count, ranks come from
a range sort of distinct pairs, and joins on ranks are between stored tables with one row per rank on the
right, so a line that a third of all documents share is split by Spark. The positions joined on are unique.

Null text stays null (no lines). Empty text is one line without words and stays. Rows with equal id and
text are one document and get one result each; rows with one id and different texts are ordered by a
hash of the text; null ids come first. A document of which all lines are copies gets an empty text. Other
columns stay as they are, except text; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, hash_lanes, release, stage

MIN_WORDS = 8


def _words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, " "), lambda w: w != ""))


def _sequence(docs: DataFrame) -> DataFrame:
    """Every line: g (place in the sequence), start (g of its document's first line), left (lines after it),
    two lanes that identify the line, words, and the document's key."""
    lines = F.transform(
        F.split("text", "\n"), lambda x: F.struct(F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"), _words(x).alias("w"))
    )
    keyed = docs.where("text IS NOT NULL").select("doc_id", "t1", "t2", lines.alias("lines"))
    order = ["doc_id", "t1", "t2"]
    # Equal documents stand side by side after the sort; the first of them counts.
    sorted_docs = keyed.dropDuplicates(order).repartitionByRange(*order).sortWithinPartitions(*order)
    each = sorted_docs.select(*order, F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
    placed = each.select(F.monotonically_increasing_id().alias("g"), *order, "pos", "n", "line.a", "line.b", "line.w")
    return placed.select("g", (F.col("g") - F.col("pos")).alias("start"), (F.col("n") - 1 - F.col("pos")).alias("left"), *order, "a", "b", "w")


def _ranked(groups: DataFrame, key: list[str]) -> DataFrame:
    """Groups (key, first) of two or more, numbered in the order of their keys."""
    ordered = groups.where("members > 1").select(*key, "first").repartitionByRange(*key).sortWithinPartitions(*key)
    return stage(ordered.withColumn("rank", F.monotonically_increasing_id()))


def _groups(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.min("g").alias("first"))


def _levels(sequence: DataFrame) -> list[DataFrame]:
    """(g, left, w, rank, first) of the windows of 1, 2, 4, ... lines that occur twice or more; w counts their words."""
    lines = _ranked(_groups(sequence, ["a", "b"]), ["a", "b"])
    level = stage(sequence.join(lines, ["a", "b"]).select("g", "left", F.col("w").cast("bigint").alias("w"), "rank", "first"))
    release(lines)
    levels, width = [], 1
    while not level.isEmpty():
        levels.append(level)
        then = level.select((F.col("g") - width).alias("g"), F.col("w").alias("w_then"), F.col("rank").alias("rank_then"))
        pairs = stage(
            level.where(F.col("left") >= 2 * width - 1)
            .join(then, "g")
            .select("g", "left", (F.col("w") + F.col("w_then")).alias("w"), F.col("rank").alias("rank_here"), "rank_then")
        )
        key = ["rank_here", "rank_then"]
        ranks = _ranked(_groups(pairs, key), key)
        level = stage(pairs.join(ranks, key).select("g", "left", "w", "rank", "first"))
        for old in (pairs, ranks):
            release(old)
        width *= 2
    release(level)
    return levels


def repeated_runs(sequence: DataFrame, min_words: int) -> DataFrame:
    """(g, reach): the longest run of lines at g that occurs earlier as well ends before reach and has enough words."""
    levels = _levels(sequence)
    # Members of nodes: the least member, which names a node together with its length, the place, lines after it, and
    # lines and words of the common prefix. Two nodes of one length with one least member would be the same suffixes.
    kind = "least bigint, g bigint, left bigint, length bigint, words bigint"
    nodes = sequence.sparkSession.createDataFrame([], kind)
    done = []
    for k in range(len(levels) - 1, -1, -1):
        width, level = 1 << k, levels[k]
        # Suffixes without common prefix so far: all windows of this level but those that follow a first one in a longer level.
        # The first of equal windows is first among the longer ones too, so the level above knows all that have moved on.
        roots = level.select(F.lit(-1).cast("bigint").alias("least"), "g", F.col("left").cast("bigint").alias("left"),
                             F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("words"), "w", "rank")
        if k + 1 < len(levels):
            roots = roots.join(levels[k + 1].where("g <> first").select("g"), "g", "left_anti")
        after = level.select("g", "w", "rank")
        below = nodes.select(*nodes.columns, F.when(F.col("left") >= F.col("length"), F.col("g") + F.col("length")).alias("at")).join(
            after.withColumnRenamed("g", "at"), "at", "left").drop("at")
        members = stage(below.unionByName(roots))
        key = ["least", "length", "rank"]
        # Stored, so that the join has plain exchanges on both sides and a hot rank is split.
        groups = members.where("rank IS NOT NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.min("g").alias("first"))
        groups = stage(groups.where("members > 1").drop("members"))
        # One row of each member for the longer node it moves to, one for the node it stays in.
        longer = F.struct(F.col("first").alias("least"), "g", "left",
                          (F.col("length") + width).alias("length"), (F.col("words") + F.col("w")).alias("words"))
        moves, stays = F.col("first").isNotNull(), F.expr("least >= 0 AND (first IS NULL OR g = first)")
        places = F.filter(F.array(F.when(moves, longer), F.when(stays, F.struct(*nodes.columns))), lambda x: x.isNotNull())
        both = members.join(groups, key, "left")
        nodes = both.select(F.explode(places).alias("m")).select("m.*")
        done += [members, groups]
    copies = nodes.where("g > least")
    found = copies.groupBy("g").agg(F.max(F.struct("length", "words")).alias("run"))
    runs = stage(found.where(F.col("run.words") >= min_words).select("g", (F.col("g") + F.col("run.length")).alias("reach")))
    for old in (*levels, *done):
        release(old)
    return runs


def remove_repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None,
) -> DataFrame:
    """docs with later copies of line runs deleted from the text; counts names two more columns for the
    number of lines before and of lines deleted."""
    text = F.col(f"`{text_col}`")
    t1, t2 = hash_lanes(text)
    key = F.struct(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), t1.alias("t1"), t2.alias("t2"))
    own, masked, gone_at = free_names(docs.columns, "key", "masked", "deleted")
    slim = docs.select(key.alias("k"), text.alias("text")).select("k.*", "text")
    sequence = stage(_sequence(slim))
    runs = repeated_runs(sequence, min_words)
    before = Window.partitionBy("start").orderBy("g")
    marked = sequence.join(runs, "g", "left").withColumn("deleted", F.coalesce(F.max("reach").over(before) > F.col("g"), F.lit(False)))
    masks = marked.groupBy("start").agg(
        F.first("doc_id").alias("doc_id"), F.first("t1").alias("t1"), F.first("t2").alias("t2"),
        F.array_sort(F.collect_list(F.struct("g", "deleted"))).alias("lines"),
    ).where(F.exists("lines", lambda x: x["deleted"])).select(
        F.struct("doc_id", "t1", "t2").alias(masked), F.transform("lines", lambda x: x["deleted"]).alias(gone_at)
    )
    masks = stage(masks)
    for old in (sequence, runs):
        release(old)
    joined = docs.withColumn(own, key).join(masks, F.col(own).eqNullSafe(F.col(masked)), "left")
    lines = F.split(text, "\n")
    kept = F.filter(F.zip_with(lines, F.col(gone_at), lambda x, gone: F.when(~gone, x)), lambda x: x.isNotNull())
    new_text = F.when(F.col(gone_at).isNull(), text).otherwise(F.array_join(kept, "\n"))
    more = []
    if counts:
        gone = F.size(F.filter(F.coalesce(gone_at, F.array().cast("array<boolean>")), lambda x: x))
        more = [F.when(text.isNull(), 0).otherwise(F.size(lines)).alias(counts[0]), gone.alias(counts[1])]
    columns = [new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, *more)


def op1_query(docs: DataFrame) -> DataFrame:
    found = remove_repeated_lines(docs.select("doc_id", "text"), counts=("n_lines", "n_removed"))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_removed").cast("bigint").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


# Pairs of equal lines, those on one diagonal of two documents without a gap as one run; doc_id is unique here.
ORACLE = f"""
WITH each AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) AS g, doc_id, line, len(list_filter(string_split(line, ' '), lambda x: x <> '')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents WHERE text IS NOT NULL)),
summed AS (SELECT *, sum(words) OVER (ORDER BY g) AS upto FROM each),
pairs AS (SELECT a.g, a.g - b.g AS back, a.doc_id, b.doc_id AS earlier FROM each a JOIN each b ON a.line = b.line AND b.g < a.g),
islands AS (SELECT *, g - row_number() OVER (PARTITION BY doc_id, earlier, back ORDER BY g) AS island FROM pairs),
ends AS (SELECT g, max(g) OVER (PARTITION BY doc_id, earlier, back, island) AS last FROM islands),
runs AS (SELECT g, max(last) AS last FROM ends GROUP BY g),
reaches AS (
  SELECT r.g, r.last FROM runs r JOIN summed f ON f.g = r.g JOIN summed t ON t.g = r.last WHERE t.upto - f.upto + f.words >= {MIN_WORDS}),
marked AS (
  SELECT e.doc_id, e.g, e.line, coalesce(max(r.last) OVER (PARTITION BY e.doc_id ORDER BY e.g) >= e.g, false) AS gone
  FROM each e LEFT JOIN reaches r ON r.g = e.g),
kept AS (
  SELECT doc_id, coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY g), '') AS t,
         count(*) FILTER (WHERE gone) AS n_removed, count(*) AS n_lines FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(t) AS text_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
