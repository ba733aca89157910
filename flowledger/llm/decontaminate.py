"""Benchmark decontamination: a generalised suffix automaton of test items reads every text as a stream.

Items and texts are sequences of words, A-Z lower-cased. After each word of a text the automaton's state and
size are the longest run of words ending here that stands in some item. From a size of `window` words on, the
last `window` words are a window of an item: they are hit, and the state's ancestor for that length names the
items that have it. An item of fewer words is one window; its last state, found on the way up the suffix
links, names it. Only stretches whose neighbouring words also are neighbours in some item enter the automaton;
shorter matches than the shortest window cannot be hits and are not reported.

Items are cut into pieces that overlap by a window less one word, so no window is lost, and the pieces are
dealt into blocks of about BLOCK_WORDS words by their hash. One block at a time goes through the driver and to
the tasks, and each block reads all documents; several blocks' spans are merged per document.

Null or wordless texts have no words and no hits; null or wordless items have no windows. Items that share an
id are one item; words of an item without id are hit, but it is not listed. Repeated documents and null
doc_ids are read one by one. Texts are read whole, in slices. Extra columns are not read by scan_items and
are returned as they are by decontaminate. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_lanes, plain_text, stage
from .sqlparts import WORDS_SQL
from .words import WORD_BYTES, word_slices

WINDOW = 10
PIECE_WORDS, BLOCK_WORDS = 4096, 1 << 17
READ_WORDS = 1 << 18
# Odd constant that spreads pairs of word numbers over the table of known pairs.
_PAIRS = 0x9E3779B1


class ItemAutomaton:
    """Suffix automaton of (item, words) pieces; items are listed by their window states."""

    def __init__(self, pieces: tuple[tuple[str | None, tuple[bytes, ...]], ...], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set[str | None]] = {}
        texts = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in pieces if words]
        whole: dict[int, int] = {}
        for item, ids in texts:
            last = 0
            for w in ids:
                last = self._extend(last, w)
            if len(ids) < window:
                whole[last] = len(ids)
                self.items.setdefault(last, set()).add(item)
        self._places(whole)
        for item, ids in texts:
            state = 0
            for size, w in enumerate(ids, 1):
                state = self.next[state][w]
                if size >= window:
                    self.items.setdefault(self.at_window[state], set()).add(item)
        self.shortest = min((min(len(ids), window) for _, ids in texts), default=window)
        pairs = np.array([p for _, ids in texts for p in zip(ids, ids[1:])], np.int64).reshape(-1, 2)
        self.mask = (1 << max(10, int(16 * len(pairs)).bit_length())) - 1
        self.pairs = np.zeros(self.mask + 1, bool)
        self.pairs[self._pair(pairs[:, 0], pairs[:, 1])] = True

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * _PAIRS + b) >> 7 & self.mask

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _branch(self, p: int, w: int) -> int:
        """The state of p's longest string followed by w, where p already has a step for w."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._branch(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._branch(p, w)
        return new

    def _places(self, whole: dict[int, int]) -> None:
        """Per state: its suffix state of window length (or -1), and whole short items that are its suffixes."""
        self.at_window = [-1] * len(self.link)
        self.shorts: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= self.window:
                self.at_window[s] = s if self.length[up] < self.window else self.at_window[up]
            self.shorts[s] = (*self.shorts[up], (whole[s], s)) if s in whole else self.shorts[up]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.get, words, repeat(-1)), np.int32, len(words))

    def stretches(self, ids: np.ndarray) -> tuple[list[int], list[int]]:
        """Begins and ends of the stretches of ids that may hold a window; unknown words are -1."""
        if not len(ids) or not self.words:
            return [], []
        known = ids >= 0
        if self.shortest > 1:
            known = known[1:] & known[:-1] & self.pairs[self._pair(ids[:-1], ids[1:])]
        change = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        begins, ends = change[::2], change[1::2]
        long = ends - begins >= max(1, self.shortest - 1)
        return begins[long].tolist(), (ends[long] + (self.shortest > 1)).tolist()

    def read(self, ids: list[int], at: int) -> tuple[list[tuple[int, int]], set[str | None], int]:
        """Hit (first, last) words of a stretch that begins at word `at`, items, longest matching length."""
        state = size = longest = 0
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for i, w in enumerate(ids, at):
            to = self.next[state].get(w)
            if to is None:
                while state and to is None:
                    state = self.link[state]
                    to = self.next[state].get(w)
                size = self.length[state]
            state, size = (to, size + 1) if to is not None else (0, 0)
            hit = 0
            if size >= self.window:
                hit = self.window
                found.add(self.at_window[state])
            for n, s in self.shorts[state]:
                if size >= n:
                    hit = max(hit, n)
                    found.add(s)
            if hit:
                longest = max(longest, size)
                first = i + 1 - hit
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append((first, i))
        return spans, set().union(*map(self.items.__getitem__, found)), longest


@lru_cache(2)
def _automaton(pieces: tuple[tuple[str | None, tuple[bytes, ...]], ...], window: int) -> ItemAutomaton:
    return ItemAutomaton(pieces, window)


def item_pieces(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (id as text), words (joined by spaces), n: pieces of items that overlap by window - 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str | None, bytes, int]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, cut = [], False
                for part in word_slices(text):
                    words += part
                    while len(words) > PIECE_WORDS + window:
                        out.append((item, b" ".join(words[:PIECE_WORDS]), PIECE_WORDS))
                        words, cut = words[PIECE_WORDS - window + 1 :], True
                # The overlap alone has no window of its own.
                if words and not (cut and len(words) < window):
                    out.append((item, b" ".join(words), len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary()),
                 pa.array([o[2] for o in out], pa.int64())],
                ["item", "words", "n"],
            )

    plain = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return plain.mapInArrow(run, "item string, words binary, n bigint").distinct()


SPANS = "doc_id bigint, first_lane bigint, second_lane bigint, n_words bigint, longest bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"
_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _rows(keys: list[pa.Array], n_words: list, longest: list, spans: list, items: list) -> pa.RecordBatch:
    spans = [[{"first": a, "last": b} for a, b in s] for s in spans]
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array(n_words, pa.int64()), pa.array(longest, pa.int64()), pa.array(spans, _SPAN),
         pa.array([sorted(i - {None}) for i in items], pa.list_(pa.string()))],
        [c.split()[0] for c in SPANS.split(", ")],
    )


def _read_block(docs: DataFrame, pieces: tuple, window: int) -> DataFrame:
    """SPANS of every row of docs (doc_id, lanes, text) against one block of pieces."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _automaton(*shared.value)
        gap = np.full(1, -1, np.int32)
        for batch in batches:
            n = batch.num_rows
            counts, longest, spans, items = [0] * n, [0] * n, [[] for _ in range(n)], [set() for _ in range(n)]
            held, owners, starts, size = [], [], [], 0

            def flush() -> None:
                ids = np.concatenate([*held, gap])
                begins, ends = found.stretches(ids)
                for begin, end, where in zip(begins, ends, np.searchsorted(starts, begins, side="right") - 1):
                    row = owners[where]
                    hit, these, most = found.read(ids[begin:end].tolist(), begin - starts[where])
                    spans[row] += hit
                    items[row] |= these
                    longest[row] = max(longest[row], most)

            for row in range(n):
                # Word numbers take 4 bytes; a text is read as one stream whatever its length.
                owners.append(row)
                starts.append(size)
                for part in word_slices(batch.column(3)[row].as_py()):
                    held.append(found.numbers(part))
                    counts[row] += len(part)
                held.append(gap)
                size += counts[row] + 1
                if size >= READ_WORDS or row == n - 1:
                    flush()
                    held, owners, starts, size = [], [], [], 0
            yield _rows([batch.column(i) for i in range(3)], counts, longest, spans, items)

    return docs.mapInArrow(run, SPANS)


def _merged(parts: DataFrame) -> DataFrame:
    """SPANS of documents from the lists of their spans and items in all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for lists in batch.column(5).to_pylist():
                joined: list[tuple[int, int]] = []
                for a, b in sorted((s["first"], s["last"]) for spans_of_block in lists for s in spans_of_block):
                    if joined and a <= joined[-1][1] + 1:
                        joined[-1] = joined[-1][0], max(b, joined[-1][1])
                    else:
                        joined.append((a, b))
                spans.append(joined)
            items = [{i for items_of_block in lists for i in items_of_block} for lists in batch.column(6).to_pylist()]
            yield _rows([batch.column(i) for i in range(3)], batch.column(3).to_pylist(), batch.column(4).to_pylist(), spans, items)

    return parts.mapInArrow(run, SPANS)


def scan_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, **columns: str) -> DataFrame:
    """One row per row of docs, see SPANS: words hit by windows of items as spans of word numbers from 0."""
    if window < 1:
        raise ValueError("a window has at least one word")
    texts = plain_text(docs, **columns)
    texts = texts.select("doc_id", *(h.alias(n) for h, n in zip(hash_lanes(F.col("text")), ("first_lane", "second_lane"))), "text")
    pieces = stage(item_pieces(items, window))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        # About block_words words, whatever the number of items.
        rows = dealt.where(F.col("block") == b).select("item", "words").collect()
        block = tuple(sorted(((r.item, tuple(bytes(r.words).split())) for r in rows), key=lambda p: (p[1], p[0] or "")))
        read = _read_block(texts, block, window)
        if blocks == 1:
            return read
        # Rows that repeat id and text have the same spans; they are counted and stored once.
        key = ["doc_id", "first_lane", "second_lane"]
        rest = [c.split()[0] for c in SPANS.split(", ")][3:]
        once = stage(read.groupBy(*key).agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in rest)))
        found = once if found is None else found.union(once)
    merged = found.groupBy(*key).agg(
        F.first("copies").alias("copies"), F.first("n_words").alias("n_words"), F.max("longest").alias("longest"),
        F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"),
    )
    spread = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")
    return _merged(spread)


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "replace")
    letters = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    begins = np.flatnonzero(letters & np.append(True, ~letters[:-1]))
    ends = np.flatnonzero(letters & np.append(~letters[1:], True)) + 1
    kept, at = [], 0
    for s in spans:
        kept.append(raw[at : begins[s["first"]]])
        at = ends[s["last"]]
    return b"".join([*kept, raw[at:]]).decode("utf-8")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: float = 0.5, **columns: str) -> DataFrame:
    """docs without benchmark text: hit spans are cut out of the text; rows with more than `most` of their words hit go.

    All columns are returned; only the text column of rows with hits changes.
    """
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    scanned = scan_items(docs, items, window, **columns).where("size(spans) > 0")
    hits = stage(scanned.select("doc_id", "first_lane", "second_lane", "n_words", "spans").distinct())
    names = ["__" + n for n in ("id", "first", "second")]
    while any(n in docs.columns for n in names):
        names = ["_" + n for n in names]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keys = dict(zip(names, (F.col(f"`{id_col}`").cast("bigint"), *hash_lanes(text))))
    left = docs.withColumns(keys)
    same = [left[n].eqNullSafe(hits[c]) for n, c in zip(names, ("doc_id", "first_lane", "second_lane"))]
    joined = left.join(hits, same[1] & same[2] & same[0], "left")
    covered = F.aggregate(hits["spans"], F.lit(0).cast("bigint"), lambda s, x: s + x["last"] - x["first"] + 1)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, s) for t, s in zip(texts, spans)], dtype=object)

    changed = F.when(hits["spans"].isNull(), left[f"`{text_col}`"]).otherwise(cut(F.when(hits["spans"].isNotNull(), text), hits["spans"]))
    keep = hits["spans"].isNull() | (covered <= hits["n_words"] * F.lit(most))
    return joined.where(keep).select(*(changed.alias(c) if c == text_col else left[f"`{c}`"] for c in docs.columns))


def op11_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = scan_items(docs, items)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["last"] - x["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE = f"""
WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), {WINDOW}) AS k, array_to_string(w[p : p + least(len(w), {WINDOW}) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS p FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (
  SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS run
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM docs, sizes WHERE len(w) >= k)
),
hits AS (SELECT doc_id, p, r.k, item_id FROM runs r JOIN windows USING (run)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(len(f.ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(f.ids, ','), '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""
