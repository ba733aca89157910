"""Byte-level BPE: encoding of whole texts to token ids and decoding back.

Words to be merged are found without a regular expression. Every code point is a letter, number, space,
white space or something else; each class is a transition function of a small automaton. Functions
compose associatively, so the state before each character comes from a scan over composed functions,
done by table look-ups on whole columns of characters at once. Slices between the starts are merged
once each and kept in a bounded cache. Byte offsets are kept beside the ids, so a range of tokens can
be decoded alone.

Null text is empty text: no ids. Repeated rows and null or repeated document ids are encoded one by
one. Other columns are ignored, whatever their names. Nothing is shuffled; a task holds a block of
about a million characters (or one document) at a time.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_text

BLOCK_CHARS = 1 << 20
CACHE_WORDS = 150_000
NONE = np.int32(2**31 - 1)

# Symbols: what a character is, with a look at the next ones where that decides.
LETTER, NUMBER, OTHER, WHITE, WHITE_LAST, SPACE_LAST, END, SHORT, LONG = range(9)
# States: what the previous character was.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AFTER_SPACE, ONE_LEFT, TWO_LEFT, TAKEN = range(9)

# Unicode White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# What may follow an apostrophe as a word of its own.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a word starts at this character."""
    if symbol == END:
        return START, True
    if state == TWO_LEFT and symbol == LETTER:
        return ONE_LEFT, False
    if state == ONE_LEFT and symbol == LETTER:
        return TAKEN, False
    if symbol in (SHORT, LONG):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol in (LETTER, NUMBER, OTHER):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[symbol]
        return run, state not in (run, AFTER_SPACE)
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if symbol == SPACE_LAST else IN_WHITE), True


@lru_cache(1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The symbols' functions by id (0 changes nothing), then tables with 4 bits for each argument:
    composition, action of a function on a state, and whether a word starts in a state at a symbol."""
    generators = [tuple(_step(q, s)[0] for q in range(9)) for s in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(9)), *generators]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[q] for q in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = list(known)
    assert len(functions) <= 16
    compose, action, starts = np.zeros((16, 16), np.uint8), np.zeros((16, 16), np.uint8), np.zeros((16, 16), bool)
    for i, f in enumerate(functions):
        action[i, :9] = f
        for j, g in enumerate(functions):
            compose[i, j] = known[tuple(g[q] for q in f)]
    starts[:9, :9] = [[_step(q, s)[1] for s in range(9)] for q in range(9)]
    return np.array([known[g] for g in generators], np.uint8), compose.ravel(), action.ravel(), starts.ravel()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point; one more entry stands for the end of a text."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)] + [END], np.uint8)
    table[WHITE_SPACE] = WHITE
    return table


def word_starts(codes: np.ndarray) -> np.ndarray:
    """True where a word starts; codes hold whole texts, each closed by 0x110000."""
    symbols = _classes()[codes]
    following = np.append(symbols[1:], END)
    last = (symbols == WHITE) & (following != WHITE) & (following != END)
    apostrophe = np.flatnonzero(codes == ord("'"))
    after = np.append(codes, [0x110000, 0x110000])
    one, two = after[apostrophe + 1], after[apostrophe + 2]
    symbols[last] = np.where(codes[last] == 0x20, SPACE_LAST, WHITE_LAST)
    symbols[apostrophe[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
    for a, b in LONG_ENDINGS:
        symbols[apostrophe[(one == ord(a)) & (two == ord(b))]] = LONG

    generators, compose, action, starts = _automaton()
    n = len(symbols)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    functions = np.zeros(rows * width, np.uint8)
    functions[:n] = generators[symbols]
    functions = np.ascontiguousarray(functions.reshape(rows, width).T)
    before = np.empty_like(functions)
    so_far = np.zeros(rows, np.uint8)
    for j in range(width):
        before[j] = so_far
        so_far = compose[(so_far << 4) | functions[j]]
    entry, state = np.empty(rows, np.uint8), START
    for r, f in enumerate(so_far.tolist()):
        entry[r] = state
        state = int(action[f << 4 | state])
    states = action[(before << 4) | entry].T.ravel()[:n]
    return starts[(states << 4) | symbols]


class ByteBpe:
    """Ranks of a tiktoken file, with a cache of merged words."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.lengths = np.zeros(max(self.tokens) + 1, np.int64)
        self.lengths[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def single(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending pairs of ranks (one long each) that join to a token, and that token's rank."""
        keys, ranks = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(rank)
        keys, ranks = np.array(keys, np.int64), np.array(ranks, np.int32)
        order = np.argsort(keys)
        return keys[order], ranks[order]

    @cached_property
    def first_pairs(self) -> np.ndarray:
        return self._rank(self.single[:, None], self.single[None, :])

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that a and b make together, NONE if none."""
        keys = (a.astype(np.int64) << 32) | b
        known, ranks = self.pairs
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, ranks[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids (int32 bytes) of many words at once: every word takes its next merge in the same step."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.ranks:
                out[i] = self.ranks[w].to_bytes(4, "little")
            elif len(w) > 64:
                out[i] = np.array(self.merge(w), np.int32).tobytes()
            else:
                by_width.setdefault(-(-len(w) // 8) * 8, []).append(i)
        for width, members in by_width.items():
            raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in members), np.uint8).reshape(-1, width)
            sizes = np.array([len(words[i]) for i in members])
            columns = np.arange(width)
            ids = self.single[raw]
            ranks = self.first_pairs[raw[:, :-1], raw[:, 1:]]
            ranks = np.where(columns[1:] < sizes[:, None], ranks, NONE)
            ranks = np.concatenate([ranks, np.full((len(raw), 1), NONE, np.int32)], axis=1)
            rows = np.arange(len(raw))
            while len(rows):
                at = ranks[rows].argmin(axis=1)
                best = ranks[rows, at]
                rows, at, best = rows[best < NONE], at[best < NONE], best[best < NONE]
                if not len(rows):
                    break
                take = np.minimum(columns + (columns > at[:, None]), width - 1)
                ids[rows] = np.take_along_axis(ids[rows], take, 1)
                ranks[rows] = np.take_along_axis(ranks[rows], take, 1)
                ids[rows, at] = best
                sizes[rows] -= 1
                ranks[rows, width - 1] = NONE
                left = np.flatnonzero(at > 0)
                ranks[rows[left], at[left] - 1] = self._rank(ids[rows[left], at[left] - 1], best[left])
                more = at + 1 < sizes[rows]
                right = np.flatnonzero(more)
                ranks[rows[right], at[right]] = self._rank(best[right], ids[rows[right], at[right] + 1])
                ranks[rows[~more], at[~more]] = NONE
            for row, size, i in zip(ids, sizes.tolist(), members):
                out[i] = row[:size].tobytes()
        return out

    def merge(self, word: bytes) -> list[int]:
        """The lowest-ranked neighbouring pair is joined first, the leftmost of equals."""
        if word in self.ranks:
            return [self.ranks[word]]
        if len(word) > 256:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks, far = self.ranks, len(self.ranks) + 1
        pairs = [ranks.get(a + b, far) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < far:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], far)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], far)
        return [ranks[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same by a heap over linked parts, so a very long word takes n log n steps."""
        import heapq

        n, ranks = len(word), self.ranks
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n + [False]
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i], right[i] = False, stop, right[j]
            if right[i] < n:
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and (b := right[a]) < n and (r := ranks.get(word[a : end[b]])) is not None:
                    heapq.heappush(heap, (r, a, end[b]))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = right[i]
        return out

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; texts together should be about BLOCK_CHARS long."""
        raw = "".join(texts).encode("utf-32-le", "surrogatepass")
        codes, ends, at = np.frombuffer(raw, np.uint32), [], 0
        for t in texts:
            ends.append(at := at + len(t))
        codes = np.insert(codes, ends, 0x110000)
        begin = np.flatnonzero(word_starts(codes))
        stops = np.array(ends) + np.arange(len(ends))
        cut = np.searchsorted(begin, stops)
        found, missing, first, offset = [], {}, 0, 0
        for text, to, stop in zip(texts, cut.tolist(), stops.tolist()):
            places = (begin[first : to + 1] - offset).tolist()
            words = [text[a:b] for a, b in zip(places, places[1:])]
            ids = list(map(self.cache.get, words))
            if None in ids:
                missing.update((w, None) for w, known in zip(words, ids) if known is None)
                found.append((words, ids))
            else:
                found.append((None, ids))
            first, offset = to + 1, stop + 1
        # Words not met since the cache last filled up are forgotten.
        new = [w for w in missing if w not in self.older]
        merged = dict(zip(new, self.merge_many([w.encode("utf-8", "replace") for w in new])))
        missing = {w: merged[w] if w in merged else self.older[w] for w in missing}
        if len(self.cache) + len(missing) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        self.cache.update((w, ids) for w, ids in missing.items() if len(w) <= 64)
        return [
            np.frombuffer(b"".join(ids if words is None else [i or missing[w] for w, i in zip(words, ids)]), np.int32)
            for words, ids in found
        ]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token begins."""
        sizes = self.lengths[ids]
        return np.cumsum(sizes) - sizes

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens in a row, and where each begins."""
        parts = [self.tokens.get(i, b"") for i in range(len(self.lengths))]
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(self.lengths) - self.lengths

    def decode_many(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of token lists in a row, and where each list's bytes end; ends: where each list of ids ends."""
        spelled, begin = self.spelled
        sizes = self.lengths[ids]
        stops = np.cumsum(sizes)
        places = np.repeat(begin[ids] - (stops - sizes), sizes)
        places += np.arange(len(places))
        return spelled[places], np.append(0, stops)[ends]

    def decode(self, ids) -> bytes:
        return self.decode_many(np.asarray(ids, np.int64), np.array([len(ids)]))[0].tobytes()


@lru_cache(2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def bpe_encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, offsets array<int> (bytes) for every row; ranks_path is the same on all machines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(ranks_path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in blocks(texts):
                ids = bpe.encode_texts(texts[a:b])
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = np.concatenate(ids)
                starts = np.concatenate([bpe.offsets(x) for x in ids]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(starts, pa.int32())),
                ], ["doc_id", "ids", "offsets"])

    return plain_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>, offsets array<int>")


def bpe_decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded` (binary) to rows with doc_id and ids; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(1)
                ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
                text, stops = bpe.decode_many(ids.flatten().to_numpy(), ends)
                offsets = pa.py_buffer(np.append(0, stops).astype(np.int32))
                decoded = pa.Array.from_buffers(pa.binary(), len(ids), [None, offsets, pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([part.column(0), ids, decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def op2_query(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Digests of ids and of the decoded bytes per document."""
    decoded = bpe_decode(bpe_encode(docs, ranks_path), ranks_path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
