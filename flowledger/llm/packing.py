"""Packing of documents into sequences of at most `window` tokens, in order, by dynamic programming.

The token stream of a block of documents is cut at document ends, sentence ends, or, where neither comes
for STRIDE tokens, in between. The cut plan minimises padding to the window plus a truncation penalty per
cut (none at a document end, more inside a sentence). Padding is linear in the length, so the best
previous cut is the minimum of cost + position over a sliding window: a monotone queue gives it in
constant time, and a block takes time in proportion to its cuts.

Documents keep the order of the stored rows; nothing is shuffled. A task packs blocks of about
BLOCK_TOKENS tokens one after the other (only the last sequence of a block can be short for lack of
documents) and numbers its sequences from partition * 2**40, so ids are the same when a task is repeated.

Null text is empty text: its document is the closing id alone. Repeated rows and null ids are packed one
by one; other columns are not read; an empty table gives no pieces. Any length of text is cut over as
many sequences as it needs.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import plain_text

WINDOW, CLOSING = 4096, 2
STRIDE, SENTENCE, INSIDE = 128, 4.0, 48.0
BLOCK_TOKENS = 1 << 20
CACHE_WORDS = 600_000

# Control characters that Python splits at, though the vocabulary's pattern takes them as words.
_ENDINGS = ".,;:!?*#%&$|"
_SEPARATORS = re.compile("[\x1c-\x1f]")


class WordTokenizer:
    """Ids of a vocabulary that drops white space: each stretch between white space is tokenized once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        # Byte-level names: printable bytes are their own character, the rest are numbered from 256.
        named = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in named]
        self.byte_names = {b: b for b in named} | {b: 256 + i for i, b in enumerate(rest)}
        words = self.tokenizer.get_vocab()
        self.ends_sentence = np.zeros(max(words.values()) + 1, bool)
        self.ends_sentence[[i for w, i in words.items() if w.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True

    def _fresh(self, words: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return {w: array("I", e.ids).tobytes() for w, e in zip(words, found)}

    def _letters(self, word: str) -> bytes:
        """Ids of lower-case letters, past the normalisation and splitting that leave them as they are."""
        named = word.encode().decode("latin-1").translate(self.byte_names)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(named)]).tobytes()

    def _ids(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words. Letters and the punctuation after them are words of their own and case does
        not count, so most new words are known letters in another case or with another ending."""
        fresh, whole = {}, []
        for w in words:
            head = w.rstrip(_ENDINGS)
            if not (head.isalpha() and max(head) < "\u0100"):
                whole.append(w)
                continue
            head, tail = head.lower(), w[len(head) :]
            ids = self.heads.get(head)
            if ids is None:
                ids = self.heads[head] = self._letters(head)
            if tail and tail not in self.cache:
                self.cache.update(self._fresh([tail]))
            fresh[w] = ids + self.cache[tail] if tail else ids
        fresh.update(self._fresh(whole))
        for cache in (self.cache, self.heads):
            if len(cache) + len(fresh) > CACHE_WORDS:
                cache.clear()
        self.cache.update((w, ids) for w, ids in fresh.items() if len(w) <= 64)
        return fresh

    def encode(self, texts: list[str]) -> list[tuple[bytes, np.ndarray]]:
        """For each text its ids (uint32 bytes) and the positions after a sentence's end."""
        found, missing = [], {}
        for text in texts:
            if _SEPARATORS.search(text):
                found.append((None, [self._fresh([text])[text]]))
                continue
            words = text.split()
            parts = list(map(self.cache.get, words))
            if None in parts:
                missing.update((w, None) for w, p in zip(words, parts) if p is None)
                found.append((words, parts))
            else:
                found.append((None, parts))
        missing = self._ids(list(missing))
        out = []
        for words, parts in found:
            raw = b"".join(parts if words is None else [missing[w] if p is None else p for w, p in zip(words, parts)])
            out.append((raw, np.flatnonzero(self.ends_sentence[np.frombuffer(raw, np.uint32)]) + 1))
        return out


@lru_cache(2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_places(lengths: np.ndarray, sentences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending positions where a sequence may end, from 0, and the penalty of each.

    lengths: tokens of each document; sentences: positions inside each document after a sentence.
    """
    ends = np.concatenate([[0], np.cumsum(lengths)])
    inside = [s[(s > 0) & (s < n)] + at for s, n, at in zip(sentences, lengths, ends)]
    places = np.unique(np.concatenate([ends, *inside]).astype(np.int64))
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > STRIDE)
    extra = [np.arange(places[i] + STRIDE, places[i + 1], STRIDE) for i in wide]
    hard = np.concatenate([*extra, np.zeros(0, np.int64)])
    at = np.concatenate([places, hard])
    penalty = np.concatenate([np.where(np.isin(places, ends), 0.0, SENTENCE), np.full(len(hard), INSIDE)])
    order = np.argsort(at, kind="stable")
    return at[order], penalty[order]


def best_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions of the cheapest cuts, the last place included: padding of every piece plus penalties."""
    at, cost_of = places.tolist(), penalty.tolist()
    cost, back = [0.0] * len(at), [0] * len(at)
    queue: deque[tuple[float, int]] = deque()
    for j in range(1, len(at)):
        here, i = at[j], j - 1
        value = cost[i] + at[i]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
        while here - at[queue[0][1]] > window:
            queue.popleft()
        value, i = queue[0]
        cost[j], back[j] = value + window - here + cost_of[j], i
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def pieces(lengths: np.ndarray, cuts: list[int]) -> tuple[np.ndarray, ...]:
    """(document, start in it, length, sequence, offset there) of every piece, in order."""
    ends = np.cumsum(lengths)
    stops = np.unique(np.concatenate([ends, cuts]).astype(np.int64))
    starts = np.concatenate([[0], stops[:-1]])
    document = np.searchsorted(ends, starts, side="right")
    sequence = np.searchsorted(cuts, starts, side="right")
    begin = np.concatenate([[0], np.array(cuts, np.int64)])[sequence]
    return document, starts - (ends - lengths)[document], stops - starts, sequence, starts - begin


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, sequence_tokens bigint"
)


def _pack(doc_ids: list, ids: list[bytes], sentences: list[np.ndarray], first_sequence: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(i) >> 2 for i in ids], np.int64)
    cuts = best_cuts(*cut_places(lengths, sentences))
    document, start, length, sequence, offset = pieces(lengths, cuts)
    checks = [
        zlib.crc32(memoryview(ids[d])[s * 4 : (s + n) * 4])
        for d, s, n in zip(document.tolist(), start.tolist(), length.tolist())
    ]
    sizes = np.diff(np.concatenate([[0], cuts]))
    columns = [
        pa.array([doc_ids[d] for d in document.tolist()], pa.int64()), pa.array(start), pa.array(length),
        pa.array(checks, pa.int64()), pa.array(lengths[document]), pa.array(first_sequence + sequence), pa.array(offset),
        pa.array(sizes[sequence]),
    ]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names), len(cuts)


def pack_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep_words: bool = True
) -> DataFrame:
    """One row per piece of a document, see SCHEMA.

    Workers keep the words they know for later tasks; with keep_words=False each task forgets them at its end
    and leaves the memory to other steps. The result is the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, closing = tokenizer(vocabulary), CLOSING.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        doc_ids, ids, sentences, size = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, (found, ends) in zip(part.column(0).to_pylist(), tok.encode(part.column(1).to_pylist())):
                    doc_ids.append(doc_id)
                    ids.append(found + closing)
                    sentences.append(ends)
                    size += len(ids[-1]) >> 2
                    if size >= BLOCK_TOKENS:
                        out, n = _pack(doc_ids, ids, sentences, sequence)
                        yield out
                        sequence += n
                        doc_ids, ids, sentences, size = [], [], [], 0
        if ids:
            yield _pack(doc_ids, ids, sentences, sequence)[0]
        if not keep_words:
            tok.cache.clear()
            tok.heads.clear()

    return plain_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op8_query(docs: DataFrame, vocabulary: str) -> DataFrame:
    return pack_documents(docs, vocabulary)
