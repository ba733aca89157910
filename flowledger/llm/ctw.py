"""Scores of texts by context-tree weighting over bytes.

Bytes (A-Z lower-cased) are coded as eight binary decisions, each in a context of the previous 0 to `depth`
bytes. Every context keeps counts of zeros and ones with a Krichevsky-Trofimov estimate; context-tree
weighting mixes a node's own estimate with its children's, from the deepest contexts up, so depths are weighted
by how well they coded the training bytes. Scoring mixes the estimates along a byte's path with the weights
that training left.

Counts come from all training texts. Texts are dealt to blocks of about BLOCK_BYTES by a hash of id and text;
a block counts its distinct words and byte strings first and asks for those only. Words are dealt by a hash, byte
strings by their nearest CUT context bytes, to as many parts as there are blocks, with one packed row per block and
part. A part holds whole subtrees below depth CUT and works them out in arrays. The levels above are
grouped tables; the two top levels have at most 255 and 65,280 rows and are broadcast, the next is joined by key.
Answers meet their block again in a co-group, so no task holds more than a block or a part and its strings.

Null text is empty text: one token (the end), score 0 and no bits per byte. A null id counts as the empty
string for the split. Repeated rows are trained on and scored one by one. Without training texts every word
is unknown and every estimate one half. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, plain_text, release, shuffles_dropped, stage, words_of

DEPTH, CUT = 6, 3
BLOCK_BYTES, LEAST_BLOCKS, PART = 16 << 20, 12, 1 << 21


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def byte_strings(texts: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of every byte with its context (previous bytes, zeros before the text), and where each text's end."""
    width = 4 if depth < 4 else 8
    raw = [t.encode("utf-8", "replace").translate(LOWER) for t in texts]
    joined = bytes(width - 1).join([b"", *raw])
    sizes = np.array([len(r) for r in raw], np.int64)
    n = len(joined) - width + 1
    if n <= 0:
        return np.zeros(0, f"u{width}"), np.cumsum(sizes)
    # Overlapping big-endian numbers: the byte itself is lowest, the oldest of its context highest.
    codes = np.ndarray(n, f">u{width}", joined, strides=(1,)).astype(f"u{width}")
    if depth + 1 < width:
        codes &= (1 << 8 * (depth + 1)) - 1
    own = np.ones(n + width, bool)
    ends = np.cumsum(sizes + width - 1) - (width - 1)
    own[(ends[:, None] + np.arange(width - 1)).ravel()] = False
    return codes[own[:n]], np.cumsum(sizes)


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def _runs(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and how often each occurs (or the sums of its counts)."""
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    first = np.append(0, np.flatnonzero(codes[1:] != codes[:-1]) + 1)
    return codes[first], np.diff(np.append(first, len(codes))) if counts is None else np.add.reduceat(counts, first)


def _distinct(texts: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    found = [_runs(byte_strings(part, depth)[0]) for part in _parts(texts)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, counts = _runs(*(np.concatenate(x) for x in zip(*found)))
    return codes.astype(np.int64), counts


def _part_of(codes: np.ndarray, cut: int, parts: int) -> np.ndarray:
    near = (codes.astype(np.uint64) >> np.uint64(8)) & np.uint64((1 << 8 * cut) - 1)
    return ((near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def _dealt(codes: np.ndarray, cut: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ascending codes by part, the parts that occur, and where each begins (and the last ends)."""
    part = _part_of(codes, cut, parts)
    order = np.argsort(part, kind="stable")
    numbers, first = np.unique(part[order], return_index=True)
    return order, numbers, np.append(first, len(codes))


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte values, compressed plane by plane."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _words_by_part(words: Iterator[bytes], parts: int) -> dict[int, list[bytes]]:
    dealt = {}
    for w in sorted(words):
        dealt.setdefault(zlib.crc32(w) % parts, []).append(w)
    return dealt


def _pack_words(words: list[bytes]) -> bytes:
    joined = b" ".join(words)
    return len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)


def _unpack_words(packed: bytes) -> list[bytes]:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True).split(b" ")


ASKED = "block int, part int, n bigint, words binary, codes binary, counts binary"


def _asked(depth: int, cut: int, parts: int):
    """Distinct words and byte strings of a block with their counts in its training texts."""

    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        texts = {h: block.filter(pc.equal(block.column("held"), h)).column("text").to_pylist() for h in (True, False)}
        words = Counter()
        for t in texts[False]:
            words.update(words_of(t))
        for t in texts[True]:
            words.update({w: 0 for w in words_of(t) if w not in words})
        codes, counts = _distinct(texts[False], depth)
        unseen = np.setdiff1d(_distinct(texts[True], depth)[0], codes)
        codes, counts = _runs(np.append(codes, unseen), np.append(counts, np.zeros(len(unseen), np.int64)))
        order, numbers, ends = _dealt(codes, cut, parts)
        codes, counts = codes[order], counts[order]
        spans = list(zip(ends[:-1], ends[1:]))
        dealt = _words_by_part(words, parts)
        n_words, n_parts = len(dealt), len(numbers)
        return pa.table({
            "block": pa.array(np.full(n_words + n_parts, number, np.int32)),
            "part": pa.array([*dealt, *numbers.tolist()], pa.int32()),
            "n": pa.array([*map(len, dealt.values()), *np.diff(ends).tolist()], pa.int64()),
            "words": pa.array([*map(_pack_words, dealt.values())] + [None] * n_parts, pa.binary()),
            "codes": pa.array([None] * n_words + [_pack(np.diff(codes[i:j], prepend=0)) for i, j in spans], pa.binary()),
            "counts": pa.array([_pack(np.array([words[w] for w in ws], np.int64)) for ws in dealt.values()]
                               + [_pack(counts[i:j]) for i, j in spans], pa.binary()),
        })

    return run


COUNTED = "block int, part int, counts binary, total bigint, distinct bigint"


def _counted(rows: pa.Table) -> pa.Table:
    """For every row of a part of the words their counts in all blocks, and the part's sums."""
    asked = [_unpack_words(w) for w in rows.column("words").to_pylist()]
    counts = {}
    for words, packed in zip(asked, rows.column("counts").to_pylist()):
        for w, n in zip(words, _unpack(packed, len(words), np.int64).tolist()):
            counts[w] = counts.get(w, 0) + n
    packed = [_pack(np.array([counts[w] for w in words], np.int64)) for words in asked]
    total, distinct = (np.full(len(asked), x) for x in (sum(counts.values()), sum(n > 0 for n in counts.values())))
    return pa.table([rows.column("block"), rows.column("part"), pa.array(packed, pa.binary()), total, distinct],
                    ["block", "part", "counts", "total", "distinct"])


def _merged(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Codes of each row, and all distinct codes with the sums of their counts."""
    sizes = rows.column("n").to_pylist()
    codes = [np.cumsum(_unpack(c, n, np.int64)) for c, n in zip(rows.column("codes").to_pylist(), sizes)]
    counts = [_unpack(c, n, np.int64) for c, n in zip(rows.column("counts").to_pylist(), sizes)]
    return codes, *_runs(np.concatenate(codes), np.concatenate(counts))


def _log_gammas(x: np.ndarray) -> np.ndarray:
    """As log_gamma, of an array."""
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def _subtrees(codes: np.ndarray, counts: np.ndarray, depth: int, cut: int) -> list[tuple[np.ndarray, np.ndarray | None, list[tuple]]]:
    """Levels cut to depth of the tree over ascending codes: (codes of the level, place of each deeper code in them,
    and per bit (group of each code, first code of each group, zeros, ones, own, weighted)).

    With its context highest, a level's groups of any bit are runs of its ascending codes.
    """
    levels = []
    for d in range(depth, cut - 1, -1):
        inside = None
        if d < depth:
            short, inside = np.unique(codes & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
            counts = np.bincount(inside, counts, len(short)).astype(np.int64)
            codes = short
        bits = []
        for j in range(8):
            key = codes >> (8 - j)
            new = np.append(True, key[1:] != key[:-1])
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            ones = np.add.reduceat(counts * (codes >> (7 - j) & 1), first).astype(float)
            zeros = np.add.reduceat(counts, first) - ones
            own = _log_gammas(zeros + 0.5) + _log_gammas(ones + 0.5) - math.log(math.pi) - _log_gammas(zeros + ones + 1.0)
            weighted = own
            if d < depth:
                _, first_below, _, _, _, below = levels[-1][2][j]
                below = np.bincount(group[inside[first_below]], below, len(first))
                weighted = np.logaddexp(own, below) + math.log(0.5)
            bits.append((group, first, zeros, ones, own, weighted))
        levels.append((codes, inside, bits))
    return levels[::-1]


def _nodes(codes: np.ndarray, first: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and node of groups of bit j."""
    return codes[first] >> 8, (1 << j) + ((codes[first] & 255) >> (8 - j))


NODES = "part int, context bigint, node int, zeros double, ones double, own double, weighted double"


def _roots(depth: int, cut: int):
    """Nodes at depth `cut` of a part."""

    def run(rows: pa.Table) -> pa.Table:
        _, codes, counts = _merged(rows)
        codes, _, bits = _subtrees(codes, counts, depth, cut)[0]
        found = [(*_nodes(codes, first, j), zeros, ones, own, weighted) for j, (_, first, zeros, ones, own, weighted) in enumerate(bits)]
        context, node, *numbers = (np.concatenate(x) for x in zip(*found))
        part = np.full(len(node), rows.column("part")[0].as_py(), np.int32)
        return pa.table([part, context, node.astype(np.int32), *numbers], ["part", "context", "node", "zeros", "ones", "own", "weighted"])

    return run


def _answered(depth: int, cut: int):
    """For every row of a part the logarithms of its codes' mixed probabilities; above: (context, node, p, left)."""

    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        asked, codes, counts = _merged(rows)
        levels = _subtrees(codes, counts, depth, cut)
        key = above.column("context").to_numpy() * 256 + above.column("node").to_numpy()
        order = np.argsort(key)
        key, p_above, left_above = key[order], above.column("p").to_numpy()[order], above.column("left").to_numpy()[order]
        log_p = np.zeros(len(codes))
        for j in range(8):
            for d, (short, _, bits) in enumerate(levels, cut):
                group, first, zeros, ones, own, weighted = bits[j]
                if d == cut:
                    context, node = _nodes(short, first, j)
                    at = np.searchsorted(key, context * 256 + node)
                    p, left = p_above[at], left_above[at]
                else:
                    _, inside, over = levels[d - 1 - cut]
                    at = over[j][0][inside[first]]
                    p, left = p[at], left[at]
                share = np.exp(own - weighted + math.log(0.5)) if d < depth else 1.0
                p, left = p + left * share * (ones + 0.5) / (zeros + ones + 1.0), left * (1 - share)
            p = p[group]
            log_p += np.log(np.where(codes >> (7 - j) & 1, p, 1 - p))
        packed = [_pack(log_p[np.searchsorted(codes, c)]) for c in asked]
        return pa.table([rows.column("block"), rows.column("part"), pa.array(packed, pa.binary())], ["block", "part", "packed"])

    return run


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x > 0: Stirling's series after eight steps up."""
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _estimate(zeros: Column, ones: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def levels_above(roots: DataFrame, cut: int) -> DataFrame:
    """(part, context, node, p, left): what the levels above each node at depth `cut` add to its probability, and
    the share they leave to it and those below."""
    level, levels = roots, []
    for d in range(cut - 1, -1, -1):
        above = level.groupBy(F.col("context").bitwiseAND(F.lit((1 << (8 * d)) - 1)).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        ).withColumn("own", _estimate(F.col("zeros"), F.col("ones")))
        high, low = F.greatest("own", "below"), F.least("own", "below")
        level = stage(above.withColumn("weighted", high + F.log1p(F.exp(low - high)) + math.log(0.5)))
        levels.append(level)

    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    share = F.exp(F.col("own") - F.col("weighted") + math.log(0.5))
    p, left = F.lit(0.0), F.lit(1.0)
    mixed = None
    for d, level in enumerate([*reversed(levels), roots]):
        if mixed is not None:
            known = mixed.select(F.col("context").alias("above"), "node", "p", "left")
            if d <= 2:
                known = F.broadcast(known)  # at most 255 * 256 ** (d - 1) rows
            level = level.withColumn("above", F.col("context").bitwiseAND(F.lit((1 << (8 * (d - 1))) - 1))).join(known, ["above", "node"])
            p, left = F.col("p"), F.col("left")
        if d == cut:
            break
        # What deeper levels add is scaled by the shares not yet given out.
        mixed = level.select("context", "node", (p + left * share * one).alias("p"), (left * (1 - share)).alias("left"))
    out = stage(level.select("part", "context", "node", p.alias("p"), left.alias("left")))
    for old in levels:
        release(old)
    return out


SCHEMA = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, bits_per_byte double"
)


def _score(depth: int, cut: int, parts: int, total: int, distinct: int, ends: int):
    scale = math.log10(total + 0.5 * (distinct + 1))

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        texts, n_tokens, n_known, base, logs, sizes = block.column("text").to_pylist(), [], [], [], [], []
        spelled = answers.filter(pc.is_valid(answers.column("counts")))
        spelled = dict(zip(spelled.column("part").to_pylist(), spelled.column("counts").to_pylist()))
        dealt = _words_by_part({w for t in texts for w in words_of(t)}, parts)
        places = {w: i for i, w in enumerate(w for words in dealt.values() for w in words)}
        count = np.concatenate([np.zeros(0, np.int64), *(_unpack(spelled[k], len(words), np.int64) for k, words in dealt.items())])
        value = np.log10(count + 0.5)
        codes, _ = _distinct(texts, depth)
        log_p = np.zeros(len(codes))
        order, numbers, ends_of = _dealt(codes, cut, parts)
        packed = answers.filter(pc.is_valid(answers.column("packed")))
        packed = dict(zip(packed.column("part").to_pylist(), packed.column("packed").to_pylist()))
        for k, i, j in zip(numbers.tolist(), ends_of[:-1], ends_of[1:]):
            log_p[order[i:j]] = _unpack(packed[k], j - i, np.float64)
        for text in texts:
            at = np.fromiter(map(places.__getitem__, words_of(text)), np.int64)
            n_tokens.append(len(at) + 1)
            n_known.append(int((count[at] > 0).sum()) + (ends > 0))
            base.append(value[at].sum() + math.log10(ends + 0.5) - (len(at) + 1) * scale)
        for part in _parts(texts):
            own, stops = byte_strings(part, depth)
            own = own.astype(np.int64)
            # Looked up in ascending order, so neighbours are looked up after each other.
            ascending = np.argsort(own)
            found = np.empty(len(own))
            found[ascending] = log_p[np.searchsorted(codes, own[ascending])]
            sums = np.append(0.0, np.cumsum(found))
            starts = np.append(0, stops[:-1])
            logs += (sums[stops] - sums[starts]).tolist()
            sizes += (stops - starts).tolist()
        logs, sizes = np.array(logs), np.array(sizes)
        per_byte = -logs / math.log(2) / np.maximum(sizes, 1)
        return pa.table({
            "doc_id": block.column("doc_id"), "held_out": block.column("held"), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array(np.full(len(texts), total)),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(logs / math.log(10)),
            "bits_per_byte": pa.array(per_byte, mask=sizes == 0),
        })

    return run


def score_texts(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word and byte-model scores of every row, see SCHEMA; rows outside the held-out fifth are learned from.
    depth: at most 6, so that a byte and its context fit a bigint."""
    with shuffles_dropped(docs.sparkSession):
        return _score_texts(docs, depth, id_col, text_col)


def _score_texts(docs: DataFrame, depth: int, id_col: str, text_col: str) -> DataFrame:
    plain = plain_text(docs, id_col, text_col).withColumn("held", held_out(F.col("doc_id")))
    size, ends = plain.agg(F.sum(F.octet_length("text")), F.count(F.when(~F.col("held"), 1))).first()
    blocks, cut = max(LEAST_BLOCKS, -(-(size or 0) // BLOCK_BYTES)), min(CUT, depth)
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = stage(dealt.groupBy("block").applyInArrow(_asked(depth, cut, blocks), ASKED))
    asked_words, asked_codes = asked.where("words IS NOT NULL").drop("codes"), asked.where("words IS NULL").drop("words")

    words = stage(asked_words.groupBy("part").applyInArrow(_counted, COUNTED))
    sums = words.groupBy("part").agg(F.max("total").alias("total"), F.max("distinct").alias("distinct"))
    total, distinct = sums.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    roots = stage(asked_codes.groupBy("part").applyInArrow(_roots(depth, cut), NODES))
    above = levels_above(roots, cut)
    chances = asked_codes.groupBy("part").cogroup(above.groupBy("part")).applyInArrow(
        _answered(depth, cut), "block int, part int, packed binary"
    )
    none = F.lit(None).cast("binary")
    answers = words.select("block", "part", "counts", none.alias("packed")).union(chances.select("block", "part", none.alias("counts"), "packed"))
    scored = stage(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(depth, cut, blocks, total + ends, distinct + (ends > 0), ends), SCHEMA
    ))
    for old in (asked, words, roots, above):
        release(old)
    return scored


def op7_query(docs: DataFrame) -> DataFrame:
    return score_texts(docs)
