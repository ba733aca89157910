"""MinHash near-duplicates through an LSH forest, confirmed on full shingle sets.

Texts with equal shingle sets form one class. A class has HASHES minimum hashes; each of TREES trees is a
sorted order of the classes by its own sequence of up to DEPTH of them. Neighbours in an order whose
longest common prefix has at least ROOT hashes form a region. A region of at most CROWD classes proposes
all its pairs; a larger one proposes neighbours in the order and is split by the next hash, so the depth
adapts to how crowded a region is. Orders are dealt out by range, with the id as last key, so no region,
however large, is tied to one task. Bitmaps of the sets, of a fixed size, rule out most proposals before any full
set is made or moved.

What a crowded or cut region does not propose is left to an exact way: among the members of such
regions that are still in different components, classes that share a shingle in the rarest part of
both their sets (prefix filter) are proposed too, unless bitmaps of the sets prove them too different: first
one pair for each two components that stand side by side, then all that is still apart. Every proposal is
confirmed on the full sets; those between classes already in one component need no confirmation, so thousands
of near copies cost about as many confirmations as there are copies.

Null or empty text has no shingles, is linked with nothing and keeps itself. Rows with a null id are
linked with nothing. Rows that share an id are one document: links of each hold for the id. Other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, plain_text, release, shuffles_dropped, stage, words_of
from .components import components

TREES, ROOT, DEPTH, CROWD = 32, 4, 8, 16
HASHES = TREES * ROOT
BITS = 2048
FILTER_BITS = 1 << 22
CACHE_WORDS = 500_000
# Rows of one shingle, in order of size, that a row is compared with before all are.
NEAR_ROWS = 8
# Tokens of one set whose bitmaps are made at a time.
BEHIND_ROWS = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Distinct 64-bit shingle hashes of a text; word hashes are kept in a bounded cache."""

    def __init__(self, size: int):
        self.size = size
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        hashes = list(map(self.cache.get, words))
        if None in hashes:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            for i, w in enumerate(words):
                if hashes[i] is None:
                    hashes[i] = self.cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array(hashes, np.uint64)
        k = min(self.size, len(h))
        out = np.full(len(h) - k + 1, np.uint64(k))
        for j in range(k):
            out = out * _MIX + _spread(h[j : len(h) - k + 1 + j])
        return np.unique(_spread(out))


def _signature(shingles: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 2048):
        part = shingles[None, at : at + 2048] * multiply[:, None] + add[:, None]
        best = np.minimum(best, part.min(axis=1))
    # Four hashes of 16 mixed bits make one long.
    return (_spread(best) >> np.uint64(48)).astype(">u2").view(">i8").astype(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), two lanes that identify the set, signature (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        rng = np.random.default_rng(20)
        multiply = rng.integers(0, 2**63, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 2**63, HASHES).astype(np.uint64)
        for batch in batches:
            n, first, second, sigs = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                n.append(len(s))
                low, high = divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64)
                first.append(low - (1 << 63))
                second.append(high - (1 << 63))
                sigs.append(_signature(s, multiply, add) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 pa.array(sigs, pa.list_(pa.int64()))],
                ["doc_id", "n", "first", "second", "signature"],
            )

    return plain_text(docs).mapInArrow(run, "doc_id bigint, n bigint, first bigint, second bigint, signature array<bigint>")


def _bit_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)).astype(np.int64) % BITS


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    """BITS bits, one flipped for each shingle: two sets differ in at least as many shingles as bits."""
    bits = np.bincount(_bit_of(shingles), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _filter_of(ids: DataFrame) -> np.ndarray:
    """FILTER_BITS bits with those of the ids (column rep) set: a fixed size, however many ids there are."""
    bucket = F.pmod(F.col("rep"), F.lit(FILTER_BITS))
    words = ids.groupBy(F.shiftright(bucket, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bucket.bitwiseAND(F.lit(63)).cast("int"))).alias("word"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for at, word in words.collect():  # at most FILTER_BITS / 64 rows
        out[at] = word
    return out


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int, whole: bool = True) -> DataFrame:
    """rep, n, shingles (null unless whole), bits of the documents whose id is in ids (rep, each once), and what else ids holds.

    Texts are not shuffled: a filter of fixed size goes to the tasks, and what it lets through besides is
    dropped by a join of the small result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, words = Shingler(size), shared.value
        for batch in batches:
            rep = batch.column(0).fill_null(0).to_numpy()
            bucket = rep % FILTER_BITS
            hit = (words[bucket >> 6] >> (bucket & 63)) & 1 == 1
            batch = batch.filter(pa.array(hit))
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) if whole else None for s in sets], pa.list_(pa.int64())),
                 pa.array([_bitmap(s) for s in sets], pa.list_(pa.int64()))],
                ["rep", "n", "shingles", "bits"],
            )

    found = plain_text(docs).mapInArrow(run, "rep bigint, n bigint, shingles array<bigint>, bits array<bigint>")
    return found.join(ids, "rep")


def _similar_sizes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def _region(rest: np.ndarray, n: np.ndarray, reps: np.ndarray, depth: int, percent: int, out: list) -> None:
    """Proposals of neighbouring rows that share their first `depth` hashes; rest holds the ROOT later ones."""
    m = len(reps)
    if m < 2:
        return
    if m <= CROWD:
        i, j = np.triu_indices(m, 1)
        ok = _similar_sizes(n[i], n[j], percent)
        out.append((reps[i[ok]], reps[j[ok]]))
        return
    for step in (1, 2, 3):
        ok = _similar_sizes(n[:-step], n[step:], percent)
        out.append((reps[:-step][ok], reps[step:][ok]))
    if depth < DEPTH:
        value = rest >> np.int64(16 * (DEPTH - 1 - depth))
        cut = np.flatnonzero(value[1:] != value[:-1]) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), m]):
            _region(rest[a:b], n[a:b], reps[a:b], depth + 1, percent, out)


def _neighbours(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opening = None, True
        for batch in _with_end(batches):
            if batch is not None:
                rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
                held = rows if held is None else tuple(np.concatenate(p) for p in zip(held, rows))
            if held is None or not len(held[0]):
                continue
            tree, root, rest, n, reps = held
            same = (tree[1:] == tree[:-1]) & (root[1:] == root[:-1])
            bounds = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(tree)]])
            # The last region may go on in the next batch; a very long one is cut, which marks it as crowded.
            cut = batch is not None and len(tree) - bounds[-2] <= 50_000
            last = len(bounds) - 2 if cut else len(bounds) - 1
            sizes = np.diff(bounds)[:last]
            out, crowded = [], []
            for r in np.flatnonzero(sizes > 1).tolist():
                a, b = bounds[r], bounds[r + 1]
                _region(rest[a:b], n[a:b], reps[a:b], ROOT, percent, out)
                if b - a > CROWD:
                    crowded.append(reps[a:b])
            # Regions at the ends of a partition or of a cut may have members elsewhere.
            if opening and last:
                crowded.append(reps[bounds[0] : bounds[1]])
                opening = False
            if not cut and last:
                crowded.append(reps[bounds[last - 1] : bounds[last]])
            held = tuple(c[bounds[last] :] for c in held)
            if not cut:
                opening = True
            one = np.concatenate([p for p, _ in out] + [np.zeros(0, np.int64)])
            two = np.concatenate([q for _, q in out] + [np.zeros(0, np.int64)])
            marks = np.unique(np.concatenate([*crowded, np.zeros(0, np.int64)]))
            pairs = np.unique(np.stack([np.maximum(one, two), np.minimum(one, two)], axis=1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            a = np.concatenate([pairs[:, 0], marks])
            b = pa.array(np.concatenate([pairs[:, 1], marks]), mask=np.arange(len(a)) >= len(pairs))
            yield pa.RecordBatch.from_arrays([pa.array(a), b], ["a", "b"])

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def propose(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b), a > b: candidate pairs of classes (rep, n, signature); b is null for members of crowded regions."""
    last = TREES - 1
    trees = F.transform(
        F.sequence(F.lit(0), F.lit(last)),
        lambda t: F.struct(
            t.alias("tree"),
            F.get("signature", t).alias("root"),
            F.get("signature", F.when(t == last, 0).otherwise(t + 1)).alias("rest"),
        ),
    )
    rows = classes.select("rep", "n", F.explode(trees).alias("t")).select("t.tree", "t.root", "t.rest", "n", "rep")
    ordered = rows.repartitionByRange("tree", "root", "rest", "rep").sortWithinPartitions("tree", "root", "rest", "n", "rep")
    return ordered.mapInArrow(_neighbours(percent), "a bigint, b bigint").distinct()


def _bits_apart(a: str, b: str) -> Column:
    """Different bits of two bitmaps: a lower bound of how many shingles differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """(a, b, apart): the pairs that bitmaps (rep, n, bits) do not rule out, once for each two rows of their ids."""
    one = bitmaps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = bitmaps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("apart", _bits_apart("bits_a", "bits_b"))
    return both.where(F.col("apart") * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b", "apart")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
    both = pairs.join(one, "a").join(two, "b").withColumn("common", common)
    return both.where(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent).select("a", "b")


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not known to be in one component."""
    one = found.select(F.col("id").alias("a"), F.col("component").alias("c_a"))
    two = found.select(F.col("id").alias("b"), F.col("component").alias("c_b"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def _rare_tokens(sets: DataFrame, percent: int) -> DataFrame:
    """(rep, n, place, h) for the rarest part of each set, in which similar sets share a shingle (prefix filter).

    place is the rank of h in the part; all parts follow one order, and each is what its set has first in it.
    """
    each = sets.select("rep", "n", F.explode("shingles").alias("h"))
    common = stage(each.groupBy("h").count().where("count > 1"))
    # Shingles of one set only cannot be shared; they come first in the order and shorten the prefix.
    ranked = each.join(common, "h").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("count", "h"))).alias("by_rarity"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("by_rarity"))
    rare = stage(ranked.withColumn("prefix", prefix.cast("int")).where("prefix > 0").select(
        "rep", "n", F.posexplode(F.transform(F.slice("by_rarity", 1, F.col("prefix")), lambda x: x["h"])).alias("place", "h")
    ))
    release(common)
    return rare


def _mixed(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """Tokens with their component, of the shingles that occur in more than one component."""
    known = found.select(F.col("id").alias("rep"), "component")
    tokens = tokens.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = tokens.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return tokens.join(mixed.select("h"), "h", "left_semi")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Different bits of two bitmaps, row by row: a lower bound of how many shingles differ."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _beside(percent: int):
    """Pairs of near rows (h, n, rep, component, bits) in order that no bound rules out, the closest per pair of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            h, n, rep, component = (batch.column(c).to_numpy() for c in range(4))
            bits = batch.column(4).flatten().to_numpy().view(np.uint64).reshape(len(h), -1)
            rows = (h, n, rep, component, bits)
            if held is not None:
                rows = tuple(np.concatenate(p) for p in zip(held, rows))
            h, n, rep, component, bits = rows
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for step in range(1, NEAR_ROWS + 1):
                ok = (h[step:] == h[:-step]) & (component[step:] != component[:-step]) & _similar_sizes(n[step:], n[:-step], percent)
                i = np.flatnonzero(ok)
                apart = _apart(bits[i], bits[i + step])
                close = apart * (100 + percent) <= (n[i] + n[i + step]) * (100 - percent)
                for k, x in zip(i[close].tolist(), apart[close].tolist()):
                    a, b = int(component[k]), int(component[k + step])
                    one, two = int(rep[k]), int(rep[k + step])
                    key, value = (max(a, b), min(a, b)), (x, max(one, two), min(one, two))
                    best[key] = min(best.get(key, value), value)
            out = [(*key, *value) for key, value in best.items()]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["high", "low", "apart", "a", "b"])
            held = tuple(c[-NEAR_ROWS:] for c in rows)

    return run


def _bridges(tokens: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The closest pair (a, b) of each two components that stand near each other in the order of (h, n)."""
    rows = tokens.join(sets.select("rep", "bits"), "rep").select("h", "n", "rep", "component", "bits")
    dealt = rows.repartitionByRange("h", "n", "rep").sortWithinPartitions("h", "n", "rep")
    each = dealt.mapInArrow(_beside(percent), "high bigint, low bigint, apart bigint, a bigint, b bigint")
    least = each.groupBy("high", "low").agg(F.min(F.struct("apart", "a", "b")).alias("m"))
    return least.select("m.a", "m.b").distinct()


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, before, n, rep, component, bits) per token of a set: how many tokens come before h, bitmap of the set without those."""
    schema = pa.schema([*((c, pa.int64()) for c in ("h", "before", "n", "rep", "component")), ("bits", pa.list_(pa.int64()))])
    for batch in batches:
        n, rep, component = (batch.column(c).to_numpy() for c in range(3))
        for k in range(len(rep)):
            tokens, bits = (batch.column(c)[k].values.to_numpy() for c in (3, 4))
            bits = bits.view(np.uint8)
            for at in range(0, len(tokens), BEHIND_ROWS):
                h = tokens[at : at + BEHIND_ROWS]
                bit = _bit_of(h.view(np.uint64))
                flips = np.zeros((len(h) + 1, BITS // 8), np.uint8)
                flips[0] = bits
                flips[np.arange(1, len(h) + 1), bit >> 3] = 0x80 >> (bit & 7)
                rest = np.bitwise_xor.accumulate(flips, axis=0)
                bits = rest[-1]
                words = BITS // 64
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(np.arange(at, at + len(h))), *(pa.array(np.full(len(h), c[k])) for c in (n, rep, component)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1, dtype=np.int32) * words), pa.array(rest[:-1].reshape(-1).view(np.int64)))],
                    schema=schema,
                )


def _all_left(tokens: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that share a rare shingle and that no bound rules out.

    Of each shingle's component with the most rows only the pairs with other components are met, and rows
    meet within neighbouring bands of size only, so a shingle of a large group is dealt out and costs its
    few other rows times the group. Each meeting is judged as the first of its pair: then the sets share
    nothing before the shingle, and what both have there counts as different. That rules out nearly all
    later meetings of a pair, however many shingles it shares, and never the first one of a similar pair.
    """
    per_component = tokens.groupBy("h", "component").count()
    top = per_component.groupBy("h").agg(F.max(F.struct("count", "component"))["component"].alias("top"))
    # Similar sizes differ by at most one band; for 100 percent they are equal.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 1e-9) if percent < 100 else F.col("n")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "h"))), lambda x: x["h"])
    per_set = tokens.groupBy("rep", "n", "component").agg(in_order.alias("tokens")).join(sets, ["rep", "n"])
    # Sets of rows that share an id and a size come with the tokens of all of them, in one order.
    own = F.array_intersect("tokens", "shingles")
    behind = per_set.select("n", "rep", "component", own.alias("tokens"), "bits").mapInArrow(
        _behind, "h bigint, before bigint, n bigint, rep bigint, component bigint, bits array<bigint>")
    columns = ("n", "before", "rep", "component", "bits")
    rows = behind.join(top, "h").withColumn("band", band)
    with batches_of(tokens.sparkSession, 256):
        rows = stage(rows.select("h", "band", *columns, (F.col("component") != F.col("top")).alias("other")))
    one = rows.where("other").select("h", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
                                     *(F.col(c).alias(f"{c}_a") for c in columns))
    two = rows.select("h", "band", "other", *(F.col(c).alias(f"{c}_b") for c in columns))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    # Similar sets differ in at most this share of both sizes, and bitmaps differ no more than the sets.
    before = F.col("before_a") + F.col("before_b")
    apart = _bits_apart("bits_a", "bits_b")
    limit = (F.col("n_a") + F.col("n_b")) * (100 - percent)
    close = (before * (100 + percent) <= limit) & ((before + apart) * (100 + percent) <= limit)
    once = (F.col("component_a") != F.col("component_b")) & (~F.col("other") | (F.col("rep_a") > F.col("rep_b")))
    met = one.join(two, ["h", "band"]).where(once & fits & close)
    pairs = stage(met.select(F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b")).distinct())
    release(rows)
    return pairs


def _link_rest(sets: DataFrame, found: DataFrame, links: DataFrame, percent: int) -> tuple[list[DataFrame], DataFrame]:
    """Links among members of crowded regions that are still in different components, and all components with them.

    First the closest pair of each two components that stand side by side is confirmed and the components
    are merged; what is still apart then meets in full. Merging brings no other rows side by side and leaves
    no pair to confirm that was not tried, so this is done once.
    """
    tokens = _rare_tokens(sets, percent)
    left = stage(_mixed(tokens, found))
    new = stage(confirm(_bridges(left, sets, percent), sets, percent))
    added = [new]
    if not new.isEmpty():
        links, old = links.union(new), [left, found]
        found = components(links)
        left = stage(_mixed(left.drop("component"), found))
        for each in old:
            release(each)
    pairs = _all_left(left, sets, percent)
    if not pairs.isEmpty():
        new = stage(confirm(pairs, sets, percent))
        added.append(new)
        release(found)
        found = components(links.union(new))
    for old in (tokens, left, pairs):
        release(old)
    return added, found


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Linked: 100 * intersection >= percent * union of the sets of `size`-word shingles (A-Z lower-cased;
    fewer words make one shingle).
    """
    with shuffles_dropped(docs.sparkSession):
        return _near_duplicates(plain_text(docs, id_col, text_col), size, percent)


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    signed = stage(signatures(docs, size))
    set_key = ["n", "first", "second"]
    usable = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(usable.groupBy(*set_key).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")))
    proposed = stage(propose(classes.select("rep", "n", "signature"), percent))
    pairs, crowded = proposed.where("b IS NOT NULL"), proposed.where("b IS NULL").select(F.col("a").alias("rep"))

    members = stage(usable.select("doc_id", *set_key).join(classes.select(*set_key, "rep"), set_key).select("doc_id", "rep").distinct())
    lowest = members.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    same_id = members.join(stage(lowest), "doc_id").where("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b"))

    ends = stage(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct())
    bitmaps = stage(shingle_sets(docs, ends, size, whole=False).drop("shingles"))
    close = stage(possible(pairs, bitmaps, percent))
    release(ends)
    release(bitmaps)
    marked = close.select(F.col("a").alias("rep")).union(close.select("b")).withColumn("crowded", F.lit(False))
    marked = marked.union(crowded.withColumn("crowded", F.lit(True)))
    involved = stage(marked.groupBy("rep").agg(F.max("crowded").alias("crowded")))
    sets = stage(shingle_sets(docs, involved, size))

    # First the closest partner of each class by bitmaps, then whatever is still between components.
    nearest = close.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m")).select("a", "m.b")
    links = [stage(same_id), stage(confirm(nearest, sets, percent))]
    found = components(links[0].union(links[1]))
    between = stage(_across(close.select("a", "b").distinct(), found))
    links.append(stage(confirm(between, sets, percent)))
    release(found)
    found = components(links[0].union(links[1]).union(links[2]))
    dense = stage(sets.where("crowded").drop("crowded"))
    more, found = _link_rest(dense, found, links[0].union(links[1]).union(links[2]), percent)
    for old in (proposed, close, involved, sets, dense, between, members, *links, *more):
        release(old)

    roots = classes.join(found, classes["rep"] == found["id"], "left").select(
        *set_key, F.coalesce("component", "rep").alias("root")
    )
    out = signed.join(stage(roots), set_key, "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("root")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op10_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, size=2, percent=80)
