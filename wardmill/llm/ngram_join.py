"""N-gram Jaccard join by vertical partitioning.

A document is its set of hashed word n-grams. The global order of n-grams is cut into fragments; each fragment counts
partial overlaps on its own, drops pairs that have already lost too much there, and the counts are summed per pair.

Equal sets are one class. Which classes can have partners follows from the order: two sets that link share at least
``alpha`` of the n-grams in the leading parts of both, so a class is looked at further only if enough of its leading
n-grams occur in another class, and then by its rarest ones only. Classes that share one of those form a family. Within
a family, links to the first class of each shared n-gram are verified first; then only classes not connected yet
are held against each other, in blocks of similar length. So no group is expanded into all its pairs, and no link that
joins components is missed.

A null text and a text without words have an empty set and link with nothing; a text of fewer words than an n-gram is
one n-gram. Rows with one id are told apart by ``row_id`` (see common.with_row_ids) and each gives a row. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import free_names, in_slices, tidied, with_row_ids, written
from wardmill.llm.components import components

WORDS = 5
PERCENT = 80
#: Fragments of the global order of n-grams.
FRAGMENTS = 4
#: Classes in a block; a pair of blocks is compared in one task.
BLOCK = 256
#: Bytes of text hashed at once, if documents are shorter.
CHUNK = 1 << 18
#: Set digests a task remembers so that copies give their n-grams once; forgotten when full.
SEEN = 500_000
#: Base and odd multipliers of the hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD1342543DE82EF95)
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number scrambled one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
LETTERS[65:91] = LETTERS[97:123]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were asked for so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            one = np.ones(size, np.uint64)
            one[1:] = BASE
            cls.up = np.multiply.accumulate(one)
            one[1:] = U(inverse(int(BASE)))
            cls.down = np.multiply.accumulate(one)
        return cls.up[:n], cls.down[:n]


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of the bytes, A to Z lower-cased."""
    blank = BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = Powers.to(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[data] * up[:-1], dtype=np.uint64)])
    return start, mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * ODD)


def gram_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of each text one after the other, their number per text)."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    sets, sizes = [], []
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        to = min(to, len(texts))
        # a blank between documents ends their words
        lengths = np.diff(bounds[at : to + 1])
        first = np.concatenate([[0], np.cumsum(lengths + 1)])
        data = np.full(int(first[-1]), 32, np.uint8)
        place = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)
        data[place] = raw[bounds[at] : bounds[to]]
        start, hashed = hashed_words(data)
        own = np.searchsorted(first, start, "right") - 1
        count = np.bincount(own, minlength=to - at)
        grams = hashed.copy()
        for k in range(1, words):
            grams[: len(grams) - k] = grams[: len(grams) - k] * ODD + hashed[k:]
        grams = mixed(grams)
        ends = np.cumsum(count)
        for i in range(to - at):
            a, b = int(ends[i] - count[i]), int(ends[i])
            if b - a >= words:
                found = np.unique(grams[a : b - words + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    h = U(b - a)
                    for w in hashed[a:b]:
                        h = h * BASE + w
                found = mixed(np.array([h], np.uint64))
            else:
                found = np.zeros(0, np.uint64)
            sets.append(found)
            sizes.append(len(found))
        at = to
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def digests(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set; the order of its members does not matter."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for salt in (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values ^ salt), dtype=np.uint64)])
        out.append(sums[ends[1:]] - sums[ends[:-1]])
    return out[0], out[1]


def needed(n):
    """n-grams of a set of ``n`` that any linked set shares, for whole numbers and arrays."""
    return (PERCENT * n + 99) // 100


def leading(n):
    """(how many of a set's n-grams in order are looked at, how many of them a linked set of any size shares).

    A linked set holds needed(n) of the n n-grams, so it holds ell = 1 + n // 10 of the first n - needed(n) + ell. A
    partner, having needed(n) at least, has an ell of its own from which ``alpha`` follows.
    """
    return np.minimum(n, n - needed(n) + 1 + n // 10), 1 + needed(n) // 10


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def classes(rows: DataFrame) -> DataFrame:
    """row_id, doc_id, n (set size), d1, d2 (digests of the set)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 2):
            values, sizes = gram_sets(b.column(2))
            d1, d2 = digests(values, sizes)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(sizes), signed(d1), signed(d2)], names=["row_id", "doc_id", "n", "d1", "d2"])

    return rows.select("row_id", "doc_id", "text").mapInArrow(tidied(work), "row_id long, doc_id long, n long, d1 long, d2 long")


def leading_grams(rows: DataFrame) -> DataFrame:
    """gram, d1: the leading n-grams of each class, about once per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in in_slices(batches, 0):
            values, sizes = gram_sets(b.column(0))
            d1, _ = digests(values, sizes)
            new = np.zeros(len(sizes), bool)
            for i, d in enumerate(d1.tolist()):
                if d not in seen:
                    seen.add(d)
                    new[i] = True
            if len(seen) > SEEN:
                seen.clear()
            take, _ = leading(sizes)
            take = np.where(new, take, 0)
            within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            chosen = within < np.repeat(take, sizes)
            yield pa.record_batch([signed(values[chosen]), signed(np.repeat(d1, take))], names=["gram", "d1"])

    return rows.select("text").mapInArrow(tidied(work), "gram long, d1 long")


def shared_grams(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """gram, rep, n: for each class that can have partners, its rarest leading n-grams that another class has too."""
    grams = leading_grams(rows)
    common = grams.groupBy("gram").agg(F.min("d1").alias("low"), F.max("d1").alias("high"), F.count("*").alias("df")).where("low <> high").select("gram", "df")
    mine = grams.join(common, "gram").groupBy("d1", "gram").agg(F.max("df").alias("df"))
    lists = mine.groupBy("d1").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("list")).join(reps.select("d1", "rep", "n"), "d1")
    alpha = F.floor(F.floor((PERCENT * F.col("n") + 99) / 100) / 10) + 1
    usable = lists.where(F.size("list") >= alpha)
    first = F.slice("list", F.lit(1), (F.size("list") - alpha + 1).cast("int"))
    buckets = written(usable.select("rep", "n", F.explode(first["gram"]).alias("gram")), "buckets")
    several = buckets.groupBy("gram").agg(F.count("*").alias("size"), F.min("rep").alias("leader")).where("size > 1")
    return buckets.join(several.select("gram", "leader"), "gram")


def segments(rows: DataFrame, members: DataFrame) -> DataFrame:
    """rep, fragment, n, grams (binary, sorted 64-bit): the sets of the members cut by the global order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 1):
            values, sizes = gram_sets(b.column(1))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = np.array([(k << 64) // FRAGMENTS for k in range(1, FRAGMENTS)], np.uint64)
            parts = []
            for i in range(len(sizes)):
                own = values[ends[i] : ends[i + 1]]
                parts += [p.tobytes() for p in np.split(own, np.searchsorted(own, cuts))]
            rep = b.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), FRAGMENTS)))
            yield pa.record_batch(
                [rep, pa.array(np.tile(np.arange(FRAGMENTS), len(sizes))), pa.array(np.repeat(sizes, FRAGMENTS)), pa.array(parts, pa.binary())],
                names=["rep", "fragment", "n", "grams"],
            )

    texts = rows.select(F.col("row_id").alias("rep"), "text").join(members, "rep", "left_semi")
    return texts.mapInArrow(tidied(work), "rep long, fragment long, n long, grams binary")


def linked(a: str, b: str, overlap: str) -> str:
    return f"100 * {overlap} >= {PERCENT} * ({a} + {b} - {overlap})"


def verified_pairs(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b): partial overlaps by fragment, summed per pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            x, y = t.column("grams").to_pylist(), t.column("other").to_pylist()
            found = [len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True)) for p, q in zip(x, y, strict=True)]
            yield pa.record_batch([t.column("a"), t.column("b"), t.column("na"), t.column("nb"), pa.array(found, pa.int64())], names=["a", "b", "na", "nb", "part"])

    left = cut.select(F.col("rep").alias("a"), "fragment", F.col("n").alias("na"), "grams")
    right = cut.select(F.col("rep").alias("b"), "fragment", F.col("n").alias("nb"), F.col("grams").alias("other"))
    both = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", "grams", "other")
    parts = both.mapInArrow(tidied(work), "a long, b long, na long, nb long, part long")
    return parts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap")).where(linked("na", "nb", "overlap")).select("a", "b")


def block_overlaps(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Overlap of each set of x with each of y."""
    a, b = np.frombuffer(b"".join(x), np.uint64), np.frombuffer(b"".join(y), np.uint64)
    own_a, own_b = np.repeat(np.arange(len(x)), [len(p) // 8 for p in x]), np.repeat(np.arange(len(y)), [len(p) // 8 for p in y])
    order = np.argsort(b, kind="stable")
    b, own_b = b[order], own_b[order]
    out = np.zeros(len(x) * len(y), np.int64)
    lo, hi = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
    hits = hi - lo
    step = max(1, (1 << 20) // max(1, int(hits.max(initial=1))))
    for s in range(0, len(a), step):
        h = hits[s : s + step]
        at = np.arange(int(h.sum())) - np.repeat(np.cumsum(h) - h, h) + np.repeat(lo[s : s + step], h)
        out += np.bincount(np.repeat(own_a[s : s + step], h) * len(y) + own_b[at], minlength=len(out))
    return out.reshape(len(x), len(y))


def cross_links(members: DataFrame, cut: DataFrame) -> DataFrame:
    """Links (a, b) between classes of one family that are not connected yet.

    ``members``: rep, n, family, label. Linked sets differ in size by a fifth at most, so only blocks of equal or
    neighbouring bands of size meet. A component with many classes has blocks of its own, which don't meet each other.
    """
    families = members.groupBy("family").agg(F.count_distinct("label").alias("labels")).where("labels > 1").select("family")
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / PERCENT)))
    open_ = members.join(families, "family", "left_semi").withColumn("band", band)
    groups = open_.groupBy("family", "band", "label").agg(F.count("*").alias("size"))
    own = F.when(F.col("size") >= BLOCK // 4, F.col("label"))
    keyed = open_.join(groups, ["family", "band", "label"]).select("rep", "n", "family", "band", "label", own.alias("own"))
    keyed = written(keyed.withColumn("own_key", F.coalesce(F.col("own").cast("string"), F.lit(""))), "keyed")
    counts = keyed.groupBy("family", "band", "own_key").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    keyed = keyed.join(counts, ["family", "band", "own_key"]).withColumn("salt", F.pmod(F.xxhash64("rep"), "salts"))
    block = F.xxhash64("family", "band", "own_key", "salt").alias("block")
    keyed = written(keyed.select("rep", "label", "family", "band", "own_key", "salt", block), "blocks")
    heads = written(keyed.groupBy("block", "family", "band", "own_key").count(), "heads")
    one = heads.select(F.col("block").alias("p"), "family", F.col("band").alias("p_band"), F.col("own_key").alias("p_own"))
    two = heads.select(F.col("block").alias("q"), "family", F.col("band").alias("q_band"), F.col("own_key").alias("q_own"))
    meet = one.join(two, "family").where("abs(p_band - q_band) <= 1 AND p <= q AND NOT (p_own = q_own AND p_own <> '')").select("p", "q")
    cells = cut.join(keyed.select("rep", "label", "block"), "rep").groupBy("block", "fragment").agg(F.collect_list(F.struct("rep", "label", "n", "grams")).alias("sets"))
    cells = written(cells, "cells")
    left = meet.join(cells.select(F.col("block").alias("p"), "fragment", F.col("sets").alias("x")), "p")
    both = left.join(cells.select(F.col("block").alias("q"), "fragment", F.col("sets").alias("y")), ["q", "fragment"]).select("p", "q", "x", "y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for i in range(t.num_rows):
                x, y = t.column("x")[i].values.flatten(), t.column("y")[i].values.flatten()
                xr, xl, xn = (c.to_numpy() for c in x[:3])
                yr, yl, yn = (c.to_numpy() for c in y[:3])
                xg, yg = x[3].to_pylist(), y[3].to_pylist()
                part = block_overlaps(xg, yg)
                total = xn[:, None] + yn[None, :]
                # 9 overlaps are at least 4 of both sizes, so a set cannot lose more than the rest in any fragment
                least = (PERCENT * total + 99 + PERCENT) // (100 + PERCENT)
                sx, sy = np.array([len(g) // 8 for g in xg]), np.array([len(g) // 8 for g in yg])
                fits = (sx[:, None] - part <= xn[:, None] - least) & (sy[None, :] - part <= yn[None, :] - least)
                fits &= (xl[:, None] != yl[None, :]) & (PERCENT * total <= (100 + PERCENT) * np.minimum(xn[:, None], yn[None, :]))
                if t.column("p")[i] == t.column("q")[i]:
                    fits &= xr[:, None] < yr[None, :]
                r, c = np.nonzero(fits)
                flip = xr[r] > yr[c]
                a, b = np.where(flip, yr[c], xr[r]), np.where(flip, xr[r], yr[c])
                yield pa.record_batch(
                    [t.column("p")[i : i + 1], t.column("q")[i : i + 1], pa.array([a], pa.list_(pa.int64())), pa.array([b], pa.list_(pa.int64())), pa.array([total[r, c]], pa.list_(pa.int64())), pa.array([part[r, c]], pa.list_(pa.int64()))],
                    names=["p", "q", "a", "b", "total", "part"],
                )

    def add(_, table):
        a, b, total, part = (np.concatenate([np.zeros(0, np.int64), *(v.values.to_numpy() for v in table.column(k).combine_chunks())]) if table.num_rows else np.zeros(0, np.int64) for k in ("a", "b", "total", "part"))
        order = np.lexsort((b, a))
        a, b, total, part = a[order], b[order], total[order], part[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
        overlap = np.add.reduceat(part, first) if len(a) else part
        holds = 100 * overlap >= PERCENT * (total[first] - overlap)
        return pa.table({"a": pa.array(a[first][holds], pa.int64()), "b": pa.array(b[first][holds], pa.int64())})

    parts = both.mapInArrow(tidied(count), "p long, q long, a array<long>, b array<long>, total array<long>, part array<long>")
    return parts.groupBy("p", "q").applyInArrow(add, "a long, b long").distinct()


def near_components(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_shingles, class_id (first row of an equal set), component_row, component_id for every row."""
    rows, numbered = with_row_ids(docs.select("doc_id", "text"))
    found = written(classes(rows), "classes")
    reps = written(found.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("row_id").alias("rep")), "reps")
    buckets = written(shared_grams(rows, reps), "shared")
    pairs = buckets.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b"), "n").distinct()
    members = buckets.select("rep", "n").distinct()
    near = pairs.join(members.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a")
    near = written(near.where(f"100 * least(n, na) >= {PERCENT} * greatest(n, na)").select("a", "b"), "pairs")
    cut = written(segments(rows, members.select("rep")), "segments")
    first = written(verified_pairs(near, cut), "links")
    families = components(pairs.select("a", "b")).select(F.col("node").alias("rep"), F.col("label").alias("family"))
    known = components(first).select(F.col("node").alias("rep"), "label")
    open_ = members.join(families, "rep").join(known, "rep", "left").select("rep", "n", "family", F.coalesce("label", "rep").alias("label"))
    second = cross_links(written(open_, "members"), cut)
    labels = components(written(first.unionByName(second), "links")).select(F.col("node").alias("rep"), F.col("label").alias("component"))
    out = found.join(reps, ["n", "d1", "d2"], "left").join(labels, "rep", "left")
    out = out.select("row_id", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "row_id").alias("class_id"), F.coalesce("component", "rep", "row_id").alias("component_row"))
    if not numbered:
        return out.withColumn("component_id", F.col("component_row"))
    ids = rows.select(F.col("row_id").alias("component_row"), F.col("doc_id").alias("component_id"))
    return out.join(ids, "component_row")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, the first; columns as before."""
    (own,) = free_names(docs, "row_id")
    rows, _ = with_row_ids(docs, own)
    found = near_components(rows.select(F.col(own).alias("doc_id"), "text"))
    gone = written(found.where("row_id <> component_row").select(F.col("row_id").alias(own)), "near-copies")
    return rows.join(gone, own, "left_anti").select(*docs.columns)
