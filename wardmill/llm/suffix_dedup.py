"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Every byte that a string of ``LENGTH`` bytes covers goes if the same string starts earlier in the corpus.

Anchors bring equal strings together: of the hashed ``GRAM``-byte strings inside each ``LENGTH``-byte window the least
is an anchor, so equal windows hold equal anchors at equal places. Occurrences of an anchor whose surroundings are
equal in full need no further look: all but the first are removed whole. The different surroundings of an anchor, one
each, are sorted by what follows the anchor, with the common prefixes of neighbours: the piece of the suffix array below
the anchor. Backward extension by the preceding byte (the transform's column) then runs breadth-first, all
intervals one byte at a time: a step keeps the order inside equal bytes, common prefixes grow by one, and an interval
ends when no two of its members can reach ``LENGTH``. Where neighbours reach it, all but the earliest start of the
class are removed.

Documents are taken as UTF-8 bytes; a null text is empty; matches don't cross documents. Rows with one id are told
apart by ``row_id`` (see common.with_row_ids), which is also the order of equal ids. Other columns are ignored. An
empty table gives an empty result. A task holds at most ``HELD`` surroundings of one anchor; more are dealt to
several tasks, whose classes meet by a hash of the string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import with_row_ids, written

LENGTH = 100
GRAM = 32
BEFORE = LENGTH - GRAM
#: Bytes of text hashed at once, if documents are shorter.
CHUNK = 1 << 17
#: Anchors a task holds to combine equal surroundings before the shuffle.
COMBINED = 1 << 20
#: Surroundings of one anchor in one task.
HELD = 50_000
U = np.uint64
ODD = U(0xD1342543DE82EF95)
#: Kinds of rows between the passes: an anchor (``until``: bytes of its surrounding from its place on), a removed span,
#: a first surrounding whose text is asked for.
ANCHOR, SPAN, ASK = 0, 1, 2
ROW = "kind int, key long, around long, row_id long, at int, until int"


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number scrambled one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on (a power of two): halves join until they are long enough."""
    h, n, factor = LETTERS[data], 1, ODD
    while n < size:
        h = h[:-n] * factor + h[n:]
        factor, n = factor * factor, 2 * n
    return mixed(h)


def sliding(x: np.ndarray, size: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over each run of ``size`` values."""
    n = 1
    while 2 * n <= size:
        x, n = of(x[:-n], x[n:]), 2 * n
    return of(x[: len(x) - (size - n)], x[size - n :]) if n < size else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of documents that end at ``ends`` in ``data``; data has LENGTH bytes more.

    A window that runs over an end belongs to no document, and is left out of the choice.
    """
    with np.errstate(over="ignore"):
        h = gram_hashes(data, GRAM)[: len(data) - LENGTH + BEFORE + 1]
    low = np.maximum((h >> U(32)).astype(np.uint32), np.uint32(1))  # 0 marks windows that are left out
    width = BEFORE + 1
    least = sliding(low, width, np.minimum)
    whole = np.ones(len(least), bool)
    for e in ends:
        whole[max(0, e - LENGTH + 1) : e] = False
    whole[ends[-1] :] = False
    least = np.where(whole, least, np.uint32(0))
    none = np.zeros(width - 1, np.uint32)
    best = sliding(np.concatenate([none, least, none]), width, np.maximum)[: len(low)]
    chosen = np.flatnonzero((best == low) & (best > 0))
    return chosen, h[chosen]


def surroundings(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the bytes from lo to hi, by running sums of a polynomial."""
    up, down = Powers.to(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTERS[data] * up[:-1], dtype=np.uint64)])
        return mixed((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * ODD)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for so far."""

    base = 0x9E3779B97F4A7C15
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            one = np.ones(1 << (n - 1).bit_length(), np.uint64)
            one[1:] = U(cls.base)
            cls.up = np.multiply.accumulate(one)
            one[1:] = U(pow(cls.base, -1, 1 << 64))
            cls.down = np.multiply.accumulate(one)
        return cls.up[:n], cls.down[:n]


def records(kind, key, around, row, at, until) -> pa.RecordBatch:
    n = len(row)
    kinds = np.full(n, kind, np.int32) if np.isscalar(kind) else np.asarray(kind, np.int32)
    return pa.record_batch(
        [pa.array(kinds), pa.array(key.view(np.int64)), pa.array(around.view(np.int64)), pa.array(row), pa.array(at.astype(np.int32)), pa.array(until.astype(np.int32))],
        names=["kind", "key", "around", "row_id", "at", "until"],
    )


def joined_spans(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a row that touch or overlap become one."""
    order = np.lexsort((hi, lo, row))
    row, lo, hi = row[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(row):
        return row, lo, hi
    # the end reached so far in a row: rows are lifted apart so that one running maximum serves all
    fresh = np.append(True, row[1:] != row[:-1])
    lift = (np.cumsum(fresh) - 1) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + lift) - lift
    first = fresh | np.append(True, lo[1:] > reach[:-1])
    at = np.flatnonzero(first)
    return row[at], lo[at], np.maximum.reduceat(hi, at)


def anchored(rows: DataFrame) -> DataFrame:
    """Anchors with a hash of their surroundings, and spans that repeat inside a task; equal ones of a task combined."""

    def combine(parts):
        key, around, row, at, n = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((at, row, around, key))
        key, around, row, at, n = key[order], around[order], row[order], at[order], n[order]
        again = np.append(False, (key[1:] == key[:-1]) & (around[1:] == around[:-1])) if len(key) else np.zeros(0, bool)
        first = ~again
        yield records(ANCHOR, key[first], around[first], row[first], at[first], n[first])
        r, lo, hi = joined_spans(row[again], np.maximum(0, at[again] - BEFORE), at[again] + n[again])
        # spans pass through the shuffle by a key of their own
        yield records(SPAN, mixed(r.astype(np.uint64)), np.zeros(len(r), np.uint64), r, lo, hi)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            ids, texts = b.column(0).to_numpy(), b.column(1).cast(pa.binary()).fill_null(b"")
            bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            i = 0
            while i < len(ids):
                j = min(len(ids), max(i + 1, int(np.searchsorted(bounds, bounds[i] + CHUNK, "right")) - 1))
                data = np.concatenate([raw[bounds[i] : bounds[j]], np.zeros(LENGTH, np.uint8)])
                ends = bounds[i + 1 : j + 1] - bounds[i]
                at, key = anchors(data, ends)
                own = np.searchsorted(ends, at, "right")
                start = bounds[i + own] - bounds[i]
                end = ends[own] if len(own) else own
                lo = np.maximum(start, at - BEFORE)
                around = mixed(surroundings(data, lo, np.minimum(end, at + LENGTH)) ^ (at - lo).astype(np.uint64))
                parts.append((key, around, ids[i + own], at - start, np.minimum(end - at, LENGTH)))
                held += len(at)
                i = j
                if held > COMBINED:
                    yield from combine(parts)
                    parts, held = [], 0
        if parts:
            yield from combine(parts)

    return rows.select("row_id", "text").mapInArrow(work, ROW)


def first_surroundings(found: DataFrame, most: int = HELD) -> DataFrame:
    """Spans that repeat another surrounding in full, and requests for the text of anchors with several surroundings.

    Rows come sorted by anchor and surrounding, so a pass with one group's tail in hand sees each group whole. The
    request's ``until`` numbers the group's surroundings in parts of ``most``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_around = None, None  # of the row before
        count, waiting = 0, None  # surroundings of the anchor so far; the first one's request, while it is the only one
        for b in batches:
            kind, key, around, row, at, until = (b.column(k).to_numpy() for k in range(6))
            passing = kind == SPAN
            if passing.any():
                yield b.filter(pa.array(passing))
                keep = ~passing
                key, around, row, at, until = key[keep], around[keep], row[keep], at[keep], until[keep]
            if not len(key):
                continue
            same_key = np.append(last_key is not None and key[0] == last_key, key[1:] == key[:-1])
            same = same_key & np.append(last_around is not None and around[0] == last_around, around[1:] == around[:-1])
            r, lo, hi = joined_spans(row[same], np.maximum(0, at[same] - BEFORE), at[same].astype(np.int64) + until[same])
            if len(r):
                yield records(SPAN, np.zeros(len(r), np.uint64), np.zeros(len(r), np.uint64), r, lo, hi)
            new = np.flatnonzero(~same)
            if len(new):
                fresh = ~same_key[new]
                group = np.cumsum(fresh)  # 0: goes on from the batch before
                size = np.bincount(group, minlength=group[-1] + 1)
                begin = np.cumsum(size) - size
                number = np.arange(len(new)) - begin[group] + np.where(group == 0, count, 0)
                total = size[group] + np.where(group == 0, count, 0)
                asked = total > 1
                if waiting is not None and size[0]:
                    yield waiting
                waiting = None
                last = group == group[-1]
                if total[-1] == 1:
                    asked = asked & ~last
                ask = new[asked]
                if len(ask):
                    yield records(ASK, key[ask], np.zeros(len(ask), np.uint64), row[ask], at[ask], number[asked] // most)
                if total[-1] == 1:
                    i = new[-1:]
                    waiting = records(ASK, key[i], np.zeros(1, np.uint64), row[i], at[i], np.zeros(1, np.int64))
                count = int(total[-1])
            last_key, last_around = key[-1], around[-1]

    sorted_ = found.repartition("key").sortWithinPartitions("key", "around", "row_id", "at")
    return sorted_.mapInArrow(work, ROW)


def asked_texts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """key, part, hot, row_id, at, before (bytes before the anchor, the nearest first), after (bytes from it on)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, key, part, hot, place, before, after = [], [], [], [], [], [], []
            for i in np.flatnonzero(b.column(3).is_valid().to_numpy(zero_copy_only=False)).tolist():
                text = b.column(2)[i].as_py() or b""
                wanted = b.column(3)[i].values
                k, p, h, a = (wanted.field(n).to_pylist() for n in ("key", "until", "hot", "at"))
                key += k
                part += p
                hot += h
                place += a
                row += [i] * len(k)
                back = text[::-1]
                n = len(text)
                before += [back[n - x : n - x + BEFORE] for x in a]
                after += [text[x : x + LENGTH] for x in a]
            ids = b.column(0).take(pa.array(row, pa.int64()))
            yield pa.record_batch(
                [pa.array(key, pa.int64()), pa.array(part, pa.int32()), pa.array(hot, pa.bool_()), ids, pa.array(place, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                names=["key", "part", "hot", "row_id", "at", "before", "after"],
            )

    lists = asked.groupBy("row_id").agg(F.collect_list(F.struct("key", "until", "hot", "at")).alias("wanted"))
    return with_lists(rows, lists).mapInArrow(work, "key long, part int, hot boolean, row_id long, at int, before binary, after binary")


def with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """row_id, doc_id, text (bytes) and the row's list; the same left side each time, so its shuffle can serve twice."""
    texts = rows.select("row_id", "doc_id", F.col("text").cast("binary").alias("text"))
    return texts.join(lists.hint("merge"), "row_id", "left")


def fixed_width(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each value in a row of ``width``, zeros after it; lengths)."""
    bounds = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    size = np.diff(bounds)
    at = bounds[:-1, None] + np.arange(width)
    inside = np.arange(width) < size[:, None]
    padded = np.concatenate([raw, np.zeros(1, np.uint8)])
    return np.where(inside, padded[np.where(inside, at, len(raw))], 0).astype(np.uint8), size


def expand(group: np.ndarray, row: np.ndarray, at: np.ndarray, before: np.ndarray, nbefore: np.ndarray, after: np.ndarray, nafter: np.ndarray):
    """Repeated windows of anchors' surroundings: yields (members, places back from the anchor, first of its class?).

    ``group`` numbers the anchors; surroundings are in any order.
    """
    # the suffix array below the anchors: by anchor and by what follows it
    words = np.ascontiguousarray(np.pad(after, ((0, 0), (0, -after.shape[1] % 8)))).view(">u8")
    order = np.lexsort((*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group))
    a, g = after[order], group[order]
    common = np.zeros(len(order), np.int32)
    if len(order) > 1:
        differ = a[1:] != a[:-1]
        common[1:] = np.where(differ.any(1), differ.argmax(1), after.shape[1])
        n = nafter[order]
        common[1:] = np.minimum(common[1:], np.minimum(n[1:], n[:-1]))
        common[1:][g[1:] != g[:-1]] = 0
    interval = np.append(True, g[1:] != g[:-1]).cumsum() if len(order) else np.zeros(0, np.int64)
    member = order
    for back in range(BEFORE + 1):
        # intervals of one member end; so do runs of neighbours that are too short together, as each step adds one
        need = LENGTH - back
        starts = np.append(True, interval[1:] != interval[:-1]) if len(member) else np.zeros(0, bool)
        reach = np.where(starts, 0, common)
        hit = reach >= need
        if hit.any():
            tied = hit | np.append(hit[1:], False)
            classes = np.cumsum(~hit)[tied]
            own = member[tied]
            by = np.lexsort((at[own], row[own], classes))
            own, classes = own[by], classes[by]
            yield own, back, np.append(True, classes[1:] != classes[:-1])
        # a member stays while, with one neighbour, the most that may come before could make it LENGTH
        if back == BEFORE or not len(member):
            return
        alive = reach >= LENGTH - BEFORE
        stays = (alive | np.append(alive[1:], False)) & (nbefore[member] > back)
        # the least common prefix over dropped members carries on to the next that stays
        kept = np.flatnonzero(stays)
        if not len(kept):
            return
        low = np.minimum.reduceat(reach[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
        member, interval, reach = member[kept], interval[kept], low
        fresh = np.append(True, interval[1:] != interval[:-1])
        # backward extension: a stable order by interval and preceding byte
        byte = before[member, back].astype(np.int64)
        name = interval * 256 + byte
        step = np.argsort(name, kind="stable")
        common = carried(np.where(fresh, 0, reach), step, name)
        member, name = member[step], name[step]
        interval = np.append(True, name[1:] != name[:-1]).cumsum()


def carried(reach: np.ndarray, step: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Common prefixes after a step: the least over the members passed since the last one of the same name.

    Ranges of places are answered by a table of minima over powers of two.
    """
    place = step
    before = np.empty_like(place)
    before[0], before[1:] = -1, place[:-1]
    same = np.append(False, name[place[1:]] == name[place[:-1]]) if len(place) else np.zeros(0, bool)
    out = np.zeros(len(place), np.int32)
    lo, hi = before[same] + 1, place[same]
    if not len(lo):
        return out
    span = hi - lo + 1
    level = np.frexp(span.astype(float))[1] - 1
    result = np.empty(len(lo), np.int32)
    table, k = reach.astype(np.int32), 0
    top = int(level.max())
    while True:
        at = level == k
        if at.any():
            result[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
        if k == top:
            break
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1
    out[same] = result
    return out


def repeated_windows(texts: DataFrame) -> DataFrame:
    """Spans of windows that an earlier start repeats, and, for anchors dealt to several tasks, all their windows' hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(t: pa.Table):
            col = lambda n: pa.concat_arrays(t.column(n).chunks)
            key, part, row, at, hot = (col(n).to_numpy(zero_copy_only=False) for n in ("key", "part", "row_id", "at", "hot"))
            group = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])).cumsum()
            before, nbefore = fixed_width(col("before"), BEFORE)
            after, nafter = fixed_width(col("after"), LENGTH)
            rows, starts = [], []
            lost = {}
            for own, back, first in expand(group, row, at.astype(np.int64), before, nbefore, after, nafter):
                rows.append(row[own[~first]])
                starts.append(at[own[~first]] - back)
                if hot.any():
                    lost[back] = own[~first]
            if rows:
                r, s = np.concatenate(rows), np.concatenate(starts)
                r, lo, hi = joined_spans(r, s, s + LENGTH)
                yield r, lo, hi, np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
            some = np.flatnonzero(hot)
            for back in range(BEFORE + 1) if len(some) else ():
                own = some[(nbefore[some] >= back) & (nafter[some] >= LENGTH - back)]
                own = np.setdiff1d(own, lost.get(back, own[:0]))
                windows = [before[i, :back][::-1].tobytes() + after[i, : LENGTH - back].tobytes() for i in own]
                digest = np.array([np.frombuffer(hashlib.blake2b(w, digest_size=16).digest(), np.int64) for w in windows], np.int64).reshape(-1, 2)
                yield row[own], at[own].astype(np.int64) - back, at[own].astype(np.int64) - back + LENGTH, digest[:, 0], digest[:, 1]

        def out(t: pa.Table):
            for r, lo, hi, h1, h2 in solve(t):
                yield pa.record_batch([pa.array(r), pa.array(lo), pa.array(hi), pa.array(h1), pa.array(h2)], names=["row_id", "lo", "hi", "h1", "h2"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < HELD:
                continue
            t = pa.Table.from_batches(held)
            key, part = t.column("key").to_numpy(), t.column("part").to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
            if len(cut):
                n = int(cut[-1]) + 1
                yield from out(t.slice(0, n))
                held = t.slice(n).combine_chunks().to_batches()
        if held:
            yield from out(pa.Table.from_batches(held))

    sorted_ = texts.repartition("key", "part").sortWithinPartitions("key", "part")
    return sorted_.mapInArrow(work, "row_id long, lo long, hi long, h1 long, h2 long")


def removed_spans(rows: DataFrame, most: int = HELD) -> DataFrame:
    """row_id, lo, hi: byte ranges to remove; they may overlap."""
    found = written(first_surroundings(anchored(rows), most), "surroundings")
    asked = found.where(F.col("kind") == ASK).select("key", "row_id", "at", "until")
    hot = written(asked.where("until > 0").select("key").distinct().withColumn("hot", F.lit(True)), "hot")
    asked = asked.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    windows = repeated_windows(asked_texts(rows, asked))
    whole = found.where(F.col("kind") == SPAN).select("row_id", F.col("at").cast("long").alias("lo"), F.col("until").cast("long").alias("hi"))
    if not hot.limit(1).count():
        return whole.unionByName(windows.select("row_id", "lo", "hi"))
    windows = written(windows, "windows")
    spans = windows.where("h1 = 0 AND h2 = 0").select("row_id", "lo", "hi")
    # windows of anchors that several tasks shared: the earliest start of each stays
    dealt = windows.where("h1 <> 0 OR h2 <> 0")
    earliest = dealt.groupBy("h1", "h2").agg(F.min(F.struct("row_id", "lo")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    late = dealt.join(earliest, ["h1", "h2"]).where(F.struct("row_id", "lo") > F.col("first")).select("row_id", "lo", "hi")
    return whole.unionByName(spans).unionByName(late)


def without_repeats(docs: DataFrame, most: int = HELD) -> DataFrame:
    """row_id, doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans for every row of ``docs``."""
    rows, _ = with_row_ids(docs.select("doc_id", "text"))
    lists = removed_spans(rows, most).groupBy("row_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, size, gone, count = [], [], [], []
            for i in range(b.num_rows):
                text = b.column(2)[i].as_py() or b""
                spans, parts, at, n, removed = b.column(3)[i], [], 0, 0, 0
                if spans.is_valid:
                    lo, hi = (spans.values.field(k).to_numpy() for k in ("lo", "hi"))
                    _, lo, hi = joined_spans(np.zeros(len(lo), np.int64), lo, hi)
                    for x, y in zip(lo.tolist(), hi.tolist(), strict=True):
                        parts.append(text[at:x])
                        removed += y - x
                        n += 1
                        at = y
                parts.append(text[at:])
                kept.append(b"".join(parts))
                size.append(len(text))
                gone.append(removed)
                count.append(n)
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64())],
                names=["row_id", "doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return with_lists(rows, lists).mapInArrow(work, "row_id long, doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
