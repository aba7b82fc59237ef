"""Joins on time ranges, always through equal keys.

Time is cut into cells of ``days`` days and these are paired into blocks of 2, 4,
... up to 2^LEVELS cells.  An interval is covered by the fewest blocks that fit it,
each cell in one of them; an event lies in one block of each size.  Both meet on
(key, size, block) with the exact range test as a residual, so each pair that
matches meets exactly once, pairs tried in vain share at least the end cells, and a large key
is spread over the blocks of its time.  An open interval ends with the last event.

Both sides hold several rows for each of their source, which Spark's size estimates do
not count, so the pairs meet in a sort-merge join: a broadcast chosen by such an estimate
would hold a whole multiplied side in the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.operators.asof import asof_latest
from wardmill.operators.latest import top1
from wardmill.operators.ordered import Ordered, following, max_before


def cell(ts: Column, days: int) -> Column:
    epoch = F.lit("1970-01-01").cast("date")
    return F.floor(F.datediff(ts.cast("date"), epoch) / F.lit(days)).cast("int")


def closed_at(end: Column) -> Column:
    """Whether an interval ends; ends from the year 9000 on stand for "open" and are not cut into cells."""
    return F.coalesce(end.cast("timestamp_ntz") < F.lit("9000-01-01").cast("timestamp_ntz"), F.lit(False))


#: Blocks have up to 2^LEVELS cells.
LEVELS = 6


def _blocks(lo: Column, hi: Column) -> Column:
    """The blocks (level, place) that cover the cells ``lo`` to ``hi``, each cell once; null if there are none.

    A level has the aligned blocks between ``lo`` and ``hi`` that the next level does not cover: at most its first and
    its last. The highest level has all of its own.
    """
    ends = [(F.shiftright(lo + ((1 << k) - 1), k), F.shiftright(hi + 1, k) - 1) for k in range(LEVELS + 1)]
    block = lambda k, place: F.struct(F.lit(k).alias("level"), place.alias("place"))
    some = []
    for k in range(LEVELS):
        (first, last), (low, high) = ends[k], (2 * x for x in ends[k + 1])
        alone = low > high  # nothing on the next level
        some.append(F.when((first <= last) & (alone | (first < low)), block(k, first)))
        some.append(F.when((first < last) & (alone | (last > high + 1)), block(k, last)))
    first, last = ends[LEVELS]
    top = F.when(first <= last, F.transform(F.sequence(first, last), lambda x: block(LEVELS, x)))
    parts = [F.array_compact(F.array(*some)), F.coalesce(top, F.array().cast("array<struct<level:int,place:int>>"))]
    return F.when(lo <= hi, F.concat(*parts))


def _meeting(
    events: DataFrame, intervals: DataFrame, n: int, at: Column, start: str, end: str, last: Column, days: int, strict: bool = False, few: bool = True
) -> DataFrame:
    """Pairs of an event (``_wm_a0`` ...) and an interval (``_wm_b0`` ...) whose ``start`` to ``end`` holds the event's time.

    Both ends count, or with ``strict`` the end alone; an open interval ends at ``last``.  With ``few`` intervals beside
    the events their block sizes are looked up first, and an event gets a row only for sizes that occur.
    """
    begin, stop = F.col(start).cast("timestamp_ntz"), F.when(closed_at(F.col(end)), F.col(end).cast("timestamp_ntz")).otherwise(last)
    i = intervals.withColumns({"_wm_s": begin, "_wm_e": stop}).filter("_wm_s IS NOT NULL AND _wm_e IS NOT NULL")
    # the cells as columns of their own, so that each is worked out once
    i = i.withColumns({"_wm_lo": cell(F.col("_wm_s"), days), "_wm_hi": cell(F.col("_wm_e"), days)})
    i = i.withColumn("_wm_block", F.explode(_blocks(F.col("_wm_lo"), F.col("_wm_hi")))).drop("_wm_lo", "_wm_hi")
    i = i.select("*", F.col("_wm_block.level").alias("_wm_ilev"), F.col("_wm_block.place").alias("_wm_iplace")).drop("_wm_block")
    levels = i.select(F.array_sort(F.collect_set("_wm_ilev"))).scalar() if few else F.sequence(F.lit(0), F.lit(LEVELS))
    e = events.withColumn("_wm_at", at.cast("timestamp_ntz")).filter(F.col("_wm_at").isNotNull())
    e = e.select("*", cell(F.col("_wm_at"), days).alias("_wm_c"), F.explode(levels).alias("_wm_lev"))
    e = e.withColumn("_wm_place", F.expr("shiftright(_wm_c, _wm_lev)")).drop("_wm_c")
    inside = (F.col("_wm_at") > F.col("_wm_s") if strict else F.col("_wm_at") >= F.col("_wm_s")) & (F.col("_wm_at") <= F.col("_wm_e"))
    same = (F.col("_wm_lev") == F.col("_wm_ilev")) & (F.col("_wm_place") == F.col("_wm_iplace"))
    return e.join(i.hint("merge"), _keyed(n) & same & inside)


def _last(df: DataFrame, at: Column) -> Column:
    """The latest time in ``df``, as a subquery of its own."""
    return df.select(F.max(at.cast("timestamp_ntz"))).scalar()


def _keyed(n: int) -> Column:
    cond = F.lit(True)
    for i in range(n):
        cond = cond & (F.col(f"_wm_a{i}") == F.col(f"_wm_b{i}"))
    return cond


def join_containing(
    events: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    ts: str,
    start: str,
    end: str,
    columns: dict[str, str],
    ids: list[str] | None = None,
    latest_only: bool = False,
    tie: list[str] | None = None,
    how: str = "inner",
    days: int = 30,
) -> DataFrame:
    """Intervals that contain the event, both ends inclusive; a null end, or one from the year 9000 on, is open.

    ``latest_only`` keeps, per event (unique by ``ids``), the interval that starts
    last, ties by ``tie``; open intervals then contribute one candidate each
    through an as-of lookup.  A left join also needs ``ids``.
    """
    tie = tie or []
    started = intervals.filter(F.col(start).isNotNull())
    at = F.col(ts).cast("timestamp_ntz")
    outs = {**columns, "_wm_from": start, **{f"_wm_tie{i}": t for i, t in enumerate(tie)}}
    need = list(dict.fromkeys([*keys, *(ids or []), ts])) if (latest_only or how == "left") else events.columns
    ev = events.select(*need)

    met = started.filter(closed_at(F.col(end))) if latest_only else started
    met = met.select(
        *[F.col(k).alias(f"_wm_b{i}") for i, k in enumerate(keys)],
        F.col(start).alias("_wm_is"),
        F.col(end).alias("_wm_ie"),
        *[F.col(c).alias(f"_wm_{o}") for o, c in outs.items()],
    )
    marked = ev.withColumns({f"_wm_a{i}": F.col(k) for i, k in enumerate(keys)})
    pick = [F.col(f"_wm_{o}").alias(o) for o in outs]
    last = F.lit(None).cast("timestamp_ntz") if latest_only else _last(events, at)
    hits = _meeting(marked, met, len(keys), at, "_wm_is", "_wm_ie", last, days).select(*need, *pick)
    if latest_only:
        still = started.filter(~closed_at(F.col(end)))
        got = asof_latest(ev, still, keys, ts, start, outs, tie)
        got = got.filter(F.col("_wm_from").isNotNull())
        hits = hits.unionByName(got)
        hits = top1(hits, ids, ["-_wm_from", *[f"-_wm_tie{i}" for i in range(len(tie))]])
    hits = hits.drop("_wm_from", *[f"_wm_tie{i}" for i in range(len(tie))])
    if not (latest_only or how == "left"):
        return hits
    return events.join(hits.select(*ids, *columns), ids, how)


def join_overlap(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    a_span: tuple[str, str],
    b_span: tuple[str, str],
    columns: dict[str, str],
    days: int = 30,
) -> DataFrame:
    """Pairs of intervals of the same key that share at least one instant.

    Of such a pair the later start lies in the other interval: pairs where the
    second starts inside the first, and pairs where the first starts inside the
    second but not with it.  A null end, or one from the year 9000 on, is open.
    An interval that ends before its start shares nothing.
    """
    (s1, e1), (s2, e2) = a_span, b_span
    n = len(keys)
    real = lambda s, e: F.col(s).isNotNull() & (F.col(e).isNull() | (F.col(s) <= F.col(e)))
    left = a.filter(real(s1, e1)).withColumns({f"_wm_a{i}": F.col(k) for i, k in enumerate(keys)})
    left = left.withColumns({"_wm_ls": F.col(s1), "_wm_le": F.col(e1)})
    right = b.filter(real(s2, e2)).select(
        *[F.col(k).alias(f"_wm_b{i}") for i, k in enumerate(keys)],
        F.col(s2).alias("_wm_rs"),
        F.col(e2).alias("_wm_re"),
        *[F.col(c).alias(f"_wm_{o}") for o, c in columns.items()],
    )
    outs = [*a.columns, *[F.col(f"_wm_{o}").alias(o) for o in columns]]
    second = _meeting(right, left, n, F.col("_wm_rs"), "_wm_ls", "_wm_le", _last(b, F.col(s2)), days, few=False)
    first = _meeting(left, right, n, F.col("_wm_ls"), "_wm_rs", "_wm_re", _last(a, F.col(s1)), days, strict=True, few=False)
    return second.select(*outs).unionByName(first.select(*outs))


def overlap_flag(
    df: DataFrame, keys: list[str], start: str, end: str, order: list[str], name: str = "overlaps"
) -> DataFrame:
    """Whether another interval of the key strictly overlaps: one scan, no pairs.

    In start order an interval meets an earlier one if the largest end so far
    lies after its start, and a later one if the next start lies before its end.
    """
    far = F.coalesce(F.col(end).cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz"))
    o = Ordered(df, keys, [start, *order]).scan(
        _wm_reach=max_before(far), _wm_next=following(F.col(start).cast("timestamp_ntz"))
    )
    hit = F.coalesce(F.col("_wm_reach") > F.col(start), F.lit(False)) | F.coalesce(
        F.col("_wm_next") < far, F.lit(False)
    )
    return o.frame().withColumn(name, hit).drop("_wm_reach", "_wm_next")


def clip_days(start: Column, end: Column, lo: Column, hi: Column, now: Column) -> tuple[Column, Column, Column]:
    """Interval cut to a period and its length in days.

    Start is not before ``lo``.  An end after ``hi``, or an open one, becomes
    the day after the earlier of ``hi`` and ``now``.
    """
    ntz = lambda c: c.cast("timestamp_ntz")
    s = F.when(ntz(start) < ntz(lo), ntz(lo)).otherwise(ntz(start))
    capped = F.least(ntz(hi), ntz(now)) + F.expr("INTERVAL 1 DAY")
    e = F.when(end.isNull() | (ntz(end) > ntz(hi)), capped).otherwise(ntz(end))
    return s, e, F.datediff(e.cast("date"), s.cast("date"))


def months_touched(df: DataFrame, start: str, end: str, first, last, month: str = "month_start") -> DataFrame:
    """One row per interval and calendar month it touches within [first, last]."""
    first, last = (c if isinstance(c, Column) else F.lit(c).cast("date") for c in (first, last))
    lo = F.greatest(F.trunc(F.col(start), "MM"), F.trunc(first, "MM"))
    hi = F.least(F.coalesce(F.trunc(F.col(end), "MM"), F.trunc(last, "MM")), F.trunc(last, "MM"))
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")))
    return df.withColumn(month, F.explode(months))


