"""As-of lookups as one union and one ordered scan, never as pairs.

Left rows and every source are put on one time line per key; each left row then
takes the last known row of each source.  Any number of lookups share the same
shuffle and sort, and the row count never exceeds left + sources.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.operators.latest import top1
from wardmill.operators.ordered import KeyStats, Ordered, last_known, running_sum


@dataclass
class Lookup:
    """One source of an as-of join.

    ``columns`` maps output name to a column of ``right``; ``tie`` orders rows
    with the same time (the last in that order wins); ``strict`` asks for rows
    before, not at, the left time.
    """

    right: DataFrame
    keys: list[str]
    ts: str
    columns: dict[str, str]
    tie: list[str] = field(default_factory=list)
    strict: bool = False
    where: Column | None = None


def _time(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def time_line(df: DataFrame, keys: list[str], ts: str, types: list | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """A source for KeyStats.of whose keys and time meet those of other sources on one time line."""
    kinds = types or [df.schema[k].dataType for k in keys]
    names = [f"_wm_g{i}" for i in range(len(keys))]
    cols = [F.col(k).cast(t).alias(n) for k, t, n in zip(keys, kinds, names)]
    return df.select(*cols, _time(F.col(ts)).alias("_wm_ts")), names, ["_wm_ts"]


def _row(lk: Lookup) -> Column:
    return F.struct(*[F.col(c).alias(o) for o, c in lk.columns.items()])


def _where(lk: Lookup, value: Column) -> Column:
    return value if lk.where is None else F.when(lk.where, value)


def _shared(lookups: list[Lookup]) -> list[tuple[list[int], DataFrame]]:
    """The lookups, by number, that share one row per row of a source at the same time column, and that source's rows of use."""
    groups: dict[tuple, list[int]] = {}
    for n, lk in enumerate(lookups):
        groups.setdefault((id(lk.right), tuple(lk.keys), lk.ts, tuple(lk.tie), lk.strict), []).append(n)
    out = []
    for members in groups.values():
        lk = lookups[members[0]]
        src = lk.right.filter(F.col(lk.ts).isNotNull())
        wheres = [lookups[n].where for n in members]
        if all(w is not None for w in wheres):
            any_of = wheres[0]
            for w in wheres[1:]:
                any_of = any_of | w
            src = src.filter(any_of)
        out.append((members, src))
    return out


def asof_many(
    left: DataFrame, keys: list[str], ts: str, lookups: list[Lookup], left_sizes: DataFrame | KeyStats | None = None
) -> DataFrame:
    """All lookups of ``left`` at its own ``ts``; a left row without a match keeps nulls.

    ``left_sizes`` is a cheaper frame with the columns ``keys`` and ``ts`` on which
    the rows per key are counted when ``left`` is the end of a long plan, or the
    statistics of all sources of the job, made before from their ``time_line``.
    """
    types = {k: left.schema[k].dataType for k in keys}
    lines = left.select(
        *[F.col(k).alias(f"_wm_g{i}") for i, k in enumerate(keys)],
        _time(F.col(ts)).alias("_wm_ts"),
        F.lit(1).alias("_wm_side"),
        F.struct(*left.columns).alias("_wm_left"),
    )
    order = ["_wm_ts", "_wm_side"]
    groups = _shared(lookups)
    for g, (members, src) in enumerate(groups):
        lk = lookups[members[0]]
        ties = []
        for j, t in enumerate(lk.tie):
            name = f"_wm_t{g}_{j}"
            ties.append(F.col(t.lstrip("-")).alias(name))
            order.append(f"-{name}" if t.startswith("-") else name)
        payloads = [_where(lookups[n], _row(lookups[n])).alias(f"_wm_r{n}") for n in members]
        part = src.select(
            *[F.col(c).cast(types[k]).alias(f"_wm_g{i}") for i, (c, k) in enumerate(zip(lk.keys, keys))],
            _time(F.col(lk.ts)).alias("_wm_ts"),
            F.lit(2 if lk.strict else 0).alias("_wm_side"),
            *ties,
            *payloads,
        )
        lines = lines.unionByName(part, allowMissingColumns=True)
    steps = {f"_wm_s{n}": last_known(F.col(f"_wm_r{n}")) for n in range(len(lookups))}
    knames = [f"_wm_g{i}" for i in range(len(keys))]
    if isinstance(left_sizes, KeyStats):
        sizes = left_sizes
    else:
        kinds = [types[k] for k in keys]
        rights = {(id(lookups[m[0]].right), tuple(lookups[m[0]].keys), lookups[m[0]].ts): lookups[m[0]] for m, _ in groups}
        sizes = KeyStats.of(
            [time_line(left if left_sizes is None else left_sizes, keys, ts, kinds)]
            + [time_line(lk.right, lk.keys, lk.ts, kinds) for lk in rights.values()]
        )
    scanned = Ordered(lines, knames, order, sizes=sizes).scan(**steps).frame()
    outs = [F.col("_wm_left.*")]
    for n, lk in enumerate(lookups):
        outs += [F.col(f"_wm_s{n}.{o}").alias(o) for o in lk.columns]
    return scanned.filter("_wm_side = 1").select(*outs)


def asof_periods(
    left: DataFrame, keys: list[str], ts: str, lookups: list[Lookup], period: Callable[[Column], Column], sizes: KeyStats
) -> DataFrame:
    """``asof_many`` for left rows whose times are few for a key, such as month ends.

    ``period`` gives the first of these times at or after a source's time, null if there is none.  Only the last row of a
    source in a period can be an answer, so the sources meet in one aggregate per key and period, in one row for all lookups.
    These rows carry on what was known before, and the left rows look up them alone.  Ties run upwards and no lookup is strict;
    what ties hide (columns of rows equal in time and ties) is the greatest.
    """
    if any(lk.strict or t.startswith("-") for lk in lookups for t in (lk.tie or [""])):
        raise ValueError("lookups by period are neither strict nor have descending ties")
    knames = [f"_wm_g{i}" for i in range(len(keys))]
    types = [left.schema[k].dataType for k in keys]
    rows = None
    for members, src in _shared(lookups):
        lk = lookups[members[0]]
        known = [_time(F.col(lk.ts)).alias("ts"), *[F.col(t).alias(f"t{j}") for j, t in enumerate(lk.tie)]]
        part = src.select(
            *[F.col(c).cast(t).alias(k) for c, t, k in zip(lk.keys, types, knames)],
            period(_time(F.col(lk.ts))).alias("_wm_ts"),
            *[_where(lookups[n], F.struct(*known, _row(lookups[n]).alias("row"))).alias(f"_wm_r{n}") for n in members],
        ).filter(F.col("_wm_ts").isNotNull())
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    # dealt before they are sorted for the aggregate, unless a key is so large that scanning tasks had better cut it first
    rows = rows.repartition(*knames, "_wm_ts") if sizes.big is None else rows
    last = rows.groupBy(*knames, "_wm_ts").agg(*[F.max(f"_wm_r{n}")["row"].alias(f"_wm_r{n}") for n in range(len(lookups))])
    steps = {f"_wm_s{n}": last_known(F.col(f"_wm_r{n}")) for n in range(len(lookups))}
    carried = Ordered(last, knames, ["_wm_ts"], bounded=True).scan(**steps).frame()
    outs = {o: f"_wm_s{n}.{o}" for n, lk in enumerate(lookups) for o in lk.columns}
    return asof_many(left, keys, ts, [Lookup(carried, knames, "_wm_ts", outs)], sizes)


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    columns: dict[str, str],
    tie: list[str] | None = None,
    strict: bool = False,
    where: Column | None = None,
    right_keys: list[str] | None = None,
    left_sizes: DataFrame | KeyStats | None = None,
) -> DataFrame:
    """Last right row with ``right_ts <= left_ts`` (``<`` when strict)."""
    lk = Lookup(right, right_keys or keys, right_ts, columns, tie or [], strict, where)
    return asof_many(left, keys, left_ts, [lk], left_sizes)


def latest_at_or_after(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    columns: dict[str, str],
    tie: list[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Latest right row of the key, if it is at or after the left time.

    The latest row overall is the only candidate, so one row per key is joined.
    """
    src = right if where is None else right.filter(where)
    order = [f"-{right_ts}"] + [t[1:] if t.startswith("-") else f"-{t}" for t in (tie or [])]
    last = top1(src, keys, order).select(
        *keys, F.col(right_ts).alias("_wm_rts"), *[F.col(c).alias(f"_wm_{o}") for o, c in columns.items()]
    )
    ok = F.col("_wm_rts") >= F.col(left_ts)
    out = left.join(last, keys, "left")
    for o in columns:
        out = out.withColumn(o, F.when(ok, F.col(f"_wm_{o}")))
    return out.drop("_wm_rts", *[f"_wm_{o}" for o in columns])


def latest_between(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    lo: str,
    hi: str,
    right_ts: str,
    columns: dict[str, str],
    now,
    tie: list[str] | None = None,
    where: Column | None = None,
    sizes: KeyStats | None = None,
) -> DataFrame:
    """Latest right row with ``lo <= ts <= hi``; a null ``hi`` means ``now``.

    The last row up to ``hi`` is the answer if it is not before ``lo``; if it
    is, no row lies in the range.
    """
    lk = Lookup(right, keys, right_ts, columns, tie or [], where=where)
    return latest_between_many(left, keys, lo, hi, [lk], now, sizes)


def latest_between_many(
    left: DataFrame, keys: list[str], lo: str, hi: str, lookups: list[Lookup], now, sizes: KeyStats | None = None
) -> DataFrame:
    """``latest_between`` for all lookups in one scan."""
    left2 = left.withColumn("_wm_hi", F.coalesce(_time(F.col(hi)), _time(F.lit(now))))
    found = [replace(lk, columns={**{f"_wm_{o}": c for o, c in lk.columns.items()}, f"_wm_rts{n}": lk.ts}) for n, lk in enumerate(lookups)]
    got = asof_many(left2, keys, "_wm_hi", found, sizes)
    ok = [_time(F.col(f"_wm_rts{n}")) >= _time(F.col(lo)) for n in range(len(lookups))]
    return got.select(*left.columns, *[F.when(ok[n], F.col(f"_wm_{o}")).alias(o) for n, lk in enumerate(lookups) for o in lk.columns])


def coalesce_by_date(
    df: DataFrame, first: tuple[str, list[str]], second: tuple[str, list[str]], names: list[str]
) -> DataFrame:
    """Second source wins only if its date is earlier, or the first has none."""
    (d1, c1), (d2, c2) = first, second
    use2 = F.col(d2).isNotNull() & ((F.col(d2) < F.col(d1)) | F.col(d1).isNull())
    outs = [F.when(use2, F.col(b)).otherwise(F.col(a)).alias(n) for n, a, b in zip(names, [d1, *c1], [d2, *c2])]
    gone = {d1, d2, *c1, *c2}
    return df.select(*[c for c in df.columns if c not in gone], *outs)


def count_within(
    left: DataFrame,
    ids: list[str],
    right: DataFrame,
    keys: list[str],
    lo: str,
    hi: str,
    right_ts: str,
    counts: dict[str, Column],
    now,
    weight: Column | None = None,
    sizes: KeyStats | None = None,
) -> DataFrame:
    """Right rows inside each left row's ``[lo, hi]`` that meet each predicate, or the sum of their ``weight``.

    Counts are the difference of two running counts, so the work is one sort of
    left + right rows even when a key has very many of both.  ``ids`` identifies
    a left row.  ``sizes``: statistics made before, from the ``time_line`` of ``right`` and twice that of ``left``.
    """
    names = list(counts)
    zero = [F.lit(0).alias(f"_wm_n{i}") for i in range(len(names))]
    mark = [F.col(k).alias(f"_wm_g{i}") for i, k in enumerate(keys)]
    ident = F.struct(*ids).alias("_wm_id")
    events = right.filter(F.col(right_ts).isNotNull()).select(
        *mark,
        _time(F.col(right_ts)).alias("_wm_ts"),
        F.lit(1).alias("_wm_side"),
        *[F.when(p, F.lit(1) if weight is None else weight).otherwise(0).alias(f"_wm_n{i}") for i, p in enumerate(counts.values())],
    )
    start = left.select(*mark, _time(F.col(lo)).alias("_wm_ts"), F.lit(0).alias("_wm_side"), *zero, ident)
    stop = left.select(
        *mark, F.coalesce(_time(F.col(hi)), _time(F.lit(now))).alias("_wm_ts"), F.lit(2).alias("_wm_side"), *zero, ident
    )
    lines = events.unionByName(start, allowMissingColumns=True).unionByName(stop, allowMissingColumns=True)
    knames = [f"_wm_g{i}" for i in range(len(keys))]
    if sizes is None:
        kinds = [lines.schema[k].dataType for k in knames]
        sizes = KeyStats.of([time_line(right, keys, right_ts, kinds), (*time_line(left, keys, lo, kinds), 2)])
    scanned = (
        Ordered(lines, knames, ["_wm_ts", "_wm_side"], sizes=sizes)
        .scan(**{f"_wm_c{i}": running_sum(F.col(f"_wm_n{i}")) for i in range(len(names))})
        .frame()
        .filter("_wm_side <> 1")
    )
    signed = [
        F.greatest(
            F.sum(F.when(F.col("_wm_side") == 2, F.col(f"_wm_c{i}")).otherwise(-F.col(f"_wm_c{i}"))), F.lit(0)
        ).alias(n)
        for i, n in enumerate(names)
    ]
    totals = scanned.groupBy("_wm_id").agg(*signed).select("_wm_id.*", *names)
    return left.join(totals, ids, "left")
