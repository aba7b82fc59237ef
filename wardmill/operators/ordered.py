"""Per-key ordered scans that stay parallel when one key is very large.

Ordinals, previous/next values, run numbers and as-of lookups all need the rows
of a key in order.  A plain ``Window.partitionBy(key)`` puts a key in one task,
so a key that holds a third of the table would stop the job.  ``Ordered`` counts
the rows per key first (a partial aggregate over the key column alone).  If no
key is large the plan is the plain window.  Otherwise each large key is cut into
ranges of its order; the window then runs per (key, range) and
one small row per range carries the state over to the next range.

Every key above ``min_rows`` rows is cut, at quantiles of a sample of its own
order columns, so ranges hold about equally many rows whatever the columns' types
and however many rows share a leading value.  There are at most rows /
``min_rows`` large keys and about as many ranges; both are staged or joined by
measured size.

A job with many scans counts once: ``KeyStats.of`` takes all the job's sources
together, and is handed to each scan as ``sizes``.  Keys that are small in all
sources together are small in every scan of some of them, so no scan counts anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.sources.staging import staged

MIN_ROWS_CONF = "wardmill.skew.minRows"

_RANGE = "_wm_range"
_RN = "_wm_rn"
_CNT = "_wm_cnt"


def split_order(order: list[str]) -> list[tuple[str, bool]]:
    """``"-ts"`` means descending; returns (name, descending) pairs."""
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def order_columns(order: list[str]) -> list[Column]:
    """Sort columns with nulls lowest, as both source databases order them."""
    return [
        F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_first()
        for n, d in split_order(order)
    ]


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def lead_columns(order: list[str]) -> list[str]:
    """The leading order columns that run in one direction: ranges follow these."""
    pairs = split_order(order)
    first = next((i for i, (_, d) in enumerate(pairs) if d != pairs[0][1]), len(pairs))
    return [n for n, _ in pairs[:first]]


#: Sampled rows of a large key per range.
SAMPLED = 64


@dataclass(frozen=True)
class KeyStats:
    """Keys above the row limit, with cuts of their order between ranges of about equal numbers of rows.

    ``big``: ``_wm_k0`` ... and ``_wm_cuts``, an array of structs of the order columns, ascending; None if no key is large.
    A wrong count costs balance, never rows.
    """

    big: DataFrame | None
    width: int = 1

    @staticmethod
    def of(sources: list[tuple], more: int = 0) -> KeyStats:
        """One count over all ``sources``, each (frame, key columns, leading order columns) and maybe how often its rows count.

        Columns of different sources meet by place and must have one type.  ``more``: further rows that any key may
        have in a scan, such as one per month.
        """
        spark = sources[0][0].sparkSession
        limit = int(spark.conf.get(MIN_ROWS_CONF, "2000000")) - more
        width = min(len(s[2]) for s in sources)
        rows = None
        for df, keys, order, *times in sources:
            names = [F.col(k).alias(f"_wm_k{i}") for i, k in enumerate(keys)]
            part = df.select(*names, *[F.col(c).alias(f"_wm_l{i}") for i, c in enumerate(order[:width])], F.lit(times[0] if times else 1).alias("_wm_w"))
            rows = part if rows is None else rows.unionByName(part)
        keys = [f"_wm_k{i}" for i in range(len(sources[0][1]))]
        counts = rows.groupBy(*keys).agg(F.sum("_wm_w").alias("_wm_n")).filter(F.col("_wm_n") > limit)
        if counts.first() is None:
            return KeyStats(None, width)
        big = staged(counts, "large-keys")
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"{k}b"))
        named = big.select(*[F.col(k).alias(f"{k}b") for k in keys], "_wm_n")
        ranges = F.ceil(F.col("_wm_n") / F.lit(max(1, limit))) + 1
        lead = F.struct(*[F.col(f"_wm_l{i}") for i in range(width)])
        sample = rows.join(named, cond).filter(F.rand(7) * F.col("_wm_n") < SAMPLED * ranges * F.col("_wm_w"))
        sample = sample.groupBy(*[f"{k}b" for k in keys]).agg(F.array_sort(F.collect_list(lead)).alias("_wm_s"), F.max(ranges).cast("int").alias("_wm_r"))
        cuts = F.expr("array_distinct(transform(sequence(1, _wm_r - 1), i -> _wm_s[least(cast(i * size(_wm_s) div _wm_r as int), size(_wm_s) - 1)]))")
        return KeyStats(staged(sample.select(*[F.col(f"{k}b").alias(k) for k in keys], cuts.alias("_wm_cuts")), "cuts"), width)


@dataclass(frozen=True)
class Step:
    """One output of a scan: what to compute, over which column."""

    kind: str
    value: Column | None = None


def ordinal() -> Step:
    return Step("ordinal")


def ordinal_desc() -> Step:
    return Step("ordinal_desc")


def previous(value: Column) -> Step:
    return Step("previous", value)


def following(value: Column) -> Step:
    return Step("following", value)


def last_known(value: Column) -> Step:
    """Last non-null value up to and including the row."""
    return Step("last_known", value)


def running_sum(value: Column) -> Step:
    """Sum up to and including the row; over doubles the last digits depend on the order of addition, so pass decimals or
    whole numbers where they matter."""
    return Step("running_sum", value)


def max_before(value: Column) -> Step:
    """Maximum over the rows strictly before the row."""
    return Step("max_before", value)


@dataclass
class Ordered:
    """Rows of each key in order.  ``scan`` adds columns; ``frame`` returns the rows."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    bounded: bool = False
    """True when a key is known to be small (lines of one order): no key count is made."""
    sizes: DataFrame | KeyStats | None = None
    """Statistics made before, or a cheaper frame with the same keys and leading order column to count the keys on."""
    _split: bool | None = field(default=None, repr=False)

    def _prepared(self) -> tuple[DataFrame, bool]:
        if self._split is not None:
            return self.df, self._split
        lead = lead_columns(self.order)
        plain = self.df.withColumn(_RANGE, F.lit(None).cast("long"))
        if self.bounded:
            return plain, False
        stats = self.sizes
        if not isinstance(stats, KeyStats):
            src = self.df if stats is None else stats
            there = [c for c in lead if c in src.columns]
            there = lead[: next((i for i, c in enumerate(lead) if c not in there), len(lead))]
            stats = KeyStats.of([(src, self.keys, there)])
        if stats.big is None:
            return plain, False
        cond = F.lit(True)
        for i, k in enumerate(self.keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"_wm_k{i}"))
        kinds = stats.big.schema["_wm_cuts"].dataType.elementType.fields
        used = list(zip(lead, kinds))
        here = F.struct(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in used])
        cuts = F.transform("_wm_cuts", lambda c: F.struct(*[c[f.name].alias(f.name) for _, f in used]))
        big = stats.big.withColumn("_wm_cuts", F.array_distinct(cuts))
        ranged = self.df.withColumn("_wm_lead", here).join(big, cond, "left")
        # nulls sort lowest and NaN highest in structs as in the scans
        rng = F.expr("CASE WHEN _wm_cuts IS NOT NULL THEN cast(size(filter(_wm_cuts, c -> c < _wm_lead)) AS long) END")
        ranged = ranged.withColumn(_RANGE, rng).drop("_wm_lead", "_wm_cuts", *[f"_wm_k{i}" for i in range(len(self.keys))])
        return ranged, True

    def scan(self, **steps: Step) -> "Ordered":
        df, split = self._prepared()
        lead_desc = split_order(self.order)[0][1]
        local_all = Window.partitionBy(*self.keys, *([_RANGE] if split else []))
        local = local_all.orderBy(*order_columns(self.order))
        upto = local.rowsBetween(Window.unboundedPreceding, 0)
        before = local.rowsBetween(Window.unboundedPreceding, -1)

        kinds = {s.kind for s in steps.values()}
        need_cnt = bool(kinds & {"ordinal_desc", "following"})
        df = df.withColumn(_RN, F.row_number().over(local))
        if need_cnt:
            df = df.withColumn(_CNT, F.count(F.lit(1)).over(local_all))
        local_cols, values = [], []
        for i, s in enumerate(steps.values()):
            v = f"_wm_v{i}"
            if s.value is not None:
                values.append(s.value.alias(v))
        if values:
            df = df.select("*", *values)
        for i, s in enumerate(steps.values()):
            v, name = f"_wm_v{i}", f"_wm_o{i}"
            if s.kind == "ordinal":
                c = F.col(_RN)
            elif s.kind == "ordinal_desc":
                c = F.col(_CNT) - F.col(_RN) + 1
            elif s.kind == "previous":
                c = F.lag(v).over(local)
            elif s.kind == "following":
                c = F.lead(v).over(local)
            elif s.kind == "last_known":
                c = F.last(v, ignorenulls=True).over(upto)
            elif s.kind == "running_sum":
                c = F.sum(v).over(upto)
            elif s.kind == "max_before":
                c = F.max(v).over(before)
            else:
                raise ValueError(s.kind)
            local_cols.append(c.alias(name))
        df = df.select("*", *local_cols)
        if not split:
            cast = {"ordinal": "int", "ordinal_desc": "int"}
            outs = []
            for i, (n, s) in enumerate(steps.items()):
                c = F.col(f"_wm_o{i}")
                outs.append((c.cast(cast[s.kind]) if s.kind in cast else c).alias(n))
            return Ordered(df.select(*self._kept(), *outs), self.keys, self.order, _split=False)

        # one row per range of a large key, with the state the range hands on
        aggs = [F.count(F.lit(1)).alias("_wm_rows")]
        for i, s in enumerate(steps.values()):
            v, a = f"_wm_v{i}", f"_wm_a{i}"
            if s.kind == "previous":
                aggs.append(F.max_by(v, _RN).alias(a))
            elif s.kind == "following":
                aggs.append(F.min_by(v, _RN).alias(a))
            elif s.kind == "last_known":
                aggs.append(F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(_RN))).alias(a))
            elif s.kind == "running_sum":
                aggs.append(F.sum(v).alias(a))
            elif s.kind == "max_before":
                aggs.append(F.max(v).alias(a))
        ranges = df.filter(F.col(_RANGE).isNotNull()).groupBy(*self.keys, _RANGE).agg(*aggs)
        rorder = F.col(_RANGE).desc() if lead_desc else F.col(_RANGE).asc()
        rw = Window.partitionBy(*self.keys).orderBy(rorder)
        rbefore = rw.rowsBetween(Window.unboundedPreceding, -1)
        rafter = rw.rowsBetween(1, Window.unboundedFollowing)
        carry = []
        for i, s in enumerate(steps.values()):
            a, c = f"_wm_a{i}", f"_wm_c{i}"
            if s.kind == "ordinal":
                carry.append(F.sum("_wm_rows").over(rbefore).alias(c))
            elif s.kind == "ordinal_desc":
                carry.append(F.sum("_wm_rows").over(rafter).alias(c))
            elif s.kind == "previous":
                carry.append(F.lag(a).over(rw).alias(c))
            elif s.kind == "following":
                carry.append(F.lead(a).over(rw).alias(c))
            elif s.kind == "last_known":
                carry.append(F.last(a, ignorenulls=True).over(rbefore).alias(c))
            elif s.kind == "running_sum":
                carry.append(F.sum(a).over(rbefore).alias(c))
            elif s.kind == "max_before":
                carry.append(F.max(a).over(rbefore).alias(c))
        carried = ranges.select(
            *[F.col(k).alias(f"_wm_k{i}") for i, k in enumerate(self.keys)],
            F.col(_RANGE).alias("_wm_krange"),
            *carry,
        )
        cond = F.col(_RANGE) == F.col("_wm_krange")
        for i, k in enumerate(self.keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"_wm_k{i}"))
        df = df.join(carried, cond, "left")
        outs = []
        for i, (name, s) in enumerate(steps.items()):
            o, c = F.col(f"_wm_o{i}"), F.col(f"_wm_c{i}")
            if s.kind in ("ordinal", "ordinal_desc"):
                v = (o + F.coalesce(c, F.lit(0))).cast("int")
            elif s.kind == "previous":
                v = F.when((F.col(_RN) == 1) & F.col("_wm_krange").isNotNull(), c).otherwise(o)
            elif s.kind == "following":
                v = F.when((F.col(_RN) == F.col(_CNT)) & F.col("_wm_krange").isNotNull(), c).otherwise(o)
            elif s.kind == "last_known":
                v = F.coalesce(o, c)
            elif s.kind == "running_sum":
                v = F.when(o.isNull(), c).when(c.isNull(), o).otherwise(o + c)
            else:
                v = F.greatest(o, c)
            outs.append(v.alias(name))
        return Ordered(df.select(*self._kept(), *outs), self.keys, self.order, _split=True)

    def _kept(self) -> list[Column]:
        cols = [c for c in self.df.columns if c != _RANGE]
        return [F.col(c) for c in cols] + [F.col(_RANGE)]

    def frame(self) -> DataFrame:
        return self.df.drop(_RANGE)


def index_pair(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    names: tuple[str, str] = ("index_asc", "index_desc"),
    bounded: bool = False,
    sizes: DataFrame | KeyStats | None = None,
) -> DataFrame:
    """Ordinal from the start and from the end of each key.

    ``order`` should end in a unique column: the reference joins some ordinals
    back by date only, which leaves ties arbitrary, and that is not reproduced.
    """
    o = Ordered(df, keys, order, bounded, sizes)
    return o.scan(**{names[0]: ordinal(), names[1]: ordinal_desc()}).frame()


def run_index(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "run_index", sizes: DataFrame | KeyStats | None = None
) -> DataFrame:
    """Run number per key: grows by one whenever ``value`` differs from the row before."""
    return _runs(df, keys, order, value, name, sizes).frame()


def run_pair(
    df: DataFrame, keys: list[str], order: list[str], value: str, names: tuple[str, str], sizes: DataFrame | KeyStats | None = None
) -> DataFrame:
    """Run number from the start and from the end of each key; keys must not be null."""
    up = run_index(df, keys, order, value, names[0], sizes)
    last = up.groupBy(*keys).agg(F.max(names[0]).alias("_wm_last"))
    return up.join(last, keys, "left").withColumn(names[1], F.col("_wm_last") - F.col(names[0]) + 1).drop("_wm_last")


def _runs(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, sizes: DataFrame | KeyStats | None = None
) -> Ordered:
    o = Ordered(df, keys, order, sizes=sizes).scan(
        _wm_prev=previous(F.struct(F.col(value).alias("v"))),
    )
    changed = F.when(
        F.col("_wm_prev").isNull() | ~F.col("_wm_prev.v").eqNullSafe(F.col(value)), 1
    ).otherwise(0)
    o = o.scan(**{name: running_sum(changed)})
    out = o.df.drop("_wm_prev").withColumn(name, F.col(name).cast("int"))
    return Ordered(out, o.keys, o.order, _split=o._split)


def run_start(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    ts: str,
    name: str = "run_start",
    index: str = "run_index",
    sizes: DataFrame | KeyStats | None = None,
) -> DataFrame:
    """Run number plus the ``ts`` of the first row of the current run."""
    o = Ordered(df, keys, order, sizes=sizes).scan(_wm_prev=previous(F.struct(F.col(value).alias("v"))))
    first = F.col("_wm_prev").isNull() | ~F.col("_wm_prev.v").eqNullSafe(F.col(value))
    o = o.scan(
        **{
            index: running_sum(F.when(first, 1).otherwise(0)),
            "_wm_start": last_known(F.when(first, F.struct(F.col(ts).alias("v")))),
        }
    )
    return (
        o.frame()
        .withColumn(index, F.col(index).cast("int"))
        .withColumn(name, F.col("_wm_start.v"))
        .drop("_wm_prev", "_wm_start")
    )


def episodes(
    df: DataFrame, keys: list[str], ts: str, order: list[str], end: str = "end_ts", sizes: DataFrame | KeyStats | None = None
) -> DataFrame:
    """Each row lasts until the next row of its key; the last one stays open."""
    return Ordered(df, keys, order, sizes=sizes).scan(**{end: following(F.col(ts))}).frame()


def ever_before(
    df: DataFrame, keys: list[str], order: list[str], predicate: Column, name: str = "ever_before", sizes: DataFrame | KeyStats | None = None
) -> DataFrame:
    """1 if an earlier row of the key meets ``predicate``, else 0."""
    o = Ordered(df, keys, order, sizes=sizes).scan(_wm_seen=max_before(F.when(predicate, 1).otherwise(0)))
    return o.frame().withColumn(name, F.coalesce(F.col("_wm_seen"), F.lit(0))).drop("_wm_seen")


def lag_attr(
    df: DataFrame, keys: list[str], order: list[str], sizes: DataFrame | KeyStats | None = None, **columns: Column
) -> DataFrame:
    """Values of the row one ordinal earlier, under new names."""
    return Ordered(df, keys, order, sizes=sizes).scan(**{n: previous(c) for n, c in columns.items()}).frame()
