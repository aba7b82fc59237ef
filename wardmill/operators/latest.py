"""First, latest and n-th row per key.

Every form filters a ranking window by a small constant, which lets Spark cut
each map task to the first rows of a key before the shuffle (window group
limit).  A very large key therefore sends only a few rows to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.operators.ordered import Ordered, order_columns, running_sum


def _ranked(df: DataFrame, keys: list[str], order: list[str], rank: Column) -> DataFrame:
    return df.withColumn("_wm_rank", rank.over(Window.partitionBy(*keys).orderBy(*order_columns(order))))


def top1(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; end ``order`` in a unique column."""
    return _ranked(df, keys, order, F.row_number()).filter("_wm_rank = 1").drop("_wm_rank")


def top_n(df: DataFrame, keys: list[str], order: list[str], n: int, name: str = "position") -> DataFrame:
    """The first ``n`` rows of each key with their position."""
    return (
        _ranked(df, keys, order, F.row_number())
        .filter(F.col("_wm_rank") <= n)
        .withColumnRenamed("_wm_rank", name)
    )


def nth(df: DataFrame, keys: list[str], order: list[str], offset: int) -> DataFrame:
    """The row at ``offset`` (0 = first) of each key; keys with fewer rows are absent."""
    return (
        _ranked(df, keys, order, F.row_number())
        .filter(F.col("_wm_rank") == offset + 1)
        .drop("_wm_rank")
    )


def nth_distinct(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """The n-th latest distinct ``value`` of each key."""
    return nth(df.select(*keys, value).distinct(), keys, [f"-{value}"], n - 1)


def keep_latest_ties(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Drop a row only if the key has a strictly later one: ties and null dates stay."""
    kept = _ranked(df.filter(F.col(ts).isNotNull()), keys, [f"-{ts}"], F.rank())
    return kept.filter("_wm_rank = 1").drop("_wm_rank").unionByName(df.filter(F.col(ts).isNull()))


def agg_lookup(df: DataFrame, src: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Left join of per-key aggregates (a correlated min/max as one aggregate)."""
    return df.join(src.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]), keys, "left")


def rank_by_count(df: DataFrame, keys: list[str], value: str, name: str = "rank") -> DataFrame:
    """1 + number of rows of the key with a lower value, from counts per distinct value."""
    per_value = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_wm_n"))
    ranks = (
        Ordered(per_value, keys, [value])
        .scan(_wm_cum=running_sum(F.col("_wm_n")))
        .frame()
        .select(*keys, value, (F.col("_wm_cum") - F.col("_wm_n") + 1).cast("int").alias(name))
    )
    return df.join(ranks, [*keys, value], "left")


def first_flag(df: DataFrame, keys: list[str], ts: str, name: str = "is_first") -> DataFrame:
    """True when no row of the same key is earlier; rows that tie for first are all true."""
    first = df.groupBy(*keys).agg(F.min(ts).alias("_wm_first"))
    return (
        df.join(first, keys, "left")
        .withColumn(name, F.col(ts) == F.col("_wm_first"))
        .drop("_wm_first")
    )


def month_latest(
    df: DataFrame, keys: list[str], ts: str, columns: list[str], tie: str, month: str = "month_end"
) -> DataFrame:
    """Latest row per key and calendar month in one aggregate, without a join back."""
    packed = F.struct(F.col(ts), F.col(tie), *[F.col(c) for c in columns if c not in (ts, tie)])
    return (
        df.withColumn(month, F.last_day(F.col(ts)))
        .groupBy(*keys, month)
        .agg(F.max(packed).alias("_wm_row"))
        .select(*keys, month, *[F.col(f"_wm_row.{c}").alias(c) for c in dict.fromkeys([ts, tie, *columns])])
    )


def top_k_columns(
    df: DataFrame, keys: list[str], value: str, order: list[str], k: int = 3, prefix: str | None = None,
    extra: list[str] | None = None, first_null_stops: bool = False,
) -> DataFrame:
    """First ``k`` distinct values per key in ``order``, spread into columns 1..k.

    ``extra`` columns of the row that won each place come along as ``<extra>_i``.
    With ``first_null_stops`` a key whose very first row has no value gets no
    values at all, as when each next value is searched by ``<> first``.
    """
    prefix = prefix or value
    extra = extra or []
    src = df if first_null_stops else df.filter(F.col(value).isNotNull())
    best = top1(src, [*keys, value], order)
    placed = top_n(best, keys, order, k + 1 if first_null_stops else k, "_wm_place")
    row = F.struct("_wm_place", F.col(value).alias("_wm_value"), *extra)
    # at most k + 1 rows per key are collected
    got = placed.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_wm_rows"))
    if first_null_stops:
        none = F.slice("_wm_rows", 1, 0)
        present = F.filter("_wm_rows", lambda r: r["_wm_value"].isNotNull())
        got = got.withColumn(
            "_wm_rows", F.when(F.col("_wm_rows")[0]["_wm_value"].isNull(), none).otherwise(present)
        )
    cols = []
    for i in range(1, k + 1):
        r = F.get("_wm_rows", F.lit(i - 1))
        cols.append(r["_wm_value"].alias(f"{prefix}_{i}"))
        cols += [r[e].alias(f"{e}_{i}") for e in extra]
    return got.select(*keys, *cols)


def argmax_sources(
    base: DataFrame, key: str, sources: dict[str, tuple[DataFrame, str]], name: str, smallest: bool = False
) -> DataFrame:
    """Latest (or earliest) date over one row per key in several tables, and its source.

    On equal dates the source named first wins.
    """
    out = base
    for s, (df, ts) in sources.items():
        out = out.join(df.select(key, F.col(ts).alias(f"_wm_{s}")), key, "left")
    cols = [F.col(f"_wm_{s}") for s in sources]
    best = cols[0] if len(cols) == 1 else (F.least(*cols) if smallest else F.greatest(*cols))
    which = F.lit(None).cast("string")
    for s in reversed(list(sources)):
        which = F.when(F.col(f"_wm_{s}") == best, F.lit(s)).otherwise(which)
    return (
        out.withColumn(name, best).withColumn(f"{name}_source", which).drop(*[f"_wm_{s}" for s in sources])
    )


def freshness(tables: dict[str, tuple[DataFrame, list[str], str]], keys: list[str]) -> DataFrame:
    """Latest timestamp of each table per key as one row with one column per table.

    Each table is reduced to one row per key before the union, so the pivot sees
    only (tables x keys) rows.
    """
    parts = None
    for name, (df, cols, ts) in tables.items():
        part = (
            df.select(*[F.col(c).cast("string").alias(k) for c, k in zip(cols, keys)], F.col(ts).alias("_wm_ts"))
            .groupBy(*keys)
            .agg(F.max("_wm_ts").alias("_wm_ts"))
            .withColumn("_wm_table", F.lit(name))
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_wm_table") == n, F.col("_wm_ts"))).alias(n) for n in tables]
    )
