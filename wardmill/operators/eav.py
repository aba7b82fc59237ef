"""Observation rows to columns.

``obs`` is tall: one row per answer, its value in the column its concept calls
for.  ``pivot`` reads it once for any number of answers; the filter on the
concepts asked for reaches the scan.  Lists are sets of coded names, so their
size is bounded by the dictionary and partial aggregation keeps a very large
key small before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECENCY = ("date_created", "obs_id")


@dataclass(frozen=True)
class Answer:
    """How one output column is taken from the observations of a key.

    kind: ``latest`` / ``earliest`` row's value, ``max``, ``min``, ``sum``,
    ``count``, ``list`` (distinct values joined), ``only`` (the value if there is
    just one distinct) or ``any`` (1 if a row matches, null if the question was
    never asked).
    """

    where: Column
    value: Column | None = None
    kind: str = "latest"
    sep: str = " | "
    order: tuple[str, ...] = RECENCY


def answer_column(a: Answer) -> Column:
    v = a.value
    if a.kind in ("latest", "earliest"):
        pick = F.max_by if a.kind == "latest" else F.min_by
        return pick(v, F.when(a.where & v.isNotNull(), F.struct(*a.order)))
    if a.kind == "only":
        given = F.when(a.where, v)
        return F.when(F.min(given) == F.max(given), F.min(given))
    if a.kind == "list":
        return text_list(F.when(a.where, v), a.sep)
    if a.kind == "any":
        return F.max(F.when(a.where, v.cast("int")))
    if a.kind == "count":
        return F.count(F.when(a.where, v if v is not None else F.lit(1)))
    return {"max": F.max, "min": F.min, "sum": F.sum}[a.kind](F.when(a.where, v))


def text_list(value: Column, sep: str = " | ") -> Column:
    """Distinct non-null values in order, joined; null when there is none."""
    joined = F.array_join(F.array_sort(F.collect_set(value.cast("string"))), sep)
    return F.nullif(joined, F.lit(""))


def pivot(obs: DataFrame, keys: list[str], answers: dict[str, Answer], only: Column | None = None, dealt: bool = False) -> DataFrame:
    """One row per key with one column per answer, in a single aggregate.

    ``dealt``: the rows are dealt by key before they are aggregated. Spark sorts what it aggregates to texts and structs, so
    else each scanning task sorts all that it reads. For narrow rows of keys that have few rows each.
    """
    src = obs if only is None else obs.filter(only)
    src = src.repartition(*keys) if dealt else src
    return src.groupBy(*keys).agg(*[answer_column(a).alias(n) for n, a in answers.items()])


def coded_list(df: DataFrame, keys: list[str], value: str, sep: str = " | ", name: str = "values") -> DataFrame:
    return df.groupBy(*keys).agg(text_list(F.col(value), sep).alias(name))


def any_flag(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """1 if any row of the key has the flag, else 0; nulls count as 0."""
    return df.groupBy(*keys).agg(
        *[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in columns]
    )


def group_attr(
    obs: DataFrame, anchor: Column, anchor_columns: dict[str, str], group: str, answers: dict[str, Answer]
) -> DataFrame:
    """Each anchor observation with answers taken from its siblings in the same group."""
    heads = obs.filter(anchor).select(group, *[F.col(c).alias(o) for o, c in anchor_columns.items()])
    siblings = pivot(obs.filter(F.col(group).isNotNull()), [group], answers)
    return heads.join(siblings, group, "left")


def join_nonnull(cols: list[Column], sep: str = ",") -> Column:
    """Present values joined in column order; the separator never doubles or leads."""
    return F.concat_ws(sep, *cols)


def any_symptom(answers: list[Column], explicit: Column, yes: Column, no: Column) -> Column:
    """Explicit result if given; else yes if any symptom is yes, no if any was answered."""
    some_yes = F.greatest(*[F.coalesce((a == yes).cast("int"), F.lit(0)) for a in answers])
    some = F.coalesce(*answers).isNotNull()
    return F.coalesce(explicit, F.when(some_yes == 1, yes).when(some, no))
