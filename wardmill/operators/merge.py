"""Unions, upserts and duplicate merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.operators.latest import top1


def union_rows(parts: list[DataFrame], distinct: bool = False) -> DataFrame:
    """Rows of all parts by column name; a column missing in a part is null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.distinct() if distinct else out


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Insert new keys; for known keys overwrite the ``update`` columns.

    ``delta`` must be unique per key.
    """
    d = delta.select(*[F.col(c).alias(f"_wm_{c}") for c in delta.columns], F.lit(True).alias("_wm_new"))
    b = base.withColumn("_wm_old", F.lit(True))
    cond = reduce(lambda x, y: x & y, [b[k] == d[f"_wm_{k}"] for k in keys])
    joined = b.join(d, cond, "full_outer")
    cols = []
    for c in base.columns:
        new = F.col(f"_wm_{c}") if c in delta.columns else F.lit(None).cast(base.schema[c].dataType)
        if c in update:
            v = F.when(F.col("_wm_new"), new).otherwise(F.col(c))
        else:
            v = F.when(F.col("_wm_old"), F.col(c)).otherwise(new)
        cols.append(v.alias(c))
    return joined.select(*cols)


def dedup_merge(
    df: DataFrame, keys: list[str], flags: list[str], ts: str, columns: list[str], tie: list[str]
) -> DataFrame:
    """One row per key: flags are ORed over all rows, the rest comes from the latest row."""
    best = F.struct(F.col(ts), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)], *[
        F.col(c) for c in columns if c != ts
    ])
    return (
        df.groupBy(*keys)
        .agg(
            *[F.max(F.coalesce(F.col(f).cast("int"), F.lit(0))).alias(f) for f in flags],
            F.max(best).alias("_wm_best"),
        )
        .select(*keys, *flags, *[F.col(f"_wm_best.{c}").alias(c) for c in dict.fromkeys([ts, *columns])])
    )


def dedup_by_ref(
    df: DataFrame,
    keys: list[str],
    flags: list[str],
    ref: DataFrame,
    match: list[str],
    columns: list[str],
    order: list[str],
) -> DataFrame:
    """Flags ORed per key; other columns from the row whose ``match`` columns agree with ``ref``.

    A key that ``ref`` does not know keeps nulls.
    """
    ored = df.groupBy(*keys).agg(
        *[F.max(F.coalesce(F.col(f).cast("int"), F.lit(0))).alias(f) for f in flags]
    )
    rows = df.join(ref.select(*keys, *match), [*keys, *match], "left_semi")
    chosen = top1(rows, keys, order).select(*keys, *match, *[c for c in columns if c not in match])
    return ored.join(chosen, keys, "left")


def row_id(df: DataFrame, columns: list[str], name: str = "row_id") -> DataFrame:
    """Stable 128-bit id of the identifying columns: the same row gets the same id on a retry.

    Columns are told apart by a separator and nulls by a mark of their own, both outside ordinary text.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return df.withColumn(name, F.md5(F.concat_ws(chr(31), *parts)))
