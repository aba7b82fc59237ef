"""Filters, decoding and enrichment joins.

No join here carries a broadcast hint: dimension tables are broadcast by Spark
when their measured size is under the session threshold and shuffled when not,
and adaptive execution splits a skewed side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.operators.eav import text_list
from wardmill.operators.latest import top1


def active(df: DataFrame, type_column: str | None = None, types: list | None = None) -> DataFrame:
    """Rows not voided, optionally of the given entity types."""
    out = df.filter(~F.coalesce(F.col("voided"), F.lit(False)))
    return out.filter(F.col(type_column).isin(list(types))) if types is not None else out


def exclude_flagged(df: DataFrame, flags: DataFrame, key: str, flag_key: str | None = None) -> DataFrame:
    """Drop the entities named in ``flags`` (test subjects)."""
    gone = flags.select(F.col(flag_key or key).alias("_wm_k")).filter("_wm_k is not null")
    return df.join(gone, F.col(key) == F.col("_wm_k"), "left_anti")


def semi(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_semi")


def anti(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """NOT EXISTS: a null key never matches, so its row stays."""
    return df.join(other.select(*keys), keys, "left_anti")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """NOT IN as SQL defines it.

    Empty list: every row stays.  A null in the list: no row stays.  Otherwise
    rows with a null value go.  The list's state is two values from one
    aggregate, attached by an outer join on a constant to a single row.
    """
    src = other.select(F.col(other_column).alias("_wm_v"))
    state = src.agg(
        F.count(F.lit(1)).alias("_wm_n"), F.max(F.col("_wm_v").isNull().cast("int")).alias("_wm_null")
    ).withColumn("_wm_one", F.lit(1))
    hits = src.filter("_wm_v is not null").distinct().withColumn("_wm_hit", F.lit(1))
    out = (
        df.withColumn("_wm_one", F.lit(1))
        .join(F.broadcast(state), "_wm_one")
        .join(hits, F.col(column) == F.col("_wm_v"), "left")
    )
    keep = (F.col("_wm_n") == 0) | (
        (F.col("_wm_null") == 0) & F.col("_wm_hit").isNull() & F.col(column).isNotNull()
    )
    return out.filter(keep).select(*df.columns)


#: Lots that rows without a key are dealt to.
LOTS = 30011


def decode(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str], dealt_by: list[str] | None = None
) -> DataFrame:
    """Left join of a dimension with a unique key; unmatched rows get nulls.

    ``dealt_by``: columns that tell rows apart, for a key that is null in many of them.
    """
    d = dim.select(F.col(dim_key).alias("_wm_k"), *[F.col(c).alias(o) for o, c in columns.items()])
    if dealt_by:
        return sparse_left(df, d, key, "_wm_k", dealt_by).drop("_wm_k")
    return df.join(d, F.col(key) == F.col("_wm_k"), "left").drop("_wm_k")


def sparse_left(df: DataFrame, right: DataFrame, key: str, right_key: str, dealt_by: list[str]) -> DataFrame:
    """Left join on a key, a number or a text, that is null in many rows.

    A shuffle takes all null keys to one task. A second key, which repeats the first, is a hash of ``dealt_by`` in
    those rows, so they spread over all tasks; they still match nothing.
    """
    lot = F.coalesce(F.col(key), F.pmod(F.xxhash64(*dealt_by), F.lit(LOTS)).cast(df.schema[key].dataType))
    on = (F.col(key) == F.col(right_key)) & (F.col("_wm_lot") == F.col(right_key))
    return df.withColumn("_wm_lot", lot).join(right, on, "left").drop("_wm_lot")


#: Where ``gathered`` rows are dealt to: their key, or a lot.
AT = "_wm_at"


def gathered(
    rows: DataFrame,
    key: str,
    lookups: dict[str, Callable[[DataFrame], DataFrame]],
    dealt_by: list[str] | None = None,
    scan: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``rows`` with all that is looked up for several of their columns, in one shuffle of the rows.

    Rows are dealt by ``key``, a number or a text; those without it by a hash of ``dealt_by``, else to one task. Each of ``lookups`` names a
    column; its function gets the distinct values of that column, dealt by it, each with every place (``AT``) that has rows of it if it is not
    the key, and returns them with more columns, as left or inner joins do. A value that it returns twice doubles its rows, a missing one and a null
    get nulls. What was found goes to the places in the shuffle of the rows and meets them in a window, so a place with very many rows and values
    costs a sort and no pairs. ``scan`` adds columns before that, with windows over ``AT`` and more; the rows of what was found, null in
    all else, run along. The column ``AT`` stays, for windows that follow.
    """
    lot = F.pmod(F.xxhash64(*dealt_by), F.lit(LOTS)) if dealt_by else F.lit(0)
    source = rows.withColumn(AT, F.coalesce(F.col(key), lot.cast(rows.schema[key].dataType)))
    # what neighbouring rows have in common side by side, so that it is compressed in one piece
    common = list(dict.fromkeys([AT, *lookups]))
    out = source.select(F.lit(-1).alias("_wm_kind"), *common, *[c for c in rows.columns if c not in common])
    added: dict[str, list[str]] = {}
    for i, (column, lookup) in enumerate(lookups.items()):
        if column == key:
            found = lookup(rows.select(key).filter(F.col(key).isNotNull()).distinct()).withColumn(AT, F.col(key))
        else:
            found = lookup(source.select(AT, column).filter(F.col(column).isNotNull()).repartition(column).distinct())
        added[column] = [c for c in found.columns if c not in (AT, column)]
        found = found.select(F.lit(i).alias("_wm_kind"), *dict.fromkeys([AT, column]), F.struct(*added[column]).alias(f"_wm_f{i}"))
        out = out.unionByName(found, allowMissingColumns=True)
    out = out.repartition(AT)
    if scan is not None:
        out = scan(out)
    names = [c for c in out.columns if not c.startswith("_wm_f") and c != "_wm_kind"]
    # the key's own values last: they are found by place alone, which needs no further sort
    for i, column in sorted(enumerate(lookups), key=lambda x: x[1] == key):
        met = F.collect_list(f"_wm_f{i}").over(Window.partitionBy(*([AT] if column == key else [AT, column])))
        met = F.when(F.col(key).isNotNull(), met) if column == key else met
        out = out.withColumn(f"_wm_f{i}", met).filter(F.col("_wm_kind") != i)
    for i, column in enumerate(lookups):
        names += added[column]
        rest = [f"_wm_f{j}" for j in range(i + 1, len(lookups))]
        out = out.select(*names[: len(names) - len(added[column])], *rest, F.inline_outer(f"_wm_f{i}"))
    return out


def enrich(
    df: DataFrame, src: DataFrame, on: list[str], values: dict[str, str], order: list[str]
) -> DataFrame:
    """Overwrite columns of ``df`` where ``src`` matches; never adds or drops rows.

    Several matches: the first in ``order`` is used.  No match: the old value
    stays (null for a new column).
    """
    one = top1(src, on, order).select(
        *on, F.lit(1).alias("_wm_hit"), *[F.col(c).alias(f"_wm_{o}") for o, c in values.items()]
    )
    out = df.join(one, on, "left")
    for o in values:
        old = F.col(o) if o in df.columns else F.lit(None)
        out = out.withColumn(o, F.when(F.col("_wm_hit") == 1, F.col(f"_wm_{o}")).otherwise(old))
    return out.drop("_wm_hit", *[f"_wm_{o}" for o in values])


def resolve_facility(
    df: DataFrame,
    visits: DataFrame,
    names: DataFrame,
    facilities: DataFrame,
    visit: str = "visit_id",
    location: str = "location_id",
    unknown: str = "Unknown Location",
    dealt_by: list[str] | None = None,
) -> DataFrame:
    """Visit location, encounter location and the facility they resolve to.

    ``names`` has location_id and location_name; ``facilities`` also has facility,
    the nearest ancestor tagged as a visit location.  ``dealt_by`` as in ``decode``,
    for rows without a visit.
    """
    out = decode(df, visits, visit, "visit_id", {"_wm_vl": "location_id"}, dealt_by)
    out = decode(out, names, "_wm_vl", "location_id", {"visit_location": "location_name"}, dealt_by)
    out = decode(
        out, facilities, location, "location_id", {"encounter_location": "location_name", "_wm_fac": "facility"}
    )
    return out.withColumn(
        "facility", F.coalesce(F.col("visit_location"), F.col("_wm_fac"), F.lit(unknown))
    ).drop("_wm_vl", "_wm_fac")


def surrogate_key(partition, column: Column, only_numeric: bool = False) -> Column:
    """``"<partition>-<id>"``; a null id gives a null key.

    With ``only_numeric`` the prefix is added only when the partition is all digits.
    """
    p = F.lit(str(partition))
    joined = F.concat(p, F.lit("-"), column.cast("string"))
    return F.when(p.rlike("^[0-9]+$"), joined).otherwise(column.cast("string")) if only_numeric else joined


def modifiers(obs: DataFrame, encounters: DataFrame, key: str = "encounter_id", sep: str = ",") -> DataFrame:
    """Other users, and the dates, that entered observations after the encounter's creator."""
    enc = encounters.select(key, F.col("creator").alias("_wm_creator"))
    other = obs.join(enc, key).filter(F.col("creator") != F.col("_wm_creator"))
    return other.groupBy(key).agg(
        text_list(F.col("creator_name"), sep).alias("users_modified"),
        text_list(F.to_date("date_created"), sep).alias("dates_modified"),
    )


def related(
    df: DataFrame, edges: DataFrame, key: str, near: str, far: str, order: list[str], name: str
) -> DataFrame:
    """One related entity per row over a relationship edge table (latest edge wins)."""
    one = top1(edges, [near], order).select(F.col(near).alias("_wm_k"), F.col(far).alias(name))
    return df.join(one, F.col(key) == F.col("_wm_k"), "left").drop("_wm_k")
