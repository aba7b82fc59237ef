"""Status rules, bands, flags and data-quality checks as column expressions and single passes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import minutes_between
from wardmill.operators.eav import Answer, pivot


def waterfall(rules: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """Value of the first rule that holds."""
    (c, v), *rest = rules
    out = F.when(c, v)
    for c, v in rest:
        out = out.when(c, v)
    return out if otherwise is None else out.otherwise(otherwise)


def greatest_or(cols: list[Column], default: Column | None = None) -> Column:
    """Latest of several values; nulls are ignored, ``default`` if all are null."""
    g = cols[0] if len(cols) == 1 else F.greatest(*cols)
    return g if default is None else F.coalesce(g, default)


def least_strict(cols: list[Column]) -> Column:
    """Least of several values, null if any is null (the source database's rule)."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & c.isNotNull()
    return F.when(ok, F.least(*cols))


def code_flags(df: DataFrame, column: str, flags: dict[str, list]) -> DataFrame:
    """1/0 column per code set."""
    return df.withColumns(
        {n: F.when(F.col(column).isin(list(codes)), 1).otherwise(0) for n, codes in flags.items()}
    )


def flags_by_table(df: DataFrame, key: str, members: DataFrame, code: str, flag: str, names: list[str]) -> DataFrame:
    """As ``code_flags`` for code sets kept in a (code, flag) table of any size."""
    sets = members.groupBy(F.col(code).alias("_wm_code")).agg(F.collect_set(flag).alias("_wm_flags"))
    out = df.join(sets, F.col(key) == F.col("_wm_code"), "left")
    for n in names:
        out = out.withColumn(n, F.coalesce(F.array_contains("_wm_flags", n), F.lit(False)).cast("int"))
    return out.drop("_wm_code", "_wm_flags")


def bands(column: Column, edges: list, labels: list) -> Column:
    """Label of the first edge the value is below; the last label is for the rest."""
    out = F.when(column < edges[0], labels[0])
    for e, lab in zip(edges[1:], labels[1:]):
        out = out.when(column < e, lab)
    return out.when(column.isNotNull(), labels[len(edges)])


def days_late(reference: Column, *due: Column) -> Column:
    """Days from the first known due date to ``reference``, never below zero."""
    return F.greatest(F.datediff(reference.cast("date"), F.coalesce(*due).cast("date")), F.lit(0))


def earliest_of(a: Column, b: Column) -> tuple[Column, Column]:
    """Earlier of two dates (null = never) and 1 if it was ``a``; equal dates go to ``b``."""
    a_first = F.coalesce(a < b, a.isNotNull() & b.isNull())
    return F.when(a_first, a).otherwise(b), F.when(a_first, 1).otherwise(0)


def active_at(start: Column, end: Column, now: Column) -> Column:
    """Started by ``now`` and not ended: no end, or an end after ``now``."""
    return (start <= now) & (end.isNull() | (end > now))


def change_class(latest: Column, prior: Column) -> Column:
    """How the latest value compares with the one before it."""
    return (
        F.when(latest.isNull() | prior.isNull(), F.lit(None).cast("string"))
        .when(latest > prior, "increased")
        .when(latest < prior, "decreased")
        .otherwise("unchanged")
    )


def session_minutes(
    log: DataFrame, login: str, kind: str, ts: str, login_type: str, logout_type: str, expired_type: str, idle: int = 30
) -> DataFrame:
    """Minutes of each login session.

    Logout minus login; without a logout, expiry minus login minus the idle
    time; if that is negative, without taking the idle time off.
    """
    at = F.col(ts)
    s = pivot(
        log,
        [login],
        {
            "login_ts": Answer(F.col(kind) == login_type, at, "min"),
            "logout_ts": Answer(F.col(kind) == logout_type, at, "max"),
            "expired_ts": Answer(F.col(kind) == expired_type, at, "max"),
        },
    ).filter(F.col("login_ts").isNotNull())
    out = minutes_between(F.col("login_ts"), F.col("logout_ts"))
    exp = minutes_between(F.col("login_ts"), F.col("expired_ts"))
    return s.withColumn(
        "active_minutes", F.coalesce(out, F.when(exp - idle < 0, exp).otherwise(exp - idle))
    )


@dataclass(frozen=True)
class Rule:
    """A data-quality rule over one table: ``scope`` rows are judged by ``violation``."""

    name: str
    table: str
    violation: Column
    scope: Column | None = None


def rule_summary(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Count, total and percent per rule with at least one violation.

    All rules of a table are counted in one pass over it.
    """
    out = None
    for t, df in tables.items():
        mine = [r for r in rules if r.table == t]
        if not mine:
            continue
        aggs = []
        for i, r in enumerate(mine):
            scope = F.lit(True) if r.scope is None else r.scope
            aggs.append(F.count(F.when(scope & r.violation, 1)).alias(f"_v{i}"))
            aggs.append(F.count(F.when(scope, 1)).alias(f"_n{i}"))
        one = df.agg(*aggs)
        rows = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.col(f"_v{i}").alias("violations"),
                        F.col(f"_n{i}").alias("total"),
                    )
                    for i, r in enumerate(mine)
                ]
            )
        )
        part = one.select(rows.alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    pct = F.round(F.col("violations") * 100.0 / F.col("total"), 1)
    return out.filter("violations > 0").withColumn("percent", pct)


def rule_details(df: DataFrame, rules: list[Rule], columns: list[str]) -> DataFrame:
    """One row per violated rule and row, in one pass over the table."""
    hits = F.array_compact(
        F.array(
            *[
                F.when((F.lit(True) if r.scope is None else r.scope) & r.violation, F.lit(r.name))
                for r in rules
            ]
        )
    )
    return df.select(*columns, F.explode(hits).alias("rule"))
