"""As-of lookups at month ends: sources are cut to one row per key and month before they are scanned."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.test_sizes import driver_tables
from wardmill.catalog import registry
from wardmill.operators import asof, spine
from wardmill.operators.asof import Lookup
from wardmill.operators.ordered import KeyStats

AS_OF, SINCE = "2001-04-20", "2000-12-31"


def moment(i):
    """Days and moments around month ends, some null, before the first month and after the last."""
    base = [dt.datetime(2000, 5, 3), dt.datetime(2000, 12, 31), dt.datetime(2001, 1, 31), dt.datetime(2001, 2, 28), dt.datetime(2001, 3, 31), dt.datetime(2001, 6, 1)]
    return None if i % 11 == 5 else base[i % 6] + dt.timedelta(hours=(0, 10, 0, 30)[i % 4])


def enrolments(spark):
    day = lambda i: None if i % 5 == 0 else dt.date(2000, 11, 1) + dt.timedelta(days=17 * (i % 11))
    rows = [((None, "a", "b", "c")[i % 4], dt.date(2000, 8, 1) + dt.timedelta(days=23 * (i % 13)), day(i)) for i in range(60)]
    rows += [("d", None, None), ("d", dt.date(2001, 5, 1), None), ("e", dt.date(2001, 3, 5), dt.date(2001, 1, 1))]
    return spark.createDataFrame(rows, "k string, lo date, hi date")


def spans(df):
    return sorted(map(str, df.select("k", "lo", "hi", "reporting_date").collect()))


@pytest.mark.parametrize("after", [None, SINCE])
@pytest.mark.parametrize("shared", [2, 64])
def test_spans_share_the_rows_of_their_months(spark, monkeypatch, after, shared):
    monkeypatch.setattr(spine, "SHARED", shared)
    e = enrolments(spark)
    plain = spine.monthly_spine(e, "lo", "hi", AS_OF, after=after).distinct()
    months = spine.monthly_shared(e, ["k"], "lo", "hi", AS_OF, "own", after=after)
    assert spans(months.select("*", F.inline("own"))) == spans(plain)
    if shared == 64:
        assert months.count() == plain.select("k", "reporting_date").distinct().count() < plain.count()


def looked_up(spark):
    a = [((None, "a", "b", "c")[i % 4], i, moment(i), i % 3, None if i % 7 == 0 else f"v{i}") for i in range(200)]
    b = [(("a", "b", None)[i % 3], i, moment(i * 5)) for i in range(90)]
    a = spark.createDataFrame(a, "k string, id int, at timestamp_ntz, tie int, v string")
    b = spark.createDataFrame(b, "k string, id int, at timestamp_ntz").withColumn("day", F.to_date("at"))
    lookups = [
        Lookup(a, ["k"], "at", {"a_at": "at", "a_id": "id", "a_v": "v"}, ["tie", "id"]),
        Lookup(a, ["k"], "at", {"w_id": "id"}, ["tie", "id"], where=F.col("v").isNotNull() & (F.col("tie") == 1)),
        Lookup(b, ["k"], "day", {"b_id": "id"}, ["id"], where=F.col("id") % 2 == 0),
    ]
    return a, b, lookups


def both_ways(spark):
    left = spine.monthly_spine(enrolments(spark), "lo", "hi", AS_OF, after=SINCE)
    a, b, lookups = looked_up(spark)
    kinds = [left.schema["k"].dataType]
    sizes = KeyStats.of([asof.time_line(left, ["k"], "reporting_date", kinds), asof.time_line(a, ["k"], "at", kinds), asof.time_line(b, ["k"], "day", kinds)])
    plain = asof.asof_many(left, ["k"], "reporting_date", lookups, sizes)
    got = asof.asof_periods(left, ["k"], "reporting_date", lookups, lambda at: spine.month_end_from(at, AS_OF, SINCE), sizes)
    assert got.columns == plain.columns
    rows = sorted(map(str, plain.collect()))
    assert any("w_id=None" in r for r in rows) and any("w_id=1" in r for r in rows)
    assert sorted(map(str, got.collect())) == rows


def test_lookups_by_period_agree(spark):
    both_ways(spark)


def test_lookups_by_period_agree_on_large_keys(spark, force_skew):
    both_ways(spark)


def test_lookups_by_period_refuse_what_they_cannot_do(spark):
    a, _, lookups = looked_up(spark)
    left = spine.monthly_spine(enrolments(spark), "lo", "hi", AS_OF)
    for bad in (Lookup(a, ["k"], "at", {"x": "id"}, ["-id"]), Lookup(a, ["k"], "at", {"x": "id"}, strict=True)):
        with pytest.raises(ValueError):
            asof.asof_periods(left, ["k"], "reporting_date", [bad], lambda at: at, KeyStats(None))


def test_months_are_not_sorted_among_their_sources(spark, tmp_path):
    """All sources' rows and ties were sorted in one scan, on more than thirty columns."""
    folder = driver_tables(spark, tmp_path)
    plan = registry()["derive_hiv_monthly_reporting"].build(spark, folder)._jdf.queryExecution().executedPlan().toString()
    sorts = [len(re.findall(r" (?:ASC|DESC) NULLS ", line)) for line in plan.splitlines() if re.search(r"\bSort \[", line)]
    assert sorts and max(sorts) <= 4


def test_latest_between_of_several_lookups(spark):
    """One scan gives what a scan for each lookup gave; an open end is the moment of the report."""
    _, _, lookups = looked_up(spark)
    left = spark.createDataFrame(
        [(i, (None, "a", "b", "c")[i % 4], moment(i), None if i % 3 else moment(i + 2)) for i in range(40)], "n int, k string, lo timestamp_ntz, hi timestamp_ntz"
    )
    got = asof.latest_between_many(left, ["k"], "lo", "hi", lookups, AS_OF)
    assert got.columns == ["n", "k", "lo", "hi", "a_at", "a_id", "a_v", "w_id", "b_id"]
    for lk in lookups:
        one = asof.latest_between(left, lk.right, ["k"], "lo", "hi", lk.ts, lk.columns, AS_OF, lk.tie, where=lk.where)
        assert sorted(map(str, got.select(one.columns).collect())) == sorted(map(str, one.collect()))
        assert one.filter(F.col(one.columns[-1]).isNotNull()).count() > 0


def test_maternal_enrolments_are_counted_and_scanned_once(spark, tmp_path, monkeypatch):
    """Each of seven lookups counted its keys and joined the observations with the encounters again."""
    folder = driver_tables(spark, tmp_path)
    counted = []
    of = KeyStats.of
    monkeypatch.setattr(KeyStats, "of", staticmethod(lambda *a, **k: counted.append(1) or of(*a, **k)))
    plan = registry()["extract_mch_j9_data"].build(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert len(counted) == 1
    assert plan.count("last(_wm_v") <= 5
