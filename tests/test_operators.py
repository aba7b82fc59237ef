"""Edge cases on hand-made rows: ties, nulls, open ends, empty inputs, duplicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardmill.functions import dates as D
from wardmill.operators import asof, enrich, eav, intervals, latest, merge, rules, spine, tree


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_top1_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", None, 3)], "k string, t int, id int")
    assert rows(latest.top1(df, ["k"], ["-t", "-id"]), "k", "id") == [("a", 2), ("b", 3)]


def test_keep_latest_ties_keeps_equal_and_null_dates(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("a", None, 4)], "k string, t int, id int")
    assert rows(latest.keep_latest_ties(df, ["k"], "t"), "id") == [(2,), (3,), (4,)]


def test_window_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest.top1(df, ["k"], ["-id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_columns_first_null_stops(spark):
    df = spark.createDataFrame(
        [("a", None, 9), ("a", "x", 8), ("b", "x", 9), ("b", None, 8), ("b", "x", 7), ("b", "y", 6)], "k string, v string, o int"
    )
    got = latest.top_k_columns(df, ["k"], "v", ["-o"], 3, "d", first_null_stops=True)
    assert rows(got, "k", "d_1", "d_2", "d_3") == [("a", None, None, None), ("b", "x", "y", None)]


def test_asof_strict_inclusive_and_null_time(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 5), (4, "a", None)], "id int, k string, d int")
    right = spark.createDataFrame([("a", 3, 10), ("a", 5, 11), ("a", 5, 12), ("a", None, 99)], "k string, d int, v int")
    day = lambda df: df.withColumn("t", F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(d)"))
    args = (day(left), day(right), ["k"], "t", "t", {"v": "v"})
    assert rows(asof.asof_latest(*args, tie=["v"]), "id", "v") == [(1, 12), (2, 10), (3, None), (4, None)]
    assert rows(asof.asof_latest(*args, tie=["v"], strict=True), "id", "v") == [(1, 10), (2, None), (3, None), (4, None)]


def test_asof_on_split_keys(spark, force_skew):
    left = spark.range(40).selectExpr("id", "'hot' AS k", "timestamp_ntz'2020-01-01' + make_dt_interval(CAST(id AS INT)) AS t")
    right = spark.range(20).selectExpr("'hot' AS k", "id AS v", "timestamp_ntz'2020-01-01' + make_dt_interval(CAST(id * 2 AS INT)) AS t")
    got = asof.asof_latest(left, right, ["k"], "t", "t", {"v": "v"})
    assert rows(got, "id", "v") == sorted(((i, i // 2) for i in range(40)), key=str)


def test_count_within_is_inclusive(spark):
    left = spark.createDataFrame([(1, "a", ts("2020-01-01"), ts("2020-01-03")), (2, "a", ts("2020-01-04"), None), (3, "z", ts("2020-01-01"), None)], "id int, k string, lo timestamp_ntz, hi timestamp_ntz")
    right = spark.createDataFrame([("a", ts(f"2020-01-0{i}")) for i in (1, 3, 4, 5)], "k string, t timestamp_ntz")
    got = asof.count_within(left, ["id"], right, ["k"], "lo", "hi", "t", {"n": F.lit(True)}, "2020-02-01")
    assert rows(got, "id", "n") == [(1, 2), (2, 2), (3, 0)]


def test_containing_open_and_edges(spark):
    ev = spark.createDataFrame([(1, "a", ts("2020-01-01")), (2, "a", ts("2020-02-01")), (3, "a", ts("2021-06-01")), (4, "b", ts("2020-01-01"))], "id int, k string, t timestamp_ntz")
    iv = spark.createDataFrame(
        [("a", ts("2020-01-01"), ts("2020-02-01"), 10), ("a", ts("2020-01-15"), None, 11), ("a", ts("2020-03-01"), ts("2020-02-01"), 12)],
        "k string, s timestamp_ntz, e timestamp_ntz, v int",
    )
    all_pairs = intervals.join_containing(ev, iv, ["k"], "t", "s", "e", {"v": "v"})
    assert rows(all_pairs, "id", "v") == [(1, 10), (2, 10), (2, 11), (3, 11)]
    one = intervals.join_containing(ev, iv, ["k"], "t", "s", "e", {"v": "v"}, ["id"], True, ["v"], "left")
    assert rows(one, "id", "v") == [(1, 10), (2, 11), (3, 11), (4, None)]


def test_overlap_pairs_with_open_ends(spark):
    iv = spark.createDataFrame(
        [(1, "a", ts("2020-01-01"), ts("2020-01-10")), (2, "a", ts("2020-01-10"), None), (3, "a", ts("2020-02-01"), ts("2020-05-01")), (4, "b", ts("2020-01-01"), None)],
        "id int, k string, s timestamp_ntz, e timestamp_ntz",
    )
    got = intervals.join_overlap(iv, iv, ["k"], ("s", "e"), ("s", "e"), {"other": "id"}).filter("id < other")
    assert rows(got, "id", "other") == [(1, 2), (2, 3)]
    flags = intervals.overlap_flag(iv, ["k"], "s", "e", ["id"])
    assert rows(flags, "id", "overlaps") == [(1, False), (2, True), (3, True), (4, False)]


def test_clip_days_same_day_and_open(spark):
    df = spark.createDataFrame([(1, ts("2020-01-05T08:00"), ts("2020-01-05T20:00")), (2, ts("2019-12-30"), None)], "id int, s timestamp_ntz, e timestamp_ntz")
    _, _, d = intervals.clip_days(F.col("s"), F.col("e"), F.lit("2020-01-01").cast("date"), F.lit("2020-01-31").cast("date"), F.lit("2020-01-10T12:00").cast("timestamp_ntz"))
    assert rows(df.withColumn("d", d), "id", "d") == [(1, 0), (2, 10)]


def test_enrich_never_multiplies(spark):
    base = spark.createDataFrame([("a", "old"), ("b", "old"), (None, "old")], "k string, v string")
    src = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "k string, id int, w string")
    assert rows(enrich.enrich(base, src, ["k"], {"v": "w"}, ["-id"]), "k", "v") == [("a", "y"), ("b", "old"), (None, "old")]


@pytest.mark.parametrize("others, want", [([1, None], []), ([], [(1,), (2,), (None,)]), ([1], [(2,)])])
def test_not_in_follows_sql(spark, others, want):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    o = spark.createDataFrame([(x,) for x in others], "w int")
    assert rows(enrich.not_in(df, "v", o, "w"), "v") == sorted(want, key=str)


def test_pivot_lists_and_flags(spark):
    df = spark.createDataFrame([("a", 1, "x", 1, 1), ("a", 1, "y", 1, 2), ("a", 1, "x", 2, 3), ("b", 2, None, 1, 4)], "k string, q int, v string, date_created int, obs_id int")
    got = eav.pivot(df, ["k"], {"l": eav.Answer(F.col("q") == 1, F.col("v"), "list"), "last": eav.Answer(F.col("q") == 1, F.col("v"))})
    assert rows(got, "k", "l", "last") == [("a", "x | y", "x"), ("b", None, None)]


def test_join_nonnull_keeps_separator_over_a_gap(spark):
    df = spark.createDataFrame([("1", None, "3"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(eav.join_nonnull([F.col(x) for x in "abc"])).collect()] == ["1,3", ""]


def test_upsert_inserts_and_updates(spark):
    base = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id int, v string, w string")
    delta = spark.createDataFrame([(2, "B", "Q"), (3, "C", "R")], "id int, v string, w string")
    assert rows(merge.upsert(base, delta, ["id"], ["v"]), "id", "v", "w") == [(1, "a", "p"), (2, "B", "q"), (3, "C", "R")]


def test_nearest_tagged_ancestor(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (9, None)], "location_id int, parent_location int")
    tags = spark.createDataFrame([(1,), (3,)], "location_id int")
    assert rows(tree.tagged_ancestor(nodes, tags), "location_id", "ancestor_id") == [(1, 1), (2, 1), (3, 3), (4, 3), (9, None)]


def test_tagged_ancestor_is_found_however_deep(spark):
    nodes = spark.createDataFrame([(i, i + 1 if i < 40 else None) for i in range(41)], "location_id int, parent_location int")
    tags = spark.createDataFrame([(40,)], "location_id int")
    assert {r.ancestor_id for r in tree.tagged_ancestor(nodes, tags).collect()} == {40}
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 2)], "location_id int, parent_location int")
    with pytest.raises(ValueError, match="cycle"):
        tree.tagged_ancestor(ring, tags)
    assert {r.ancestor_id for r in tree.tagged_ancestor(ring, spark.createDataFrame([(3,)], "location_id int")).collect()} == {3}


def test_set_closure_depth(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (5, 6)], "p int, c int")
    roots = spark.createDataFrame([(1,)], "r int")
    assert [m for _, m in rows(tree.set_closure(e, "p", "c", roots, 4), "root", "member")] == [2, 3, 4, 5]


def test_calendar_rules(spark):
    c = spine.calendar(spine.days_between(spark, "2013-01-01", "2049-12-31"))
    assert c.count() == 13514 and len(c.columns) == 37
    day = {r["DateKey"]: r for r in c.filter("DateKey IN ('20160229', '20240527', '20241105', '20240118', '20240101', '20231231', '20230902')").collect()}
    assert day["20240527"]["HolidayUSA"] == "Memorial Day" and day["20241105"]["HolidayUSA"] == "Election Day"
    assert day["20240101"]["HolidayUK"] == "New Year's Day" and day["20240101"]["WeekOfYear"] == "1"
    assert day["20231231"]["WeekOfYear"] == "53" and day["20160229"]["DaySuffix"] == "29th"
    assert day["20230902"]["Fiscal_Quarter"] == "Q1" and not day["20230902"]["IsWeekday"]


def test_date_units_are_kept_apart(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), dt.date(2001, 1, 1))], "a date, b date")
    a, b = F.col("a"), F.col("b")
    r = df.select(D.years_crossed(a, b), D.complete_years(a, b), D.months_crossed(a, b), D.complete_months(a, b)).first()
    assert tuple(r) == (1, 0, 1, 0)


def test_bands_and_days_late(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "v int")
    assert [r[0] for r in df.select(rules.bands(F.col("v"), [10, 20], ["a", "b", "c"])).collect()] == ["a", "b", None]
    d = df.limit(1).select(rules.days_late(F.lit("2020-01-10"), F.lit(None).cast("date"), F.lit("2020-01-12").cast("date"))).first()[0]
    assert d == 0


def test_monthly_spine_empty_when_reversed(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 3, 1), dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 31), dt.date(2020, 2, 1))], "id int, s date, e date")
    got = spine.monthly_spine(df, "s", "e", "2020-12-31")
    assert rows(got, "id", "reporting_date") == [(2, dt.date(2020, 1, 31)), (2, dt.date(2020, 2, 29))]


def test_range_joins_broadcast_no_multiplied_side(spark):
    ev = spark.createDataFrame([("a", 1, ts("2020-01-05"))], "k string, id int, t timestamp_ntz")
    iv = spark.createDataFrame([("a", 7, ts("2020-01-01"), ts("2020-01-09"))], "k string, v int, s timestamp_ntz, e timestamp_ntz")
    pairs = intervals.join_overlap(iv, iv, ["k"], ("s", "e"), ("s", "e"), {"other": "v"})
    within = intervals.join_containing(ev, iv, ["k"], "t", "s", "e", {"v": "v"})
    for df in (pairs, within):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(pairs, "v", "other") == [(7, 7)] and rows(within, "id", "v") == [(1, 7)]


def test_rows_without_a_key_spread_over_tasks(spark):
    """A left join on a key that most rows lack leaves no task with all of them, and matches the same rows."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    dim = spark.range(0, 4000, 20).select(F.col("id").alias("d"), F.lit("x").alias("v"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = enrich.decode(df, dim, "k", "d", {"v": "v"}, ["id"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 1500 and sum(sizes) == 4000
        assert got.filter("v IS NOT NULL").count() == 200 and got.columns == ["id", "k", "v"]
        assert got.exceptAll(enrich.decode(df, dim, "k", "d", {"v": "v"})).isEmpty()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_rows_without_a_text_key_spread_too(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "7")], "id int, k string")
    dim = spark.createDataFrame([("a", 1), ("7", 2), (None, 3)], "d string, v int")
    assert rows(enrich.decode(df, dim, "k", "d", {"v": "v"}, ["id"]), "id", "v") == [(1, 1), (2, None), (3, None), (4, 2)]
