"""The split scan of a large key gives the same rows as a plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmill.operators import ordered as O


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for i in range(400):
        key = None if rnd.random() < 0.1 else rnd.choice(["a", "a", "a", "b", "c"])
        data.append((key, i, rnd.choice([None, *range(30)]), rnd.choice(["x", "y", None])))
    return spark.createDataFrame(data, "k string, id int, t int, v string").cache()


def _plain(df):
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("id"))
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy("k")
    return df.select(
        "*",
        F.row_number().over(w).alias("a"),
        (F.count(F.lit(1)).over(allw) - F.row_number().over(w) + 1).cast("int").alias("d"),
        F.lag("v").over(w).alias("p"),
        F.lead("v").over(w).alias("n"),
        F.last("v", True).over(up).alias("l"),
        F.sum("t").over(up).alias("s"),
        F.max("t").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"),
    )


def _split(df):
    return (
        O.Ordered(df, ["k"], ["t", "id"])
        .scan(
            a=O.ordinal(),
            d=O.ordinal_desc(),
            p=O.previous(F.col("v")),
            n=O.following(F.col("v")),
            l=O.last_known(F.col("v")),
            s=O.running_sum(F.col("t")),
            m=O.max_before(F.col("t")),
        )
        .frame()
    )


def _key(df):
    return sorted(map(str, df.collect()))


def test_plain_path(spark, rows):
    assert _key(_plain(rows)) == _key(_split(rows))


def test_split_path(spark, rows, force_skew):
    assert _key(_plain(rows)) == _key(_split(rows))


def test_runs_split_equals_plain(spark, rows):
    a = _key(O.run_start(rows, ["k"], ["t", "id"], "v", "t"))
    spark.conf.set(O.MIN_ROWS_CONF, "5")
    try:
        b = _key(O.run_start(rows, ["k"], ["t", "id"], "v", "t"))
    finally:
        spark.conf.unset(O.MIN_ROWS_CONF)
    assert a == b


def test_run_index_aba(spark):
    df = spark.createDataFrame(
        [("k", 1, "A"), ("k", 2, "B"), ("k", 3, "A"), ("k", 4, "A"), ("j", 1, None)],
        "k string, t int, v string",
    )
    got = {(r.k, r.t): (r.run_index, r.run_start) for r in O.run_start(df, ["k"], ["t"], "v", "t").collect()}
    assert got == {("k", 1): (1, 1), ("k", 2): (2, 2), ("k", 3): (3, 3), ("k", 4): (3, 3), ("j", 1): (1, 1)}


def test_descending_split(spark, rows, force_skew):
    got = O.index_pair(rows, ["k"], ["-t", "-id"], ("d", "a"))
    want = O.index_pair(rows, ["k"], ["t", "id"], ("a", "d"))
    assert _key(got.select("k", "id", "a", "d")) == _key(want.select("k", "id", "a", "d"))


def test_window_always_has_a_key(spark, rows):
    plan = _split(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_run_pair_counts_from_both_ends(spark, force_skew):
    df = spark.createDataFrame([("k", t, v) for t, v in enumerate("AABBAC")], "k string, t int, v string")
    got = [(r.t, r.up, r.down) for r in O.run_pair(df, ["k"], ["t"], "v", ("up", "down")).orderBy("t").collect()]
    assert got == [(0, 1, 4), (1, 1, 4), (2, 2, 3), (3, 2, 3), (4, 3, 2), (5, 4, 1)]


@pytest.mark.parametrize("lead", ["double", "string", "date"])
def test_odd_leads_split_equals_plain(spark, lead):
    rnd = random.Random(11)
    odd = {
        "double": [None, float("nan"), float("inf"), float("-inf"), -0.5, *map(float, range(20)), *[3.0] * 20],
        "string": [None, "", "a", "ab", "abcdefgh", "abcdefgi", "é", "z", *[f"s{i}" for i in range(12)]],
        "date": [None, "9999-12-31", "0001-01-01", *[f"2020-01-{i:02}" for i in range(1, 20)]],
    }[lead]
    kind = "string" if lead == "date" else lead
    data = [(rnd.choice(["a", "a", "a", "b", None]), i, rnd.choice(odd), rnd.choice(["x", "y", None])) for i in range(500)]
    df = spark.createDataFrame(data, f"k string, id int, t {kind}, v string").withColumn("t", F.col("t").cast(lead)).cache()

    def scanned():
        steps = {"a": O.ordinal(), "d": O.ordinal_desc(), "p": O.previous(F.col("v")), "n": O.following(F.col("v")), "l": O.last_known(F.col("v"))}
        return _key(O.Ordered(df, ["k"], ["t", "id"]).scan(**steps).frame())

    plain = scanned()
    spark.conf.set(O.MIN_ROWS_CONF, "20")
    try:
        assert scanned() == plain
        ranged, split = O.Ordered(df, ["k"], ["t", "id"])._prepared()
        sizes = [r["count"] for r in ranged.where("k = 'a'").groupBy(O._RANGE).count().collect()]
        assert split and len(sizes) > 4 and max(sizes) < 200
    finally:
        spark.conf.unset(O.MIN_ROWS_CONF)
