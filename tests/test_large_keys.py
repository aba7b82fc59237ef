"""One key with very many rows: interval joins, shared statistics and ranges of strings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardmill.operators import asof, intervals
from wardmill.operators import ordered as O

DAY = dt.datetime(2020, 1, 1)


def stamp(days):
    return None if days is None else DAY + dt.timedelta(days=days)


@pytest.mark.parametrize("days", [1, 30])
def test_blocks_cover_each_cell_once(spark, days):
    rng = random.Random(3)
    spans = [(lo, lo + rng.choice([-1, 0, 1, 5, 63, 64, 65, 200, 999])) for lo in (rng.randint(-500, 500) for _ in range(200))]
    df = spark.createDataFrame(spans, "lo int, hi int").withColumn("b", intervals._blocks(F.col("lo"), F.col("hi")))
    for r in df.collect():
        cells = [c for x in (r["b"] or []) for c in range(x["place"] << x["level"], (x["place"] + 1) << x["level"])]
        assert sorted(cells) == list(range(r["lo"], r["hi"] + 1))
        assert len(r["b"] or []) <= 2 * intervals.LEVELS + max(0, r["hi"] - r["lo"]) // 64 + 2


def test_interval_joins_against_pairs(spark):
    rng = random.Random(5)
    ev = [(i, rng.choice("ab"), rng.randint(-400, 4000)) for i in range(150)]
    iv = []
    for i in range(120):
        lo = rng.choice([None, rng.randint(-400, 4000), rng.randint(-400, 4000)])
        hi = rng.choice([None, None if lo is None else lo + rng.choice([0, 1, 40, 900, -3])])
        iv.append((i, rng.choice("abc"), lo, hi))
    e = spark.createDataFrame([(i, k, stamp(t)) for i, k, t in ev], "id int, k string, t timestamp_ntz")
    v = spark.createDataFrame([(i, k, stamp(a), stamp(b)) for i, k, a, b in iv], "iid int, k string, s timestamp_ntz, e timestamp_ntz")
    far = 10**6
    want = sorted((i, j) for i, k, t in ev for j, q, a, b in iv if k == q and a is not None and a <= t <= (far if b is None else b))
    got = intervals.join_containing(e, v, ["k"], "t", "s", "e", {"iid": "iid"})
    assert sorted((r["id"], r["iid"]) for r in got.collect()) == want
    real = [(j, q, a, far if b is None else b) for j, q, a, b in iv if a is not None and (b is None or b >= a)]
    want = sorted((x[0], y[0]) for x in real for y in real if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    got = intervals.join_overlap(v, v, ["k"], ("s", "e"), ("s", "e"), {"other": "iid"})
    assert sorted((r["iid"], r["other"]) for r in got.collect()) == want


def test_one_key_with_open_intervals(spark):
    """10^5 open intervals and 10^5 events of one key that hardly meet: no pair is made in vain."""
    ev = spark.range(100_000).select(F.lit("a").alias("k"), F.col("id"), (F.lit(DAY) + F.make_dt_interval(days=(F.col("id") % 3000).cast("int"))).alias("t"))
    iv = spark.range(100_000).select(F.lit("a").alias("k"), F.col("id").alias("iid"), F.lit(DAY + dt.timedelta(days=2999)).alias("s"), F.lit(None).cast("timestamp_ntz").alias("e"))
    few = ev.filter("id >= 2999 * 33 AND id < 2999 * 33 + 2 OR t < timestamp_ntz '2028-03-18'")
    got = intervals.join_containing(few, iv, ["k"], "t", "s", "e", {"iid": "iid"})
    assert got.count() == 100_000 * few.filter(F.col("t") >= F.lit(DAY + dt.timedelta(days=2999))).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_wm_ilev" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("prefix", ["", "site-prefix1-"])
def test_strings_with_a_common_prefix_split_evenly(spark, prefix):
    rows = [("hot", f"{prefix}{i:06}", i % 7) for i in range(2000)] + [("cold", f"{prefix}x", 1)]
    df = spark.createDataFrame(rows, "k string, id string, v int")
    spark.conf.set(O.MIN_ROWS_CONF, "200")
    try:
        ranged, split = O.Ordered(df, ["k"], ["id"])._prepared()
        sizes = [r["count"] for r in ranged.where("k = 'hot'").groupBy(O._RANGE).count().collect()]
        assert split and len(sizes) >= 10 and max(sizes) <= 400
        got = {r["id"]: (r["a"], r["n"]) for r in O.Ordered(df, ["k"], ["id"]).scan(a=O.ordinal(), n=O.following(F.col("id"))).frame().where("k = 'hot'").collect()}
    finally:
        spark.conf.unset(O.MIN_ROWS_CONF)
    ids = [r[1] for r in rows[:2000]]
    assert got == {x: (i + 1, ids[i + 1] if i < 1999 else None) for i, x in enumerate(ids)}


def test_equal_leading_values_split_by_the_next_column(spark):
    df = spark.createDataFrame([("hot", 1, i) for i in range(1000)], "k string, t int, id int")
    spark.conf.set(O.MIN_ROWS_CONF, "100")
    try:
        ranged, _ = O.Ordered(df, ["k"], ["t", "id"])._prepared()
        sizes = [r["count"] for r in ranged.groupBy(O._RANGE).count().collect()]
        mixed, _ = O.Ordered(df, ["k"], ["t", "-id"])._prepared()
        assert max(sizes) <= 200 and mixed.select(O._RANGE).distinct().count() == 1
    finally:
        spark.conf.unset(O.MIN_ROWS_CONF)


def test_shared_statistics_serve_all_scans(spark):
    """One count for a job: every scan of the job splits its large key by it and gives the plain rows."""
    rng = random.Random(8)
    left = spark.createDataFrame([(rng.choice(["hot", "hot", "x"]), i, stamp(rng.randint(0, 300))) for i in range(300)], "k string, id int, t timestamp_ntz")
    right = spark.createDataFrame([(rng.choice(["hot", "y", "x"]), i, stamp(rng.randint(0, 300)).date()) for i in range(300)], "k string, rid int, d date")

    def run(sizes):
        a = asof.asof_latest(left, right, ["k"], "t", "d", {"rid": "rid"}, ["rid"], left_sizes=sizes)
        b = O.index_pair(right, ["k"], ["d", "rid"], sizes=sizes)
        return sorted(map(str, a.collect())), sorted(map(str, b.collect()))

    plain = run(None)
    spark.conf.set(O.MIN_ROWS_CONF, "40")
    try:
        sizes = O.KeyStats.of([asof.time_line(left, ["k"], "t"), asof.time_line(right, ["k"], "d")])
        assert [r["_wm_k0"] for r in sizes.big.select("_wm_k0").orderBy("_wm_k0").collect()][0] == "hot"
        assert run(sizes) == plain
        assert O.KeyStats.of([asof.time_line(left.where("k = 'x'").limit(5), ["k"], "t")]).big is None
    finally:
        spark.conf.unset(O.MIN_ROWS_CONF)
