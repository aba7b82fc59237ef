"""Ordinals, runs, as-of, ranges and spines over orders, lineitem and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.base import Tables, query
from wardmill.functions.dates import days_crossed
from wardmill.operators import asof, intervals, latest, ordered, spine
from wardmill.operators.ordered import KeyStats


@query(
    "order_ordinals",
    "R9 R9b R10",
    """
    SELECT o_orderkey, o_custkey,
      CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS index_desc
    FROM orders
    """,
)
def order_ordinals(t: Tables):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered.index_pair(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "event_ordinals_by_group",
    "R9 R10 R15b",
    """
    SELECT event_id,
      CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS INTEGER) AS index_desc
    FROM events
    """,
)
def event_ordinals_by_group(t: Tables):
    df = t.events.select("event_id", "user_id", "event_type", "ts")
    return ordered.index_pair(df, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "event_id", "index_asc", "index_desc"
    )


@query(
    "latest_order_per_customer",
    "R5",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
    """,
)
def latest_order_per_customer(t: Tables):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return latest.top1(df, ["o_custkey"], ["-o_orderdate", "-o_orderkey"])


@query(
    "third_order_per_customer",
    "R8",
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) WHERE rn = 3
    """,
)
def third_order_per_customer(t: Tables):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.nth(df, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2)


@query(
    "second_latest_order_date",
    "R14",
    """
    SELECT DISTINCT o_custkey, o_orderdate FROM (
      SELECT o_custkey, o_orderdate, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r
      FROM orders) WHERE r = 2
    """,
)
def second_latest_order_date(t: Tables):
    return latest.nth_distinct(t.orders, ["o_custkey"], "o_orderdate", 2)


@query(
    "order_rank_by_count",
    "R15",
    """
    SELECT o.o_orderkey,
      CAST(1 + (SELECT count(*) FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate < o.o_orderdate) AS INTEGER) AS visit_rank
    FROM orders o
    """,
)
def order_rank_by_count(t: Tables):
    df = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return latest.rank_by_count(df, ["o_custkey"], "o_orderdate", "visit_rank").select("o_orderkey", "visit_rank")


RUNS = """
    WITH e AS (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
    r AS (
      SELECT *, CAST(sum(CASE WHEN prev IS NULL OR prev <> event_type THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS run_index FROM e)
"""


@query("event_run_index", "R11", RUNS + "SELECT event_id, run_index FROM r")
def event_run_index(t: Tables):
    df = t.events.select("event_id", "user_id", "ts", "event_type")
    return ordered.run_index(df, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "run_index")


@query(
    "event_run_start",
    "R12",
    RUNS + "SELECT event_id, run_index, min(ts) OVER (PARTITION BY user_id, run_index) AS run_start FROM r",
)
def event_run_start(t: Tables):
    df = t.events.select("event_id", "user_id", "ts", "event_type")
    out = ordered.run_start(df, ["user_id"], ["ts", "event_id"], "event_type", "ts")
    return out.select("event_id", "run_index", "run_start")


@query(
    "event_episodes",
    "R13 R13b",
    """
    SELECT event_id, user_id, event_type, ts AS start_ts,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts
    FROM events
    """,
)
def event_episodes(t: Tables):
    df = t.events.select("event_id", "user_id", "event_type", "ts")
    return ordered.episodes(df, ["user_id"], "ts", ["ts", "event_id"]).withColumnRenamed("ts", "start_ts")


@query(
    "first_event_of_type",
    "R23",
    """
    SELECT event_id, NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id
      AND p.event_type = e.event_type AND p.ts < e.ts) AS is_first FROM events e
    """,
)
def first_event_of_type(t: Tables):
    df = t.events.select("event_id", "user_id", "event_type", "ts")
    return latest.first_flag(df, ["user_id", "event_type"], "ts").select("event_id", "is_first")


@query(
    "first_order_of_year",
    "R23",
    """
    SELECT o_orderkey, o_orderdate = min(o_orderdate) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS first_visit_this_year
    FROM orders
    """,
)
def first_order_of_year(t: Tables):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("yr"))
    return latest.first_flag(df, ["o_custkey", "yr"], "o_orderdate", "first_visit_this_year").select(
        "o_orderkey", "first_visit_this_year"
    )


@query(
    "error_ever_before",
    "R23b",
    """
    SELECT event_id, CAST(coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS ever_before
    FROM events
    """,
)
def error_ever_before(t: Tables):
    df = t.events.select("event_id", "user_id", "ts", "event_type")
    return ordered.ever_before(df, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").select(
        "event_id", "ever_before"
    )


@query(
    "previous_order_attributes",
    "R49",
    """
    SELECT o_orderkey, lag(o_orderstatus) OVER w AS prev_status, lag(o_orderdate) OVER w AS prev_date
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
def previous_order_attributes(t: Tables):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return ordered.lag_attr(
        df,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        prev_status=F.col("o_orderstatus"),
        prev_date=F.col("o_orderdate"),
    ).select("o_orderkey", "prev_status", "prev_date")


@query(
    "purchase_as_of_view",
    "R6",
    """
    SELECT v.event_id, p.event_id AS purchase_id, p.ts AS purchase_ts
    FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN LATERAL (
      SELECT p.event_id, p.ts FROM events p
      WHERE p.event_type = 'purchase' AND p.user_id = v.user_id AND p.ts <= v.ts
      ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) p ON TRUE
    """,
)
def purchase_as_of_view(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return asof.asof_latest(
        e.filter("event_type = 'view'").select("event_id", "user_id", "ts"),
        e.filter("event_type = 'purchase'"),
        ["user_id"],
        "ts",
        "ts",
        {"purchase_id": "event_id", "purchase_ts": "ts"},
        tie=["event_id"],
    ).select("event_id", "purchase_id", "purchase_ts")


@query(
    "previous_filled_order",
    "R6b",
    """
    SELECT o.o_orderkey, p.o_orderkey AS prev_filled, p.o_orderdate AS prev_filled_date FROM orders o
    LEFT JOIN LATERAL (
      SELECT p.o_orderkey, p.o_orderdate FROM orders p
      WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'F' AND p.o_orderdate < o.o_orderdate
      ORDER BY p.o_orderdate DESC, p.o_orderkey DESC LIMIT 1) p ON TRUE
    """,
)
def previous_filled_order(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return asof.asof_latest(
        o.drop("o_orderstatus"),
        o,
        ["o_custkey"],
        "o_orderdate",
        "o_orderdate",
        {"prev_filled": "o_orderkey", "prev_filled_date": "o_orderdate"},
        tie=["o_orderkey"],
        strict=True,
        where=F.col("o_orderstatus") == "F",
    ).select("o_orderkey", "prev_filled", "prev_filled_date")


@query(
    "event_context_lookups",
    "R6 R6b",
    """
    SELECT e.event_id, a.ts AS last_signup, b.ts AS last_click_before, c.value AS last_large_value
    FROM (SELECT * FROM events WHERE event_type = 'error') e
    LEFT JOIN LATERAL (SELECT ts FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'signup'
      AND p.ts <= e.ts ORDER BY ts DESC, event_id DESC LIMIT 1) a ON TRUE
    LEFT JOIN LATERAL (SELECT ts FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'click'
      AND p.ts < e.ts ORDER BY ts DESC, event_id DESC LIMIT 1) b ON TRUE
    LEFT JOIN LATERAL (SELECT value FROM events p WHERE p.user_id = e.user_id AND p.value > 100
      AND p.ts <= e.ts ORDER BY ts DESC, event_id DESC LIMIT 1) c ON TRUE
    """,
)
def event_context_lookups(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    kind = F.col("event_type")
    return asof.asof_many(
        e.filter(kind == "error").select("event_id", "user_id", "ts"),
        ["user_id"],
        "ts",
        [
            asof.Lookup(e, ["user_id"], "ts", {"last_signup": "ts"}, ["event_id"], where=kind == "signup"),
            asof.Lookup(e, ["user_id"], "ts", {"last_click_before": "ts"}, ["event_id"], True, kind == "click"),
            asof.Lookup(e, ["user_id"], "ts", {"last_large_value": "value"}, ["event_id"], where=F.col("value") > 100),
        ],
    ).select("event_id", "last_signup", "last_click_before", "last_large_value")


@query(
    "latest_purchase_after_error",
    "R6c",
    """
    SELECT e.event_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'error') e
    LEFT JOIN LATERAL (
      SELECT event_id FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts >= e.ts
      ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) p ON TRUE
    """,
)
def latest_purchase_after_error(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return asof.latest_at_or_after(
        e.filter("event_type = 'error'").drop("event_type"),
        e,
        ["user_id"],
        "ts",
        "ts",
        {"purchase_id": "event_id"},
        ["event_id"],
        F.col("event_type") == "purchase",
    ).select("event_id", "purchase_id")


@query(
    "status_from_two_sources",
    "R6d",
    """
    WITH x AS (
      SELECT e.event_id, a.ts AS d1, a.value AS v1, b.ts AS d2, b.value AS v2
      FROM (SELECT * FROM events WHERE event_type = 'view') e
      LEFT JOIN LATERAL (SELECT ts, value FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase'
        AND p.ts <= e.ts ORDER BY ts DESC, event_id DESC LIMIT 1) a ON TRUE
      LEFT JOIN LATERAL (SELECT ts, value FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'signup'
        AND p.ts <= e.ts ORDER BY ts DESC, event_id DESC LIMIT 1) b ON TRUE)
    SELECT event_id, CASE WHEN d2 < d1 OR d1 IS NULL THEN d2 ELSE d1 END AS status_ts,
      CASE WHEN d2 IS NOT NULL AND (d2 < d1 OR d1 IS NULL) THEN v2 ELSE v1 END AS status_value
    FROM x
    """,
)
def status_from_two_sources(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    kind = F.col("event_type")
    both = asof.asof_many(
        e.filter(kind == "view").select("event_id", "user_id", "ts"),
        ["user_id"],
        "ts",
        [
            asof.Lookup(e, ["user_id"], "ts", {"d1": "ts", "v1": "value"}, ["event_id"], where=kind == "purchase"),
            asof.Lookup(e, ["user_id"], "ts", {"d2": "ts", "v2": "value"}, ["event_id"], where=kind == "signup"),
        ],
    )
    return asof.coalesce_by_date(both, ("d1", ["v1"]), ("d2", ["v2"]), ["status_ts", "status_value"]).select(
        "event_id", "status_ts", "status_value"
    )


@query(
    "latest_pending_in_window",
    "R7",
    """
    SELECT o.o_orderkey, p.o_orderkey AS pending_key FROM orders o
    LEFT JOIN LATERAL (
      SELECT p.o_orderkey FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'P'
        AND p.o_orderdate BETWEEN o.o_orderdate AND
            CASE WHEN o.o_orderstatus = 'O' THEN TIMESTAMP '2002-01-01 00:00:00' ELSE o.o_orderdate + INTERVAL 200 DAY END
      ORDER BY p.o_orderdate DESC, p.o_orderkey DESC LIMIT 1) p ON TRUE
    """,
)
def latest_pending_in_window(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    left = o.withColumn("until", F.when(F.col("o_orderstatus") != "O", F.expr("o_orderdate + INTERVAL 200 DAY")))
    return asof.latest_between(
        left,
        o,
        ["o_custkey"],
        "o_orderdate",
        "until",
        "o_orderdate",
        {"pending_key": "o_orderkey"},
        "2002-01-01 00:00:00",
        ["o_orderkey"],
        F.col("o_orderstatus") == "P",
    ).select("o_orderkey", "pending_key")


@query(
    "orders_within_half_year",
    "R28",
    """
    SELECT o.o_orderkey,
      count(p.o_orderkey) AS n_all,
      count(CASE WHEN p.o_orderstatus = 'F' THEN 1 END) AS n_filled,
      count(CASE WHEN p.o_orderpriority = '1-URGENT' THEN 1 END) AS n_urgent
    FROM orders o LEFT JOIN orders p ON p.o_custkey = o.o_custkey
      AND p.o_orderdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 180 DAY
    GROUP BY o.o_orderkey
    """,
)
def orders_within_half_year(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    left = o.select("o_orderkey", "o_custkey", "o_orderdate", F.expr("o_orderdate + INTERVAL 180 DAY").alias("until"))
    return asof.count_within(
        left,
        ["o_orderkey"],
        o,
        ["o_custkey"],
        "o_orderdate",
        "until",
        "o_orderdate",
        {
            "n_all": F.lit(True),
            "n_filled": F.col("o_orderstatus") == "F",
            "n_urgent": F.col("o_orderpriority") == "1-URGENT",
        },
        "2002-01-01",
    ).select("o_orderkey", "n_all", "n_filled", "n_urgent")


@query(
    "shipments_inside_order_windows",
    "R18",
    """
    WITH l AS (SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT o.o_orderkey, count(*) AS shipments
    FROM orders o JOIN l ON l.o_custkey = o.o_custkey
      AND l.l_shipdate >= o.o_orderdate AND (o.o_orderstatus = 'O' OR l.l_shipdate <= o.o_orderdate + INTERVAL 45 DAY)
    GROUP BY o.o_orderkey
    """,
)
def shipments_inside_order_windows(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    lines = t.lineitem.select("l_orderkey", "l_shipdate").join(
        o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("o_custkey", "l_shipdate")
    # many shipments share a customer and day: count them first; windows then take differences of running sums
    daily = lines.groupBy("o_custkey", "l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    span = o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "O", F.expr("o_orderdate + INTERVAL 45 DAY")).alias("until"),
    )
    # an order has a handful of lines, so the days with shipments need no count of their own
    line = asof.time_line(o, ["o_custkey"], "o_orderdate")
    counted = asof.count_within(
        span, ["o_orderkey"], daily, ["o_custkey"], "o_orderdate", "until", "l_shipdate",
        {"shipments": F.lit(True)}, "9999-12-31 00:00:00", F.col("n"), KeyStats.of([(*line, 9)]),
    )
    return counted.filter("shipments > 0").select("o_orderkey", "shipments")


@query(
    "enclosing_order_of_order",
    "R18 F16",
    """
    SELECT o.o_orderkey, p.o_orderkey AS enclosing_key FROM orders o
    LEFT JOIN LATERAL (
      SELECT p.o_orderkey FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'F'
        AND p.o_orderdate <= o.o_orderdate AND (p.o_orderkey % 10 = 0 OR o.o_orderdate <= p.o_orderdate + INTERVAL 120 DAY)
      ORDER BY p.o_orderdate DESC, p.o_orderkey DESC LIMIT 1) p ON TRUE
    """,
)
def enclosing_order_of_order(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    until = F.when(F.col("o_orderkey") % 10 != 0, F.expr("o_orderdate + INTERVAL 120 DAY"))
    span = o.filter("o_orderstatus = 'F'").withColumn("until", until)
    return intervals.join_containing(
        o,
        span,
        ["o_custkey"],
        "o_orderdate",
        "o_orderdate",
        "until",
        {"enclosing_key": "o_orderkey"},
        ["o_orderkey"],
        True,
        ["o_orderkey"],
        "left",
    ).select("o_orderkey", "enclosing_key")


@query(
    "overlapping_order_pairs",
    "R19",
    """
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderdate AS s, o_orderdate + (o_orderkey % 60) * INTERVAL 1 DAY AS e FROM orders)
    SELECT a.o_orderkey AS first_key, b.o_orderkey AS second_key FROM s a JOIN s b
      ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s <= b.e AND b.s <= a.e
    """,
)
def overlapping_order_pairs(t: Tables):
    s = t.orders.selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate AS s", "o_orderdate + (o_orderkey % 60) * INTERVAL 1 DAY AS e"
    )
    return (
        intervals.join_overlap(
            s.withColumnRenamed("o_orderkey", "first_key"),
            s,
            ["o_custkey"],
            ("s", "e"),
            ("s", "e"),
            {"second_key": "o_orderkey"},
        )
        .filter("first_key < second_key")
        .select("first_key", "second_key")
    )


@query(
    "order_overlap_flag",
    "R19",
    """
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderdate AS s, o_orderdate + (o_orderkey % 60) * INTERVAL 1 DAY AS e FROM orders)
    SELECT a.o_orderkey, EXISTS (SELECT 1 FROM s b WHERE a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
      AND ((a.s, a.o_orderkey) > (b.s, b.o_orderkey) AND b.e > a.s OR (a.s, a.o_orderkey) < (b.s, b.o_orderkey) AND b.s < a.e)) AS overlaps
    FROM s a
    """,
)
def order_overlap_flag(t: Tables):
    s = t.orders.selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate AS s", "o_orderdate + (o_orderkey % 60) * INTERVAL 1 DAY AS e"
    )
    return intervals.overlap_flag(s, ["o_custkey"], "s", "e", ["o_orderkey"]).select("o_orderkey", "overlaps")


@query(
    "order_days_by_month",
    "R17 R19 R20",
    """
    WITH s AS (
      SELECT l_orderkey, min(o_orderdate) AS s, max(l_shipdate) AS e
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey HAVING max(l_shipdate) >= min(o_orderdate)),
    m AS (
      SELECT l_orderkey, s, e, unnest(generate_series(date_trunc('month', s), date_trunc('month', e), INTERVAL 1 MONTH)) AS m FROM s),
    c AS (
      SELECT l_orderkey, CAST(m AS DATE) AS month_start,
        greatest(s, CAST(m AS TIMESTAMP)) AS cs,
        CASE WHEN e > CAST(last_day(CAST(m AS DATE)) AS TIMESTAMP) THEN CAST(last_day(CAST(m AS DATE)) + INTERVAL 1 DAY AS TIMESTAMP) ELSE e END AS ce
      FROM m)
    SELECT month_start, count(*) AS stays, CAST(sum(date_diff('day', CAST(cs AS DATE), CAST(ce AS DATE))) AS BIGINT) AS stay_days
    FROM c GROUP BY month_start
    """,
)
def order_days_by_month(t: Tables):
    ship = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("e"))
    s = (
        ship.join(t.orders.select("o_orderkey", F.col("o_orderdate").alias("s")), F.col("l_orderkey") == F.col("o_orderkey"))
        .filter("e >= s")
        .select("l_orderkey", "s", "e")
    )
    m = intervals.months_touched(s, "s", "e", "1995-01-01", "2002-12-31")
    end = F.last_day("month_start")
    _, _, days = intervals.clip_days(
        F.col("s"), F.col("e"), F.col("month_start"), end, F.lit("2003-01-01").cast("timestamp_ntz")
    )
    return (
        m.withColumn("d", days)
        .groupBy("month_start")
        .agg(F.count(F.lit(1)).alias("stays"), F.sum("d").alias("stay_days"))
    )


@query(
    "customer_month_spine",
    "R17",
    """
    WITH c AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l FROM orders GROUP BY o_custkey)
    SELECT o_custkey, last_day(CAST(m AS DATE)) AS reporting_date FROM (
      SELECT o_custkey, l, unnest(generate_series(date_trunc('month', f), date_trunc('month', l), INTERVAL 1 MONTH)) AS m FROM c)
    WHERE last_day(CAST(m AS DATE)) <= DATE '2001-06-15' AND last_day(CAST(m AS DATE)) > DATE '1997-01-01'
    """,
)
def customer_month_spine(t: Tables):
    c = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("f"), F.max("o_orderdate").alias("l"))
    return spine.monthly_spine(c, "f", "l", "2001-06-15", after="1997-01-01").select("o_custkey", "reporting_date")


@query(
    "latest_order_per_month",
    "R17b",
    """
    SELECT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS month_end, o_orderdate, o_orderkey, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
    """,
)
def latest_order_per_month(t: Tables):
    return latest.month_latest(t.orders, ["o_custkey"], "o_orderdate", ["o_orderstatus"], "o_orderkey")


@query(
    "month_end_snapshot",
    "R17 R6 R53 R37",
    """
    WITH c AS (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY o_custkey),
    s AS (
      SELECT o_custkey, f, last_day(CAST(m AS DATE)) AS reporting_date FROM (
        SELECT o_custkey, f, unnest(generate_series(date_trunc('month', f), TIMESTAMP '2001-06-01', INTERVAL 1 MONTH)) AS m FROM c)
      WHERE last_day(CAST(m AS DATE)) <= DATE '2001-06-15')
    SELECT s.o_custkey, s.reporting_date, o.o_orderdate AS latest_order_date, o.o_orderstatus AS latest_status,
      greatest(CAST(date_diff('day', CAST(coalesce(o.o_orderdate + INTERVAL 90 DAY, s.f) AS DATE), s.reporting_date) AS INTEGER), 0) AS days_late,
      CASE WHEN o.o_orderdate IS NULL THEN 'none'
           WHEN greatest(date_diff('day', CAST(o.o_orderdate + INTERVAL 90 DAY AS DATE), s.reporting_date), 0) <= 28 THEN 'active'
           ELSE 'lost' END AS status
    FROM s ASOF LEFT JOIN (
      SELECT o_custkey, o_orderdate, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1) o
      ON s.o_custkey = o.o_custkey AND CAST(s.reporting_date AS TIMESTAMP) >= o.o_orderdate
    """,
)
def month_end_snapshot(t: Tables):
    from wardmill.operators.rules import days_late, waterfall

    o = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("f"))
    s = spine.monthly_spine(first, "f", None, "2001-06-15")
    got = asof.asof_latest(
        s,
        o,
        ["o_custkey"],
        "reporting_date",
        "o_orderdate",
        {"latest_order_date": "o_orderdate", "latest_status": "o_orderstatus"},
        ["o_orderkey"],
    )
    due = F.expr("latest_order_date + INTERVAL 90 DAY")
    late = days_late(F.col("reporting_date"), due, F.col("f"))
    status = waterfall(
        [(F.col("latest_order_date").isNull(), F.lit("none")), (late <= 28, F.lit("active"))], F.lit("lost")
    )
    return got.select(
        "o_custkey", "reporting_date", "latest_order_date", "latest_status", late.alias("days_late"), status.alias("status")
    )


CALENDAR_SQL = """
    WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
    b AS (
      SELECT d, month(d) AS mo, day(d) AS dom, year(d) AS yr, quarter(d) AS q, CAST(dayofweek(d) + 1 AS INTEGER) AS dow,
        CAST(date_trunc('quarter', d) AS DATE) AS qs, CAST(date_trunc('month', d) AS DATE) AS ms,
        CAST(date_trunc('year', d) AS DATE) AS ys FROM days),
    x AS (
      SELECT *, CAST(floor((dayofyear(d) + dayofweek(ys) - 1) / 7) AS INTEGER) + 1 AS woy,
        CAST(floor((dayofyear(ms) + dayofweek(ys) - 1) / 7) AS INTEGER) + 1 AS woy_ms,
        CAST(ceil(dom / 7) AS INTEGER) AS nth,
        CAST(ys + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS ye FROM b),
    nov AS (
      SELECT *, CAST(CAST(make_date(yr, 11, 1) + CAST((9 - (dayofweek(make_date(yr, 11, 1)) + 1)) % 7 AS INTEGER) AS DATE) + 1 AS DATE) AS election,
        CAST(make_date(yr, 5, 31) - CAST((dayofweek(make_date(yr, 5, 31)) + 6) % 7 AS INTEGER) AS DATE) AS memorial FROM x),
    h AS (
      SELECT *,
        CASE WHEN d = election THEN 'Election Day'
             WHEN mo = 10 AND dom = 31 THEN 'Halloween'
             WHEN mo = 6 AND dow = 1 AND nth = 3 THEN 'Father''s Day'
             WHEN mo = 5 AND dow = 1 AND nth = 2 THEN 'Mother''s Day'
             WHEN mo = 2 AND dow = 2 AND nth = 3 THEN 'President''s Day'
             WHEN mo = 1 AND dow = 2 AND nth = 3 THEN 'Martin Luthor King Jr Day'
             WHEN mo = 3 AND dom = 17 THEN 'Saint Patrick''s Day'
             WHEN mo = 2 AND dom = 14 THEN 'Valentine''s Day'
             WHEN mo = 9 AND dow = 2 AND dom <= 7 THEN 'Labor Day'
             WHEN d = memorial THEN 'Memorial Day'
             WHEN mo = 1 AND dom = 1 THEN 'New Year''s Day'
             WHEN mo = 7 AND dom = 4 THEN 'Independance Day'
             WHEN mo = 12 AND dom = 25 THEN 'Christmas Day'
             WHEN mo = 11 AND dow = 5 AND nth = 4 THEN 'Thanksgiving Day' END AS usa,
        CASE WHEN mo = 4 AND dom = 18 THEN 'Good Friday' WHEN mo = 4 AND dom = 21 THEN 'Easter Monday'
             WHEN mo = 5 AND dom = 5 THEN 'Early May Bank Holiday' WHEN mo = 5 AND dom = 26 THEN 'Spring Bank Holiday'
             WHEN mo = 8 AND dom = 25 THEN 'Summer Bank Holiday' WHEN mo = 12 AND dom = 25 THEN 'Christmas Day'
             WHEN mo = 12 AND dom = 26 THEN 'Boxing Day' WHEN mo = 1 AND dom = 1 THEN 'New Year''s Day' END AS uk
      FROM nov)
    SELECT strftime(d, '%Y%m%d') AS "DateKey", CAST(d AS TIMESTAMP) AS "Date", strftime(d, '%d/%m/%Y') AS "FullDateUK",
      strftime(d, '%m/%d/%Y') AS "FullDateUSA", CAST(dom AS VARCHAR) AS "DayOfMonth",
      CAST(dom AS VARCHAR) || CASE WHEN dom IN (11, 12, 13) THEN 'th' WHEN dom % 10 = 1 THEN 'st' WHEN dom % 10 = 2 THEN 'nd'
        WHEN dom % 10 = 3 THEN 'rd' ELSE 'th' END AS "DaySuffix",
      dayname(d) AS "DayName", CAST(dow AS VARCHAR) AS "DayOfWeekUSA", CAST(CASE WHEN dow = 1 THEN 7 ELSE dow - 1 END AS VARCHAR) AS "DayOfWeekUK",
      CAST(nth AS VARCHAR) AS "DayOfWeekInMonth", CAST(CAST(ceil(dayofyear(d) / 7) AS INTEGER) AS VARCHAR) AS "DayOfWeekInYear",
      CAST((d - qs) // 7 + 1 AS VARCHAR) AS "DayOfQuarter", CAST(dayofyear(d) AS VARCHAR) AS "DayOfYear",
      CAST(woy + 1 - woy_ms AS VARCHAR) AS "WeekOfMonth", CAST((d - qs) // 7 + 1 AS VARCHAR) AS "WeekOfQuarter",
      CAST(woy AS VARCHAR) AS "WeekOfYear", CAST(mo AS VARCHAR) AS "Month", monthname(d) AS "MonthName",
      CAST((mo - 1) % 3 + 1 AS VARCHAR) AS "MonthOfQuarter", 'Q' || q AS "Quarter",
      CASE q WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS "QuarterName",
      CASE q WHEN 1 THEN 'Q3' WHEN 2 THEN 'Q4' WHEN 3 THEN 'Q1' ELSE 'Q2' END AS "Fiscal_Quarter",
      CAST(yr AS VARCHAR) AS "Year", 'CY ' || yr AS "YearName", left(monthname(d), 3) || '-' || yr AS "MonthYear",
      strftime(d, '%m%Y') AS "MMYYYY", ms AS "FirstDayOfMonth", last_day(d) AS "LastDayOfMonth", qs AS "FirstDayOfQuarter",
      CAST(qs + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "LastDayOfQuarter", ys AS "FirstDayOfYear", ye AS "LastDayOfYear",
      usa IS NOT NULL AS "IsHolidayUSA", dow NOT IN (1, 7) AS "IsWeekday", usa AS "HolidayUSA", uk IS NOT NULL AS "IsHolidayUK", uk AS "HolidayUK"
    FROM h
"""


@query("order_calendar", "R43 D2", CALENDAR_SQL)
def order_calendar(t: Tables):
    return spine.calendar(t.orders.select(F.to_date("o_orderdate").alias("day")).distinct())


@query(
    "date_expressions",
    "2.6",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      CAST(year(l_shipdate) - year(o_orderdate) AS INTEGER) AS years_crossed,
      CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS INTEGER) AS months_crossed,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_crossed,
      CAST(m // 12 AS INTEGER) AS complete_years,
      CAST(m AS INTEGER) AS complete_months,
      CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, last_day(CAST(l_shipdate AS DATE)) AS month_end
    FROM (SELECT *, CASE WHEN l_shipdate >= o_orderdate THEN k - CASE WHEN day(l_shipdate) < day(o_orderdate) THEN 1 ELSE 0 END
            ELSE k + CASE WHEN day(l_shipdate) > day(o_orderdate) THEN 1 ELSE 0 END END AS m
          FROM (SELECT *, (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS k
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
    """,
)
def date_expressions(t: Tables):
    from wardmill.functions import dates as D

    j = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    a, b = F.col("o_orderdate"), F.col("l_shipdate")
    return j.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        D.years_crossed(a, b).alias("years_crossed"),
        D.months_crossed(a, b).alias("months_crossed"),
        days_crossed(a, b).alias("days_crossed"),
        D.complete_years(a, b).alias("complete_years"),
        D.complete_months(a, b).alias("complete_months"),
        D.month_start(b).alias("month_start"),
        D.month_end(b).alias("month_end"),
    )
