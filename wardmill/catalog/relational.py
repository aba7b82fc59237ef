"""Filters, decoding, enrichment, pivots, merges, hierarchies and rules over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.base import Tables, query
from wardmill.functions import dates as D
from wardmill.operators import eav, enrich, latest, merge, rules, spine, tree
from wardmill.operators.eav import Answer
from wardmill.operators.rules import Rule


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "active_events_of_types",
    "R1 R55",
    "SELECT event_id, user_id, event_type FROM events WHERE value >= 5 AND event_type IN ('click', 'purchase')",
)
def active_events_of_types(t: Tables):
    e = t.events.withColumn("voided", F.col("value") < 5)
    return enrich.active(e, "event_type", ["click", "purchase"]).select("event_id", "user_id", "event_type")


@query(
    "orders_without_flagged_customers",
    "R2 R22",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')
    """,
)
def orders_without_flagged_customers(t: Tables):
    flagged = t.customer.filter("c_mktsegment = 'MACHINERY'")
    return enrich.exclude_flagged(t.orders.select("o_orderkey", "o_custkey"), flagged, "o_custkey", "c_custkey")


@query(
    "decoded_customers",
    "R3 R58 F1",
    """
    SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def decoded_customers(t: Tables):
    c = t.customer.select("c_custkey", "c_nationkey")
    c = enrich.decode(c, t.nation, "c_nationkey", "n_nationkey", {"nation": "n_name", "rk": "n_regionkey"})
    return enrich.decode(c, t.region, "rk", "r_regionkey", {"region": "r_name"}).select("c_custkey", "nation", "region")


@query(
    "customers_enriched_by_order",
    "R4",
    """
    WITH p AS (
      SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
      FROM orders WHERE o_orderstatus = 'P')
    SELECT c_custkey, CASE WHEN o_custkey IS NOT NULL THEN o_orderpriority ELSE c_mktsegment END AS label
    FROM customer LEFT JOIN (SELECT * FROM p WHERE rn = 1) ON o_custkey = c_custkey
    """,
)
def customers_enriched_by_order(t: Tables):
    base = t.customer.select("c_custkey", F.col("c_mktsegment").alias("label"))
    src = t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority"
    )
    return enrich.enrich(base, src, ["c_custkey"], {"label": "o_orderpriority"}, ["-o_orderkey"])


@query(
    "customers_with_urgent_orders",
    "R21",
    "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def customers_with_urgent_orders(t: Tables):
    o = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return enrich.semi(t.customer.select("c_custkey"), o, ["c_custkey"])


@query(
    "parts_never_returned",
    "R22",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)",
)
def parts_never_returned(t: Tables):
    return enrich.not_in(
        t.part.select("p_partkey"), "p_partkey", t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 48"), "l_partkey"
    )


@query(
    "event_pivot",
    "R24 R24b F9 F14 F15",
    """
    SELECT user_id,
      (SELECT value FROM events p WHERE p.user_id = u.user_id AND event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1) AS last_purchase,
      (SELECT value FROM events p WHERE p.user_id = u.user_id AND event_type = 'signup' ORDER BY ts, event_id LIMIT 1) AS first_signup,
      (SELECT max(value) FROM events p WHERE p.user_id = u.user_id AND event_type = 'view') AS max_view,
      (SELECT min(ts) FROM events p WHERE p.user_id = u.user_id AND event_type = 'error') AS first_error,
      (SELECT count(*) FROM events p WHERE p.user_id = u.user_id AND event_type = 'click') AS clicks,
      (SELECT CAST(max(CASE WHEN value > 60 THEN 1 ELSE 0 END) AS INTEGER) FROM events p WHERE p.user_id = u.user_id AND event_type = 'error') AS any_large_error
    FROM (SELECT DISTINCT user_id FROM events) u
    """,
)
def event_pivot(t: Tables):
    e, v = t.events, F.col("value")
    kind = lambda k: F.col("event_type") == k
    when = ("ts", "event_id")
    return eav.pivot(
        e,
        ["user_id"],
        {
            "last_purchase": Answer(kind("purchase"), v, order=when),
            "first_signup": Answer(kind("signup"), v, "earliest", order=when),
            "max_view": Answer(kind("view"), v, "max"),
            "first_error": Answer(kind("error"), F.col("ts"), "min"),
            "clicks": Answer(kind("click"), None, "count"),
            "any_large_error": Answer(kind("error"), v > 60, "any"),
        },
    )


@query(
    "priority_list_per_customer",
    "R25 R25b F11",
    """
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY o_custkey
    """,
)
def priority_list_per_customer(t: Tables):
    return eav.coded_list(t.orders, ["o_custkey"], "o_orderpriority", " | ", "priorities")


@query(
    "joined_labels",
    "R25c",
    """
    SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END,
      CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderpriority < '3' THEN o_orderpriority END) AS labels
    FROM orders
    """,
)
def joined_labels(t: Tables):
    return _orders(t).select(
        "o_orderkey",
        eav.join_nonnull(
            [
                F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")),
                F.when(F.col("o_totalprice") > 200000, "large"),
                F.when(F.col("o_orderpriority") < "3", F.col("o_orderpriority")),
            ]
        ).alias("labels"),
    )


@query(
    "customer_flags",
    "R26",
    """
    SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INTEGER) AS has_pending,
      CAST(max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS INTEGER) AS has_large FROM orders GROUP BY o_custkey
    """,
)
def customer_flags(t: Tables):
    o = _orders(t).select(
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", True).alias("has_pending"),
        (F.col("o_totalprice") > 450000).alias("has_large"),
    )
    return eav.any_flag(o, ["o_custkey"], ["has_pending", "has_large"])


@query(
    "daily_quantity_summary",
    "R27 D15",
    """
    SELECT l_returnflag, CAST(l_shipdate AS DATE) AS ship_date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS daily_quantity,
      count(*) AS lines, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest
    FROM lineitem GROUP BY 1, 2
    """,
)
def daily_quantity_summary(t: Tables):
    return t.lineitem.groupBy("l_returnflag", F.to_date("l_shipdate").alias("ship_date")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("daily_quantity"),
        F.count(F.lit(1)).alias("lines"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
    )


@query(
    "parties_union",
    "R29 R32",
    """
    SELECT c_nationkey AS nation_key, 'customer' AS party FROM customer UNION
    SELECT s_nationkey, 'supplier' FROM supplier
    """,
)
def parties_union(t: Tables):
    return merge.union_rows(
        [
            t.customer.select(F.col("c_nationkey").alias("nation_key"), F.lit("customer").alias("party")),
            t.supplier.select(F.col("s_nationkey").alias("nation_key"), F.lit("supplier").alias("party")),
        ],
        distinct=True,
    )


@query(
    "status_events_union_all",
    "R29",
    """
    SELECT o_custkey, o_orderdate AS ts, 'placed' AS status FROM orders UNION ALL
    SELECT o_custkey, o_orderdate + INTERVAL 30 DAY, 'filled' FROM orders WHERE o_orderstatus = 'F'
    """,
)
def status_events_union_all(t: Tables):
    o = _orders(t)
    return merge.union_rows(
        [
            o.select("o_custkey", F.col("o_orderdate").alias("ts"), F.lit("placed").alias("status")),
            o.filter("o_orderstatus = 'F'").select(
                "o_custkey", F.expr("o_orderdate + INTERVAL 30 DAY").alias("ts"), F.lit("filled").alias("status")
            ),
        ]
    )


@query(
    "upserted_orders",
    "R30",
    """
    WITH d AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 5 = 0),
    b AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0)
    SELECT coalesce(b.o_orderkey, d.o_orderkey) AS o_orderkey, coalesce(d.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
      coalesce(b.o_orderpriority, d.o_orderpriority) AS o_orderpriority
    FROM b FULL JOIN d ON b.o_orderkey = d.o_orderkey
    """,
)
def upserted_orders(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    base = o.filter("o_orderkey % 10 <> 0")
    delta = o.filter("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    return merge.upsert(base, delta, ["o_orderkey"], ["o_orderstatus"])


@query(
    "latest_orders_with_ties",
    "R31 D4",
    """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders o WHERE NOT EXISTS (
      SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate > o.o_orderdate)
    """,
)
def latest_orders_with_ties(t: Tables):
    return latest.keep_latest_ties(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate")


DEDUP = """
    WITH f AS (
      SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INTEGER) AS pending,
        CAST(max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS INTEGER) AS urgent FROM orders GROUP BY o_custkey),
    l AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
      WHERE rn = 1)
"""


@query(
    "merged_customer_rows",
    "R31b D4",
    DEDUP
    + "SELECT f.*, l.o_orderdate, l.o_orderstatus, l.o_totalprice FROM f JOIN l ON f.o_custkey = l.o_custkey",
)
def merged_customer_rows(t: Tables):
    o = _orders(t).withColumns(
        {
            "pending": F.when(F.col("o_orderstatus") == "P", 1),
            "urgent": F.when(F.col("o_orderpriority") == "1-URGENT", 1),
        }
    )
    return merge.dedup_merge(
        o, ["o_custkey"], ["pending", "urgent"], "o_orderdate", ["o_orderstatus", "o_totalprice"], ["o_orderkey"]
    )


@query(
    "merged_rows_by_reference",
    "R31c D4",
    DEDUP
    + """, c AS (
      SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderkey DESC) AS rk
        FROM orders o JOIN l ON l.o_custkey = o.o_custkey AND l.o_orderpriority = o.o_orderpriority
        WHERE l.o_orderstatus <> 'O') WHERE rk = 1)
    SELECT f.*, c.o_orderpriority, c.o_totalprice FROM f LEFT JOIN c ON f.o_custkey = c.o_custkey
    """,
)
def merged_rows_by_reference(t: Tables):
    o = _orders(t).withColumns(
        {
            "pending": F.when(F.col("o_orderstatus") == "P", 1),
            "urgent": F.when(F.col("o_orderpriority") == "1-URGENT", 1),
        }
    )
    ref = latest.top1(o, ["o_custkey"], ["-o_orderdate", "-o_orderkey"]).filter("o_orderstatus <> 'O'")
    return merge.dedup_by_ref(
        o, ["o_custkey"], ["pending", "urgent"], ref, ["o_orderpriority"], ["o_totalprice"], ["-o_orderkey"]
    )


@query(
    "distinct_nation_segments",
    "R32 R33",
    "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer ORDER BY c_nationkey, c_mktsegment",
)
def distinct_nation_segments(t: Tables):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct().orderBy("c_nationkey", "c_mktsegment")


@query(
    "top_three_brands_per_order",
    "R34 F20",
    """
    WITH b AS (
      SELECT l_orderkey, p_brand, max(l_extendedprice) AS price FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY price DESC, p_brand) AS rn FROM b)
    SELECT l_orderkey, max(CASE WHEN rn = 1 THEN p_brand END) AS brand_1, max(CASE WHEN rn = 2 THEN p_brand END) AS brand_2,
      max(CASE WHEN rn = 3 THEN p_brand END) AS brand_3,
      max(CASE WHEN rn = 1 THEN price END) AS price_1, max(CASE WHEN rn = 2 THEN price END) AS price_2,
      max(CASE WHEN rn = 3 THEN price END) AS price_3
    FROM r GROUP BY l_orderkey
    """,
)
def top_three_brands_per_order(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("price")).join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )
    return latest.top_k_columns(lines, ["l_orderkey"], "p_brand", ["-price", "p_brand"], 3, "brand", ["price"])


@query(
    "latest_of_timestamps",
    "R35",
    """
    SELECT c_custkey, coalesce(greatest(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END),
        max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END)), TIMESTAMP '1990-01-01 00:00:00') AS last_done,
      CASE WHEN max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) IS NOT NULL
          AND max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) IS NOT NULL
        THEN least(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END), max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END)) END AS both_by
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
    """,
)
def latest_of_timestamps(t: Tables):
    per = eav.pivot(
        t.orders,
        ["o_custkey"],
        {
            "f": Answer(F.col("o_orderstatus") == "F", F.col("o_orderdate"), "max"),
            "p": Answer(F.col("o_orderstatus") == "P", F.col("o_orderdate"), "max"),
        },
    )
    c = t.customer.select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    default = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
    return c.select(
        "c_custkey",
        rules.greatest_or([F.col("f"), F.col("p")], default).alias("last_done"),
        rules.least_strict([F.col("f"), F.col("p")]).alias("both_by"),
    )


@query(
    "latest_across_sources",
    "R36",
    """
    WITH l AS (
      SELECT user_id, max(CASE WHEN event_type = 'click' THEN ts END) AS a, max(CASE WHEN event_type = 'view' THEN ts END) AS b,
        max(CASE WHEN event_type = 'purchase' THEN ts END) AS c FROM events GROUP BY user_id)
    SELECT user_id, greatest(a, b, c) AS last_seen, CASE WHEN a = greatest(a, b, c) THEN 'click'
      WHEN b = greatest(a, b, c) THEN 'view' WHEN c = greatest(a, b, c) THEN 'purchase' END AS last_seen_source FROM l
    """,
)
def latest_across_sources(t: Tables):
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    one = lambda k: (latest.top1(e.filter(F.col("event_type") == k), ["user_id"], ["-ts", "-event_id"]), "ts")
    base = e.select("user_id").distinct()
    return latest.argmax_sources(
        base, "user_id", {k: one(k) for k in ("click", "view", "purchase")}, "last_seen"
    )


@query(
    "order_status_waterfall",
    "R37 R59 R53 R61",
    """
    SELECT o_orderkey,
      CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '1-URGENT' THEN 'hurry'
        WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN 'old' ELSE 'waiting' END AS state,
      CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'large' END AS band,
      CAST(greatest(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01'), 0) AS INTEGER) AS late_days,
      (o_orderdate <= TIMESTAMP '2000-01-01 00:00:00' AND (o_orderstatus = 'O' OR o_orderdate + INTERVAL 100 DAY > TIMESTAMP '2000-01-01 00:00:00')) AS open_now
    FROM orders
    """,
)
def order_status_waterfall(t: Tables):
    now = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    o = _orders(t)
    end = F.when(F.col("o_orderstatus") != "O", F.expr("o_orderdate + INTERVAL 100 DAY"))
    return o.select(
        "o_orderkey",
        rules.waterfall(
            [
                (F.col("o_orderstatus") == "F", F.lit("done")),
                (F.col("o_orderpriority") == "1-URGENT", F.lit("hurry")),
                (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"), F.lit("old")),
            ],
            F.lit("waiting"),
        ).alias("state"),
        rules.bands(F.col("o_totalprice"), [50000, 200000], ["small", "middle", "large"]).alias("band"),
        rules.days_late(now, F.col("o_orderdate")).alias("late_days"),
        rules.active_at(F.col("o_orderdate"), end, now).alias("open_now"),
    )


@query(
    "part_code_flags",
    "R38",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 1 ELSE 0 END AS budget,
      CASE WHEN p_type IN ('PROMO') THEN 1 ELSE 0 END AS promo,
      CAST(CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size = 50) THEN 1 ELSE 0 END AS INTEGER) AS big_brand
    FROM part
    """,
)
def part_code_flags(t: Tables):
    p = rules.code_flags(
        t.part.select("p_partkey", "p_type", "p_brand"), "p_type", {"budget": ["ECONOMY", "SMALL"], "promo": ["PROMO"]}
    )
    members = t.part.filter("p_size = 50").select("p_brand", F.lit("big_brand").alias("flag"))
    return rules.flags_by_table(p, "p_brand", members, "p_brand", "flag", ["big_brand"]).select(
        "p_partkey", "budget", "promo", "big_brand"
    )


TREE = """
    WITH edges AS (
      SELECT 'r' || r_regionkey AS child, 'world' AS parent FROM region UNION ALL
      SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL
      SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL
      SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders)
"""


def _edges(t: Tables):
    pair = lambda df, p, c, q, d: df.select(
        F.concat(F.lit(p), F.col(c)).alias("child"),
        (F.concat(F.lit(q), F.col(d)) if d else F.lit(q)).alias("parent"),
    )
    return merge.union_rows(
        [
            pair(t.region, "r", "r_regionkey", "world", None),
            pair(t.nation, "n", "n_nationkey", "r", "n_regionkey"),
            pair(t.customer, "c", "c_custkey", "n", "c_nationkey"),
            pair(t.orders, "o", "o_orderkey", "c", "o_custkey"),
        ]
    )


@query(
    "members_of_regions",
    "R39 F3",
    TREE
    + """
    SELECT 'r' || r_regionkey AS root, m.child AS member FROM region
    JOIN (SELECT a.parent AS top, a.child FROM edges a UNION
          SELECT a.parent, b.child FROM edges a JOIN edges b ON b.parent = a.child UNION
          SELECT a.parent, c.child FROM edges a JOIN edges b ON b.parent = a.child JOIN edges c ON c.parent = b.child) m
      ON m.top = 'r' || r_regionkey
    """,
)
def members_of_regions(t: Tables):
    roots = t.region.select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("root"))
    return tree.set_closure(_edges(t), "parent", "child", roots, 4)


@query(
    "nearest_tagged_ancestor",
    "R40 S13",
    TREE
    + """
    , tags AS (SELECT 'n' || n_nationkey AS t FROM nation WHERE n_nationkey % 3 = 0 UNION SELECT 'r' || r_regionkey FROM region
      WHERE r_regionkey <> 2 UNION SELECT 'c' || c_custkey FROM customer WHERE c_custkey % 7 = 0)
    SELECT e.child AS node, CASE WHEN e.child IN (SELECT t FROM tags) THEN e.child WHEN p1.parent IN (SELECT t FROM tags) THEN p1.parent
      WHEN p2.parent IN (SELECT t FROM tags) THEN p2.parent WHEN p3.parent IN (SELECT t FROM tags) THEN p3.parent END AS ancestor_id
    FROM edges e LEFT JOIN edges p1 ON p1.child = e.child LEFT JOIN edges p2 ON p2.child = p1.parent LEFT JOIN edges p3 ON p3.child = p2.parent
    """,
)
def nearest_tagged_ancestor(t: Tables):
    nodes = _edges(t).withColumnRenamed("child", "node")
    tags = merge.union_rows(
        [
            t.nation.filter("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("node")),
            t.region.filter("r_regionkey <> 2").select(F.concat(F.lit("r"), "r_regionkey").alias("node")),
            t.customer.filter("c_custkey % 7 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("node")),
        ]
    )
    return tree.tagged_ancestor(nodes, tags, "node", "parent")


@query(
    "order_lines_through_group",
    "R41 F12",
    """
    WITH s AS (
      SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS returned_price,
        string_agg(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_linestatus END, ', ' ORDER BY CASE WHEN l_returnflag = 'A' THEN l_linestatus END) AS accepted_status
      FROM lineitem GROUP BY l_orderkey)
    SELECT l.l_orderkey, l.l_partkey AS anchor_part, s.returned_price, s.accepted_status
    FROM lineitem l LEFT JOIN s ON s.l_orderkey = l.l_orderkey WHERE l.l_linenumber = 1
    """,
)
def order_lines_through_group(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    return eav.group_attr(
        lines,
        F.col("l_linenumber") == 1,
        {"anchor_part": "l_partkey"},
        "l_orderkey",
        {
            "returned_price": Answer(F.col("l_returnflag") == "R", F.col("l_extendedprice"), "max"),
            "accepted_status": Answer(F.col("l_returnflag") == "A", F.col("l_linestatus"), "list", ", "),
        },
    )


@query(
    "parts_with_reference_table",
    "R44 D5",
    """
    SELECT p_partkey, category, subcategory FROM part LEFT JOIN (VALUES ('ECONOMY', 'stock', 'basic'), ('PROMO', 'campaign', 'basic'),
      ('LARGE', 'stock', 'bulk')) v(code, category, subcategory) ON code = p_type
    """,
)
def parts_with_reference_table(t: Tables):
    from wardmill.sources.reference import literal_table

    ref = literal_table(
        t.spark,
        "code string, category string, subcategory string",
        [("ECONOMY", "stock", "basic"), ("PROMO", "campaign", "basic"), ("LARGE", "stock", "bulk")],
    )
    return enrich.decode(
        t.part.select("p_partkey", "p_type"), ref, "p_type", "code", {"category": "category", "subcategory": "subcategory"}
    ).drop("p_type")


@query(
    "order_facilities",
    "R45",
    """
    SELECT o_orderkey, vl.r_name AS visit_location, el.r_name AS encounter_location,
      coalesce(vl.r_name, CASE WHEN el.r_regionkey <> 1 THEN 'near ' || el.r_name END, 'Unknown Location') AS facility
    FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 4 <> 0
    LEFT JOIN region vl ON vl.r_regionkey = c_custkey % 5
    LEFT JOIN region el ON el.r_regionkey = o_orderkey % 6
    """,
)
def order_facilities(t: Tables):
    visits = t.customer.filter("c_custkey % 4 <> 0").selectExpr("c_custkey AS visit_id", "c_custkey % 5 AS location_id")
    locs = t.region.selectExpr(
        "CAST(r_regionkey AS BIGINT) AS location_id",
        "r_name AS location_name",
        "CASE WHEN r_regionkey <> 1 THEN 'near ' || r_name END AS facility",
    )
    o = t.orders.selectExpr("o_orderkey", "o_custkey AS visit_id", "o_orderkey % 6 AS location_id")
    return enrich.resolve_facility(o, visits, locs, locs).select(
        "o_orderkey", "visit_location", "encounter_location", "facility"
    )


def _rules():
    return [
        Rule("pending large order", "orders", (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)),
        Rule(
            "urgent order not filled", "orders", F.col("o_orderstatus") != "F", F.col("o_orderpriority") == "1-URGENT"
        ),
        Rule("impossible price", "orders", F.col("o_totalprice") < 0),
        Rule("negative balance", "customer", F.col("c_acctbal") < 0),
        Rule("low balance builder", "customer", F.col("c_acctbal") < 500, F.col("c_mktsegment") == "BUILDING"),
    ]


@query(
    "rule_summary",
    "R46",
    """
    SELECT rule, violations, total, round(violations * 100.0 / total, 1) AS percent FROM (
      SELECT 'pending large order' AS rule, count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 400000) AS violations, count(*) AS total FROM orders
      UNION ALL SELECT 'urgent order not filled', count(*) FILTER (o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT'), count(*) FILTER (o_orderpriority = '1-URGENT') FROM orders
      UNION ALL SELECT 'impossible price', count(*) FILTER (o_totalprice < 0), count(*) FROM orders
      UNION ALL SELECT 'negative balance', count(*) FILTER (c_acctbal < 0), count(*) FROM customer
      UNION ALL SELECT 'low balance builder', count(*) FILTER (c_acctbal < 500 AND c_mktsegment = 'BUILDING'), count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer)
    WHERE violations > 0
    """,
)
def rule_summary(t: Tables):
    return rules.rule_summary({"orders": t.orders, "customer": t.customer}, _rules())


@query(
    "rule_details",
    "R46",
    """
    SELECT o_orderkey, o_custkey, 'pending large order' AS rule FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    UNION ALL SELECT o_orderkey, o_custkey, 'urgent order not filled' FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT'
    """,
)
def rule_details(t: Tables):
    return rules.rule_details(t.orders, [r for r in _rules() if r.table == "orders"], ["o_orderkey", "o_custkey"])


@query(
    "session_minutes",
    "R47",
    """
    WITH s AS (
      SELECT user_id * 100 + day(ts) AS login_id, min(ts) FILTER (event_type = 'signup') AS login_ts, max(ts) FILTER (event_type = 'error') AS logout_ts,
        max(ts) FILTER (event_type = 'view') AS expired_ts FROM events GROUP BY 1),
    m AS (SELECT *, CAST(trunc(epoch(logout_ts - login_ts) / 60) AS BIGINT) AS a, CAST(trunc(epoch(expired_ts - login_ts) / 60) AS BIGINT) AS b FROM s WHERE login_ts IS NOT NULL)
    SELECT login_id, login_ts, logout_ts, expired_ts, coalesce(a, CASE WHEN b - 30 < 0 THEN b ELSE b - 30 END) AS active_minutes FROM m
    """,
)
def session_minutes(t: Tables):
    log = t.events.selectExpr("user_id * 100 + day(ts) AS login_id", "event_type", "ts")
    return rules.session_minutes(log, "login_id", "event_type", "ts", "signup", "error", "view")


@query(
    "first_and_last_lookup",
    "R48",
    """
    SELECT c_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM customer
    LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
    """,
)
def first_and_last_lookup(t: Tables):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return latest.agg_lookup(
        t.customer.select("c_custkey"), o, ["c_custkey"], first_order=F.min("o_orderdate"), last_order=F.max("o_orderdate")
    )


@query(
    "surrogate_keys",
    "S10 S3 R50",
    """
    SELECT '7-' || c_custkey AS warehouse_key, c_name AS plain_key, 'north' AS site, 7 AS partition_num FROM customer
    """,
)
def surrogate_keys(t: Tables):
    from wardmill.sources.warehouse import tag_site

    df = t.customer.select(
        enrich.surrogate_key(7, F.col("c_custkey"), True).alias("warehouse_key"),
        enrich.surrogate_key("north", F.col("c_name"), True).alias("plain_key"),
        "c_acctbal",
    ).drop("c_acctbal")
    return tag_site(df, "north", 7)


@query(
    "order_modifiers",
    "R51",
    """
    SELECT l_orderkey AS encounter_id, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS users_modified,
      string_agg(DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR), ',' ORDER BY CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS dates_modified
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE l_suppkey <> o_custkey % 10 GROUP BY l_orderkey
    """,
)
def order_modifiers(t: Tables):
    lines = enrich.decode(t.lineitem, t.supplier, "l_suppkey", "s_suppkey", {"creator_name": "s_name"}).select(
        F.col("l_orderkey").alias("encounter_id"),
        F.col("l_suppkey").alias("creator"),
        "creator_name",
        F.col("l_shipdate").alias("date_created"),
    )
    enc = t.orders.selectExpr("o_orderkey AS encounter_id", "o_custkey % 10 AS creator")
    return enrich.modifiers(lines, enc)


@query(
    "stable_row_ids",
    "R52",
    """
    SELECT event_id, user_id, ts, md5(concat_ws(chr(31), '=' || event_id, '=' || user_id, '=' || CAST(ts AS VARCHAR))) AS row_id FROM events
    """,
)
def stable_row_ids(t: Tables):
    return merge.row_id(t.events.select("event_id", "user_id", "ts"), ["event_id", "user_id", "ts"])


@query(
    "earliest_of_sources",
    "R54",
    """
    WITH x AS (
      SELECT user_id, min(ts) FILTER (event_type = 'purchase' AND value > 100) AS a, min(ts) FILTER (event_type = 'signup') AS b FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN coalesce(a, TIMESTAMP '9999-12-31 00:00:00') < coalesce(b, TIMESTAMP '9999-12-31 00:00:00') THEN a ELSE b END AS start_ts,
      CAST(CASE WHEN coalesce(a, TIMESTAMP '9999-12-31 00:00:00') < coalesce(b, TIMESTAMP '9999-12-31 00:00:00') THEN 1 ELSE 0 END AS INTEGER) AS purchase_first FROM x
    """,
)
def earliest_of_sources(t: Tables):
    kind = F.col("event_type")
    x = eav.pivot(
        t.events,
        ["user_id"],
        {
            "a": Answer((kind == "purchase") & (F.col("value") > 100), F.col("ts"), "min"),
            "b": Answer(kind == "signup", F.col("ts"), "min"),
        },
    )
    start, first = rules.earliest_of(F.col("a"), F.col("b"))
    return x.select("user_id", start.alias("start_ts"), first.alias("purchase_first"))


@query(
    "trailing_months_extract",
    "R56",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01 00:00:00' AND o_orderdate < TIMESTAMP '2001-07-16 00:00:00'
    """,
)
def trailing_months_extract(t: Tables):
    from wardmill.sources.site import date_window, trailing_months

    o = t.orders.select("o_orderkey", "o_orderdate")
    return date_window(trailing_months(o, "o_orderdate", "2001-07-15", 13), "o_orderdate", None, "2001-07-15")


@query(
    "table_freshness",
    "R57 D6",
    """
    WITH u AS (
      SELECT CAST(c_nationkey AS VARCHAR) AS k, 'orders' AS tab, o_orderdate AS ts FROM orders JOIN customer ON c_custkey = o_custkey UNION ALL
      SELECT CAST(s_nationkey AS VARCHAR), 'shipments', l_shipdate FROM lineitem JOIN supplier ON s_suppkey = l_suppkey UNION ALL
      SELECT CAST(user_id % 25 AS VARCHAR), 'events', ts FROM events)
    SELECT k AS location, max(ts) FILTER (tab = 'orders') AS orders, max(ts) FILTER (tab = 'shipments') AS shipments,
      max(ts) FILTER (tab = 'events') AS events FROM u GROUP BY k
    """,
)
def table_freshness(t: Tables):
    # reduce each fact table on its own key first, then decode the few keys left
    o = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("ts"))
    s = t.lineitem.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("ts"))
    o = enrich.decode(o, t.customer, "o_custkey", "c_custkey", {"k": "c_nationkey"})
    s = enrich.decode(s, t.supplier, "l_suppkey", "s_suppkey", {"k": "s_nationkey"})
    e = t.events.select((F.col("user_id") % 25).alias("k"), "ts")
    return latest.freshness(
        {"orders": (o, ["k"], "ts"), "shipments": (s, ["k"], "ts"), "events": (e, ["k"], "ts")}, ["location"]
    )


@query(
    "latest_versus_prior",
    "R60 R9 R49",
    """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    SELECT o_custkey, max(o_totalprice) FILTER (rn = 1) AS latest, max(o_totalprice) FILTER (rn = 2) AS prior,
      CASE WHEN max(o_totalprice) FILTER (rn = 2) IS NULL THEN NULL
        WHEN max(o_totalprice) FILTER (rn = 1) > max(o_totalprice) FILTER (rn = 2) THEN 'increased'
        WHEN max(o_totalprice) FILTER (rn = 1) < max(o_totalprice) FILTER (rn = 2) THEN 'decreased' ELSE 'unchanged' END AS change
    FROM r WHERE rn <= 2 GROUP BY o_custkey
    """,
)
def latest_versus_prior(t: Tables):
    two = latest.top_n(t.orders, ["o_custkey"], ["-o_orderdate", "-o_orderkey"], 2)
    x = two.groupBy("o_custkey").agg(
        F.max(F.when(F.col("position") == 1, F.col("o_totalprice"))).alias("latest"),
        F.max(F.when(F.col("position") == 2, F.col("o_totalprice"))).alias("prior"),
    )
    return x.withColumn("change", rules.change_class(F.col("latest"), F.col("prior")))


@query(
    "related_supplier",
    "R62",
    """
    WITH e AS (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC) AS rn FROM lineitem)
    SELECT o_orderkey, l_suppkey AS last_supplier FROM orders LEFT JOIN (SELECT * FROM e WHERE rn = 1) ON l_orderkey = o_orderkey
    """,
)
def related_supplier(t: Tables):
    edges = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate")
    return enrich.related(
        t.orders.select("o_orderkey"), edges, "o_orderkey", "l_orderkey", "l_suppkey", ["-l_shipdate", "-l_suppkey"], "last_supplier"
    )


@query(
    "screening_result",
    "R63",
    """
    WITH p AS (
      SELECT user_id, day(ts) AS d, max(CASE WHEN event_type = 'click' THEN CASE WHEN value > 40 THEN 'yes' ELSE 'no' END END) AS a,
        max(CASE WHEN event_type = 'view' THEN CASE WHEN value > 40 THEN 'yes' ELSE 'no' END END) AS b,
        max(CASE WHEN event_type = 'signup' AND value > 80 THEN 'no' END) AS explicit FROM events GROUP BY 1, 2)
    SELECT user_id, CAST(d AS INTEGER) AS visit_day, coalesce(explicit, CASE WHEN a = 'yes' OR b = 'yes' THEN 'yes' WHEN a IS NOT NULL OR b IS NOT NULL THEN 'no' END) AS result
    FROM p
    """,
)
def screening_result(t: Tables):
    e = t.events.withColumn("visit_day", F.dayofmonth("ts"))
    yn = F.when(F.col("value") > 40, "yes").otherwise("no")
    kind = F.col("event_type")
    p = eav.pivot(
        e,
        ["user_id", "visit_day"],
        {
            "a": Answer(kind == "click", yn, "max"),
            "b": Answer(kind == "view", yn, "max"),
            "x": Answer((kind == "signup") & (F.col("value") > 80), F.lit("no"), "max"),
        },
    )
    return p.select(
        "user_id",
        "visit_day",
        eav.any_symptom([F.col("a"), F.col("b")], F.col("x"), F.lit("yes"), F.lit("no")).alias("result"),
    )


@query(
    "monthly_skeleton_kpis",
    "R16 R42",
    """
    WITH m AS (
      SELECT c_mktsegment AS category, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS placed,
        count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 490000) AS large_pending
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
    frame AS (
      SELECT category, month_start, indicator FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders)
      CROSS JOIN (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'), ('NONE')) c(category)
      CROSS JOIN (VALUES ('placed'), ('filled'), ('large_pending')) i(indicator))
    SELECT f.category, f.month_start, f.indicator, coalesce(CASE f.indicator WHEN 'placed' THEN placed WHEN 'filled' THEN filled ELSE large_pending END, 0) AS total
    FROM frame f LEFT JOIN m ON m.category = f.category AND m.month_start = f.month_start
    """,
)
def monthly_skeleton_kpis(t: Tables):
    o = t.orders.withColumn("month_start", D.month_start(F.col("o_orderdate")))
    # counted per customer and month before the join that brings the category
    per = o.groupBy("o_custkey", "month_start").agg(
        F.count(F.lit(1)).alias("placed"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("filled"),
        F.count(F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 490000), 1)).alias("large_pending"),
    )
    cols = ["placed", "filled", "large_pending"]
    m = (
        per.join(t.customer.select("c_custkey", F.col("c_mktsegment").alias("category")), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("category", "month_start")
        .agg(*[F.sum(c).alias(c) for c in cols])
    )
    frame = spine.skeleton(
        o.select("month_start").distinct(),
        category=["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NONE"],
        indicator=cols,
    )
    return spine.kpi_long(m, ["category", "month_start"], cols, frame, "indicator", "total")


@query(
    "text_expressions",
    "2.6",
    """
    SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS priority_code, o_orderpriority LIKE '%URGENT' AS urgent,
      regexp_matches(o_orderpriority, '^[0-9]+-N') AS unspecified, lower(trim(o_orderstatus)) AS status,
      CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS INTEGER) AS status_rank,
      o_orderstatus IN ('O', 'P') AS listed, coalesce(CASE WHEN o_orderstatus = 'F' THEN 'x' END, '') || o_orderstatus AS skipped,
      CAST(o_orderkey % 24 AS INTEGER) * 3600 AS clock_seconds
    FROM orders
    """,
)
def text_expressions(t: Tables):
    o = _orders(t)
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    ts = F.expr("o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR")
    return o.select(
        "o_orderkey",
        F.substring_index(p, "-", 1).alias("priority_code"),
        p.like("%URGENT").alias("urgent"),
        p.rlike("^[0-9]+-N").alias("unspecified"),
        F.lower(F.trim(s)).alias("status"),
        D.list_rank(s, ["F", "P"]).alias("status_rank"),
        D.in_list(s, "O,P").alias("listed"),
        D.concat_skip_null(F.when(s == "F", "x"), s).alias("skipped"),
        D.seconds_of_day(ts).alias("clock_seconds"),
    )
