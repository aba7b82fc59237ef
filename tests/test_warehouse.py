"""Sources, sinks, schema contract and incremental refresh on temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.sources import site as S
from wardmill.sources import warehouse as W
from wardmill.sources.reference import DRUG_CATEGORIES, literal_table, reference_file
from wardmill.streaming import incremental as inc


def test_conform_orders_casts_and_rejects(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    df = spark.createDataFrame([(1, "x")], "b long, a string")
    assert W.conform(df, schema).dtypes == [("a", "string"), ("b", "int")]
    with pytest.raises(ValueError, match="missing"):
        W.conform(df.drop("a"), schema)
    with pytest.raises(ValueError, match="unexpected"):
        W.conform(df.withColumn("c", F.lit(1)), schema)


def test_site_partition_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,), (2,)], "id int")
    W.write_site_partition(W.union_sites([W.tag_site(one, "n", 1), W.tag_site(one, "s", 2)]), path)
    W.write_site_partition(W.tag_site(spark.createDataFrame([(9,)], "id int"), "n", 1), path)
    got = sorted((r.partition_num, r.id) for r in W.read_warehouse(spark, path).collect())
    assert got == [(1, 9), (2, 1), (2, 2)]
    plan = W.read_warehouse(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_num" in plan


def test_emptied_site_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,), (2,)], "id int")
    for n in (1, 2):
        W.write_site_partition(W.tag_site(one, "n", n), path, n)
    W.write_site_partition(W.tag_site(one.limit(0), "n", 1), path, 1)
    assert sorted((r.partition_num, r.id) for r in W.read_warehouse(spark, path).collect()) == [(2, 1), (2, 2)]
    with pytest.raises(ValueError, match="another partition"):
        W.write_site_partition(W.tag_site(one, "n", 3), path, 1)


def test_publish_survives_a_crash_before_the_swap(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS wm_crash")
    W.publish(spark.createDataFrame([(1,)], "id int"), "wm_crash", "pub")
    with monkeypatch.context() as m:
        m.setattr(W.re, "escape", lambda s: 1 / 0)  # dies after the swap, before old versions go
        with pytest.raises(ZeroDivisionError):
            W.publish(spark.createDataFrame([(2,)], "id int"), "wm_crash", "pub")
    assert [r.id for r in spark.table("wm_crash.pub").collect()] == [2]
    spark.createDataFrame([(3,)], "id int").write.saveAsTable("wm_crash.pub_v" + "0" * 32)  # died before the swap
    assert [r.id for r in spark.table("wm_crash.pub").collect()] == [2]
    W.publish(spark.createDataFrame([(4,)], "id int"), "wm_crash", "pub")
    assert [r.id for r in spark.table("wm_crash.pub").collect()] == [4]
    assert len(spark.catalog.listTables("wm_crash")) == 2
    spark.sql("DROP DATABASE wm_crash CASCADE")


def test_publish_swaps_by_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wm_test")
    W.publish(spark.createDataFrame([(1,)], "id int"), "wm_test", "pub")
    W.publish(spark.table("wm_test.pub").withColumn("id", F.col("id") + 1), "wm_test", "pub")
    assert [r.id for r in spark.table("wm_test.pub").collect()] == [2]
    spark.sql("DROP DATABASE wm_test CASCADE")


def test_missing_optional_table_gives_typed_empty_frame(spark, tmp_path):
    site = S.ParquetSite(spark, "n", 1, str(tmp_path))
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    assert S.extract_if(site, "none", lambda: 1 / 0, schema).schema == schema
    spark.createDataFrame([(1,)], schema).write.parquet(site.path("some"))
    assert S.extract_if(site, "some", lambda: site.read("some"), schema).count() == 1


def test_jdbc_site_reads_in_slices(spark):
    site = S.JdbcSite(spark, "n", 1, "jdbc:x", {"user": "u"}, {"obs": ("obs_id", 1, 100, 8)})
    o = site.options("obs")
    assert o["partitionColumn"] == "obs_id" and o["numPartitions"] == "8"
    assert "partitionColumn" not in site.options("visit")
    with pytest.raises(ValueError, match="needs bounds"):
        site.options("orders")


def test_reference_file_is_read_by_contract(spark, tmp_path):
    f = tmp_path / "d.csv"
    f.write_text("product_code,product_name,category_name,subcategory,on_global_form,on_HA_form\n1,n,c,,Yes,No\n")
    assert reference_file(spark, str(f), DRUG_CATEGORIES).first()["category_name"] == "c"
    assert literal_table(spark, "a int, b string", [(1, "x"), (2, None)]).count() == 2


def ts(d):
    return dt.datetime(2020, 1, d)


def test_incremental_equals_full_refresh_and_is_repeatable(spark, tmp_path):
    path, log, stage = (str(tmp_path / n) for n in ("table", "log", "stage"))
    tag = lambda rows: W.tag_site(spark.createDataFrame(rows, "id int, patient_id string, v string"), "n", 1)
    feed = lambda rows: spark.createDataFrame(rows, "patient_id string, last_updated timestamp_ntz").withColumn("partition_num", F.lit(1))
    args = lambda fresh, ch: (spark, path, log, "t", 1, fresh, ch, ts(30), stage)
    first = tag([(1, "a", "x"), (2, "b", "x"), (3, "c", "x")])
    inc.incremental_refresh(*args(first, feed([("a", ts(1)), ("b", ts(2)), ("c", ts(2))])))
    # b changed, c deleted (it is in the feed but not in the source any more), d is new
    second = tag([(1, "a", "x"), (2, "b", "y"), (5, "b", "z"), (4, "d", "x")])
    changes = feed([("a", ts(1)), ("b", ts(5)), ("c", ts(5)), ("d", ts(6))])
    for _ in range(2):
        inc.incremental_refresh(*args(second, changes))
        got = sorted((r.id, r.v) for r in W.read_warehouse(spark, path).collect())
        assert got == sorted((r.id, r.v) for r in second.collect())
    assert inc.prev_watermark(inc.read_log(spark, log), "t", 1) == ts(6)
    inc.incremental_refresh(*args(second, feed([])))  # empty feed changes nothing
    assert W.read_warehouse(spark, path).count() == 4


def test_stream_applies_latest_change_per_patient(spark, tmp_path):
    feed, chk = str(tmp_path / "feed"), str(tmp_path / "chk")
    schema = "patient_id string, last_updated timestamp_ntz, deleted boolean"
    spark.createDataFrame([("a", ts(1), False), ("a", ts(2), True), ("b", ts(1), False)], schema).write.parquet(feed)
    seen = []
    q = inc.follow_changes(spark, feed, schema, lambda df, i: seen.extend((r.patient_id, r.deleted) for r in df.collect()), chk)
    q.awaitTermination(120)
    assert sorted(seen) == [("a", True), ("b", False)]
