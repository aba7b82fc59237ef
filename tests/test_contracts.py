"""Schema contracts: classes of difference, values that a cast would lose, and the writers that hold to them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardmill.sources import contracts as C
from wardmill.sources import site as S
from wardmill.sources import warehouse as W
from wardmill.sources.staging import Published, shared_folder


def contract(ddl):
    made = C.Contracts()
    made.declare("t", ddl)
    return made.schemas["t"]


@pytest.mark.parametrize(
    ("have", "want", "kind"),
    [
        ("a int", "a bigint", "widening"), ("a bigint", "a int", "narrowing"), ("a date", "a timestamp_ntz", "widening"),
        ("a timestamp_ntz", "a date", "narrowing"), ("a int", "a string", "widening"), ("a string", "a int", "narrowing"),
        ("a float", "a double", "widening"), ("a bigint", "a double", "narrowing"), ("a decimal(10,2)", "a decimal(12,2)", "widening"),
        ("a decimal(12,2)", "a decimal(12,4)", "narrowing"), ("a int", "a decimal(10,0)", "widening"), ("a boolean", "a int", "narrowing"),
    ],
)
def test_classes_of_types(spark, have, want, kind):
    found = C.drifts(spark.createDataFrame([], have), contract(want))
    assert [d.kind for d in found] == [kind]


def test_missing_and_extra(spark):
    df = spark.createDataFrame([(1, "x")], "b int, z string")
    found = C.drifts(df, contract("a date, b int"))
    assert [(d.kind, d.column) for d in found] == [("missing", "a"), ("extra", "z")]
    with pytest.raises(C.ContractError, match="a date is missing; z string is unexpected"):
        C.fitted(df, contract("a date, b int"), "t")
    got = C.fitted(df, contract("a date, b int"), add_missing=True, drop_extra=True)
    assert got.dtypes == [("a", "date"), ("b", "int")] and got.collect() == [(None, 1)]


def test_narrowing_looks_at_the_values(spark):
    small = spark.createDataFrame([(5, "7", dt.datetime(2020, 1, 1)), (None, None, None)], "a bigint, b string, c timestamp_ntz")
    want = contract("a int, b int, c date")
    assert C.failing(small, want) == []
    assert C.fitted(small, want).collect() == [(5, 7, dt.date(2020, 1, 1)), (None, None, None)]
    with pytest.raises(C.ContractError, match="narrowing"):
        C.fitted(small, want, narrow=False)
    large = spark.createDataFrame([(5_000_000_000, "seven", dt.datetime(2020, 1, 1, 8)), (1, "8", None)], small.schema)
    assert [(d.kind, d.column, d.rows) for d in C.failing(large, want)] == [("failing", "a", 1), ("failing", "b", 1), ("failing", "c", 1)]
    with pytest.raises(C.ContractError, match=r"a is bigint, declared int: failing \(1 rows\)"):
        C.fitted(large, want)


def test_registry_round_trip(spark, tmp_path):
    reg = C.Contracts()
    reg.declare("visits", "visit_id string, started timestamp_ntz, cost decimal(12,2)")
    reg.declare("people", "id bigint, tags array<string>")
    reg.write(spark, str(tmp_path / "contracts"))
    again = C.Contracts.read(spark, str(tmp_path / "contracts"))
    assert again.schemas == reg.schemas
    reg.declare("people", "id bigint, tags array<string>")
    with pytest.raises(ValueError, match="declared otherwise"):
        reg.declare("people", "id int")
    df = spark.createDataFrame([("1", None, None)], "visit_id string, started timestamp_ntz, cost decimal(10,2)")
    assert [(t, d.kind) for t, d in again.report({"visits": df})] == [("visits", "widening")]
    assert again.fitted(df, "visits").schema == reg.schemas["visits"]


def test_writers_hold_to_the_contract(spark, tmp_path):
    path = str(tmp_path / "t")
    want = contract("id bigint, day date, site string")
    good = W.tag_site(spark.createDataFrame([(1, dt.date(2020, 1, 1))], "id int, day date"), "n", 1)
    W.write_site_partition(good, path, 1, want)
    bad = W.tag_site(spark.createDataFrame([(1, "soon")], "id int, day string"), "s", 2)
    with pytest.raises(C.ContractError):
        W.write_site_partition(bad, path, 2, want)
    got = W.read_warehouse(spark, path)
    assert dict(got.dtypes) == {"id": "bigint", "day": "date", "site": "string", "partition_num": "int"} and got.count() == 1
    spark.sql("CREATE DATABASE IF NOT EXISTS wm_contract")
    W.publish(good.drop("partition_num"), "wm_contract", "t", want)
    with pytest.raises(C.ContractError):
        W.publish(bad.drop("partition_num"), "wm_contract", "t", want)
    assert spark.table("wm_contract.t").count() == 1
    spark.sql("DROP DATABASE wm_contract CASCADE")


def test_a_site_without_a_column_gives_the_same_schema(spark, tmp_path):
    full = spark.createDataFrame([(1, "why")], "id bigint, reason string")
    full.write.parquet(str(tmp_path / "a/person.parquet"))
    full.drop("reason").write.parquet(str(tmp_path / "b/person.parquet"))
    got = [S.ParquetSite(spark, n, 1, str(tmp_path / n)).with_columns("person", {"reason": "string", "other": "date"}) for n in "ab"]
    assert got[0].schema == got[1].schema and got[0].collect() == [(1, "why", None)] and got[1].collect() == [(1, None, None)]
    assert set(S.ParquetSite(spark, "b", 1, str(tmp_path / "b")).columns("person")) == {"id"}


def test_shared_tables_belong_to_their_site(spark, tmp_path):
    """Sites of one name over other folders, made one after another, never see each other's tables."""
    for k in range(6):
        spark.createDataFrame([(k,)], "id int").write.parquet(str(tmp_path / f"run{k}/t.parquet"))
    for k in range(6):
        site = S.ParquetSite(spark, "one", 1, str(tmp_path / f"run{k}"))
        for _ in range(2):
            assert [r.id for r in site.published("made", lambda s=site: s.read("t")).collect()] == [k]
        site.refresh()
        made = site.published("made", lambda s=site: s.read("t").withColumn("id", F.col("id") + 100))
        assert [r.id for r in made.collect()] == [k + 100]


def test_no_machine_local_folder_on_a_cluster(spark):
    class Other:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Other)
    assert Published(spark).paths == {}
