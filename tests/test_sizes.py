"""Size estimates of the clinic's tables that hold several rows per row of a driver table."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmill.catalog import registry
from wardmill.catalog.base import SCHEMAS
from wardmill.catalog.clinic_tables import Dictionary, DriverSite
from wardmill.operators import enrich
from wardmill.plans.extract.clinic import Clinic, Q


def estimate(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def test_estimates_count_the_rows_of_an_expansion(spark, tmp_path):
    at = dt.datetime(2000, 1, 1)
    rows = [(i, i % 7, "O", 1.0, at, "1-URGENT") for i in range(50)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    site = DriverSite(spark, str(tmp_path), Dictionary(["q"], ["a"], ["t"]))
    ids = site.read("orders").select("order_id")
    states = site.read("patient_state").select("patient_state_id", "patient_program_id")
    assert states.count() == 150 and sorted(r[0] for r in states.select("patient_state_id").collect()) == [i * 4 + q for i in range(50) for q in range(3)]
    assert estimate(states) >= 3 * estimate(ids)
    assert site.read("obs").count() == 50 * 17
    assert estimate(site.read("obs").select("obs_id")) >= 17 * estimate(ids)


def driver_tables(spark, folder, n=40):
    """Small driver tables of a clinic's patients, visits and staff."""
    at = lambda i: dt.datetime(2000, 1, 1) + dt.timedelta(days=i % 90)
    rows = {
        "region": [(i, f"R{i}") for i in range(5)],
        "nation": [(i, f"N{i}", i % 5) for i in range(25)],
        "customer": [(i, f"C{i}", i % 25, 1.0, "s") for i in range(n)],
        "supplier": [(i, f"S{i}", i % 25, 1.0) for i in range(10)],
        "orders": [(i, i % n, "O", 1.0, at(i), "1-URGENT") for i in range(5 * n)],
        "events": [(i, at(i), i % 10, "view", 1.0, "{}") for i in range(n)],
    }
    for t, r in rows.items():
        spark.createDataFrame(r, SCHEMAS[t]).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def sorts_of_a_stage(plan):
    """The most sorts that run in one stage of a physical plan with shuffled joins."""
    name = plan.getClass().getSimpleName()
    below = [sorts_of_a_stage(plan.children().apply(i)) for i in range(plan.children().size())]
    done, open_ = max([b[0] for b in below], default=0), sum(b[1] for b in below) + (name == "SortExec")
    if name in ("ShuffleExchangeExec", "BroadcastExchangeExec"):
        return max(done, open_), 0
    return max(done, open_), open_


def test_few_sorts_of_the_patients_share_a_stage(spark, tmp_path):
    """Each sort holds a page of memory until its stage ends."""
    folder = driver_tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = registry()["extract_hiv_patient"].build(spark, folder)
        assert sorts_of_a_stage(df._jdf.queryExecution().executedPlan())[0] <= 12
        assert df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def scans_sorted_for_aggregates(plan, above=None):
    """Aggregates that keep texts or structs, and so sort, in the very stage that scans."""
    name = plan.getClass().getSimpleName()
    if name in ("ShuffleExchangeExec", "BroadcastExchangeExec"):
        above = None
    elif name in ("SortAggregateExec", "ObjectHashAggregateExec"):
        above = name
    found = [above] if above and name.startswith("FileSourceScan") and "o_orderkey" in plan.toString() else []
    return found + [x for i in range(plan.children().size()) for x in scans_sorted_for_aggregates(plan.children().apply(i), above)]


def test_answers_are_dealt_before_they_are_sorted(spark, tmp_path):
    folder = driver_tables(spark, tmp_path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("extract_covid_admission", "extract_chemo_session_regimens"):
            df = registry()[name].build(spark, folder)
            assert scans_sorted_for_aggregates(df._jdf.queryExecution().executedPlan()) == [], name
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


#: Columns of all such shuffles together; 254, 131 and 203 with a shuffle of the rows for every lookup.
LIMITS = {"all_lab_results": 200, "all_procedures": 60, "all_medication_prescribed": 120}


class TinySite:
    def __init__(self, **tables):
        self.tables = tables

    def read(self, name):
        return self.tables[name]


def test_rows_that_tell_nothing_are_left_out(spark):
    """Every kind of answer over rows with nulls, other answers and empty comments; the silent rows are gone before any join."""
    at = [dt.datetime(2000, 1, d) for d in (1, 2, 3)]
    obs = [
        (1, 1, 1, None, 5.0, "a", at[0], "old", at[0], False), (2, 1, 1, 8, None, None, None, None, at[1], False), (3, 1, 1, 9, 4.0, "b", None, "x", at[1], False),
        (4, 2, 1, 9, None, None, at[2], "y", at[0], None), (5, 3, 1, None, None, None, None, None, at[0], False), (6, None, 1, 8, 1.0, "z", at[0], "z", at[2], False),
        (7, 2, 2, 8, 7.0, None, None, "c", at[0], False), (8, 4, 2, 9, 7.0, "t", at[1], "c", at[0], True),
    ]
    schema = "obs_id long, encounter_id long, concept_id long, value_coded long, value_numeric double, value_text string, value_datetime timestamp_ntz, comments string, date_created timestamp_ntz, voided boolean"
    names = [(8, "Yes", "en", True, "FULLY_SPECIFIED", False), (9, "No", "en", True, "FULLY_SPECIFIED", False)]
    site = TinySite(
        obs=spark.createDataFrame(obs, schema),
        report_mapping=spark.createDataFrame([(1, "L", "q"), (2, "L", "p"), (8, "L", "1065"), (9, "L", "1066")], "concept_id long, source string, code string"),
        concept_name=spark.createDataFrame(names, "concept_id long, name string, locale string, locale_preferred boolean, concept_name_type string, voided boolean"),
    )
    c = Clinic(site, "2001-01-01")
    spec = {k: Q(k, "q") for k in ("num", "text", "date", "coded", "comment", "list", "yn", "obs", "code", "mark", "max_num", "max_text", "max_date", "max_coded", "max_comment")}
    spec |= {"yes": Q("has", "q", "1065"), "no": Q("mark", "q", "1066"), "one": Q("either", "q", ("1065", "1066")), "most": Q("max_either", "q", ("1065", "1066"))}
    spec |= {"yes_note": Q("comment", "q", "1065"), "p_num": Q("num", "p"), "unknown": Q("num", "no such question")}
    got = {r["encounter_id"]: r.asDict() for r in c.with_answers(spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "encounter_id long"), spec).collect()}
    blank = dict.fromkeys(spec) | {"yes": False}
    want = {
        1: blank | dict(num=4.0, text="b", date=at[0], coded="No", comment="x", list="No | Yes", yn=False, obs=3, code=9, mark=1, max_num=5.0, max_text="b", max_date=at[0], max_coded="Yes", max_comment="x", yes=True, no=1, most=True),
        2: blank | dict(date=at[2], coded="No", comment="y", list="No", yn=False, obs=4, code=9, mark=1, max_date=at[2], max_coded="No", max_comment="y", no=1, one=False, most=False, p_num=7.0),
        3: blank | dict(obs=5, mark=1),
        4: blank,
    }
    assert got == {k: {"encounter_id": k} | v for k, v in want.items()}
    one = {"yes": spec["yes"], "text": spec["text"]}
    left = {r["obs_id"]: r["value_text"] for r in c._telling(c.live("obs"), one).collect()}
    assert left == {1: "a", 2: None, 3: "b", 6: "z"}


def shuffles_of(plan, *columns):
    """Sizes of rows, in columns, of the shuffles that carry the named columns."""
    out = plan.output()
    names = {out.apply(i).name() for i in range(out.size())}
    mine = [out.size()] if plan.getClass().getSimpleName() == "ShuffleExchangeExec" and set(columns) <= names else []
    return mine + [x for i in range(plan.children().size()) for x in shuffles_of(plan.children().apply(i), *columns)]


def test_results_are_not_shuffled_for_lookups_of_their_encounters(spark, tmp_path):
    """Each lookup of an encounter passes over the encounters; with every join a shuffled one, the many rows move less often."""
    folder = driver_tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {}
        for name, columns in {"all_lab_results": ("obs_id", "patient_id"), "all_procedures": ("obs_id", "patient_id"), "all_medication_prescribed": ("drug_concept", "encounter_id")}.items():
            plan = registry()[f"extract_{name}"].build(spark, folder)._jdf.queryExecution().executedPlan()
            found[name] = sum(shuffles_of(plan, *columns))
        assert all(found[n] < most for n, most in LIMITS.items()), found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_gather_lookups_of_several_columns(spark):
    """Null keys, lots that are real keys, values that repeat, are missing or have only nulls: as joins give them."""
    rows = [(i, p, e) for i, (p, e) in enumerate([(1, 10), (1, 11), (2, 10), (2, None), (None, 10), (None, 12), (None, None), (0, 12), (3, 13), (1, 10)] * 3)]
    rows += [(100 + i, 7, 14) for i in range(6000)]
    r = spark.createDataFrame(rows, "id long, p long, e long")
    people = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (0, None), (7, "h"), (9, "x")], "k long, name string")
    visits = spark.createDataFrame([(10, "v", 1.0), (10, "w", None), (12, None, None), (14, "z", 2.0), (None, "n", 3.0)], "k long, place string, size double")
    want = enrich.decode(enrich.decode(r, people, "p", "k", {"name": "name"}), visits, "e", "k", {"place": "place", "size": "size"})
    of_e = lambda x: x.join(visits, F.col("e") == F.col("k"), "left").drop("k")
    of_p = lambda x: x.join(people, F.col("p") == F.col("k")).drop("k")
    plain = lambda df: sorted(map(repr, (tuple(t) for t in df.select("id", "p", "e", "name", "place", "size").collect())))
    for by in (None, ["id"], ["e", "id"]):
        for key in ("p", "e"):
            assert plain(enrich.gathered(r, key, {"e": of_e, "p": of_p}, by)) == plain(want)
    first = F.min("id").over(Window.partitionBy(enrich.AT, "p", "e"))
    got = enrich.gathered(r, "p", {"e": lambda x: x.withColumn("twice", F.col("e") * 2)}, None, lambda d: d.withColumn("first", first)).collect()
    least = {}
    for i, p, e in rows:
        least.setdefault((p, e), i)
    assert len(got) == len(rows) and all(t["first"] == least[t["p"], t["e"]] and t["twice"] == (t["e"] and t["e"] * 2) for t in got)


def moved(spark, folder, names, key="obs_id"):
    """Shuffles that carry an observation's id and time, per extract, with every join a shuffled one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = {n: registry()[f"extract_{n}"].build(spark, folder)._jdf.queryExecution().executedPlan() for n in names}
        return {n: len([x for x in shuffles_of(p, key, "obs_datetime") if x > 3]) for n, p in plans.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_diagnoses_move_once_for_all_lookups_but_those_of_concepts(spark, tmp_path):
    found = moved(spark, driver_tables(spark, tmp_path), ("all_diagnosis", "diagnoses"))
    # the names, codes and sets of a dictionary this small would be broadcast
    assert found == {"all_diagnosis": 2, "diagnoses": 2}


def test_procedures_move_once_for_encounters_and_patients(spark, tmp_path):
    # once more for users and for names, which are broadcast if they are few
    assert moved(spark, driver_tables(spark, tmp_path), ["all_procedures"]) == {"all_procedures": 3}


def test_tests_of_tuberculosis_are_numbered_where_they_gather(spark, tmp_path, force_skew):
    folder = driver_tables(spark, tmp_path)
    name = "extract_tb_lab_results"
    by_range = sorted(map(repr, registry()[name].build(spark, folder).collect()))
    spark.conf.unset("wardmill.skew.minRows")
    assert sorted(map(repr, registry()[name].build(spark, folder).collect())) == by_range and len(by_range) > 100
    # those not done move to their orders before; the lookups of users and names follow
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry()[name].build(spark, folder)._jdf.queryExecution().executedPlan()
        assert len(shuffles_of(plan, "obs_datetime")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
