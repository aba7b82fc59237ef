"""HIV programme tables: monthly snapshots, current summary and appointments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import months_crossed
from wardmill.operators import asof, latest, ordered, spine
from wardmill.operators.asof import Lookup
from wardmill.operators.eav import Answer, join_nonnull, pivot, text_list
from wardmill.operators.enrich import decode
from wardmill.operators.merge import union_rows
from wardmill.operators.rules import days_late, earliest_of, waterfall

# Results that count as a TB co-infection, by test type.
COINFECTION = {"genxpert": ["Detected"], "smear": ["1+", "++", "+++"], "culture": ["Scanty", "++", "+++"]}
RECENT_COINFECTION = {k: COINFECTION[k] for k in ("genxpert", "smear")}
TB_DIAGNOSIS = {
    "genxpert": ["Detected"],
    "skin test": ["Positive"],
    "smear": ["1+", "++", "+++"],
    "culture": ["1+", "++", "+++"],
}
GRACE_DAYS = 28
ACTIVE = "active - on arvs"


def _positive(results: dict[str, list[str]]):
    out = F.lit(False)
    for kind, values in results.items():
        out = out | ((F.col("test_type") == kind) & F.col("test_result_text").isin(values))
    return out


def _any_arv():
    return F.coalesce("arv_1_med", "arv_2_med", "arv_3_med").isNotNull()


def _is_art(any_case: bool):
    if any_case:
        return (F.upper("order_action") == "NEW") & (F.upper("drug_category") == "ART")
    return (F.col("order_action") == "NEW") & (F.col("drug_category") == "ART")


def arv_start(dispensing: DataFrame, regimens: DataFrame) -> DataFrame:
    """emr_id, arv_start_date and whether dispensing came before any prescription."""
    d = dispensing.filter(_any_arv()).groupBy("emr_id").agg(F.min("dispense_date").alias("_d"))
    r = regimens.filter(_is_art(False)).groupBy("emr_id").agg(F.min("start_date").alias("_r"))
    both = d.join(r, "emr_id", "full_outer")
    start, first = earliest_of(F.col("_d"), F.col("_r"))
    return both.select("emr_id", F.to_date(start).alias("arv_start_date"), first.alias("dispense_before_prescription"))


def hiv_monthly_reporting(
    program: DataFrame,
    visits: DataFrame,
    dispensing: DataFrame,
    regimens: DataFrame,
    viral_loads: DataFrame,
    tb_screening: DataFrame,
    tb_labs: DataFrame,
    pmtct_visits: DataFrame,
    status: DataFrame,
    vitals: DataFrame,
    diagnoses: DataFrame,
    as_of,
    since="2022-01-01",
) -> DataFrame:
    """Enrolment x month-end snapshots.

    All as-of attributes are found together; see ``asof_periods``.  The rows per
    patient are counted once, over all sources together, each as often as the scan
    has its rows.  Enrolments share the rows of their patient's months until all is
    found.
    """
    kind = [program.schema["emr_id"].dataType]
    line = lambda df, ts, key="emr_id", times=1: (*asof.time_line(df, [key], ts, kind), times)
    sizes = ordered.KeyStats.of(
        [
            line(program, "date_enrolled"), line(visits, "visit_date", times=3), line(dispensing, "dispense_date"), line(viral_loads, "date_entered", times=2),
            line(regimens, "encounter_datetime"), line(tb_screening, "tb_screening_date"), line(tb_labs, "specimen_collection_date"),
            line(pmtct_visits, "visit_date"), line(status, "start_date"), line(vitals, "encounter_datetime"),
            line(diagnoses, "obs_datetime", "patient_primary_id"),
        ],
        more=spine.MOST_MONTHS,
    )
    nxt = ordered.Ordered(
        program.select("emr_id", "date_enrolled", "date_completed", "hiv_program_id"),
        ["emr_id"],
        ["date_enrolled", "hiv_program_id"],
        sizes=sizes,
    ).scan(_next=ordered.following(F.col("date_enrolled")))
    kept = nxt.frame().filter(F.coalesce(F.col("_next") != F.col("date_completed"), F.lit(True)))
    months = spine.monthly_shared(kept, ["emr_id"], "date_enrolled", "date_completed", as_of, "_enrolments", after=since, sizes=sizes)
    months = decode(months, arv_start(dispensing, regimens), "emr_id", "emr_id", {"arv_start_date": "arv_start_date"})

    day = F.to_date
    visit_days = visits.groupBy("emr_id", "visit_date").agg(
        F.max_by("next_visit_date", "encounter_id").alias("next_visit_date")
    )
    visit_days = ordered.lag_attr(visit_days, ["emr_id"], ["visit_date"], sizes, prev=F.col("visit_date"))
    disp = dispensing.withColumn("_day", day("dispense_date"))
    vl = viral_loads
    key = ["emr_id"]
    vl_cols = lambda p: {
        f"{p}id": "hiv_vl_id",
        f"{p}taken": "vl_sample_taken_date",
        f"{p}result": "vl_result_date",
        f"{p}order": "order_date",
        f"{p}status": "status",
    }
    lookups = [
        Lookup(
            visit_days,
            key,
            "visit_date",
            {"_visit": "visit_date", "_next_visit": "next_visit_date", "second_to_latest_hiv_visit_date": "prev"},
        ),
        Lookup(
            visits,
            key,
            "visit_date",
            {"_transfer": "visit_date", "latest_transfer_in_location": "referral_transfer_location_in"},
            ["encounter_id"],
            where=F.col("referral_transfer_in") == "Transfer",
        ),
        Lookup(
            visits,
            key,
            "visit_date",
            {"latest_reason_not_on_ARV_date": "visit_date", "latest_reason_not_on_ARV": "reason_not_on_arv"},
            ["encounter_id"],
            where=F.col("reason_not_on_arv").isNotNull(),
        ),
        Lookup(
            disp,
            key,
            "_day",
            {
                "latest_dispensing_date": "dispense_date",
                "_next_dispense": "next_dispense_date",
                "latest_months_dispensed": "months_dispensed",
                "days_late_at_latest_pickup": "days_late_to_pickup",
            },
            ["dispense_date", "encounter_id"],
        ),
        Lookup(
            vl,
            key,
            "vl_sample_taken_date",
            vl_cols("_s"),
            ["date_entered", "hiv_vl_id"],
        ),
        Lookup(vl, key, "date_entered", vl_cols("_u"), ["hiv_vl_id"], where=F.col("vl_sample_taken_date").isNull()),
        Lookup(
            regimens.withColumn("_day", day("encounter_datetime")),
            key,
            "_day",
            {"latest_arv_regimen_date": "encounter_datetime", "latest_arv_regimen_line": "art_treatment_line"},
            ["encounter_datetime", "order_id"],
            where=_is_art(True),
        ),
        Lookup(
            disp,
            key,
            "_day",
            {"latest_arv_dispensed_date": "dispense_date", "latest_arv_dispensed_line": "current_art_treatment_line"},
            ["dispense_date", "encounter_id"],
            where=_any_arv(),
        ),
        Lookup(
            tb_screening,
            key,
            "tb_screening_date",
            {"_tbs_date": "tb_screening_date", "latest_tb_screening_result": "tb_screening_result"},
            ["encounter_id"],
        ),
        Lookup(
            tb_labs,
            key,
            "specimen_collection_date",
            {
                "latest_tb_test_date": "specimen_collection_date",
                "latest_tb_test_type": "test_type",
                "latest_tb_test_result": "test_result_text",
            },
            ["tb_lab_results_id"],
        ),
        Lookup(
            tb_labs,
            key,
            "specimen_collection_date",
            {"latest_tb_coinfection_date": "specimen_collection_date"},
            ["tb_lab_results_id"],
            where=_positive(COINFECTION),
        ),
        Lookup(
            visits,
            key,
            "visit_date",
            {"_b1": "visit_date", "_b1s": "breastfeeding_status", "_b1d": "last_breastfeeding_date"},
            ["encounter_id"],
            where=F.col("breastfeeding_status").isNotNull(),
        ),
        Lookup(
            pmtct_visits,
            key,
            "visit_date",
            {"_b2": "visit_date", "_b2s": "breastfeeding_status", "_b2d": "last_breastfeeding_date"},
            ["encounter_id"],
            where=F.col("breastfeeding_status").isNotNull(),
        ),
        Lookup(
            status.withColumn("_open_last", F.coalesce("end_date", F.lit("9999-12-31").cast("date"))),
            key,
            "start_date",
            {"latest_program_status_outcome_date": "start_date", "latest_program_status_outcome": "status_outcome"},
            ["_open_last", "status_id"],
        ),
        Lookup(
            vitals,
            key,
            "encounter_datetime",
            {"latest_bp_diastolic": "bp_diastolic", "_dia": "encounter_datetime"},
            ["date_entered", "all_vitals_id"],
            where=F.col("bp_diastolic").isNotNull(),
        ),
        Lookup(
            vitals,
            key,
            "encounter_datetime",
            {"latest_bp_systolic": "bp_systolic", "_sys": "encounter_datetime"},
            ["date_entered", "all_vitals_id"],
            where=F.col("bp_systolic").isNotNull(),
        ),
        Lookup(
            diagnoses,
            ["patient_primary_id"],
            "obs_datetime",
            {"_htn": "obs_datetime"},
            ["date_created", "obs_id"],
            where=F.col("diagnosis_entered").like("%HYPERTENSION"),
        ),
    ]
    t = asof.asof_periods(months, key, "reporting_date", lookups, lambda at: spine.month_end_from(at, as_of, since), sizes)
    t = t.select("*", F.inline("_enrolments"))
    t = asof.coalesce_by_date(
        t,
        ("_b1", ["_b1s", "_b1d"]),
        ("_b2", ["_b2s", "_b2d"]),
        ["date_of_last_breastfeeding_status", "latest_breastfeeding_status", "latest_breastfeeding_date"],
    )
    ref, enrolled = F.col("reporting_date"), F.col("date_enrolled")
    visit_late = days_late(ref, F.col("_next_visit"), F.col("_visit"), enrolled)
    disp_late = days_late(ref, F.col("_next_dispense"), F.col("latest_dispensing_date"), enrolled)
    started = F.trunc("arv_start_date", "MM")
    vl_of = lambda c: F.when(F.col("_sid").isNotNull(), F.col(f"_s{c}")).otherwise(F.col(f"_u{c}"))
    outcome = F.col("latest_program_status_outcome")
    return t.select(
        "emr_id",
        "date_enrolled",
        "date_completed",
        "reporting_date",
        "latest_program_status_outcome",
        "latest_program_status_outcome_date",
        F.col("_visit").alias("latest_hiv_visit_date"),
        F.col("_next_visit").alias("latest_expected_hiv_visit_date"),
        visit_late.alias("hiv_visit_days_late"),
        "second_to_latest_hiv_visit_date",
        F.col("_transfer").alias("latest_transfer_in_date"),
        "latest_transfer_in_location",
        "latest_dispensing_date",
        F.col("_next_dispense").alias("latest_expected_dispensing_date"),
        disp_late.alias("dispensing_days_late"),
        "latest_months_dispensed",
        vl_of("order").alias("latest_hiv_viral_load_order_date"),
        vl_of("status").alias("latest_hiv_viral_load_status"),
        vl_of("taken").alias("latest_hiv_viral_load_collection_date"),
        vl_of("result").alias("latest_hiv_viral_load_results_date"),
        "latest_arv_regimen_date",
        "latest_arv_regimen_line",
        "latest_arv_dispensed_date",
        "latest_arv_dispensed_line",
        "days_late_at_latest_pickup",
        "latest_reason_not_on_ARV_date",
        "latest_reason_not_on_ARV",
        day("_tbs_date").alias("latest_tb_screening_date"),
        "latest_tb_screening_result",
        "latest_tb_test_date",
        "latest_tb_test_type",
        "latest_tb_test_result",
        "latest_tb_coinfection_date",
        "date_of_last_breastfeeding_status",
        "latest_breastfeeding_status",
        "latest_breastfeeding_date",
        "arv_start_date",
        waterfall(
            [
                (started == F.trunc(ref, "MM"), F.lit("new")),
                (started < F.trunc(ref, "MM"), F.lit("existing")),
            ],
            F.lit("not on ART"),
        ).alias("monthly_arv_status"),
        waterfall(
            [
                (F.col("date_completed") < ref, outcome),
                (disp_late <= GRACE_DAYS, F.lit(ACTIVE)),
                (outcome.isNotNull() & ~outcome.like("%pregnant%"), outcome),
            ],
            F.lit("Lost to followup"),
        ).alias("latest_status"),
        "latest_bp_diastolic",
        day("_dia").alias("latest_bp_diastolic_date"),
        "latest_bp_systolic",
        day("_sys").alias("latest_bp_systolic_date"),
        F.col("_htn").isNotNull().alias("htn_diagnosis"),
        day("_htn").alias("latest_htn_diagnosis_date"),
    )


def hiv_appointment_summary(visits: DataFrame) -> DataFrame:
    """Each visit with an appointment, and the patient's next visit day.

    The next visit is looked for within the patient; visits of the same day
    follow each other in encounter order.
    """
    v = visits.select("emr_id", "encounter_id", "visit_date", "next_visit_date", "visit_location", "encounter_type")
    sizes = ordered.KeyStats.of([(v, ["emr_id"], ["visit_date"])])
    nxt = ordered.Ordered(v, ["emr_id"], ["visit_date", "encounter_id"], sizes=sizes).scan(
        _next=ordered.following(F.struct("visit_date", "visit_location", "encounter_type", "encounter_id"))
    )
    out = nxt.frame().filter(F.col("next_visit_date").isNotNull() & F.col("_next").isNotNull())
    out = out.select(
        "emr_id",
        F.col("encounter_id").alias("appointment_scheduling_encounter_id"),
        F.col("next_visit_date").alias("appointment_date"),
        F.col("_next.visit_date").alias("next_actual_visit"),
        F.col("_next.visit_location").alias("visit_location"),
        F.col("_next.encounter_type").alias("encounter_type"),
        F.col("_next.encounter_id").alias("encounter_id"),
    )
    return ordered.index_pair(out, ["emr_id"], ["appointment_date", "appointment_scheduling_encounter_id"], sizes=sizes)


def _latest(df: DataFrame, order: list[str], columns: dict[str, str], where=None) -> DataFrame:
    src = df if where is None else df.filter(where)
    return latest.top1(src, ["emr_id"], order).select("emr_id", *[F.col(c).alias(o) for o, c in columns.items()])


def hiv_patient_summary_status(
    program: DataFrame,
    patients: DataFrame,
    visits: DataFrame,
    dispensing: DataFrame,
    regimens: DataFrame,
    viral_loads: DataFrame,
    tb_labs: DataFrame,
    pmtct_visits: DataFrame,
    eid_visits: DataFrame,
    status: DataFrame,
    vitals: DataFrame,
    diagnoses: DataFrame,
    as_of,
) -> DataFrame:
    """One row per HIV patient as of ``as_of``.

    Every source is first cut to one row per patient; the joins then add
    columns to the patient list without widening it.
    """
    today = F.lit(as_of).cast("date")
    base = program.filter("emr_id is not null").groupBy("emr_id").agg(
        F.min("date_enrolled").alias("initial_enrollment_date")
    )
    start = arv_start(dispensing, regimens)
    first_disp = _latest(
        dispensing.filter(_any_arv()),
        ["dispense_date", "-encounter_id"],
        {"_m1": "arv_1_med", "_m2": "arv_2_med", "_m3": "arv_3_med"},
    )
    initial = (
        regimens.filter(_is_art(False))
        .join(start, "emr_id")
        .filter(F.to_date("start_date") == F.col("arv_start_date"))
        .groupBy("emr_id")
        .agg(text_list(F.col("drug_short_name"), ",").alias("_prescribed"))
    )
    latest_arv = _latest(
        dispensing.filter(_any_arv()),
        ["-dispense_date", "-encounter_id"],
        {"_l1": "arv_1_med", "_l2": "arv_2_med", "_l3": "arv_3_med"},
    )

    old = F.lit("1900-01-01").cast("date")
    ntz = lambda c: F.col(c).cast("timestamp_ntz")
    inh = _latest(
        visits,
        ["-visit_date", "index_desc"],
        {"s": "inh_start_date", "e": "inh_end_date"},
        (F.col("inh_start_date") > old) & ((F.col("inh_end_date") > old) | F.col("inh_end_date").isNull()),
    )
    rif = _latest(
        visits,
        ["-visit_date", "index_desc"],
        {"s": "rif_and_inh_start_date", "e": "rif_and_inh_end_date"},
        F.col("rif_and_inh_start_date").isNotNull(),
    )
    part = lambda df, name, rank, tie: df.select(
        "emr_id", name.alias("r"), ntz("s").alias("s"), ntz("e").alias("e"), F.lit(rank).alias("rank"), tie.alias("tie")
    )
    reg = regimens.filter(F.col("drug_short_name").isin("Isoniazid", "Rifapentine + Isoniazid")).select(
        "emr_id", "drug_short_name", F.col("start_date").alias("s"), F.col("end_date").alias("e"), "order_id"
    )
    none = F.lit(0).cast("bigint")
    prophylaxis = union_rows(
        [
            part(inh, F.lit("Isoniazid"), 1, none),
            part(rif, F.lit("Rifapentine + Isoniazid"), 2, none),
            part(reg, F.col("drug_short_name"), 3, F.col("order_id").cast("bigint")),
        ]
    ).withColumn("_end", F.coalesce("e", F.lit("1900-01-01").cast("timestamp_ntz")))
    prophylaxis = latest.top1(prophylaxis, ["emr_id"], ["-_end", "-s", "-rank", "-tie"]).select(
        "emr_id",
        F.col("r").alias("prophylactic_regimen"),
        F.to_date("s").alias("prophylactic_start_date"),
        F.to_date("e").alias("prophylactic_end_date"),
    )

    one = lambda df, p: df.filter("index_desc = 1").select(
        "emr_id", F.to_date("visit_date").alias(f"_{p}v"), F.to_date("next_visit_date").alias(f"_{p}n")
    )
    pickup = dispensing.filter("dispense_date_descending = 1").select(
        "emr_id",
        F.to_date("dispense_date").alias("last_med_pickup_date"),
        F.col("months_dispensed").alias("last_med_pickup_months_dispensed"),
        F.col("current_art_treatment_line").alias("last_med_pickup_treatment_line"),
        F.to_date("next_dispense_date").alias("next_med_pickup_date"),
    )
    vl = viral_loads.filter("order_desc = 1").select(
        "emr_id",
        F.to_date("order_date").alias("last_viral_load_order_date"),
        F.col("status").alias("last_viral_load_status"),
        F.col("vl_sample_taken_date").alias("last_viral_load_collection_date"),
        F.col("vl_result_date").alias("last_viral_load_results_date"),
        F.col("viral_load").alias("last_viral_load_numeric"),
        F.when(F.col("vl_coded_results") != "Detected", "t").alias("last_viral_load_undetected"),
    )
    coinf = tb_labs.filter(_positive(RECENT_COINFECTION)).groupBy("emr_id").agg(
        F.max("specimen_collection_date").alias("last_tb_coinfection_date")
    )
    diag = tb_labs.filter(_positive(TB_DIAGNOSIS)).withColumn(
        "_on", F.coalesce("test_result_date", "specimen_collection_date")
    )
    diag = _latest(
        diag.filter("_on is not null"),
        ["_on", "tb_lab_results_id"],
        {"tb_diag_date": "_on", "tb_diag_test": "test_type"},
    )
    tx = regimens.filter(F.lower("drug_category") == "tb").groupBy("emr_id").agg(
        F.to_date(F.min("start_date")).alias("tb_tx_start_date"), F.to_date(F.max("end_date")).alias("tb_tx_end_date")
    )
    when = ("encounter_datetime", "date_entered", "all_vitals_id")
    measures = ("weight", "height", "bp_diastolic", "bp_systolic")
    vit = pivot(
        vitals,
        ["emr_id"],
        {f"last_{m}": Answer(F.lit(True), F.col(m), order=when) for m in measures}
        | {f"last_{m}_date": Answer(F.col(m).isNotNull(), F.to_date("encounter_datetime"), order=when) for m in measures},
    )
    htn = latest.top1(
        diagnoses.filter(F.col("diagnosis_entered").like("%HYPERTENSION")),
        ["patient_primary_id"],
        ["-obs_datetime", "-date_created", "-obs_id"],
    ).select(
        F.col("patient_primary_id").alias("emr_id"),
        F.col("diagnosis_entered").alias("last_htn_diag"),
        F.to_date("obs_datetime").alias("last_htn_diag_date"),
    )
    treat = latest.top1(
        status.filter(~F.col("status_outcome").isin("Patient pregnant", "Not pregnant")),
        ["emr_id"],
        ["-start_date", "-end_date", "-status_id"],
    )
    treat = treat.filter((F.col("start_date") <= today) & ((F.col("end_date") >= today) | F.col("end_date").isNull()))
    treat = treat.select("emr_id", F.col("status_outcome").alias("_tr"), F.col("start_date").alias("_trd"))
    enr = program.filter(F.col("date_enrolled") <= today).withColumn(
        "_open_last", F.coalesce("date_completed", F.lit("9999-12-31").cast("date"))
    )
    enr = latest.top1(enr, ["emr_id"], ["-date_enrolled", "-_open_last", "-hiv_program_id"]).select(
        "emr_id",
        F.col("date_enrolled").alias("_enr"),
        F.when(F.col("date_completed").isNotNull(), F.col("outcome")).alias("_out"),
        F.col("date_completed").alias("_outd"),
    )
    comp = _latest(
        dispensing,
        ["-dispense_date", "-encounter_id"],
        {"last_pickup_accompagnateur": "dispensed_accompagnateur"},
        F.col("dispensed_accompagnateur").isNotNull(),
    )
    chw = _latest(visits, ["-visit_date", "-encounter_id"], {"hiv_note_accompagnateur": "chw"}, F.col("chw").isNotNull())
    second = latest.nth_distinct(visits, ["emr_id"], "visit_date", 2).withColumnRenamed(
        "visit_date", "second_to_latest_hiv_visit_date"
    )
    people = patients.select(
        "emr_id",
        F.col("hivemr_v1_id").alias("legacy_emr_id"),
        F.col("given_name").alias("first_name"),
        F.col("family_name").alias("last_name"),
        "gender",
        "birthdate",
        "age",
        F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("address", "department", "commune", "section_communal")]).alias("address"),
        "locality",
        F.col("telephone_number").alias("phone_number"),
        "user_entered",
        F.col("latest_enrollment_location").alias("site"),
        "biometrics_collected",
        "latest_biometrics_collection_date",
        "biometrics_collector",
    )
    t = base
    for src in (
        people, start, first_disp, initial, latest_arv, prophylaxis, one(visits, "h"), one(pmtct_visits, "p"),
        one(eid_visits, "e"), pickup, vl, coinf, diag, tx, vit, htn, treat, enr, comp, chw, second,
    ):
        t = t.join(src, "emr_id", "left")

    far = F.lit("9999-12-31").cast("date")
    v = [F.coalesce(f"_{p}v", old) for p in "hpe"]
    n = [F.coalesce(f"_{p}n", far) for p in "hpe"]
    last_visit = F.nullif(F.greatest(*v), old)
    next_visit = F.nullif(F.least(*n), far)
    late = lambda c: F.greatest(F.coalesce(F.datediff(today, c), F.lit(0)), F.lit(0))
    due = F.coalesce("next_med_pickup_date", "_enr")
    active = F.coalesce(F.datediff(today, due) <= GRACE_DAYS, F.lit(False))
    pickup_date = (
        F.when(active, F.coalesce("last_med_pickup_date", "_enr"))
        .when(F.col("next_med_pickup_date").isNotNull(), F.date_add("next_med_pickup_date", GRACE_DAYS))
        .otherwise(F.date_add("_enr", GRACE_DAYS))
    )
    order = [
        (F.col("_out").isNotNull(), F.col("_out"), F.col("_outd")),
        (active, F.lit(ACTIVE), pickup_date),
        (F.col("_tr").isNotNull(), F.col("_tr"), F.col("_trd")),
    ]
    before = F.coalesce("dispense_before_prescription", F.lit(0))
    return t.select(
        "emr_id",
        "legacy_emr_id",
        "first_name",
        "last_name",
        "gender",
        "birthdate",
        "age",
        "last_pickup_accompagnateur",
        "hiv_note_accompagnateur",
        "address",
        "locality",
        "phone_number",
        "user_entered",
        "initial_enrollment_date",
        "arv_start_date",
        F.when(before == 1, join_nonnull([F.col("_m1"), F.col("_m2"), F.col("_m3")]))
        .otherwise(F.col("_prescribed"))
        .alias("initial_arv_regimen"),
        F.when(
            F.coalesce("_l1", "_l2", "_l3").isNotNull(),
            F.concat(
                F.coalesce("_l1", F.lit("")),
                F.coalesce(F.concat(F.lit(","), "_l2"), F.lit("")),
                F.coalesce(F.concat(F.lit(","), "_l3"), F.lit("")),
            ),
        ).alias("latest_arv_dispensed"),
        months_crossed(F.col("arv_start_date"), today).alias("months_on_art"),
        "prophylactic_regimen",
        "prophylactic_start_date",
        "prophylactic_end_date",
        "site",
        last_visit.alias("last_visit_date"),
        "second_to_latest_hiv_visit_date",
        "last_med_pickup_date",
        "last_med_pickup_months_dispensed",
        "last_med_pickup_treatment_line",
        next_visit.alias("next_visit_date"),
        "next_med_pickup_date",
        late(next_visit).alias("days_late_for_next_visit"),
        late(F.col("next_med_pickup_date")).alias("days_late_for_next_med_pickup"),
        "last_viral_load_order_date",
        "last_viral_load_status",
        "last_viral_load_collection_date",
        "last_viral_load_results_date",
        "last_viral_load_numeric",
        "last_viral_load_undetected",
        months_crossed(F.col("last_viral_load_collection_date"), today).alias("months_since_last_viral_load"),
        "last_tb_coinfection_date",
        "last_weight",
        "last_weight_date",
        "last_height",
        "last_height_date",
        "tb_diag_date",
        "tb_diag_test",
        "tb_tx_start_date",
        "tb_tx_end_date",
        waterfall([(c, s) for c, s, _ in order], F.lit("ltfu")).alias("status"),
        waterfall([(c, d) for c, _, d in order], pickup_date).alias("status_date"),
        "last_bp_diastolic",
        "last_bp_diastolic_date",
        "last_bp_systolic",
        "last_bp_systolic_date",
        "last_htn_diag",
        "last_htn_diag_date",
        "biometrics_collected",
        "latest_biometrics_collection_date",
        "biometrics_collector",
    )
