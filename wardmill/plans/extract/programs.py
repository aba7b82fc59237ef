"""Extracts at the grain of an enrolment, a programme state, an order, a group or a test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import age_tenths, complete_months, complete_years, month_start
from wardmill.operators import enrich, latest, ordered
from wardmill.operators.eav import any_symptom
from wardmill.operators.merge import union_rows
from wardmill.operators.rules import active_at, bands, least_strict, waterfall
from wardmill.plans.extract.clinic import UNKNOWN_LOCATION, Clinic, Q, coded, comment, date, listed, mark, num, text, yn
from wardmill.plans.extract.forms import MENTAL_HEALTH, ONCOLOGY_INTAKE
from wardmill.plans.extract.records import HIV_DISPENSING_TYPE, HIV_FOLLOWUP_TYPE, HIV_INTAKE_TYPE, _order_status
from wardmill.sources.staging import staged

# Programmes, encounter types and states of the source system.
HIV = "b1cb1fc1-5190-4f7a-af08-48870975dafc"
INFANTS = "7e06bf82-9f1a-4218-b68f-823082ef519b"
MATERNAL = "41a2715e-8a14-11e8-9a94-a6cf71072f73"
ONCOLOGY = "5bdbf9f6-690c-11e8-adc0-fa7ae01bbebc"
MENTAL = "0e69c3ab-1ccb-430b-b0db-b9760319230f"
NCD = "515796ec-bf3a-11e7-abc4-cec278b6b50a"
ONCOLOGY_PLAN = "f9cfdf8b-d086-4658-9b9d-45a62896da03"
OBGYN = "d83e98fd-dc7b-420f-aa3f-36f648b4483d"
DELIVERY = "00e5ebb2-90ec-11e8-9eb6-529269fb1459"
PMTCT_INITIAL = "584124b9-1f10-4757-ba09-91fc9075af92"
PMTCT_FOLLOWUP = "95e03e7d-9aeb-4a99-bd7a-94e8591ec2c5"
PEDS_INTAKE = "c31d3416-40c4-11e7-a919-92ebcb67fe33"
PEDS_FOLLOWUP = "c31d34f2-40c4-11e7-a919-92ebcb67fe33"
NCD_INITIAL = "ae06d311-1866-455b-8a64-126a9bd74171"
NCD_FOLLOWUP = "5cbfd6a2-92d9-4ad0-b526-9d29bfe1d10c"
DRUG_ORDER = "131168f4-15f5-102d-96e4-000c29c2a5d7"
PREGNANT_STATE = "5da5fa62-ef9f-4f15-9b58-d23136c2907b"
ONCOLOGY_STATUSES = ("11582", "11583", "1345", "2224")
TREATMENT_STATUSES = ("10364", "10359")


def _null(t: str):
    return F.lit(None).cast(t)


def _grouped(c: Clinic) -> DataFrame:
    return c.live("obs").filter("obs_group_id is not null")


def _group_answers(c: Clinic, df: DataFrame, spec: dict[str, Q], key: str, sparse: bool = False) -> DataFrame:
    return c.with_answers(df, spec, key, _grouped(c), "obs_group_id", sparse=sparse)


def _visit_columns(c: Clinic, df: DataFrame, columns: dict[str, str], key: str = "encounter_id") -> DataFrame:
    return enrich.decode(df, c.table("encounter"), key, "encounter_id", columns)


# ---- programmes -----------------------------------------------------------


def hiv_patient_program(c: Clinic) -> DataFrame:
    p = c.without_test_patients(c.enrolments(HIV))
    p = c.with_identifier(c.with_concept_name(c.with_place(p, "location"), "outcome_concept_id", "outcome", "en"))
    return p.select(
        F.col("patient_program_id").alias("hiv_program_id"), "emr_id", F.to_date("date_enrolled").alias("date_enrolled"),
        F.to_date("date_completed").alias("date_completed"), "location", "outcome",
        _null("int").alias("index_asc"), _null("int").alias("index_desc"),
    )


def hiv_status(c: Clinic, transfer: str = "internal transfer") -> DataFrame:
    """Enrolments, state changes and outcomes as one time line per patient.

    ``transfer`` is the code of the status that stands for a move inside the
    network; the row after it gets the place the patient came from.
    """
    e = c.enrolments(HIV)
    base = ["patient_id", F.col("patient_program_id").alias("hiv_program_id"), "location_id"]
    start = lambda col: F.to_date(col).alias("start_date")
    key = lambda kind, col: F.concat(F.lit(kind), F.col(col).cast("string")).alias("status_id")
    enrolled = e.select(*base, start("date_enrolled"), key("e-", "patient_program_id"))
    s = c.states().join(
        c.table("patient_program").filter(c.program_ids(HIV)).select("patient_program_id", "patient_id", "location_id"),
        "patient_program_id",
    )
    states = s.filter("state_concept_id is not null").select(
        *base, start("start_date"), F.col("state_concept_id").alias("status_concept_id"), key("s-", "patient_state_id")
    )
    done = e.filter("date_completed is not null").select(
        *base, start("date_completed"), F.to_date("date_completed").alias("end_date"),
        F.col("outcome_concept_id").alias("status_concept_id"), F.lit(1).alias("outcome"), key("o-", "patient_program_id"),
    )
    rows = union_rows([enrolled, states, done])
    lost = c.is_code("status_concept_id", "LOST TO FOLLOWUP")
    moved = c.is_code("status_concept_id", transfer)
    o = ordered.Ordered(rows, ["patient_id"], ["start_date", "hiv_program_id", "status_id"]).scan(
        index_patient_ascending=ordered.ordinal(),
        index_patient_descending=ordered.ordinal_desc(),
        _lost=ordered.max_before(F.when(lost, 1).otherwise(0)),
        _from=ordered.previous(F.when(moved, F.col("location_id"))),
    )
    rows = ordered.index_pair(
        o.frame(), ["hiv_program_id"], ["start_date", "status_id"], ("index_program_ascending", "index_program_descending"), sizes=rows
    )
    d = latest.top1(c.encounters([HIV_DISPENSING_TYPE]), ["patient_id"], ["-encounter_datetime", "-encounter_id"])
    d = c.with_answers(d.select("patient_id", "encounter_id"), {"_due": date("5096")}, within=c.encounters([HIV_DISPENSING_TYPE]))
    rows = enrich.decode(rows, d, "patient_id", "patient_id", {"_due": "_due"})
    never = F.lit("1900-01-01").cast("date")
    late = F.datediff(F.lit(c.as_of).cast("date"), F.coalesce(F.to_date("_due"), never)) >= 29
    rows = c.with_place(c.with_place(rows, "patient_location"), "transfer_in_from", "_from")
    rows = c.with_identifier(c.with_concept_name(rows, "status_concept_id", "status_outcome", "en"))
    back = F.coalesce((F.col("_lost") == 1) & F.col("outcome").isNull(), F.lit(False))
    return rows.select(
        "status_id", "emr_id", "patient_location", "transfer_in_from", "status_outcome", "start_date", "end_date",
        back.cast("int").alias("return_to_care"), late.cast("int").alias("currently_late_for_pickup"), "hiv_program_id",
        "index_program_ascending", "index_program_descending", "index_patient_ascending", "index_patient_descending",
    )


def mch_status(c: Clinic) -> DataFrame:
    """Programme states; an enrolment without a state keeps one row."""
    s = c.states().select(
        "patient_program_id", "patient_state_id", F.col("start_date").alias("status_start_date"),
        F.col("end_date").alias("status_end_date"), "state_concept_id",
    )
    p = c.without_test_patients(c.enrolments(MATERNAL)).join(s, "patient_program_id", "left")
    p = c.with_concept_name(c.with_concept_name(p, "state_concept_id", "treatment_status"), "outcome_concept_id", "outcome")
    p = c.with_identifier(c.with_place(p, "enrollment_location"))
    return p.select(
        c.key("patient_state_id"), c.key("patient_program_id").alias("mch_program_id"), "emr_id", "enrollment_location",
        F.col("date_enrolled").alias("program_date_enrolled"), F.col("date_completed").alias("program_date_completed"),
        "treatment_status", "status_start_date", "status_end_date", "outcome",
        _null("int").alias("index_asc"), _null("int").alias("index_desc"),
    )


def oncology_program(c: Clinic) -> DataFrame:
    """Status events: enrolment, outcome, programme status and treatment status."""
    e = c.enrolments(ONCOLOGY)
    day = F.to_date
    s = c.states().join(e.select("patient_program_id", "patient_id"), "patient_program_id")
    row = lambda df, a, b, kind, status: df.select(
        "patient_id", day(a).alias("status_start_date"), day(b).alias("status_end_date"), F.lit(kind).alias("status_type"), status.alias("status")
    )
    out = c.with_concept_name(e, "outcome_concept_id", "_name", "en")
    named = c.with_concept_name(s, "state_concept_id", "_name", "en")
    rows = union_rows(
        [
            row(e, "date_enrolled", "date_completed", "enrollment_status", F.lit("enrolled")),
            row(out, "date_completed", "date_completed", "outcome", F.col("_name")),
            row(named.filter(c.is_code("state_concept_id", *ONCOLOGY_STATUSES)), "start_date", "end_date", "program_status", F.col("_name")),
            row(named.filter(c.is_code("state_concept_id", *TREATMENT_STATUSES)), "start_date", "end_date", "treatment_status", F.col("_name")),
        ]
    )
    return c.with_identifier(rows).select(
        "emr_id", "status_start_date", "status_end_date", "status_type", "status"
    ).distinct()


def _latest_state(c: Clinic, program: str, codes: tuple[str, ...], name: str, newest_only: bool) -> DataFrame:
    """Name of the newest of the given states per patient, in the newest enrolment if asked."""
    e = c.enrolments(program).select("patient_program_id", "patient_id")
    if newest_only:
        top = c.table("patient_program").filter(c.program_ids(program)).groupBy("patient_id").agg(
            F.max("patient_program_id").alias("patient_program_id")
        )
        e = e.join(top.select("patient_program_id"), "patient_program_id", "left_semi")
    s = c.states().filter(c.is_code("state_concept_id", *codes)).join(e, "patient_program_id")
    s = latest.top1(s, ["patient_id"], ["-start_date", "-patient_state_id"])
    return c.with_concept_name(s, "state_concept_id", name, "en").select("patient_id", name)


def oncology_monthly_summary(c: Clinic) -> DataFrame:
    p = c.enrolments(ONCOLOGY)
    first = c.with_place(c.first_enrolment(ONCOLOGY), "_place")
    p = enrich.decode(p, first, "patient_id", "patient_id", {"enrollment_location": "_place"})
    p = c.with_identifier(c.with_concept_name(p, "outcome_concept_id", "program_outcome", "en"))
    all_enc = c.table("encounter")
    for types, day, answers in (
        ([ONCOLOGY_INTAKE], "latest_intake_date", {"latest_consult_note": text("10578")}),
        ([ONCOLOGY_PLAN], "latest_treatment_plan_date", {"latest_stage": coded("10373")}),
    ):
        ids = c.metadata_ids("encounter_type", "encounter_type_id", "uuid", types)
        of_type = all_enc.filter(F.col("encounter_type").isin(ids))
        mine = of_type.groupBy("patient_id").agg(
            F.to_date(F.max("encounter_datetime")).alias(day), F.max("encounter_id").alias("encounter_id")
        )
        mine = c.with_answers(mine, answers, within=of_type)
        p = enrich.decode(p, mine, "patient_id", "patient_id", {day: day, **{a: a for a in answers}})
    for codes, name in ((ONCOLOGY_STATUSES, "latest_oncology_program_status"), (TREATMENT_STATUSES, "latest_oncology_treatment_status")):
        p = p.join(_latest_state(c, ONCOLOGY, codes, name, True), "patient_id", "left")
    return p.select(
        month_start(F.lit(c.as_of).cast("date")).alias("report_month"), "emr_id", F.col("date_enrolled").alias("enrollment_date"),
        "enrollment_location", F.col("date_completed").alias("program_completion_date"), "program_outcome", "latest_stage",
        "latest_intake_date", "latest_treatment_plan_date", _null("date").alias("latest_chemotherapy_date"), "latest_consult_note",
        "latest_oncology_program_status", "latest_oncology_treatment_status",
    )


def oncology_treatment_plan(c: Clinic, workflow: int = 5) -> DataFrame:
    """Treatment plans; the intent is the current state of the patient's open enrolment."""
    from wardmill.plans.extract.form import FormJob, run

    open_program = latest.top1(
        c.enrolments(ONCOLOGY).filter("date_completed is null"), ["patient_id"], ["-date_enrolled", "-patient_program_id"]
    ).select("patient_program_id", "patient_id")
    s = c.states().filter((F.col("program_workflow_id") == workflow) & F.col("end_date").isNull())
    s = latest.top1(s.join(open_program, "patient_program_id"), ["patient_id"], ["-start_date", "-patient_state_id"])
    intent = c.with_concept_name(s, "state_concept_id", "_intent", "en")
    job = FormJob(
        "oncology_treatment_plan",
        (ONCOLOGY_PLAN,),
        (
            "emr_id", "encounter_id", "visit_id", "visit_location", "encounter_datetime", "encounter_location", "facility",
            "date_entered", "user_entered", "encounter_provider=provider", "treatment_intent", "cancer_stage", "plan_details",
        ),
        {"cancer_stage": coded("10373"), "plan_details": text("2881")},
        drop=("raw_patient_id",),
        finish=lambda c, e: enrich.decode(e, intent, "raw_patient_id", "patient_id", {"treatment_intent": "_intent"}),
    )
    return run(c, job)


def oncology_diagnosis(c: Clinic) -> DataFrame:
    e = c.encounters([ONCOLOGY_INTAKE, ONCOLOGY_PLAN])
    o = c.obs("3064").select("encounter_id", "obs_id", "obs_group_id", "value_coded")
    o = o.join(e, "encounter_id")
    o = _group_answers(c, o, {"diagnosis_order": coded("7537")}, "obs_group_id", sparse=True)
    o = c.with_concept_name(o, "value_coded", "diagnosis", "en")
    o = c.with_provider(c.with_user(c.with_facility(c.with_type_name(c.with_identifier(o)))), "encounter_provider")
    return o.select(
        "emr_id", c.key("encounter_id"), c.key("visit_id"), "visit_location", "encounter_datetime", "encounter_location", "facility",
        F.col("date_created").alias("date_entered"), "user_entered", "encounter_provider",
        F.col("encounter_type_name").alias("encounter_type"), "diagnosis_order", "diagnosis",
    )


def mh_patients(c: Clinic) -> DataFrame:
    p = c.enrolments(MENTAL)
    p = c.with_identifier(c.with_person(p, {"gender": "gender", "dob": "birthdate"}))
    p = c.with_health_center(p)
    p = enrich.decode(p, c.addresses(voided_too=False), "patient_id", "person_id", {"_town": "city_village", "_has": "person_address_id"})
    last = latest.top1(c.encounters([MENTAL_HEALTH]), ["patient_id"], ["-encounter_datetime", "-encounter_id"])
    last = c.with_answers(last.select("patient_id", "encounter_id"), {"interventions": listed("10636"), "referral": listed("10647")}, within=c.encounters([MENTAL_HEALTH]))
    p = enrich.decode(p, last, "patient_id", "patient_id", {"interventions": "interventions", "referral": "referral"})
    return p.select(
        c.key("patient_program_id"), c.key("patient_id"), "emr_id", F.concat(F.lit(f"{c.partition}-"), "emr_id").alias("emr_id_deprecated"),
        "dob", "gender", "health_center", F.when(F.col("_has").isNotNull(), F.coalesce("_town", F.lit(""))).alias("town"), "referral",
        F.col("date_enrolled").alias("program_enrollment_date"), "interventions", _null("int").alias("index_asc"), _null("int").alias("index_desc"),
    )


def mh_diagnoses(c: Clinic) -> DataFrame:
    e = c.window(c.encounters([MENTAL_HEALTH]), "encounter_datetime")
    o = c.obs("10594").select("encounter_id", "value_coded").join(e, "encounter_id")
    o = c.with_concept_name(o, "value_coded", "diagnosis", "en")
    o = c.with_provider(c.with_user(c.with_facility(c.with_identifier(o)), "creator", "encounter_creator"))
    o = c.with_person(c.with_age(o, "age_at_enc"), {"gender": "gender"})
    return o.select(
        c.key("encounter_id", True), c.key("patient_id", True), "emr_id", "encounter_datetime",
        F.col("encounter_location").alias("encounter_location_name"), "facility", c.key("visit_id", True), "visit_location",
        "encounter_creator", "provider", "age_at_enc", "gender", "diagnosis",
    )


def mh_medications(c: Clinic) -> DataFrame:
    e = c.window(c.encounters([MENTAL_HEALTH]), "encounter_datetime")
    o = c.obs("10742").select("encounter_id", F.col("obs_id").alias("_group")).distinct().join(e, "encounter_id")
    spec = {"medication_name": listed("10634"), "dosage_unit": listed("10744"), "dosage": num("9073")}
    o = _group_answers(c, o, spec, "_group")
    o = c.with_provider(c.with_user(c.with_facility(c.with_identifier(o)), "creator", "encounter_creator"))
    return o.select(
        c.key("encounter_id", True), c.key("patient_id", True), "emr_id", "encounter_datetime",
        F.col("encounter_location").alias("encounter_location_name"), "facility", c.key("visit_id", True), "visit_location",
        "encounter_creator", "provider", "medication_name", "dosage", "dosage_unit",
    )


# ---- HIV ------------------------------------------------------------------

# Identifiers of encounter types, a workflow and an attribute type.
PMTCT_VISIT_TYPES = ("4d77916a-0620-11e5-a6c0-1697f925ec7b", "39C09928-0CAB-4DBA-8E48-39C631FA4286")
INFANT_WORKFLOW = "7e35b35e-5f40-4652-b2f2-b4afcb8e683a"
TELEPHONE = "14d4f066-15f5-102d-96e4-000c29c2a5d7"

# Order reasons and the categories they stand for.
REGIMEN_REASONS = {
    "CIEL:138405": "ART",
    "CIEL:160538": "PMTCT",
    "CIEL:163768": "HIV Prophylaxis",
    "CIEL:112992": "STI",
    "CIEL:112141": "TB",
    "14256": "TB Prophylaxis",
}


def hiv_location(c: Clinic, e: DataFrame, name: str) -> DataFrame:
    """Encounter place, or the place of the enrolment at the time when the former is unknown."""
    unknown = c.table("location").filter(F.col("uuid") == UNKNOWN_LOCATION).select(F.col("location_id").alias("_unknown"))
    from wardmill.operators.intervals import join_containing

    lost = e.join(unknown, F.col("location_id") == F.col("_unknown"), "left_semi")
    span = c.enrolments(HIV).select("patient_id", "date_enrolled", "date_completed", "patient_program_id", F.col("location_id").alias("_place"))
    hit = join_containing(
        lost.select("encounter_id", "patient_id", "encounter_datetime"), span, ["patient_id"], "encounter_datetime", "date_enrolled",
        "date_completed", {"_place": "_place"}, ["encounter_id"], True, ["patient_program_id"], days=180,
    )
    e = enrich.decode(e, hit, "encounter_id", "encounter_id", {"_prog_place": "_place"})
    return c.with_place(e.withColumn("_where", F.coalesce("_prog_place", "location_id")), name, "_where")


def hiv_regimens(c: Clinic) -> DataFrame:
    """New drug orders for HIV reasons, and the orders that revise or stop them."""
    kinds = c.metadata_ids("order_type", "order_type_id", "uuid", [DRUG_ORDER])
    reason = c.is_code("order_reason", *REGIMEN_REASONS)
    every = c.table("orders")
    new = c.live("orders").filter(F.col("order_type_id").isin(kinds) & reason & (F.col("order_action") == "NEW"))
    prior = new.select(F.col("order_id").alias("previous_order_id"), F.col("order_reason").alias("_reason"))
    cols = ["order_id", "patient_id", "order_action", "encounter_id", "concept_id", "date_activated", "date_stopped", "auto_expire_date"]
    o = union_rows(
        [
            new.select(*cols, "order_reason"),
            every.select(*cols, "previous_order_id").join(prior, "previous_order_id").withColumnRenamed("_reason", "order_reason"),
        ]
    )
    category = waterfall([(c.is_code("order_reason", k), F.lit(v)) for k, v in REGIMEN_REASONS.items()])
    art = o.withColumn("drug_category", category).filter("drug_category = 'ART'").select("patient_id", "order_id", "encounter_id")
    first = c.with_answers(latest.top1(art, ["patient_id"], ["order_id"]), {"_line": coded("CIEL:166073")}, within=art).select("patient_id", "_line")
    last = latest.top1(art, ["patient_id"], ["-order_id"]).select("order_id", F.lit(True).alias("_last"))
    o = c.with_answers(o.withColumn("drug_category", category), {"art_treatment_line": coded("CIEL:166073")}, within=o)
    o = o.join(first, "patient_id", "left").join(last, "order_id", "left")
    expired = F.col("date_stopped").isNull() & (F.col("order_action") == "NEW") & F.col("auto_expire_date").isNotNull()
    o = o.withColumns({"_expired": expired, "end_date": F.when(expired, F.col("auto_expire_date")).otherwise(F.col("date_stopped"))})
    after = c.live("orders").filter(F.col("order_action").isin("DISCONTINUE", "REVISE"))
    after = c.with_concept_name(after, "order_reason", "_why", "en")
    after = after.groupBy("previous_order_id").agg(
        F.max(F.when(F.col("order_action") == "REVISE", "Revised order")).alias("_revised"),
        F.max_by("_why", F.when(F.col("order_action") == "DISCONTINUE", F.col("order_id"))).alias("_stopped"),
    )
    o = enrich.decode(o, after, "order_id", "previous_order_id", {"_revised": "_revised", "_stopped": "_stopped"})
    e = hiv_location(c, c.table("encounter"), "visit_location")
    e = c.with_user(e, "creator", "user_entered", login=True)
    o = enrich.decode(
        o, e, "encounter_id", "encounter_id",
        {"encounter_datetime": "encounter_datetime", "date_entered": "date_created", "user_entered": "user_entered", "visit_location": "visit_location"},
    )
    d = enrich.decode(c.table("drug_order"), c.table("drug"), "drug_inventory_id", "drug_id", {"drug_name": "name"})
    d = enrich.decode(d, c.table("order_frequency"), "frequency", "order_frequency_id", {"_fc": "concept_id"})
    for column, name in (("dose_units", "_du"), ("quantity_units", "_qu"), ("route", "_ro"), ("_fc", "_fr"), ("duration_units", "_un")):
        d = c.with_concept_name(d, column, name)
    o = enrich.decode(
        o, d, "order_id", "order_id",
        {"drug_id": "drug_inventory_id", "drug_name": "drug_name", "dose": "dose", "dose_units": "_du", "prescribed_quantity": "quantity",
         "quantity_units": "_qu", "route": "_ro", "frequency": "_fr", "duration": "duration", "duration_units": "_un"},
    )
    o = c.with_identifier(c.with_concept_name(o, "concept_id", "drug_short_name", "en"))
    start = c.order_start("CIEL:138405")
    o = enrich.decode(o, start, "patient_id", "patient_id", {"_art": "order_start"})
    return o.select(
        "order_id", "previous_order_id", "emr_id", "order_action", c.key("encounter_id"), "encounter_datetime", "visit_location",
        "date_entered", "user_entered", "drug_category", "art_treatment_line", "drug_id", "drug_short_name", "drug_name", "dose",
        "dose_units", "prescribed_quantity", "quantity_units", "route", "frequency", F.col("duration").cast("double").alias("duration"),
        "duration_units", F.col("date_activated").alias("start_date"), "end_date",
        F.when(
            F.col("end_date").isNotNull(),
            F.coalesce("_revised", "_stopped", F.when(F.col("_expired"), "expired")),
        ).alias("end_reasons"),
        F.when(F.col("drug_category").isin("PMTCT", "HIV Prophylaxis"), "1").otherwise("0").alias("ptme_or_prophylaxis"),
        F.when(F.col("_last"), F.col("_line")).alias("regimen_line_original"), F.to_date("_art").alias("art_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("inh_completion_date"),  # in the contract, filled by no step
    )


def hiv_viral_load(c: Clinic) -> DataFrame:
    """Viral load orders with their specimens, and specimens entered without an order."""
    o = c.table("orders").filter(c.is_code("concept_id", "15124"))
    o = c.with_concept_name(o, "order_reason", "vl_type")
    spec = latest.top1(c.obs("10781"), ["value_text"], ["-encounter_id", "-obs_id"]).select(
        F.col("value_text").alias("_number"), F.col("encounter_id").alias("specimen_encounter_id")
    )
    ordered_ = o.join(spec, F.col("order_number") == F.col("_number"), "left").select(
        F.concat(F.lit("o-"), F.col("order_id")).alias("_id"), "patient_id", F.col("encounter_id").alias("order_encounter_id"),
        "specimen_encounter_id", "order_number", "date_activated", "date_stopped", "auto_expire_date", "fulfiller_status", "vl_type",
    )
    alone = c.obs("HIV viral load construct").select(
        F.concat(F.lit("s-"), F.col("obs_id")).alias("_id"), F.col("person_id").alias("patient_id"),
        F.col("encounter_id").alias("specimen_encounter_id"),
    )
    bare = union_rows([ordered_.select("specimen_encounter_id"), alone.select("specimen_encounter_id")])
    v = union_rows([ordered_, alone]).withColumn("_enc", F.coalesce("specimen_encounter_id", "order_encounter_id"))
    v = _visit_columns(
        c, v, {"location_id": "location_id", "date_entered": "date_created", "creator": "creator", "_at": "encounter_datetime"}, "_enc"
    )
    taken = F.when(F.col("specimen_encounter_id").isNotNull(), F.col("_at"))
    v = c.with_answers(
        v,
        {
            "vl_sample_taken_date_estimated": listed("11781"),
            "vl_result_date": date("Date of test results"),
            "specimen_number": text("CIEL:162086"),
            "vl_coded_results": listed("CIEL:1305"),
            "viral_load": num("CIEL:856"),
            "ldl_value": num("11548"),
        },
        "specimen_encounter_id",
        obs_key="encounter_id",
        within=bare,
    )
    v = c.with_identifier(c.with_user(c.with_place(v, "visit_location"))).withColumn("_taken", taken)
    today = F.lit(c.as_of).cast("date")
    return v.select(
        F.concat(F.lit(f"{c.partition}-"), "_id").alias("hiv_vl_id"), "emr_id", c.key("patient_id"), c.key("order_encounter_id"),
        c.key("specimen_encounter_id"), c.key("order_number"), "visit_location", "date_entered", "user_entered",
        _order_status(c.as_of, F.col("specimen_encounter_id").isNotNull(), F.col("vl_result_date").isNotNull()).alias("status"),
        F.col("date_activated").alias("order_date"), F.to_date("_taken").alias("vl_sample_taken_date"), "vl_sample_taken_date_estimated",
        F.to_date("vl_result_date").alias("vl_result_date"), "specimen_number", "vl_coded_results",
        F.col("viral_load").cast("int").alias("viral_load"), F.col("ldl_value").cast("int").alias("ldl_value"), "vl_type",
        F.datediff(today, F.coalesce("_taken", "date_activated").cast("date")).alias("days_since_vl"),
        _null("int").alias("order_desc"), _null("int").alias("order_asc"),
    )


def hiv_tests(c: Clinic) -> DataFrame:
    """Rapid and PCR tests, and test groups that hold no such test."""
    o = c.obs("CIEL:163722", "CIEL:1030")
    t = c.with_concept_name(c.with_concept_name(o, "concept_id", "test_type", "en"), "value_coded", "test_result", "en")
    t = t.select("person_id", "encounter_id", "obs_group_id", F.col("obs_datetime").alias("_on"), "test_type", "test_result", "date_created")
    t = c.with_answers(t, {"_said": date("HIV TEST DATE"), "_r1": date("10783"), "_r2": date("11387")}, within=o)
    g = c.obs("11522").select("person_id", "encounter_id", F.col("obs_id").alias("obs_group_id"), "date_created")
    g = enrich.anti(g, t.filter("obs_group_id is not null"), ["obs_group_id"])
    g = _group_answers(c, g, {"_on": date("1837"), "test_result": listed("2169")}, "obs_group_id")
    rows = union_rows(
        [
            t.select("person_id", "encounter_id", F.coalesce("_on", "_said").alias("_day"), F.coalesce("_r1", "_r2").alias("_res"), "test_type", "test_result", "date_created"),
            g.select("person_id", "encounter_id", F.col("_on").alias("_day"), F.lit("HIV test").alias("test_type"), "test_result", "date_created"),
        ]
    )
    rows = c.with_identifier(c.with_identifier(rows, key="person_id"), "hivemr_v1_id", "hiv", "person_id")
    rows = c.with_type_name(_visit_columns(c, rows, {"encounter_type": "encounter_type"}))
    return rows.select(
        "emr_id", "hivemr_v1_id", c.key("encounter_id"), F.col("encounter_type_name").alias("encounter_type"),
        F.to_date("_day").alias("specimen_collection_date"), F.to_date("_res").alias("result_date"), "test_type", "test_result",
        "date_created", _null("int").alias("index_asc"), _null("int").alias("index_desc"),
    )


# Answer concepts of the dispensing form.
ARV_SLOTS = {"arv_1": "3013", "arv_2": "2848", "arv_3": "13960", "tms_1": "3120", "b6": "766"}


def _medicine(c: Clinic, keys: list[str]) -> DataFrame:
    """Drug name, short name, quantity and course of each dispensing group."""
    o = _grouped(c)
    med = o.filter(c.is_code("concept_id", "CIEL:1282", "CIEL:1443", "13786"))
    med = enrich.decode(med, c.table("drug"), "value_drug", "drug_id", {"_drug": "name"})
    med = c.with_concept_name(med, "value_coded", "_name", "en")
    latest_of = lambda code, v: F.max_by(v, F.when(c.is_code("concept_id", code) & F.col(v).isNotNull(), F.struct("date_created", "obs_id")))
    return med.groupBy("obs_group_id").agg(
        latest_of("CIEL:1282", "_drug").alias("med"),
        latest_of("CIEL:1282", "_name").alias("med_short_name"),
        latest_of("CIEL:1443", "value_numeric").cast("int").alias("quantity"),
        latest_of("13786", "_name").alias("sequence"),
    ).select(F.col("obs_group_id").alias("_g"), *keys)


def hiv_dispensing(c: Clinic) -> DataFrame:
    """Dispensing encounters with up to three ARVs, prophylaxis courses and pick-up delays."""
    from wardmill.plans.extract.form import FormJob, run

    cols = ["med", "med_short_name", "quantity", "sequence"]
    meds = _medicine(c, cols)
    o = c.live("obs")
    anchors = o.filter(c.is_code("value_coded", *ARV_SLOTS.values()) & F.col("obs_group_id").isNotNull())
    slot = waterfall([(c.is_code("value_coded", v), F.lit(k)) for k, v in ARV_SLOTS.items()])
    anchors = latest.top1(
        anchors.withColumn("_slot", slot), ["encounter_id", "_slot"], ["-date_created", "-obs_id"]
    ).select("encounter_id", "_slot", "obs_group_id")
    inh = o.filter(c.is_code("concept_id", "1535") & c.is_code("value_coded", "656"))
    inh = latest.top_n(inh, ["encounter_id"], ["obs_datetime", "obs_id"], 2).select(
        "encounter_id", F.concat(F.lit("inh_"), F.col("position").cast("string")).alias("_slot"), "obs_group_id"
    )
    given = anchors.unionByName(inh).join(meds, F.col("obs_group_id") == F.col("_g"), "left")
    slots = [*ARV_SLOTS, "inh_1", "inh_2"]
    wide = given.groupBy("encounter_id").agg(
        *[F.max(F.when(F.col("_slot") == s, F.col(k))).alias(f"{s}_{k}") for s in slots for k in cols]
    )
    answers = {
        "dispensed_to": coded("12071"),
        "dispensed_accompagnateur": text("13276"),
        "current_art_treatment_line": coded("CIEL:166073"),
        "next_dispense_date": date("CIEL:5096"),
        "_months": num("3102"),
        "_match": Q("code", "3277"),
    }

    def finish(c: Clinic, e: DataFrame) -> DataFrame:
        e = e.join(wide.withColumnRenamed("encounter_id", "_k"), F.col("raw_encounter_id") == F.col("_k"), "left")
        line = F.col("current_art_treatment_line")
        core = e.select("raw_encounter_id", "raw_patient_id", "encounter_datetime", "current_art_treatment_line", "next_dispense_date", "arv_1_med_short_name")
        bare = c.encounters([HIV_DISPENSING_TYPE]).select(F.col("patient_id").alias("raw_patient_id"), "encounter_datetime")
        o = ordered.Ordered(core, ["raw_patient_id"], ["encounter_datetime", "raw_encounter_id"], sizes=bare).scan(
            dispense_date_ascending=ordered.ordinal(),
            dispense_date_descending=ordered.ordinal_desc(),
            _prev=ordered.previous(F.struct(line.alias("line"), F.col("next_dispense_date").alias("due"))),
        )
        new_line = F.col("_prev").isNull() | ~F.col("_prev.line").eqNullSafe(line) | line.isNull()
        o = o.scan(
            _start=ordered.last_known(F.when(new_line, F.col("encounter_datetime"))),
            _first=ordered.last_known(F.when(F.col("dispense_date_ascending") == 1, F.struct(F.col("arv_1_med_short_name").alias("m")))),
        )
        t = o.frame().select(
            F.col("raw_encounter_id").alias("_k2"), "dispense_date_ascending", "dispense_date_descending", "_prev", "_start", "_first"
        )
        e = e.join(t, F.col("raw_encounter_id") == F.col("_k2"), "left")
        last = F.col("dispense_date_descending") == 1
        same = F.col("_first.m") == F.col("arv_1_med_short_name")
        due = F.col("_prev.due")
        late = F.when(F.col("encounter_datetime") > due, F.datediff(F.to_date("encounter_datetime"), F.to_date(due))).otherwise(0)
        return e.withColumns(
            {
                "months_dispensed": F.col("_months").cast("int"),
                "is_current_mmd": F.when(F.col("_months") >= 3, "Y").otherwise("N"),
                "regimen_match": F.when(F.col("_match").isNotNull(), F.when(c.is_code("_match", "1065"), "1").otherwise("0")),
                "current_art_line_start_date": F.col("_start"),
                "regimen_change": F.when(last, F.when(same, "0").otherwise("1")),
                "days_late_to_pickup": F.when(last, late),
            }
        )

    arv = [f"arv_{i}_{k}" for i in (1, 2, 3) for k in ("med", "med_short_name", "quantity")]
    tms = [f"tms_1_{k}" for k in ("med", "med_short_name", "quantity")]
    inh_cols = [f"inh_{i}_{k}" for i in (1, 2) for k in ("med", "med_short_name", "sequence", "quantity")]
    b6 = [f"b6_{k}" for k in ("med", "med_short_name", "quantity")]
    job = FormJob(
        "hiv_dispensing",
        (HIV_DISPENSING_TYPE,),
        (
            "emr_id", "encounter_id", "visit_id", "visit_location", "dispense_date=encounter_datetime", "dispense_site=encounter_location",
            "facility", "date_entered", "user_entered=username", "age_at_dispense_date=age_at_encounter", "dispensed_to",
            "dispensed_accompagnateur", "current_art_treatment_line", "current_art_line_start_date", "months_dispensed", "is_current_mmd",
            "next_dispense_date", *arv, *tms, *inh_cols, *b6, "regimen_change", "days_late_to_pickup", "regimen_match",
            "dispense_date_ascending", "dispense_date_descending",
        ),
        answers,
        finish=finish,
        drop=("raw_patient_id", "raw_encounter_id"),
    )
    return run(c, job)


SYMPTOMS = {
    "cough": "11567", "fever": "11565", "weight_loss": "11566", "tb_contact": "11568", "lymph_pain": "11569",
    "bloody_cough": "970", "dyspnea": "5960", "chest_pain": "136",
}
PRESENT, ABSENT = "11563", "11564"


def top_place(c: Clinic, df: DataFrame, name: str, key: str = "location_id") -> DataFrame:
    """Name of the place two levels up, or of the highest there is."""
    loc = c.table("location").select("location_id", "name", "parent_location")
    df = enrich.decode(df, loc, key, "location_id", {"_n0": "name", "_p0": "parent_location"})
    df = enrich.decode(df, loc, "_p0", "location_id", {"_n1": "name", "_p1": "parent_location"})
    df = enrich.decode(df, loc, "_p1", "location_id", {"_n2": "name"})
    up = F.when(F.col("_p0").isNull(), F.col("_n0")).when(F.col("_p1").isNull(), F.col("_n1")).otherwise(F.col("_n2"))
    return df.withColumn(name, up).drop("_n0", "_n1", "_n2", "_p0", "_p1")


def _symptoms(c: Clinic, obs: DataFrame) -> DataFrame:
    """Per encounter and symptom: 1 present, 0 absent, from the latest answer of either question."""
    o = obs.filter(c.is_code("concept_id", PRESENT, ABSENT))
    pick = lambda code: F.max_by(
        F.when(c.is_code("concept_id", PRESENT), "1").otherwise("0"), F.when(c.is_code("value_coded", code), F.struct("date_created", "obs_id"))
    )
    return o.groupBy("encounter_id").agg(*[pick(code).alias(f"{n}_result") for n, code in SYMPTOMS.items()])


def tb_screening(c: Clinic) -> DataFrame:
    e = c.encounters([HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PEDS_INTAKE, PEDS_FOLLOWUP])
    s = _symptoms(c, c.live("obs"))
    e = e.select("encounter_id", "patient_id", "encounter_datetime", "date_created", "creator", "location_id").join(s, "encounter_id")
    e = ordered.index_pair(
        e, ["patient_id"], ["encounter_datetime", "encounter_id"], ("index_ascending", "index_descending"), sizes=c.encounters([HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PEDS_INTAKE, PEDS_FOLLOWUP])
    )
    e = c.with_answers(e, {"_said": Q("code", "CIEL:160108")}, within=c.encounters([HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PEDS_INTAKE, PEDS_FOLLOWUP]))
    explicit = F.when(c.is_code("_said", "703"), "1").when(c.is_code("_said", "664"), "0")
    answers = [F.col(f"{n}_result") for n in SYMPTOMS]
    result = any_symptom(answers, explicit, F.lit("1"), F.lit("0"))
    e = top_place(c, c.with_user(e, "creator", "user_entered", login=True), "screening_location")
    e = c.with_identifiers(e, {"emr_id": "emr", "dossier_id": "dossier"})
    return e.select(
        "emr_id", "dossier_id", c.key("encounter_id"), "screening_location", *[f"{n}_result" for n in SYMPTOMS],
        F.coalesce(result, F.lit("0")).alias("tb_screening_result"), F.col("encounter_datetime").alias("tb_screening_date"), "index_ascending", "index_descending",
        F.col("date_created").alias("date_entered"), "user_entered",
    )


# Concepts of tuberculosis tests.
TB_TESTS = {
    "smear": "TUBERCULOSIS SMEAR RESULT",
    "culture": "TUBERCULOSIS CULTURE RESULT",
    "genxpert": "CIEL:162202",
    "skin test": "TUBERCULIN SKIN TEST",
}


def tb_lab_results(c: Clinic) -> DataFrame:
    """TB tests done, of four kinds, and tests not done, of three."""
    kinds = list(TB_TESTS)
    # kinds go by number and status by a flag; their names come after the shuffle
    kind = lambda column, n: waterfall([(c.is_code(column, code), F.lit(i)) for i, code in enumerate(list(TB_TESTS.values())[:n])])
    base = ["person_id", "encounter_id", "creator", F.col("obs_id").alias("_id"), "obs_datetime", "date_created", "value_coded"]
    done = c.obs(*TB_TESTS.values()).withColumn("_kind", kind("concept_id", 4))
    numeric = F.when(F.col("_kind") == kinds.index("skin test"), F.col("value_numeric"))
    done = done.select(*base, "_kind", F.lit(True).alias("_done"), numeric.alias("value_numeric"))
    o = c.live("orders").filter(F.col("fulfiller_status").contains("EXCEPTION"))
    o = o.select("order_id", F.col("concept_id").alias("_ordered")).filter(c.is_code("_ordered", *list(TB_TESTS.values())[:3]))
    not_done = c.obs("CIEL:165182").join(o, "order_id")
    not_done = not_done.select(*base, kind("_ordered", 3).alias("_kind"), F.lit(False).alias("_done"))
    e = c.encounters().select("encounter_id", "encounter_datetime", "location_id")
    asked = {"_estimated": coded("11781"), "_d1": date("DATE OF LABORATORY TEST"), "_d2": date("Date of test results"), "_ppd": coded("PPD qualitative")}
    # a person's tests meet in one task, where they are numbered; those of a person with very many are numbered in ranges
    sizes = ordered.KeyStats.of([(c.obs(*TB_TESTS.values(), "CIEL:165182"), ["person_id"], ["encounter_id"])])
    place, keys, dealt_by = ("person_id", [enrich.AT, "person_id"], None) if sizes.big is None else ("encounter_id", ["person_id"], ["_id"])
    found = {
        "encounter_id": lambda x: c.with_answers(x.join(e, "encounter_id", "left"), asked, within=x),
        "person_id": lambda p: c.with_identifiers(p, {"emr_id": "emr", "dossier_id": "dossier"}, "person_id"),
    }
    t = enrich.gathered(union_rows([done, not_done]), place, found, dealt_by)
    t = t.withColumn("test_type", waterfall([(F.col("_kind") == i, F.lit(k)) for i, k in enumerate(kinds)]))
    on = F.when(F.col("test_type") == "genxpert", F.coalesce("encounter_datetime", "obs_datetime")).otherwise(F.col("obs_datetime"))
    t = t.withColumn("specimen_collection_date", F.to_date(on))
    t = ordered.index_pair(t, keys, ["encounter_id", "specimen_collection_date", "date_created", "test_type", "_id"], sizes=sizes)
    # staged, the names' sizes are known, and if they are few the tests are not shuffled by user or place
    places = staged(top_place(c, c.table("location").select("location_id").distinct(), "test_location"), "top-places")
    t = enrich.decode(t, places, "location_id", "location_id", {"test_location": "test_location"})
    t = c.with_user(t, "creator", "user_entered", login=True, users=staged(c.user_names(), "user-names"))
    t = c.with_concept_name(t, "value_coded", "_name", "en")
    performed, skin = F.col("_done"), F.col("test_type") == "skin test"
    told = {
        "test_status": F.when(performed, "performed").otherwise("not performed"),
        "sample_taken_date_estimated": F.when(performed, F.col("_estimated")),
        "test_result_date": F.to_date(F.when(performed, F.coalesce("_d2", "_d1")).otherwise(F.col("_d2"))),
        "reason_test_not_perform": F.when(~performed, F.col("_name")),
        "test_result_text": F.when(performed, F.when(skin, F.col("_ppd")).otherwise(F.col("_name"))),
        "test_result_numeric": F.col("value_numeric"),
    }
    t = t.withColumns(told)
    return t.select(
        c.key("_id").alias("tb_lab_results_id"), "emr_id", "dossier_id", c.key("encounter_id"), "test_location", "specimen_collection_date",
        "sample_taken_date_estimated", "test_result_date", F.lit("tb").alias("test_related_to"), "test_type", "test_status",
        "reason_test_not_perform", "test_result_text", "test_result_numeric", "index_asc", "index_desc",
        F.col("date_created").alias("date_entered"), "user_entered",
    )


# ---- mothers and infants --------------------------------------------------


def pmtct_visits(c: Clinic) -> DataFrame:
    from wardmill.plans.extract.form import FormJob, run

    def finish(c: Clinic, e: DataFrame) -> DataFrame:
        o = c.live("obs")
        given = c.is_code("value_coded", *SYMPTOMS.values())
        s = o.filter(given).groupBy("encounter_id").agg(
            F.max("obs_datetime").alias("_on"), F.max(F.when(c.is_code("concept_id", PRESENT), 1)).alias("_present")
        )
        contact = c.obs("13265", "FIRST NAME", "LAST NAME", "TELEPHONE NUMBER OF CONTACT").select("encounter_id").distinct()
        e = enrich.decode(e, s, "raw_encounter_id", "encounter_id", {"_on": "_on", "_present": "_present"})
        e = e.join(contact.select(F.col("encounter_id").alias("_c")), F.col("raw_encounter_id") == F.col("_c"), "left")
        bare = c.encounters([PMTCT_INITIAL, PMTCT_FOLLOWUP])
        bare = bare.select(F.col("encounter_id").alias("raw_encounter_id"), "patient_id", "encounter_datetime")
        e = c.enrolment_at(e, HIV, ["raw_encounter_id"], "_program", events=bare)
        return e.withColumns(
            {
                "tb_screening_date": F.to_date(F.when(F.col("_present") == 1, F.col("_on"))),
                "has_provided_contact": F.when(F.col("_c").isNotNull(), True),
                "hiv_program_id": c.key("_program"),
                "hiv_test_date": F.to_date("_tested"),
                "expected_delivery_date": F.to_date("_edd"),
            }
        )

    job = FormJob(
        "pmtct_visits",
        (PMTCT_INITIAL, PMTCT_FOLLOWUP),
        (
            "visit_id=raw_visit_id", "visit_location", "encounter_id", "hiv_program_id", "emr_id", "visit_date",
            "health_facility=encounter_location", "date_entered", "user_entered=username", "hiv_test_date", "expected_delivery_date",
            "tb_screening_date", "has_provided_contact", "breastfeeding_status", "last_breastfeeding_date", "next_visit_date", "delivery",
            "delivery_datetime", "index_asc", "index_desc", "index_program_asc=index_asc", "index_program_desc=index_desc",
        ),
        {
            "_edd": date("5596"),
            "_tested": date("HIV TEST DATE"),
            "next_visit_date": date("5096"),
            "breastfeeding_status": coded("13642"),
            "last_breastfeeding_date": date("6889"),
            "delivery": yn("14990"),
            "delivery_datetime": date("5599"),
        },
        finish=finish,
        drop=("raw_patient_id", "raw_encounter_id", "facility"),
    )
    return run(c, job)


def _pregnant_states(c: Clinic) -> DataFrame:
    return c.states().filter(F.col("state_uuid") == PREGNANT_STATE)


def pmtct_contacts(c: Clinic) -> DataFrame:
    o = c.obs("13182").select("person_id", "obs_id", "obs_datetime", "date_created", "creator")
    o = ordered.index_pair(o, ["person_id"], ["obs_datetime", "obs_id"], ("contact_index", "_desc")).withColumnRenamed("person_id", "patient_id")
    e = latest.top1(c.enrolments(HIV), ["patient_id"], ["-date_enrolled", "-patient_program_id"])
    s = latest.top1(_pregnant_states(c), ["patient_program_id"], ["-start_date", "-patient_state_id"])
    e = enrich.decode(e, s, "patient_program_id", "patient_program_id", {"_since": "start_date"})
    o = enrich.decode(o, e, "patient_id", "patient_id", {"hiv_enrollment_date": "date_enrolled", "pmtct_initiation_date": "_since"})
    o = enrich.decode(o, c.order_start("11197"), "patient_id", "patient_id", {"art_start_date": "order_start"})
    o = _group_answers(c, o, {"contact_type": listed("13265"), "contact_gender": listed("2845"), "contact_age": num("3467")}, "obs_id")
    o = c.with_identifier(c.with_person(c.with_user(o, "creator", "user_entered", login=True), {"_birth": "birthdate"}))
    return o.select(
        "emr_id", complete_years(F.col("_birth"), F.lit(c.as_of)).alias("age"), "hiv_enrollment_date", "pmtct_initiation_date", "art_start_date",
        F.col("obs_datetime").alias("reference_date"), "contact_index", "contact_type", "contact_gender",
        "contact_age", F.col("date_created").alias("date_entered"), "user_entered",
    )


def pmtct_labs(c: Clinic) -> DataFrame:
    """Tests taken while the patient was in the pregnant state."""
    from wardmill.operators.intervals import join_containing

    p = c.table("patient_program").filter(c.program_ids(HIV)).select("patient_program_id", "patient_id")
    spans = _pregnant_states(c).join(p, "patient_program_id").select("patient_id", "start_date", "end_date", "patient_state_id")
    e = c.encounters([*PMTCT_VISIT_TYPES])
    hit = join_containing(
        e.select("encounter_id", "patient_id", "encounter_datetime"), spans, ["patient_id"], "encounter_datetime", "start_date", "end_date",
        {"_state": "patient_state_id"}, ["encounter_id"], True, ["patient_state_id"], days=60,
    ).select("encounter_id")
    tests = c.table("concept").filter("class = 'Test'").select("concept_id")
    o = c.live("obs").join(tests, "concept_id", "left_semi").join(hit, "encounter_id", "left_semi")
    o = ordered.index_pair(o, ["person_id"], ["obs_datetime", "obs_id"], sizes=c.live("obs"))
    o = c.with_concept_name(c.with_concept_name(o, "concept_id", "test_type"), "value_coded", "_coded", "en")
    o = c.with_answers(o, {"test_result_date": date("3267")}, within=e)
    o = c.with_identifier(c.with_user(o, "creator", "user_entered", login=True), key="person_id")
    return o.select(
        "emr_id", F.col("obs_datetime").alias("test_date"), "test_result_date", "test_type",
        F.coalesce("_coded", F.col("value_numeric").cast("string"), "value_text").alias("test_result"),
        F.col("date_created").alias("date_entered"), "user_entered", "index_asc", "index_desc",
    )


def pmtct_pregnancy(c: Clinic) -> DataFrame:
    """Pregnant states in open HIV enrolments."""
    open_ = c.enrolments(HIV).filter("date_completed is null").select("patient_program_id", "patient_id")
    p = c.states().filter(c.is_code("state_concept_id", "PATIENT PREGNANT")).join(open_, "patient_program_id")
    p = p.select("patient_id", "patient_state_id", "start_date")
    p = c.with_identifier(c.with_person(p, {"birthdate": "birthdate"}))
    p = p.withColumn("age_at_pregnancy", complete_years(F.col("birthdate"), F.col("start_date")))
    p = enrich.decode(p, c.order_start("11197"), "patient_id", "patient_id", {"_a1": "order_start"})
    follow = c.encounters([PMTCT_FOLLOWUP]).select("encounter_id")
    arv = c.obs("CIEL:159599").join(follow, "encounter_id", "left_semi").groupBy("person_id").agg(F.max_by("value_datetime", "obs_id").alias("_a2"))
    p = enrich.decode(p, arv, "patient_id", "person_id", {"_a2": "_a2"})
    both = least_strict([F.col("_a1"), F.col("_a2")])
    o = c.obs("CIEL:159758", "REFERRAL OR TRANSFER", "11525", "13955")
    since = p.select("patient_state_id", F.col("patient_id").alias("person_id"), "start_date").join(o, "person_id")
    since = since.filter(F.col("obs_datetime") >= F.col("start_date").cast("timestamp_ntz"))
    newest = lambda code, v: F.max_by(v, F.when(c.is_code("concept_id", code), F.struct("obs_datetime", "obs_id")))
    since = since.groupBy("patient_state_id").agg(
        F.max(F.when(c.is_code("concept_id", "CIEL:159758") & c.is_code("value_coded", "CIEL:1065"), True)).alias("has_birthplan"),
        F.max(F.when(c.is_code("concept_id", "REFERRAL OR TRANSFER") & c.is_code("value_coded", "TRANSFER"), True)).alias("transfer_status"),
        newest("11525", "value_datetime").alias("_counsel"),
        newest("13955", "value_coded").alias("_known"),
    )
    p = p.join(since, "patient_state_id", "left")
    active = c.live("orders").filter(c.is_code("order_reason", "11197") & F.col("auto_expire_date").isNull() & F.col("date_stopped").isNull())
    p = enrich.decode(p, active.select("patient_id").distinct().withColumn("_on", F.lit(True)), "patient_id", "patient_id", {"is_active_on_art": "_on"})
    p = enrich.decode(p, c.latest_obs("CIEL:5497"), "patient_id", "person_id", {"cd4_count_assessed": "value_numeric"})
    e = c.encounters([PMTCT_INITIAL, PMTCT_FOLLOWUP]).groupBy("patient_id").agg(F.max_by("location_id", "encounter_id").alias("location_id"))
    p = enrich.decode(p, c.with_place(e, "_place"), "patient_id", "patient_id", {"health_facility": "_place"})
    age = F.col("age_at_pregnancy")
    group = waterfall(
        [(age.between(lo, lo + 4), F.lit(f"Group {i}")) for i, lo in enumerate(range(15, 50, 5), 1)]
        + [(age > 50, F.lit("Group 7")), (age.isNull(), F.lit("Group 10"))]
    )
    return p.select(
        "emr_id", "start_date", F.col("start_date").alias("pmtct_enrollment_date"), "health_facility",
        F.to_date(F.coalesce(both, "_a1", "_a2")).alias("art_start_date"), "birthdate", "age_at_pregnancy", group.alias("age_at_pregnancy_cat"),
        "has_birthplan", "is_active_on_art", "transfer_status", "cd4_count_assessed", F.to_date("_counsel").alias("post_test_counseling_date"),
        c.yes_no("_known").alias("hiv_known_before_current_pregnancy"), _null("int").alias("index_asc"), _null("int").alias("index_desc"),
    )


def pmtct_infant_delivery(c: Clinic) -> DataFrame:
    p = c.enrolments(INFANTS).select("patient_id", "date_enrolled", "date_completed")
    p = c.with_identifier(c.with_person(p, {"_birth": "birthdate"}))
    p = p.withColumn("infant_age_in_months", complete_months(F.col("_birth"), F.lit(c.as_of)).cast("double"))
    months = F.col("infant_age_in_months")
    group = F.when(months < 2, "<2 mo").when((months >= 2) & (months <= 12), "2-12 mo").otherwise("> 2 mo")
    rapid = c.latest_obs("13135").select("person_id", "obs_id", "obs_datetime")
    rapid = _group_answers(c, rapid, {"_res": listed("1040")}, "obs_id")
    p = enrich.decode(p, rapid, "patient_id", "person_id", {"hiv_rapid_test_date": "obs_datetime", "hiv_test_result": "_res"})
    for code, cols in (
        ("1030", {"pcr_test_date": "obs_datetime", "pcr_result": "_name"}),
        ("13964", {"_parto": "value_coded"}),
        ("CIEL:164851", {"maternity_clinic_type": "_name"}),
        ("CIEL:163529", {"_place": "value_text"}),
        ("CIEL:1151", {"breastfeeding_status": "_name"}),
    ):
        p = enrich.decode(p, c.with_concept_name(c.latest_obs(code), "value_coded", "_name"), "patient_id", "person_id", cols)
    places = c.table("location").select(F.col("location_id").cast("string").alias("_lid"), "name")
    p = enrich.decode(p, places, "_place", "_lid", {"health_facility": "name"})
    now = F.lit(c.as_of).cast("timestamp_ntz")
    o = c.table("orders").filter(c.is_code("order_reason", "11197"))
    o = o.withColumns({"_start": F.coalesce("scheduled_date", "date_activated"), "_stop": F.coalesce("date_stopped", "auto_expire_date")})
    o = o.groupBy("patient_id").agg(
        F.min("_start").alias("_art"), F.max(F.when(active_at(F.col("_start"), F.col("_stop"), now), True)).alias("_on")
    )
    p = enrich.decode(p, o, "patient_id", "patient_id", {"art_start_date": "_art", "is_active_on_art": "_on"})
    d = latest.top1(c.encounters([HIV_DISPENSING_TYPE]), ["patient_id"], ["-encounter_datetime", "-encounter_id"])
    d = c.with_answers(d.select("patient_id", "encounter_id"), {"_due": date("5096")}, within=c.encounters([HIV_DISPENSING_TYPE]))
    p = enrich.decode(p, d, "patient_id", "patient_id", {"_due": "_due"})
    due = F.to_date("_due")
    lost = F.when(F.date_add(due, 28) > F.lit(c.as_of).cast("date"), "0").otherwise("1")
    return p.select(
        "emr_id", "infant_age_in_months", group.alias("age_cat_infant"), F.col("date_enrolled").alias("eid_date_enrolled"),
        F.col("date_completed").alias("eid_date_completed"), c.yes_no("_parto").alias("delivery_with_partograph"), "maternity_clinic_type",
        "breastfeeding_status", "hiv_rapid_test_date", "hiv_test_result", "pcr_test_date", "pcr_result", "art_start_date", "is_active_on_art",
        due.alias("next_dispensing_date"), lost.alias("is_LTFU"), F.lit(1).alias("is_exposed"), "health_facility",
    )


def eid_patient(c: Clinic, workflow_uuid: str = INFANT_WORKFLOW, mother_types=("Parent",)) -> DataFrame:
    """Infants enrolled, with programme, latest HIV test and mother."""
    p = c.without_test_patients(c.enrolments(INFANTS).select("patient_id").distinct())
    p = c.with_identifiers(p, {"emr_id": "emr", "hivemr_v1_id": "hiv", "hiv_dossier_id": "dossier"})
    p = enrich.decode(p, c.names(), "patient_id", "person_id", {"given_name": "given_name", "family_name": "family_name"})
    p = c.with_person(p, {"gender": "gender", "birthdate": "birthdate"})
    p = c.with_health_center(c.with_attribute(p, "telephone_number", TELEPHONE, "uuid"))
    first = c.with_place(c.first_enrolment(INFANTS), "_place")
    p = enrich.decode(p, first, "patient_id", "patient_id", {"_first": "date_enrolled", "initial_enrollment_location": "_place"})
    last = c.with_concept_name(c.with_place(c.last_enrolment(INFANTS), "_place"), "outcome_concept_id", "_outcome")
    flow = c.metadata_ids("program_workflow", "program_workflow_id", "uuid", [workflow_uuid])
    ends = last.select("patient_program_id", F.col("date_completed").alias("_done"))
    s = c.states().filter(F.col("program_workflow_id").isin(flow) if flow else F.lit(False)).join(ends, "patient_program_id")
    s = s.filter(F.col("end_date").isNull() | (F.col("end_date").cast("timestamp_ntz") == F.col("_done")))
    s = c.with_concept_name(latest.top1(s, ["patient_program_id"], ["-start_date", "-patient_state_id"]), "state_concept_id", "_state")
    last = enrich.decode(last, s, "patient_program_id", "patient_program_id", {"_state": "_state"})
    p = enrich.decode(
        p, last, "patient_id", "patient_id",
        {"latest_enrollment_location": "_place", "current_treatment_status": "_state", "_done": "date_completed", "outcome": "_outcome"},
    )
    t = latest.top1(c.obs("1040", "1030", "1042"), ["person_id"], ["-obs_datetime", "-obs_id"])
    t = c.with_concept_name(c.with_concept_name(t, "concept_id", "_kind", short=True), "value_coded", "_result")
    p = enrich.decode(
        p, t, "patient_id", "person_id",
        {"latest_hiv_test_date": "obs_datetime", "latest_hiv_test_type": "_kind", "latest_hiv_test_result": "_result"},
    )
    p = enrich.decode(p, c.order_start("CIEL:138405"), "patient_id", "patient_id", {"_art": "order_start"})
    kinds = c.metadata_ids("relationship_type", "relationship_type_id", "a_is_to_b", list(mother_types))
    women = c.table("person").filter("gender = 'F'").select(F.col("person_id").alias("person_a"))
    r = c.live("relationship").filter(F.col("relationship").isin(kinds)).join(women, "person_a", "left_semi")
    p = enrich.related(p, r, "patient_id", "person_b", "person_a", ["-date_created", "-relationship_id"], "_mother")
    p = c.with_identifier(p, "mother_emr_id", "emr", "_mother")
    return p.select(
        "emr_id", "hivemr_v1_id", "hiv_dossier_id", "given_name", "family_name", "gender", "birthdate", "telephone_number", "health_center",
        age_tenths(F.col("birthdate"), F.lit(c.as_of)).alias("current_age"), F.to_date("_first").alias("initial_enrollment_date"),
        "initial_enrollment_location", "latest_enrollment_location", "current_treatment_status", F.to_date("_done").alias("completion_date"),
        "outcome", "latest_hiv_test_date", "latest_hiv_test_type", "latest_hiv_test_result", F.to_date("_art").alias("art_start_date"), "mother_emr_id",
    )


def mch_birth(c: Clinic) -> DataFrame:
    """One row per birth of a delivery, numbered within it."""
    e = c.encounters([DELIVERY])
    deliveries = e
    e = c.with_answers(e, {"delivery_datetime": date("5599")}, within=deliveries)
    b = c.obs("13555").select("encounter_id", F.col("obs_id").alias("_group"))
    # births of one delivery: a handful of rows per key
    b = ordered.index_pair(b, ["encounter_id"], ["_group"], ("birth_number", "_left"), bounded=True)
    b = b.withColumn("multiples", F.col("birth_number") + F.col("_left") - 1).join(e, "encounter_id")
    spec = {
        "birth_outcome": listed("CIEL:161033"),
        "birth_weight": num("CIEL:5916"),
        "birth_apgar": num("CIEL:1504"),
        "birth_neonatal_resuscitation": listed("CIEL:162131"),
        "birth_macerated_fetus": listed("CIEL:135437"),
        "_type": listed("11663"),
        "c_section_maternal_reasons": listed("13571"),
        "other_c_section_maternal_reasons": comment("13571", "5622"),
        "c_section_fetal_reasons": listed("13572"),
        "other_c_section_fetal_reason": comment("13572", "5622"),
        "c_section_obstetrical_reasons": listed("13573"),
        "other_c_section_obstetrical_reason": comment("13573", "5622"),
    }
    b = _group_answers(c, b, spec, "_group")
    loose = c.live("obs").filter("obs_group_id is null")
    b = c.with_answers(b, {"_type2": listed("11663", sep="|")}, obs=loose, within=deliveries)
    b = c.with_identifier(c.with_facility(c.with_user(b, "creator", "user_entered", login=True)))
    return b.select(
        "emr_id", c.key("encounter_id"), F.to_date("encounter_datetime").alias("encounter_date"), F.col("date_created").alias("date_entered"),
        "user_entered", "facility", c.key("visit_id", True), "visit_location", "delivery_datetime", "birth_number", "multiples", "birth_apgar",
        "birth_outcome", "birth_weight", "birth_neonatal_resuscitation", "birth_macerated_fetus",
        F.coalesce("_type", "_type2").alias("type_of_delivery"), "c_section_maternal_reasons", "other_c_section_maternal_reasons",
        "c_section_fetal_reasons", "other_c_section_fetal_reason", "c_section_obstetrical_reasons", "other_c_section_obstetrical_reason",
    )


def mch_patient(c: Clinic) -> DataFrame:
    """Patients with obstetric encounters, and those enrolled without one."""
    e = c.encounters([OBGYN, DELIVERY])
    cols = ["patient_id", "encounter_id", "encounter_datetime", "location_id", "encounter_type"]
    e = c.with_type_name(c.with_place(e.select(*cols), "_place"))
    last = latest.top1(e, ["patient_id"], ["-encounter_datetime", "-encounter_id"])
    first = latest.top1(e, ["patient_id"], ["encounter_datetime", "encounter_id"])
    last = c.with_answers(last, {"_anc": mark("Type of HUM visit", "ANC VISIT"), "_edd": date("ESTIMATED DATE OF CONFINEMENT")}, within=c.encounters([OBGYN, DELIVERY]))
    p = last.select(
        "patient_id", F.col("_place").alias("current_reporting_health_center"), F.col("encounter_type_name").alias("latest_encounter_type"),
        F.col("encounter_datetime").alias("latest_encounter_date"), (F.col("_anc") == 1).alias("antenatal_visit"), F.to_date("_edd").alias("estimated_delivery_date"),
    )
    p = enrich.decode(
        p, first, "patient_id", "patient_id",
        {"initial_health_center": "_place", "first_encounter_type": "encounter_type_name", "first_encounter_date": "encounter_datetime"},
    )
    open_ = c.enrolments(MATERNAL).filter("date_completed is null").join(c.live("patient").select("patient_id"), "patient_id", "left_semi")
    open_ = enrich.anti(c.with_place(open_, "initial_health_center").select("patient_id", "initial_health_center").distinct(), p, ["patient_id"])
    p = c.without_test_patients(union_rows([p, open_]))
    p = enrich.decode(p, c.names(), "patient_id", "person_id", {"first_name": "given_name", "last_name": "family_name", "nickname": "middle_name"})
    p = c.with_person(p, {"gender": "gender", "dob": "birthdate"})
    reg = c.obs("CIVIL STATUS").join(c.registrations().select("encounter_id"), "encounter_id", "left_semi")
    reg = c.with_concept_name(latest.top1(reg, ["person_id"], ["-date_created", "-obs_id"]), "value_coded", "_ms")
    p = enrich.decode(p, reg, "patient_id", "person_id", {"marital_status": "_ms"})
    p = c.with_address(p, {"locality": "address1"})
    p = c.with_health_center(c.with_identifiers(p, {"emr_id": "emr", "dossier_id": "dossier"}))
    age = complete_years(F.col("dob"), F.lit(c.as_of))
    edges = [10, 15, 20, 25, 30, 35, 40, 45, 50]
    group = F.coalesce(bands(age, edges, [f"Group {i}" for i in range(1, 11)]), F.lit("Group 10"))
    return p.select(
        "emr_id", "dossier_id", "health_center", "first_encounter_type", "latest_encounter_type", "first_encounter_date", "latest_encounter_date",
        "initial_health_center", "current_reporting_health_center", "first_name", "last_name", "nickname", "marital_status", "gender", "dob",
        F.when(F.col("dob").isNull(), "1").alias("age_unknown"), age.cast("double").alias("age"), group.alias("age_cat_1"), "locality",
        F.when(F.col("antenatal_visit"), True).alias("antenatal_visit"), "estimated_delivery_date",
        F.when(F.col("antenatal_visit"), True).alias("pregnant"),
    )


# ---- chronic disease ------------------------------------------------------

# Concepts of chronic disease categories.
NCD_CATEGORIES = {
    "htn": "903", "diabetes": "3720", "respiratory": "6768", "epilepsy": "155", "heart_failure": "3468",
    "cerebrovascular_accident": "7314", "renal_failure": "3681", "liver_failure": "3682", "rehabilitation": "7263",
    "sickle_cell": "7908", "other_ncd": "5622",
}
DM_TYPES = [
    (("6691",), "Type-1"),
    (("6692", "12228", "11943", "12227", "12251"), "Type-2"),
    (("7138",), "hyperglycemia without diabetes"),
    (("6693",), "Gestational diabetes"),
]
HEART_CATEGORIES = [
    (("5016",), "cardiomyopathy"),
    (("7955",), "mitral valve stenosis"),
    (("3071",), "hypertensive heart disease"),
    (("7497", "3131"), "other heart valve disease/congenital heart disease "),
    (("4000",), "isolated right heart failure"),
    (("3307",), "pericardial effusion"),
]
NYHA = [(("3135",), "NYHA Class I"), (("3136",), "NYHA Class II"), (("3137",), "NYHA Class III"), (("3138",), "NYHA Class IV")]
# Concepts of heart muscle diseases.
CARDIOMYOPATHIES = [
    (("7940",), "Ischemic cardiomyopathy"),
    (("3129",), "Peripartum cardiomyopathy"),
    (("4002",), "Alcoholic cardiomyopathy"),
    (("3130",), "Cardiomyopathy due to HIV"),
    (("5016",), "Other Cardiomyopathy"),
]


def _named(c: Clinic, rules, otherwise: str | None = None):
    return waterfall(
        [(c.is_code("value_coded", *codes), F.lit(name)) for codes, name in rules], F.lit(otherwise).cast("string")
    )


def ncd_patient_table_staging(c: Clinic) -> DataFrame:
    """Patients with chronic disease encounters whose categories were recorded."""
    from wardmill.operators.tree import set_closure

    types = [NCD_INITIAL, NCD_FOLLOWUP]
    e = c.encounters(types).select("encounter_id", "patient_id", "encounter_datetime")
    p = e.groupBy("patient_id").agg(
        F.to_date(F.min("encounter_datetime")).alias("ncd_first_encounter_date"),
        F.to_date(F.max("encounter_datetime")).alias("ncd_latest_encounter_date"),
    )
    o = c.live("obs").join(e.select("encounter_id"), "encounter_id", "left_semi")
    cat = o.filter(c.is_code("concept_id", "10529")).groupBy("person_id").agg(
        *[F.max(c.is_code("value_coded", code)).alias(n) for n, code in NCD_CATEGORIES.items()]
    )
    p = p.join(cat.withColumnRenamed("person_id", "patient_id"), "patient_id")
    edges = c.table("concept_set")

    def newest(code: str, in_set: str | None, value, name: str) -> DataFrame:
        x = o.filter(c.is_code("concept_id", code))
        if in_set is not None:
            root = edges.filter(F.col("concept_set") == c.code(in_set)).select("concept_set").distinct()
            m = set_closure(edges, "concept_set", "concept_id", root, 2).select(F.col("member").alias("value_coded")).distinct()
            x = x.join(m, "value_coded", "left_semi")
        x = latest.top1(x, ["person_id"], ["-obs_datetime", "-obs_id"])
        return x.select(F.col("person_id").alias("patient_id"), value.alias(name))

    p = p.join(newest("3064", "11501", _named(c, DM_TYPES), "dm_type"), "patient_id", "left")
    p = p.join(newest("3064", "11499", _named(c, HEART_CATEGORIES, "other"), "heart_failure_category"), "patient_id", "left")
    p = p.join(newest("3139", None, _named(c, NYHA), "nyha_class"), "patient_id", "left")
    unlikely = o.filter(c.is_code("concept_id", "11926")).select(F.col("person_id").alias("patient_id"), F.lit(True).alias("_unlikely")).distinct()
    p = p.join(unlikely, "patient_id", "left")
    cm = c.obs("3064").filter(c.is_code("value_coded", *[x for cs, _ in CARDIOMYOPATHIES for x in cs]))
    cm = latest.top1(cm, ["person_id"], ["-encounter_id", "-obs_id"]).select(
        F.col("person_id").alias("patient_id"), _named(c, CARDIOMYOPATHIES).alias("cardiomyopathy")
    )
    p = p.join(cm, "patient_id", "left")
    every = c.table("patient_program").filter(c.program_ids(NCD)).select("patient_program_id", "patient_id")
    s = c.table("patient_state").join(every, "patient_program_id")
    s = enrich.decode(s, c.table("program_workflow_state"), "state", "program_workflow_state_id", {"_c": "concept_id"})
    s = c.with_concept_name(s.filter("_c is not null"), "_c", "_name", "en")
    s = latest.top1(s, ["patient_id"], ["-start_date", "_name", "patient_state_id"])
    p = enrich.decode(p, s, "patient_id", "patient_id", {"ncd_status": "_name", "ncd_status_date": "start_date"})
    first = c.with_place(c.first_enrolment(NCD), "_place")
    p = enrich.decode(p, first, "patient_id", "patient_id", {"_enrolled": "date_enrolled", "ncd_enrollment_location": "_place"})
    last = c.with_place(c.last_enrolment(NCD), "_place")
    p = enrich.decode(p, last, "patient_id", "patient_id", {"ncd_current_location": "_place"})
    p = c.with_person(p, {"birthdate": "birthdate", "sex": "gender", "deceased": "dead", "_died": "death_date"})
    p = enrich.decode(p, c.addresses(voided_too=False), "patient_id", "person_id", {"department": "state_province", "commune": "city_village"})
    p = c.with_health_center(c.with_identifier(p))
    return p.select(
        "emr_id", "birthdate", "sex", "department", "commune",
        F.coalesce(F.to_date("_enrolled"), "ncd_first_encounter_date").alias("ncd_enrollment_date"), "ncd_first_encounter_date",
        "ncd_latest_encounter_date", "ncd_enrollment_location", "ncd_current_location", *NCD_CATEGORIES, "dm_type", "heart_failure_category",
        "cardiomyopathy", "nyha_class", (F.col("heart_failure") & F.coalesce("_unlikely", F.lit(False))).alias("heart_failure_improbable"),
        "ncd_status", "ncd_status_date", "deceased", F.to_date("_died").alias("date_of_death"), "health_center",
    )


HF_FLAGS = {"hf_broad": "3468", "hf_left": "12645", "hf_isolated_right": "4000", "hf_congestive": "9444", "hf_rheumatic": "221"}


def ncd_heart_failure_patient_staging(c: Clinic) -> DataFrame:
    """Patients ever given a heart failure answer, with the kinds given."""
    o = c.live("obs").filter(c.is_code("value_coded", *HF_FLAGS.values()))
    ncd = c.encounters(["NCD Initial Consult", "NCD Followup Consult"], "name").select("encounter_id", F.lit(True).alias("_ncd"))
    o = o.join(ncd, "encounter_id", "left")
    p = o.groupBy("person_id").agg(
        F.to_date(F.min("obs_datetime")).alias("hf_diagnosis_date"), F.coalesce(F.max("_ncd"), F.lit(False)).alias("hf_ncd"),
        *[F.max(c.is_code("value_coded", code)).alias(n) for n, code in HF_FLAGS.items()],
    ).withColumnRenamed("person_id", "patient_id")
    last = c.encounters().groupBy("patient_id").agg(F.to_date(F.max("encounter_datetime")).alias("last_visit_date"))
    open_ = c.enrolments("NCD", "name").filter("date_completed is null").select("patient_id", F.lit(True).alias("_en")).distinct()
    p = p.join(last, "patient_id", "left").join(open_, "patient_id", "left")
    p = c.with_person(p, {"sex": "gender", "birthdate": "birthdate", "deceased": "dead"})
    p = c.with_health_center(c.with_identifier(p))
    return p.select(
        "emr_id", "sex", "birthdate", "hf_diagnosis_date", F.coalesce("_en", F.lit(False)).alias("ncd_enrolled"), "hf_ncd", *HF_FLAGS,
        "last_visit_date", "deceased", "health_center",
    )


# ---- pathology ------------------------------------------------------------

PATHOLOGY_ORDER = "65c912c2-88cf-46c2-83ae-2b03b1f97d3a"
ROLES = {
    "ordering_provider": "c458d78e-8374-4767-ad58-9f8fe276e01c",
    "resident": "6e630e03-5182-4cb3-9a82-a5b1a85c09a7",
    "attending_surgeon": "9b135b19-7ebe-4a51-aea2-69a53f9383af",
}
PROCESSING = ("10485", "10840", "7818", "14239", "6110")
RESULTS = ("7907", "10783", "14314", "10785", "14313")


def _last_entry(c: Clinic, codes: tuple[str, ...], at: str, who: str) -> DataFrame:
    """When, and by whom, the newest observation of a set of questions was entered."""
    o = latest.top1(c.obs(*codes), ["encounter_id"], ["-date_created", "-obs_id"])
    o = c.with_user(o, "creator", who)
    return o.select("encounter_id", F.col("date_created").alias(at), who)


def pathology_encounters(c: Clinic, order_type: str = PATHOLOGY_ORDER) -> DataFrame:
    kinds = c.metadata_ids("order_type", "order_type_id", "uuid", [order_type])
    o = c.window(c.table("orders").filter(F.col("order_type_id").isin(kinds)), "date_activated")
    bare = o
    o = c.with_concept_name(o.select("order_id", "encounter_id", "order_number", "patient_id", "order_reason"), "order_reason", "prepath_dx")
    e = c.table("encounter").select("encounter_id", "visit_id", "location_id", "encounter_datetime", "date_created", "creator")
    o = c.with_facility(c.with_user(o.join(e, "encounter_id", "left"), "creator", "order_user_entered"))
    roles = c.table("encounter_role").select("encounter_role_id", F.col("uuid").alias("_role"))
    who = c.live("encounter_provider").join(roles, "encounter_role_id")
    who = latest.top1(who, ["encounter_id", "_role"], ["-date_created", "-encounter_provider_id"])
    who = enrich.decode(who, enrich.decode(c.table("provider"), c.person_names(), "person_id", "person_id", {"_pn": "person_name"}), "provider_id", "provider_id", {"_pn": "_pn"})
    who = who.groupBy("encounter_id").agg(*[F.max(F.when(F.col("_role") == u, F.col("_pn"))).alias(n) for n, u in ROLES.items()])
    o = o.join(who, "encounter_id", "left")
    texts = {
        "clinical_history": "10142", "specimen_details_1": "10775", "specimen_details_2": "10776", "specimen_details_3": "10777",
        "specimen_details_4": "10778", "specimen_details_5": "14317", "specimen_details_6": "14318", "specimen_details_7": "14319",
        "specimen_details_8": "14320", "md_to_notify": "10779", "clinician_telephone": "6589", "specimen_accession_number": "10840",
        "results_note": "7907",
    }
    bools = {
        "urgent_review": "7813", "suspected_cancer": "14111", "immunohistochemistry_needed": "14209", "immunohistochemistry_sent": "7818",
        "cancer_confirmed": "14313",
    }
    spec = {n: text(k) for n, k in texts.items()} | {n: yn(k) for n, k in bools.items()}
    spec |= {
        "immunohistochemistry_sent_date": date("14239"), "process_date": date("10485"), "results_date": date("10783"),
        "_file": Q("obs", "10785"), "_g1": Q("obs", "10782"), "_g2": Q("obs", "14315"), "_g3": Q("obs", "14314"),
    }
    o = c.with_answers(o, spec, within=bare)
    loose = c.live("obs").filter("obs_group_id is null")
    o = c.with_answers(o, {"specimen_to_boston_date": date("14239")}, obs=loose, within=bare)
    o = _group_answers(c, o, {"post_op_diagnosis": listed("3064")}, "_g1", sparse=True)
    o = _group_answers(
        c, o, {"specimen_to_pap": yn("7817"), "specimen_to_pap_date": date("14239"), "specimen_returned_pap_date": date("6110")}, "_g2", sparse=True
    )
    o = _group_answers(c, o, {"post_result_diagnosis": listed("3064")}, "_g3", sparse=True)
    o = o.join(_last_entry(c, PROCESSING, "process_date_entered", "process_user_entered"), "encounter_id", "left")
    o = o.join(_last_entry(c, RESULTS, "result_date_entered", "result_user_entered"), "encounter_id", "left")
    o = c.with_identifier(c.with_person(o, {"gender": "gender", "_birth": "birthdate"}))
    return o.select(
        "emr_id", complete_years(F.col("_birth"), F.col("encounter_datetime")).alias("age_at_enc"), "gender", c.key("order_id", True),
        c.key("order_number", True), c.key("encounter_id", True), "encounter_location", "facility",
        F.col("encounter_datetime").alias("order_datetime"), F.col("date_created").alias("order_entered_datetime"), "order_user_entered",
        *ROLES, "md_to_notify", "clinician_telephone", "prepath_dx", "clinical_history", "post_op_diagnosis",
        *[f"specimen_details_{i}" for i in range(1, 9)], "urgent_review", "suspected_cancer", "immunohistochemistry_needed",
        "immunohistochemistry_sent", "immunohistochemistry_sent_date", "process_date", "process_date_entered", "process_user_entered",
        "specimen_accession_number", F.col("immunohistochemistry_sent").alias("specimen_to_boston"), "specimen_to_boston_date",
        "specimen_to_pap", "specimen_to_pap_date", "specimen_returned_pap_date", "results_date", "result_date_entered", "result_user_entered",
        "results_note", F.col("_file").isNotNull().cast("int").alias("file_uploaded"), "cancer_confirmed", "post_result_diagnosis",
    )


def pathology_procedures(c: Clinic, order_type: str = PATHOLOGY_ORDER) -> DataFrame:
    kinds = c.metadata_ids("order_type", "order_type_id", "uuid", [order_type])
    od = c.window(c.live("orders").filter(F.col("order_type_id").isin(kinds)), "date_activated").select("encounter_id", "order_id", "order_number")
    o = c.obs("10770", "10772").select("encounter_id", "person_id", "concept_id", "value_coded", "value_text").join(od, "encounter_id")
    o = c.with_concept_name(o, "value_coded", "_name")
    e = c.table("encounter").select("encounter_id", "visit_id", "location_id")
    o = c.with_identifier(c.with_facility(o.join(e, "encounter_id", "left")), key="person_id")
    return o.select(
        "emr_id", c.key("order_id", True), c.key("order_number", True), c.key("encounter_id", True),
        F.when(c.is_code("concept_id", "10770"), F.col("_name")).alias("coded_procedure"),
        F.when(c.is_code("concept_id", "10772"), F.col("value_text")).alias("noncoded_procedure"), "facility", c.key("visit_id", True), "visit_location",
    )


#: Columns of the contract that no step of the job fills.
UNFILLED_DISPENSING = {
    "encounter_id": "int", "encounter_datetime": "timestamp_ntz", "encounter_location": "string", "encounter_provider": "string",
    "duration": "int", "duration_unit": "string",
}


def new_medication_dispensing(c: Clinic) -> DataFrame:
    from wardmill.plans.extract.records import drug_codes

    m = c.table("medication_dispense")
    m = enrich.decode(m, c.table("order_frequency"), "frequency", "order_frequency_id", {"_fc": "concept_id"})
    m = c.with_concept_name(c.with_concept_name(m, "_fc", "_freq", "en"), "dose_units", "_du", "en")
    m = enrich.decode(m, c.table("drug"), "drug_id", "drug_id", {"drug_name": "name"})
    m = enrich.decode(m, drug_codes(c), "drug_id", "drug_id", {"drug_product_code": "code"})
    m = c.with_identifier(enrich.decode(m, c.table("users"), "creator", "user_id", {"user_entered": "username"}))
    return m.select(
        "emr_id", *(F.lit(None).cast(t).alias(n) for n, t in UNFILLED_DISPENSING.items()), F.col("date_created").alias("date_entered"),
        "user_entered", "drug_name", "drug_product_code", F.col("dose").alias("quantity_per_dose"),
        F.col("_du").alias("dose_unit"), F.col("_freq").alias("frequency"), F.col("quantity").alias("quantity_dispensed"),
        F.col("dosing_instructions").alias("prescription"),
    )
