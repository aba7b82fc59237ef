"""Extracts at the grain of a patient, visit, encounter, order or observation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmill.functions.dates import complete_years, entered_later_same_clock, minutes_between
from wardmill.operators import eav, enrich, latest, tree
from wardmill.operators.merge import union_rows
from wardmill.operators.rules import code_flags, waterfall
from wardmill.plans.extract.clinic import HEALTH_CENTER_ATTRIBUTE, Clinic, Q, row_ids, text
from wardmill.plans.extract.forms import CHEMO
from wardmill.sources.site import date_window, trailing_months
from wardmill.sources.staging import staged
from wardmill.streaming.incremental import delta_extract

SPECIMEN_COLLECTION = "39C09928-0CAB-4DBA-8E48-39C631FA4286"
TEST_ORDER = "52a447d3-a64a-11e3-9aeb-50e549534c5e"
DISPENSING = "8ff50dea-18a1-4609-b4c9-3f8f2d611b84"


def _encounters(c: Clinic) -> DataFrame:
    """Live encounters; of changed patients only when the run has a previous watermark."""
    e = c.encounters()
    if c.previous_watermark is None:
        return e
    return delta_extract(e, c.table("dbevent_patient"), c.previous_watermark, c.new_watermark)


def _placed(c: Clinic, e: DataFrame) -> DataFrame:
    return c.with_identifier(c.with_facility(c.with_type_name(e)))


def all_encounters(c: Clinic) -> DataFrame:
    e = c.with_user(_placed(c, _encounters(c)))
    e = c.with_answers(e, {"next_appt": Q("max_date", "5096"), "disposition": Q("max_coded", "8620")})
    o = enrich.decode(
        c.table("obs").select("encounter_id", "creator", "date_created"),
        c.user_names(),
        "creator",
        "user_id",
        {"creator_name": "username"},
    )
    m = enrich.modifiers(o, _encounters(c), sep=", ")
    e = e.join(m, "encounter_id", "left")
    null = F.lit(None).cast("int")
    return e.select(
        "emr_id",
        c.key("encounter_id"),
        c.key("patient_id"),
        c.key("visit_id"),
        "visit_location",
        "encounter_type_name",
        "encounter_location",
        "facility",
        "encounter_datetime",
        F.col("date_created").alias("entered_datetime"),
        "user_entered",
        F.to_date("next_appt").alias("next_appt_date"),
        "disposition",
        "users_modified",
        "dates_modified",
        null.alias("index_asc"),
        null.alias("index_desc"),
    )


def all_encounters_past_year(c: Clinic) -> DataFrame:
    """As above for the trailing thirteen calendar months, fewer columns."""
    e = trailing_months(_encounters(c), "encounter_datetime", c.as_of)
    e = e.filter(F.to_date("encounter_datetime") <= F.lit(c.as_of).cast("date"))
    e = c.with_answers(c.with_user(_placed(c, e)), {"next_appt": Q("max_date", "5096")}, within=e)
    return e.select(
        "emr_id",
        c.key("encounter_id"),
        c.key("patient_id"),
        c.key("visit_id"),
        "visit_location",
        "encounter_type_name",
        "encounter_location",
        "facility",
        "encounter_datetime",
        F.col("date_created").alias("entered_datetime"),
        "user_entered",
        F.to_date("next_appt").alias("next_appt_date"),
        "voided",
    )


def all_visits(c: Clinic) -> DataFrame:
    v = c.live("visit").withColumn("_year", F.year("date_started"))
    v = latest.first_flag(v, ["patient_id", "_year"], "date_started", "_first")
    v = enrich.decode(v, c.table("visit_type"), "visit_type_id", "visit_type_id", {"visit_type": "name"})
    v = c.with_identifier(c.with_user(c.with_place(v, "visit_location"), "creator", "visit_user_entered"))
    null = F.lit(None)
    return v.select(
        "emr_id",
        c.key("visit_id"),
        c.key("patient_id"),
        F.col("date_started").alias("visit_date_started"),
        F.col("date_stopped").alias("visit_date_stopped"),
        F.col("date_created").alias("visit_date_entered"),
        "visit_user_entered",
        "visit_type",
        null.cast("boolean").alias("visit_checkin"),
        null.cast("string").alias("visit_reason"),
        "visit_location",
        F.coalesce("visit_location", F.lit(c.unknown_location())).alias("facility"),
        F.when(F.col("_first"), True).alias("first_visit_this_year"),
        null.cast("int").alias("index_asc"),
        null.cast("int").alias("index_desc"),
    )


def all_patients(c: Clinic, host_url: str | None = None) -> DataFrame:
    p = c.live("patient").select(
        "patient_id", F.coalesce("date_changed", "date_created").alias("_m_patient")
    )
    changed = F.coalesce("date_changed", "date_created")
    person = c.table("person").withColumn("_changed", changed)
    p = enrich.decode(
        p,
        person,
        "patient_id",
        "person_id",
        {
            "gender": "gender",
            "dob": "birthdate",
            "dob_estimated": "birthdate_estimated",
            "dead": "dead",
            "_died": "death_date",
            "_cause": "cause_of_death",
            "_m_person": "_changed",
            "patient_uuid": "uuid",
        },
    )
    p = c.with_concept_name(p, "_cause", "cause_of_death", "en")
    names = c.names(voided_too=True).withColumn("_changed", changed)
    p = enrich.decode(
        p, names, "patient_id", "person_id", {"name": "given_name", "family_name": "family_name", "_m_name": "_changed"}
    )
    addr = c.addresses().withColumn("_changed", changed)
    p = enrich.decode(
        p,
        addr,
        "patient_id",
        "person_id",
        {
            "country": "country",
            "department": "state_province",
            "commune": "city_village",
            "section_communale": "address3",
            "locality": "address1",
            "_m_address": "_changed",
        },
    )
    p = c.with_identifiers(p, {"emr_id": "emr", "hiv_emr_id": "hiv", "dossier_id": "dossier"})
    own = F.col("name").isin("Telephone Number", "First Name of Mother")
    attr = c.attribute_values(
        {"telephone_number": ("name", "Telephone Number"), "mothers_first_name": ("name", "First Name of Mother"), "_hc": ("uuid", HEALTH_CENTER_ATTRIBUTE)},
        _m_attr=F.max(F.when(own, changed)),
    )
    places = c.table("location").select(F.col("location_id").cast("string").alias("_lid"), "name")
    attr = enrich.decode(attr, places, "_hc", "_lid", {"health_center": "name"})
    p = enrich.decode(p, attr, "patient_id", "person_id", {n: n for n in ("telephone_number", "mothers_first_name", "health_center", "_m_attr")})
    reg = c.with_user(c.with_place(c.registrations(), "reg_location"))
    o = c.live("obs").join(reg.select("encounter_id"), "encounter_id", "left_semi")
    last_obs = o.groupBy("encounter_id").agg(F.max("date_created").alias("_m_obs"))
    reg = reg.join(last_obs, "encounter_id", "left")
    reg = c.with_answers(reg, {"civil_status": Q("max_coded", "1054"), "occupation": Q("max_coded", "1304")}, obs=o)
    p = enrich.decode(
        p,
        reg.withColumn("_day", F.to_date("encounter_datetime")),
        "patient_id",
        "patient_id",
        {
            "reg_location": "reg_location",
            "registration_date": "_day",
            "date_registration_entered": "date_created",
            "user_entered": "user_entered",
            "civil_status": "civil_status",
            "occupation": "occupation",
            "_m_reg": "date_changed",
            "_m_obs": "_m_obs",
        },
    )
    p = latest.agg_lookup(
        p,
        c.table("encounter"),
        ["patient_id"],
        first_encounter_date=F.to_date(F.min("encounter_datetime")),
        last_encounter_date=F.to_date(F.max("encounter_datetime")),
    )
    stamps = ["_m_person", "_m_name", "_m_address", "_m_attr", "_m_obs", "_m_reg", "_m_patient"]
    return p.select(
        "emr_id",
        "hiv_emr_id",
        "dossier_id",
        c.key("patient_id"),
        "mothers_first_name",
        "country",
        "department",
        "commune",
        "section_communale",
        "locality",
        "telephone_number",
        "civil_status",
        "occupation",
        "reg_location",
        "registration_date",
        "date_registration_entered",
        "user_entered",
        "first_encounter_date",
        "last_encounter_date",
        "name",
        "family_name",
        "dob",
        "dob_estimated",
        "gender",
        "dead",
        F.to_date("_died").alias("death_date"),
        "cause_of_death",
        F.greatest(*stamps).alias("last_modified_datetime"),
        "patient_uuid",
        F.substring_index(F.lit(host_url), "/", 3).alias("patient_url"),
        "health_center",
    )


# Concept sets behind the diagnosis flags.
DIAGNOSIS_SETS = {
    "weekly_notifiable": "7676",
    "urgent": "7679",
    "santefamn": "7957",
    "psychological": "7942",
    "pediatric": "7933",
    "outpatient": "7936",
    "ncd": "7935",
    "non_diagnosis": "non-diagnoses",
    "ed": "7934",
    "age_restricted": "7677",
    "oncology": "8934",
}
NON_CODED = "Diagnosis or problem, non-coded"


def _diagnosis_rows(c: Clinic, since=None, start=None, end=None) -> DataFrame:
    o = date_window(c.window(c.obs("3064", NON_CODED), "obs_datetime"), "obs_datetime", start, end)
    if since is not None:
        o = trailing_months(o, "obs_datetime", since)
        o = o.filter(F.to_date("obs_datetime") <= F.lit(since).cast("date"))
    coded = c.is_code("concept_id", "3064")
    return o.select(
        F.col("person_id").alias("patient_id"),
        "encounter_id",
        "obs_id",
        F.when(coded, F.col("obs_group_id")).alias("obs_group_id"),
        "obs_datetime",
        coded.alias("coded"),
        F.when(coded, F.col("value_coded")).alias("diagnosis_concept"),
        F.when(~coded, F.col("value_text")).alias("_text"),
    )


def set_flags(c: Clinic, df: DataFrame, key: str, sets: dict[str, str]) -> DataFrame:
    """1/0 per concept set; members of member sets count too."""
    ids = c.codes(sets.values())
    roots = {n: ids[s] for n, s in sets.items() if ids[s] is not None}
    edges = c.table("concept_set")
    top = edges.filter(F.col("concept_set").isin(list(roots.values()))).select("concept_set").distinct()
    members = tree.set_closure(edges, "concept_set", "concept_id", top, 2)
    flags = members.groupBy("member").agg(
        *[F.max((F.col("root") == F.lit(i)).cast("int")).alias(n) for n, i in roots.items()]
    )
    out = enrich.decode(df, flags, key, "member", {n: n for n in roots})
    for n in sets:
        have = F.col(n) if n in roots else F.lit(None).cast("int")
        out = out.withColumn(n, F.when(F.col(key).isNotNull(), F.coalesce(have, F.lit(0)) == 1))
    return out


def icd10(c: Clinic) -> DataFrame:
    """One ICD-10 code per concept."""
    m = c.table("report_mapping").filter(F.col("source") == "ICD-10-WHO")
    return latest.top1(m, ["concept_id"], ["code"]).select("concept_id", "code")


def all_diagnosis(c: Clinic, since=None) -> DataFrame:
    """Coded and free-text diagnoses; ``since`` keeps the trailing months up to that day."""
    # a patient's diagnoses meet in one task, where the first of each needs no shuffle of its own
    same = Window.partitionBy(enrich.AT, "patient_id", "diagnosis_concept")
    known = F.col("patient_id").isNotNull() & F.col("diagnosis_concept").isNotNull()
    first = F.when(known, F.min(F.when(F.col("coded"), F.to_date("obs_datetime"))).over(same))
    d = _diagnosis_details(c, _diagnosis_rows(c, since), DIAGNOSIS_SETS, lambda d: d.withColumn("_first", first))
    return d.select(
        c.key("patient_id"),
        "dossierid",
        "patient_primary_id",
        "loc_registered",
        "unknown_patient",
        "gender",
        complete_years(F.col("birthdate"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "department",
        "commune",
        "section",
        "locality",
        "street_landmark",
        c.key("encounter_id"),
        "encounter_location",
        "facility",
        c.key("obs_id"),
        "obs_datetime",
        "entered_by",
        "provider",
        F.coalesce("diagnosis_coded_fr", "_text").alias("diagnosis_entered"),
        "dx_order",
        "certainty",
        "coded",
        "diagnosis_concept",
        "diagnosis_coded_fr",
        "diagnosis_coded_en",
        "icd10_code",
        *DIAGNOSIS_SETS,
        "date_created",
        (entered_later_same_clock(F.col("obs_datetime"), F.col("date_created")) == 1).alias("retrospective"),
        c.key("visit_id"),
        "visit_location",
        "birthdate",
        "birthdate_estimated",
        F.col("encounter_type_name").alias("encounter_type"),
        "section_communale_cdc_id",
        F.when(
            F.col("coded"), F.coalesce(F.to_date("obs_datetime") == F.col("_first"), F.lit(True))
        ).alias("first_diagnosis"),
    )


# Fixed value: the set behind the notifiable flag of the plain diagnoses table.
NOTIFIABLE_SET = "8612"
PLAIN_SETS = {"notifiable": NOTIFIABLE_SET, **{n: s for n, s in DIAGNOSIS_SETS.items() if n != "weekly_notifiable"}}


def diagnoses(c: Clinic, start=None, end=None) -> DataFrame:
    """Coded and free-text diagnoses of a date window with plain ids, English names and 1/0 marks."""
    d = _diagnosis_details(c, _diagnosis_rows(c, None, start, end), PLAIN_SETS)
    return d.select(
        "patient_id", F.col("dossierid").alias("dossier_id"), "patient_primary_id", "loc_registered", "unknown_patient", "gender",
        complete_years(F.col("birthdate"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "department", "commune", "section", "locality", "street_landmark", "encounter_id", "encounter_location", "facility",
        "obs_id", "obs_datetime", "entered_by", "provider", F.coalesce("diagnosis_coded_en", "_text").alias("diagnosis_entered"),
        "dx_order", "certainty", F.col("coded").cast("int").cast("string").alias("coded"), "diagnosis_concept", "diagnosis_coded_fr",
        "icd10_code", *(F.col(n).cast("int").alias(n) for n in PLAIN_SETS), "date_created",
        F.coalesce(entered_later_same_clock(F.col("obs_datetime"), F.col("date_created")), F.lit(0)).cast("int").alias("retrospective"),
        "visit_id", "visit_location", "birthdate", "birthdate_estimated", F.col("encounter_type_name").alias("encounter_type"),
        "section_communale_cdc_id",
    )


def _diagnosis_details(c: Clinic, d: DataFrame, sets: dict[str, str], scan=None) -> DataFrame:
    """What group, concept, encounter and patient say about each diagnosis; ``scan`` as in ``enrich.gathered``."""
    group = c.live("obs").filter("obs_group_id is not null")
    e = c.table("encounter").select(
        "encounter_id",
        F.col("creator").alias("_creator"),
        "visit_id",
        "encounter_type",
        "location_id",
        F.col("date_created").alias("date_created"),
        "encounter_datetime",
    )
    # staged, the names' size is known, and if they are few the encounters are not shuffled by user
    e = c.with_user(c.with_facility(c.with_type_name(e)), "_creator", "entered_by", users=staged(c.user_names(), "user-names"))

    def of_groups(g: DataFrame) -> DataFrame:
        asked = {"dx_order": Q("coded", "7537"), "certainty": Q("coded", "1379")}
        g = c.with_answers(g, asked, "obs_group_id", group, "obs_group_id", g)
        return g.filter(F.coalesce(*asked).isNotNull())

    def of_patients(p: DataFrame) -> DataFrame:
        p = c.with_unknown_flag(c.with_registration_place(p))
        p = c.with_identifiers(p, {"patient_primary_id": "emr", "dossierid": "dossier"})
        p = c.with_person(p, {"gender": "gender", "birthdate": "birthdate", "birthdate_estimated": "birthdate_estimated"})
        p = c.with_address(
            p,
            {
                "department": "state_province",
                "commune": "city_village",
                "section": "address3",
                "locality": "address1",
                "street_landmark": "address2",
            },
        )
        return enrich.decode(p, c.section_codes(), "patient_id", "person_id", {"section_communale_cdc_id": "code"})

    found = {"obs_group_id": of_groups, "encounter_id": lambda x: c.with_provider(x.join(e, "encounter_id", "left")), "patient_id": of_patients}
    d = enrich.gathered(d, "patient_id", found, ["encounter_id", "obs_id"], scan)
    d = d.withColumn("facility", F.coalesce("facility", F.lit(c.unknown_location())))
    said = ("diagnosis_coded_fr", "diagnosis_coded_en", "icd10_code", *sets)
    d = enrich.decode(d, _diagnosis_concepts(c, sets), "diagnosis_concept", "concept_id", {n: n for n in said})
    return d.withColumns({n: F.when(F.col("diagnosis_concept").isNotNull(), F.coalesce(n, F.lit(False))) for n in sets})


def _diagnosis_concepts(c: Clinic, sets: dict[str, str]) -> DataFrame:
    """Names, ICD-10 code and sets of each concept that has any, staged: one table of known size, so diagnoses are not shuffled by concept."""
    tables = (c.live("concept_name"), c.table("report_mapping"), c.table("concept_set"))
    d = union_rows([t.select("concept_id") for t in tables]).filter("concept_id IS NOT NULL").distinct()
    d = c.with_concept_name(d, "concept_id", "diagnosis_coded_fr", "fr")
    d = c.with_concept_name(d, "concept_id", "diagnosis_coded_en", "en")
    d = enrich.decode(d, icd10(c), "concept_id", "concept_id", {"icd10_code": "code"})
    return staged(set_flags(c, d, "concept_id", sets), "diagnosis-concepts")


def all_diagnosis_past_year(c: Clinic) -> DataFrame:
    return all_diagnosis(c, c.as_of)


def _order_status(as_of, has_specimen, reported=None):
    """Status of a test order, most decisive fact first."""
    today = F.lit(as_of).cast("timestamp_ntz")
    s = F.col("fulfiller_status")
    head = []
    if reported is not None:
        head = [(reported, F.lit("Reported")), (has_specimen, F.lit("Collected"))]
    return waterfall(
        head
        + [
            (F.col("date_stopped").isNotNull() & ~has_specimen, F.lit("Cancelled")),
            ((F.col("auto_expire_date") < today) & ~has_specimen, F.lit("Expired")),
            (s == "COMPLETED", F.lit("Reported")),
            (s == "IN_PROGRESS", F.lit("Collected")),
            (s == "EXCEPTION", F.lit("Not Performed")),
        ],
        F.lit("Ordered"),
    )


def all_lab_orders(c: Clinic) -> DataFrame:
    kinds = c.metadata_ids("order_type", "order_type_id", "uuid", [TEST_ORDER])
    o = c.table("orders").filter(F.col("order_type_id").isin(kinds) & (F.col("order_action") == "NEW"))
    o = c.without_test_patients(c.window(o, "date_activated"))
    spec = (
        c.obs("10781")
        .join(c.encounters([SPECIMEN_COLLECTION]).select("encounter_id", "encounter_datetime"), "encounter_id")
        .select(
            F.col("value_text").alias("_number"),
            F.col("encounter_id").alias("specimen_encounter_id"),
            F.col("encounter_datetime").alias("specimen_collection_datetime"),
        )
    )
    spec = latest.top1(spec, ["_number"], ["-specimen_encounter_id"])
    o = o.join(spec, F.col("order_number") == F.col("_number"), "left")
    e = c.table("encounter").select("encounter_id", "visit_id", "location_id", "encounter_datetime")
    o = o.join(e, "encounter_id", "left")
    o = c.with_facility(o)
    o = c.with_concept_name(o, "concept_id", "orderable")
    o = c.with_concept_name(o, "order_reason", "_reason")
    p = enrich.decode(c.providers(), c.table("provider_role"), "provider_role_id", "provider_role_id", {"_role": "name"})
    o = enrich.decode(o, p, "encounter_id", "encounter_id", {"user_entered": "provider_name", "orderer_provider_type": "_role"})
    o = c.with_identifier(c.with_registration_place(c.with_unknown_flag(o)))
    o = c.with_person(o, {"gender": "gender", "_birth": "birthdate"})
    o = c.with_answers(
        o,
        {
            "test_location": Q("coded", "11791"),
            "result_date": Q("date", "Date of test results"),
            "collection_date_estimated": Q("coded", "11781"),
        },
        "specimen_encounter_id",
        obs_key="encounter_id",
        within=spec,
    )
    return o.select(
        c.key("patient_id", True),
        "emr_id",
        "loc_registered",
        F.when(F.col("unknown_patient").isNotNull(), "1").alias("unknown_patient"),
        "gender",
        complete_years(F.col("_birth"), F.col("encounter_datetime")).alias("age_at_encounter"),
        c.key("order_number", True),
        F.col("_reason").alias("order_reason"),
        F.col("accession_number").alias("lab_id"),
        "orderable",
        _order_status(c.as_of, F.col("specimen_encounter_id").isNotNull()).alias("status"),
        "user_entered",
        "orderer_provider_type",
        F.col("date_activated").alias("order_datetime"),
        F.col("encounter_location").alias("ordering_location"),
        c.key("visit_id", True),
        "visit_location",
        "facility",
        "urgency",
        "specimen_collection_datetime",
        "collection_date_estimated",
        "test_location",
        "result_date",
    )


def _at_encounters(c: Clinic, rows: DataFrame, encounters: DataFrame) -> DataFrame:
    """Rows with what was looked up for their encounters, last and in one join: the lookups pass over the fewer encounters, and rows travel narrow."""
    out = rows.join(encounters, "encounter_id", "left")
    return out.withColumn("facility", F.coalesce("facility", F.lit(c.unknown_location())))


def all_lab_results(c: Clinic, lab_set: str = "lab tests", not_performed: str = "not performed reason") -> DataFrame:
    """Results of all tests in the lab set (four levels deep) and reasons for tests not done."""
    root = c.table("report_mapping").filter(F.col("concept_id") == c.code(lab_set)).select("concept_id").distinct()
    tests = tree.set_closure(c.table("concept_set"), "concept_set", "concept_id", root, 4).select(
        F.col("member").alias("concept_id")
    )
    value = F.coalesce(F.col("value_coded").cast("string"), F.col("value_numeric").cast("string"), F.col("value_text"))
    o = c.window(c.live("obs"), "obs_datetime")
    # staged, its size is known; else all observations are shuffled by concept to meet a few tests
    done = o.join(staged(tests.distinct(), "lab-tests"), "concept_id", "left_semi").filter(value.isNotNull())
    # a coded result is told by its name alone
    plain = lambda v: F.when(F.col("value_coded").isNull(), F.col(v)).alias(v)
    cols = ["obs_id", F.col("person_id").alias("patient_id"), "encounter_id", "order_id"]
    null = lambda t: F.lit(None).cast(t)
    r = union_rows(
        [
            done.select(*cols, F.col("concept_id").alias("_test"), "value_coded", plain("value_numeric"), plain("value_text"), null("bigint").alias("_why")),
            o.filter(c.is_code("concept_id", not_performed)).select(
                *cols, null("bigint").alias("_test"), null("bigint").alias("value_coded"),
                null("double").alias("value_numeric"), null("string").alias("value_text"), F.col("value_coded").alias("_why"),
            ),
        ]
    )
    e = c.table("encounter").select(
        "encounter_id", "location_id", "encounter_type", "encounter_datetime", "date_created", "creator", "visit_id"
    )
    e = c.with_user(c.with_facility(c.with_type_name(e)))
    r = enrich.decode(
        r, c.table("orders"), "order_id", "order_id",
        {"order_number": "order_number", "_orderable": "concept_id", "lab_id": "accession_number"}, row_ids(r, "order_id"),
    )
    r = c.with_identifier(c.with_registration_place(c.with_unknown_flag(r)))
    r = c.with_person(r, {"gender": "gender", "_birth": "birthdate"})
    r = _at_encounters(c, r, e)
    dates = latest.top1(c.obs("10783"), ["encounter_id"], ["-date_created", "-obs_id"])
    r = enrich.decode(
        r, dates, "encounter_id", "encounter_id", {"_result": "value_datetime", "results_entry_date": "date_created"}
    )
    for column, name in (("_orderable", "orderable"), ("_test", "test"), ("value_coded", "_coded"), ("_why", "reason_not_performed")):
        r = c.with_concept_name(r, column, name)
    loinc = c.table("report_mapping").filter("source = 'LOINC'").groupBy("concept_id").agg(
        eav.text_list(F.col("code")).alias("LOINC")
    )
    r = enrich.decode(r, loinc, "_test", "concept_id", {"LOINC": "LOINC"})
    units = c.table("concept_numeric").select("concept_id", "units")
    r = enrich.decode(r, units, "_test", "concept_id", {"units": "units"})
    return r.select(
        c.key("obs_id", True),
        c.key("patient_id", True),
        "emr_id",
        c.key("visit_id", True),
        "visit_location",
        c.key("encounter_id", True),
        F.col("encounter_type_name").alias("encounter_type"),
        "encounter_location",
        "facility",
        "loc_registered",
        "unknown_patient",
        "gender",
        complete_years(F.col("_birth"), F.col("encounter_datetime")).alias("age_at_encounter"),
        c.key("order_number", True),
        "orderable",
        "test",
        "lab_id",
        "LOINC",
        F.to_date("encounter_datetime").alias("specimen_collection_date"),
        F.col("date_created").alias("specimen_collection_entry_date"),
        "user_entered",
        F.to_date("_result").alias("results_date"),
        "results_entry_date",
        F.when(F.col("value_coded").isNotNull(), F.col("_coded"))
        .otherwise(F.coalesce(F.col("value_numeric").cast("string"), "value_text"))
        .alias("result"),
        "units",
        "reason_not_performed",
        null("int").alias("index_asc"),
        null("int").alias("index_desc"),
    )


# Procedure codes behind each flag.
PROCEDURE_FLAGS = {
    "oophorectomy": ["10796", "8721", "8796"],
    "biopsy": [
        "8644", "8777", "9767", "10792", "8807", "10800", "10837", "10798", "10803", "9817", "10833", "8753",
        "10809", "10791", "10790", "10817",
    ],
    "cervical_biopsy": ["8644", "9767", "10800"],
    "endometrial_biopsy": ["8777"],
    "breast_biopsy": ["10792", "8807", "10837", "10798", "10803", "9817", "10833", "8753", "10809", "10791"],
    "uterine_biopsy": ["10790", "10817"],
    "uterine_currettage": ["8760", "8775"],
    "hysterectomy": ["8784"],
    "caesarean_hysterectomy": ["8764"],
    "total_abdominal_hysterectomy": ["8784"],
    "caesarean_section": ["CESAREAN SECTION", "8892"],
    "colposcopy": ["8952", "9759"],
    "cryotherapy": ["9764"],
    "instrumental_deliveries": ["10752", "10755"],
    "leep": ["9761"],
    "myomectomy": ["8695"],
    "iud_fp": ["8870"],
    "ccv_contraception": ["1719"],
}
CODED_PROCEDURES = ("10751", "10484")
FREE_PROCEDURE = "12923"


def all_procedures(c: Clinic) -> DataFrame:
    o = c.obs(*CODED_PROCEDURES, FREE_PROCEDURE).select(
        F.col("person_id").alias("patient_id"), "encounter_id", "creator", "obs_id", "obs_datetime", "concept_id", "value_coded",
        F.when(c.is_code("concept_id", FREE_PROCEDURE), F.col("value_text")).alias("value_text"), "date_created",
    )
    coded = c.is_code("concept_id", *CODED_PROCEDURES)
    e = c.encounters().select("encounter_id", "visit_id", "location_id", "encounter_type", "encounter_datetime")
    e = c.with_facility(c.with_type_name(e))
    o = enrich.gathered(
        o, "encounter_id", {"patient_id": c.with_identifier, "encounter_id": lambda x: c.with_provider(_at_encounters(c, x, e))}, ["obs_id"]
    )
    o = o.withColumn("facility", F.coalesce("facility", F.lit(c.unknown_location())))
    # staged, the names' size is known, and if they are few the observations are not shuffled by user
    o = enrich.decode(o, staged(c.user_names(), "user-names"), "creator", "user_id", {"entered_by": "person_name"})
    o = c.with_concept_name(o, "value_coded", "_name", "en")
    flags = {n: [i for i in c.codes(cs).values() if i is not None] for n, cs in PROCEDURE_FLAGS.items()}
    o = code_flags(o, "value_coded", flags)
    return o.select(
        "emr_id", "encounter_id", "obs_id", "visit_id", "visit_location", "creator", "encounter_datetime", "obs_datetime",
        "encounter_location", "facility", F.col("encounter_type_name").alias("encounter_type"), "entered_by", "provider",
        F.when(coded, F.col("_name")).otherwise(F.col("value_text")).alias("procedures"),
        coded.cast("int").alias("procedure_coded"), "date_created",
        F.when(minutes_between(F.col("encounter_datetime"), F.col("date_created")) > 30, 1).otherwise(0).alias("retrospective"),
        *PROCEDURE_FLAGS,
    )


DISPENSED = {
    "dose": Q("max_num", "9073"),
    "dose_unit": Q("max_text", "9074"),
    "duration": Q("max_num", "9075"),
    "duration_unit": Q("max_coded", "6412"),
    "frequency": Q("max_coded", "9363"),
    "quantity": Q("max_num", "9071"),
    "instructions": Q("max_text", "9072"),
}


def _drugs(c: Clinic, key: list[str], *codes: str) -> DataFrame:
    return c.obs(*codes).groupBy(*key).agg(F.max("value_drug").alias("drug_id"), F.max("value_coded").alias("drug_concept"))


def all_medication_dispensing(c: Clinic) -> DataFrame:
    """Dispensing groups of the old form plus records of the dispensing module, if the site has it."""
    heads = c.obs("9070").select(
        F.col("person_id").alias("patient_id"), "encounter_id", F.col("obs_id").alias("_group")
    )
    grouped = c.live("obs").filter("obs_group_id is not null")
    old = c.with_answers(heads, DISPENSED, "_group", grouped, "obs_group_id", heads)
    old = enrich.decode(old, _drugs(c, ["obs_group_id"], "1282"), "_group", "obs_group_id", {"drug_id": "drug_id"})
    e = c.table("encounter").select("encounter_id", "encounter_datetime", F.col("date_created").alias("datetime_entered"), "creator", "location_id", "visit_id")
    old = c.with_provider(old.join(e, "encounter_id", "left"), "encounter_provider")
    old = old.select(
        F.lit("Old").alias("form"), F.col("_group").alias("dispensing_id"), "patient_id", "encounter_id", "encounter_datetime",
        "datetime_entered", "creator", "location_id", "visit_id", "encounter_provider", "drug_id", "duration", "duration_unit",
        F.col("dose").alias("quantity_per_dose"), "dose_unit", "frequency", F.col("quantity").alias("quantity_dispensed"),
        F.col("dose_unit").alias("quantity_unit"), F.lit(None).cast("bigint").alias("order_id"), "instructions",
    )
    parts = [old]
    if c.site.exists("medication_dispense"):
        m = c.table("medication_dispense").filter(c.is_code("status", "1267"))
        m = enrich.decode(m, c.table("order_frequency"), "frequency", "order_frequency_id", {"_fc": "concept_id"})
        m = c.with_concept_name(c.with_concept_name(m, "_fc", "_freq"), "dose_units", "_du")
        m = c.with_concept_name(m, "quantity_units", "_qu")
        who = enrich.decode(c.table("provider"), c.person_names(), "person_id", "person_id", {"_pn": "person_name"})
        m = enrich.decode(m, who, "dispenser", "provider_id", {"encounter_provider": "_pn"})
        m = m.join(c.table("encounter").select("encounter_id", "visit_id"), "encounter_id", "left")
        parts.append(
            m.select(
                F.lit("New").alias("form"), F.col("medication_dispense_id").alias("dispensing_id"), "patient_id", "encounter_id",
                F.col("date_handed_over").alias("encounter_datetime"), F.col("date_created").alias("datetime_entered"), "creator",
                "location_id", "visit_id", "encounter_provider", "drug_id", F.lit(None).cast("double").alias("duration"),
                F.lit(None).cast("string").alias("duration_unit"), F.col("dose").alias("quantity_per_dose"),
                F.col("_du").alias("dose_unit"), F.col("_freq").alias("frequency"), F.col("quantity").alias("quantity_dispensed"),
                F.col("_qu").alias("quantity_unit"), F.col("drug_order_id").alias("order_id"),
                F.col("dosing_instructions").alias("instructions"),
            )
        )
    d = union_rows(parts)
    d = c.with_identifier(c.with_facility(c.with_user(d)))
    d = enrich.decode(d, c.table("drug"), "drug_id", "drug_id", {"drug_name": "name"})
    d = enrich.decode(d, drug_codes(c), "drug_id", "drug_id", {"drug_product_code": "code"})
    null = F.lit(None).cast("int")
    return d.select(
        c.key("dispensing_id"), "form", c.key("patient_id"), "emr_id", c.key("encounter_id"), "encounter_datetime",
        "encounter_location", "facility", c.key("visit_id"), "visit_location", "datetime_entered", "user_entered",
        "encounter_provider", "drug_name", "drug_product_code", F.col("duration").cast("int").alias("duration"),
        "duration_unit", "quantity_per_dose", "dose_unit", "frequency",
        F.col("quantity_dispensed").cast("int").alias("quantity_dispensed"), "quantity_unit", c.key("order_id"),
        "instructions", null.alias("index_asc"), null.alias("index_desc"),
    )


def drug_codes(c: Clinic) -> DataFrame:
    """Product code per drug (one of them, if mapped to several)."""
    return c.table("drug_code").groupBy("drug_id").agg(F.min("code").alias("code"))


def all_medication_prescribed(c: Clinic) -> DataFrame:
    """Prescription groups of forms plus drug orders."""
    e = c.encounters().select(
        "encounter_id", "encounter_datetime", F.col("date_created").alias("_created"), "visit_id", "location_id", "creator", "encounter_type"
    )
    heads = c.obs("10742").select(F.col("person_id").alias("patient_id"), "encounter_id", F.col("obs_id").alias("_group"))
    grouped = c.live("obs").filter("obs_group_id is not null")
    spec = {
        "order_dose": Q("max_num", "9073"),
        "order_dose_unit": Q("max_coded", "10744"),
        "order_dosing_instructions": Q("max_text", "9072"),
        "order_frequency": Q("max_coded", "9363"),
        "order_duration": Q("max_num", "9075"),
        "order_duration_units": Q("max_coded", "6412"),
        "order_quantity": Q("max_num", "9071"),
    }
    a = c.with_answers(heads, spec, "_group", grouped, "obs_group_id", heads)
    a = enrich.decode(
        a, _drugs(c, ["obs_group_id"], "1282", "10634"), "_group", "obs_group_id", {"drug_id": "drug_id", "drug_concept": "drug_concept"}
    )
    o = c.live("orders").join(c.table("drug_order"), "order_id")
    bare = o
    o = enrich.decode(o, c.table("order_frequency"), "frequency", "order_frequency_id", {"_fc": "concept_id"})
    for column, name in (
        ("_fc", "order_frequency"), ("dose_units", "order_dose_unit"), ("quantity_units", "order_quantity_units"),
        ("route", "order_route"), ("duration_units", "order_duration_units"), ("order_reason", "_reason"),
    ):
        o = c.with_concept_name(o, column, name)
    o = c.with_answers(o, {"order_comments": text("Medication comments (text)")}, within=bare)
    b = o.select(
        "encounter_id", "patient_id", "order_id", F.col("concept_id").alias("drug_concept"), F.col("drug_inventory_id").alias("drug_id"),
        F.col("dose").alias("order_dose"), "order_dose_unit", F.col("dosing_instructions").alias("order_dosing_instructions"),
        "order_route", "order_frequency", F.col("quantity").alias("order_quantity"), "order_quantity_units",
        F.col("duration").cast("double").alias("order_duration"), "order_duration_units", F.col("_reason").alias("order_reason"),
        F.col("drug_non_coded").alias("order_formulation_non_coded"), F.col("num_refills").alias("order_quantity_num_refills"),
        "order_comments", F.to_date("date_created").alias("order_created_date"), F.to_date("date_activated").alias("order_date_activated"),
    )
    m = c.with_identifier(union_rows([a.drop("_group").withColumn("_form", F.lit(True)), b]))
    e = c.with_facility(c.with_user(c.with_type_name(e))).withColumn("_live", F.lit(True))
    # a group counts if its encounter does, an order always
    m = _at_encounters(c, m, e).filter("_form IS NULL OR _live")
    m = m.withColumns(
        {
            "order_created_date": F.coalesce("order_created_date", F.when(F.col("_form"), F.to_date("_created"))),
            "order_date_activated": F.coalesce("order_date_activated", F.when(F.col("_form"), F.to_date("encounter_datetime"))),
        }
    )
    m = c.with_concept_name(c.with_provider(m, "prescriber"), "drug_concept", "order_drug")
    m = enrich.decode(m, c.table("drug"), "drug_id", "drug_id", {"order_formulation": "name"})
    m = enrich.decode(m, drug_codes(c), "drug_id", "drug_id", {"product_code": "code"})
    return m.select(
        "emr_id", F.col("encounter_type_name").alias("encounter_type"), c.key("encounter_id", True), c.key("visit_id", True),
        "visit_location", c.key("order_id", True), F.col("encounter_location").alias("order_location"), "facility",
        "order_created_date", "order_date_activated", "user_entered", "prescriber", "order_drug", "order_formulation",
        "order_formulation_non_coded", F.col("order_quantity_num_refills").cast("int").alias("order_quantity_num_refills"), "product_code", F.col("order_quantity").cast("int").alias("order_quantity"), "order_quantity_units",
        F.col("order_dose").cast("int").alias("order_dose"), "order_dose_unit", "order_dosing_instructions", "order_route",
        "order_frequency", F.col("order_duration").cast("int").alias("order_duration"), "order_duration_units",
        "order_reason", "order_comments",
    )


def chemo_session_regimens(c: Clinic) -> DataFrame:
    e = c.encounters([CHEMO]).select("encounter_id", "encounter_datetime")
    o = c.obs("10506").join(e, "encounter_id")
    o = c.with_identifier(c.with_concept_name(o, "value_coded", "chemo_regimen_name", "en"), key="person_id")
    o = c.with_answers(o, {"_other": Q("comment", "10506", "5622")}, within=e)
    return o.select(
        "emr_id", c.key("obs_id"), c.key("encounter_id"), "encounter_datetime", "chemo_regimen_name",
        F.when(F.col("chemo_regimen_name") == "Other", F.col("_other")).alias("other_regimen"),
    )


def datakind_encounter(c: Clinic) -> DataFrame:
    n = c.live("obs").groupBy("encounter_id").agg(F.count(F.lit(1)).alias("obs_count"))
    e = c.encounters().join(n, "encounter_id", "left")
    e = c.with_user(c.with_provider(c.with_facility(c.with_type_name(e))), "creator", "user_entered", login=True)
    null = F.lit(None).cast("int")
    return e.select(
        c.key("patient_id"), c.key("encounter_id"), "encounter_datetime", F.col("encounter_type_name").alias("encounter_type"),
        "encounter_location", "facility", c.key("visit_id"), "visit_location", "provider", F.col("date_created").alias("date_entered"),
        "user_entered", "date_changed", "obs_count", null.alias("index_asc"), null.alias("index_desc"),
    )


def datakind_patient_program(c: Clinic) -> DataFrame:
    p = c.live("patient_program").join(
        c.table("program").select("program_id", F.col("name").alias("program_name")), "program_id"
    )
    p = c.with_concept_name(p, "outcome_concept_id", "outcome", "en")
    return p.select("patient_id", "program_name", "date_enrolled", "date_completed", "outcome", "date_created", "date_changed")


def datakind_registration(c: Clinic) -> DataFrame:
    """Patients with each of their registrations, if any; voided patients stay without one."""
    from wardmill.plans.extract.clinic import REGISTRATION

    e = c.encounters([REGISTRATION]).select(
        "patient_id", F.col("encounter_datetime").alias("registration_date"),
        F.col("date_created").alias("encounter_date_created"), F.col("date_changed").alias("encounter_date_changed"),
    )
    p = c.table("patient").select(
        "patient_id", F.col("date_created").alias("patient_date_created"), F.col("date_changed").alias("patient_date_changed"), "voided"
    )
    live = p.select("patient_id", "voided").filter("not voided").select("patient_id")
    p = p.drop("voided").join(e.join(live, "patient_id", "left_semi"), "patient_id", "left")
    p = c.with_health_center(c.with_person(p, {"death_date": "death_date"}))
    return p.select(
        "patient_id", "registration_date", "death_date", "patient_date_created", "patient_date_changed",
        "encounter_date_created", "encounter_date_changed", "health_center",
    )


# ---- data quality ---------------------------------------------------------

# Rule number, category, tables, columns and description.
QUALITY_RULES = [
    (1, "Completness", "patient", "emr_id", "emr id is null"),
    (2, "Completness", "patient, person", "birthdate", "birthdate is null"),
    (3, "Completness", "patient, person", "gender", "gender is null"),
    (4, "Completness", "patient, person_name", "given_name, family_name", "given_name is null or family_name is null"),
    (5, "Consistency", "patient_program, program", "date_enrolled, date_completed", "overlapping program enrollments"),
    (6, "Validity", "patient, person", "death_date, birthdate", "death date before birthdate"),
]


def _judged(c: Clinic) -> DataFrame:
    """(rule, patient_id, violation) for every case a rule looks at."""
    pat = c.with_unknown_flag(c.with_identifier(c.live("patient").select("patient_id")), "_unknown")
    person = c.table("person").select("person_id", "birthdate", "gender", "death_date", F.col("voided").alias("_pv"))
    one = pat.join(person, F.col("patient_id") == F.col("person_id"))
    unknown = F.col("_unknown").isNotNull()
    case = lambda n, v: F.struct(F.lit(n).alias("rule"), v.alias("violation"))
    persons = one.select(
        "patient_id",
        F.explode(
            F.array(case(2, F.col("birthdate").isNull() & unknown), case(3, F.col("gender").isNull() & unknown))
        ).alias("_c"),
    ).select("patient_id", "_c.*")
    ids = pat.select("patient_id", F.lit(1).alias("rule"), F.col("emr_id").isNull().alias("violation"))
    dead = c.table("patient").select("patient_id").join(person.filter("not _pv"), F.col("patient_id") == F.col("person_id"))
    dead = dead.select(
        "patient_id", F.lit(6).alias("rule"),
        F.coalesce(F.col("death_date") < F.col("birthdate").cast("timestamp_ntz"), F.lit(False)).alias("violation"),
    )
    names = c.table("person_name").select("person_id", "given_name", "family_name")
    named = pat.join(names, F.col("patient_id") == F.col("person_id")).select(
        "patient_id", F.lit(4).alias("rule"),
        ((F.col("given_name").isNull() | F.col("family_name").isNull()) & unknown).alias("violation"),
    )
    return union_rows([ids, persons, named, dead])


def enrolment_overlaps(c: Clinic) -> DataFrame:
    """Pairs of a patient's enrolments in a program where the later starts inside the earlier."""
    from wardmill.operators.intervals import join_overlap

    pp = c.live("patient_program").join(c.table("program").select("program_id", "name"), "program_id")
    a = pp.select("patient_id", "program_id", "name", "patient_program_id", "date_enrolled", "date_completed")
    pairs = join_overlap(
        a, a, ["patient_id", "program_id"], ("date_enrolled", "date_completed"), ("date_enrolled", "date_completed"),
        {"other_id": "patient_program_id", "other_start": "date_enrolled"}, days=365,
    )
    far = F.coalesce("date_completed", F.lit("9999-12-31").cast("timestamp_ntz"))
    return pairs.filter(
        (F.col("patient_program_id") != F.col("other_id"))
        & (F.col("date_enrolled") < F.col("other_start"))
        & (far > F.col("other_start"))
    )


def enrolments_inside(c: Clinic) -> DataFrame:
    """Per enrolment the number of later ones of its patient and program that start strictly inside it: no pairs."""
    from wardmill.operators.asof import count_within

    pp = c.live("patient_program").join(c.table("program").select("program_id"), "program_id", "left_semi")
    pp = pp.filter("date_enrolled is not null").select(
        "patient_id", "program_id", "patient_program_id", F.col("date_enrolled").cast("timestamp_ntz").alias("starts"),
        F.expr("CAST(date_enrolled AS timestamp_ntz) + INTERVAL 1 MICROSECOND").alias("lo"),
        F.expr("CAST(date_completed AS timestamp_ntz) - INTERVAL 1 MICROSECOND").alias("hi"),
    )
    return count_within(
        pp, ["patient_program_id"], pp, ["patient_id", "program_id"], "lo", "hi", "starts", {"inside": F.lit(True)}, "9999-12-31 00:00:00"
    )


def _rule_table(c: Clinic) -> DataFrame:
    from wardmill.sources.reference import literal_table

    schema = "rule int, issue_category string, table_names string, column_names string, quality_issue_desc string"
    return literal_table(c.site.spark, schema, QUALITY_RULES)


def data_quality_log_summary(c: Clinic) -> DataFrame:
    """Violations, cases and percent per rule; rules without a violation are left out."""
    counts = _judged(c).groupBy("rule").agg(
        F.count(F.when(F.col("violation"), 1)).alias("number_of_cases"), F.count(F.lit(1)).alias("total_count")
    )
    pp = c.live("patient_program").join(c.table("program").select("program_id"), "program_id", "left_semi")
    # ordered pairs of enrolments of one patient in one program, from counts instead of pairs
    per = pp.groupBy("patient_id", "program_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = per.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0)).cast("bigint").alias("total_count"))
    found = enrolments_inside(c).agg(F.coalesce(F.sum("inside"), F.lit(0)).cast("bigint").alias("number_of_cases")).withColumn("rule", F.lit(5))
    five = found.join(pairs.withColumn("rule", F.lit(5)), "rule").select("rule", "number_of_cases", "total_count")
    out = union_rows([counts, five]).filter("number_of_cases > 0").join(_rule_table(c), "rule")
    return out.select(
        F.col("rule").alias("quality_rule_id"), F.lit("mysql").alias("source"), "issue_category", "table_names", "column_names",
        "quality_issue_desc", F.lit(c.as_of).cast("date").alias("issue_log_date"), "number_of_cases", "total_count",
        (F.col("number_of_cases") / F.col("total_count") * 100).alias("percentage"),
    )


def data_quality_log_details(c: Clinic) -> DataFrame:
    bad = union_rows(
        [
            _judged(c).filter("violation").select("patient_id", "rule"),
            enrolment_overlaps(c).select("patient_id", F.lit(5).alias("rule")),
        ]
    )
    bad = c.with_identifier(bad.join(_rule_table(c), "rule"))
    return bad.select(
        F.col("rule").alias("quality_rule_id"), F.lit("mysql").alias("source"), "issue_category", "patient_id", "emr_id",
        "table_names", "column_names", "quality_issue_desc", F.lit(c.as_of).cast("date").alias("issue_log_date"),
    )


HIV_DISPENSING_TYPE = "cc1720c9-3e4c-4fa8-a7ec-40eeaad1958c"
HIV_INTAKE_TYPE = "c31d306a-40c4-11e7-a919-92ebcb67fe33"
HIV_FOLLOWUP_TYPE = "c31d3312-40c4-11e7-a919-92ebcb67fe33"
INFANT_FOLLOWUP_TYPE = "0f070640-279e-4ec0-9e6c-6ef1f6567030"


# The programmes whose encounters need an enrolment.
HIV_PROGRAM = "b1cb1fc1-5190-4f7a-af08-48870975dafc"
INFANT_PROGRAM = "7e06bf82-9f1a-4218-b68f-823082ef519b"


def data_warnings(c: Clinic, site: str = "site", drug_order_type: int = 2) -> DataFrame:
    """One row per warning of ten kinds."""
    row = lambda df, kind, details: df.select(
        "patient_id", F.lit(kind).alias("warning_type"), details.cast("string").alias("warning_details")
    )
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    none = F.lit(None)
    pat = c.with_unknown_flag(c.with_identifier(c.live("patient").select("patient_id")), "_unknown")
    person = c.table("person").select("person_id", "birthdate", "gender", "death_date", F.col("voided").alias("_pv"))
    known = pat.filter(F.col("_unknown").isNotNull()).join(person, F.col("patient_id") == F.col("person_id"))
    names = c.table("person_name").select("person_id", "given_name", "family_name")
    named = pat.filter(F.col("_unknown").isNotNull()).join(names, F.col("patient_id") == F.col("person_id"))
    dead = c.table("patient").select("patient_id").join(person.filter("not _pv"), F.col("patient_id") == F.col("person_id"))
    dead = c.with_unknown_flag(dead.filter(F.col("death_date") < F.col("birthdate").cast("timestamp_ntz")), "_unknown")
    enrolled = c.live("patient_program").filter(c.program_ids(HIV_PROGRAM) | c.program_ids(INFANT_PROGRAM)).select("patient_id")
    parts = [
        row(pat.filter("emr_id is null"), "blank emr_id", text("patient_id: ", F.col("patient_id"), f" on site: {site}")),
        row(
            enrolment_overlaps(c), "overlapping program enrollments",
            text("program name: ", F.col("name"), " | patient_program_ids: ", F.col("patient_program_id"), ",", F.col("other_id")),
        ),
        row(known.filter("gender is null"), "blank gender", none),
        row(known.filter("birthdate is null"), "blank birthdate", none),
        row(
            named.filter("given_name is null or family_name is null"), "blank given or family name",
            text("given name: ", F.col("given_name"), " | family name: ", F.col("family_name")),
        ),
        row(
            dead, "death date before birth date",
            text("death date: ", F.date_format("death_date", "yyyy-MM-dd HH:mm:ss"), " | birth date: ", F.col("birthdate"),
                 " | unknown patient: ", F.coalesce("_unknown", F.lit("0"))),
        ),
    ]
    first = lambda e, label: text(f"{label}: ", F.date_format(F.col("_first"), "yyyy-MM-dd HH:mm:ss"))
    by_type = lambda t, live: (c.encounters([t]) if live else c.table("encounter").filter(
        F.col("encounter_type").isin(c.metadata_ids("encounter_type", "encounter_type_id", "uuid", [t])) if c.metadata_ids("encounter_type", "encounter_type_id", "uuid", [t]) else F.lit(False)
    )).groupBy("patient_id").agg(F.min("encounter_datetime").alias("_first"))
    drugs = c.table("orders").filter(F.col("order_type_id") == drug_order_type).select("patient_id")
    e = enrich.anti(by_type(HIV_DISPENSING_TYPE, False), drugs, ["patient_id"])
    parts.append(row(e, "HIV dispensing without any prescriptions", first(e, "first HIV dispensing")))
    for t, kind, label in (
        (HIV_INTAKE_TYPE, "HIV initial encounter", "first HIV intake"),
        (HIV_FOLLOWUP_TYPE, "HIV followup encounter", "first HIV followup"),
        (INFANT_FOLLOWUP_TYPE, "HIV exposed infant followup", "first HIV exposed infant followup"),
        (HIV_DISPENSING_TYPE, "HIV dispensing encounter", "first HIV dispensing"),
    ):
        e = enrich.anti(by_type(t, True), enrolled, ["patient_id"])
        parts.append(row(e, f"{kind} without any HIV or exposed infant enrollment", first(e, label)))
    out = c.with_identifier(union_rows(parts))
    return out.select("emr_id", c.key("patient_id"), "warning_type", "warning_details")


MIGRATION_WARNING_COLUMNS = (
    "id", "patient_id", "encounter_id", "source_encounter_id", "emr_id", "hivemr_v1_id", "hiv_dossier_id", "warning_type",
    "warning_details", "encounter_date", "field_name", "field_value", "flag_for_review",
)


def migration_warnings(c: Clinic, table: str = "migration_data_warnings") -> DataFrame:
    """Warnings kept by an earlier migration, as they are; columns in the order of the contract."""
    return c.table(table).select(*MIGRATION_WARNING_COLUMNS)


def migration_warning_counts(c: Clinic, table: str = "migration_data_warnings") -> DataFrame:
    return c.table(table).groupBy("warning_type").agg(
        F.count(F.lit(1)).alias("count"), F.max("flag_for_review").alias("flag_for_review")
    ).withColumn("timestamp", F.lit(c.as_of).cast("timestamp_ntz"))


def patient_last_update_date(c: Clinic) -> DataFrame:
    return c.table("dbevent_patient").select(c.key("patient_id"), "last_updated", "deleted")


def summary_db_restore(c: Clinic, backup=None, restore=None) -> DataFrame:
    """When each kind of record was last entered; one row."""
    parts = [
        c.live(t).agg(F.max("date_created").alias("_ts")).withColumn("_t", F.lit(t)) for t in ("patient", "encounter", "obs")
    ]
    last = lambda t: F.max(F.when(F.col("_t") == t, F.col("_ts"))).alias(f"last_sourced_{t}_datapoint_created_on")
    return union_rows(parts).agg(last("patient"), last("encounter"), last("obs")).select(
        "*", F.lit(backup).cast("timestamp_ntz").alias("backup_datetime"), F.lit(restore).cast("timestamp_ntz").alias("restore_datetime")
    )


# ---- users ----------------------------------------------------------------


def _logins(c: Clinic) -> DataFrame:
    log = c.table("authentication_event_log").filter("event_type = 'LOGIN_SUCCEEDED'")
    return log.groupBy("user_id").agg(F.max("event_datetime").alias("_last"), F.count(F.lit(1)).alias("_n"))


def _accounts(c: Clinic) -> DataFrame:
    u = c.table("users").select(
        "user_id", "person_id", F.coalesce("username", "system_id").alias("username"),
        (~F.col("retired")).alias("account_enabled"), F.col("date_created").alias("created_date"), "creator",
    )
    u = enrich.decode(u, c.names(), "person_id", "person_id", {"first_name": "given_name", "last_name": "family_name"})
    u = c.with_user(u, "creator", "created_by", login=True)
    if c.site.exists("authentication_event_log"):
        u = enrich.decode(u, _logins(c), "user_id", "user_id", {"last_login_date": "_last", "_n": "_n"})
    else:
        u = u.withColumns({"last_login_date": F.lit(None).cast("timestamp_ntz"), "_n": F.lit(0)})
    return u.withColumn("num_logins_recorded", F.coalesce("_n", F.lit(0)).cast("int")).drop("_n")


def _roles(c: Clinic) -> DataFrame:
    p = c.table("provider").select("provider_id", "person_id", "provider_role_id")
    p = enrich.decode(p, c.table("provider_role"), "provider_role_id", "provider_role_id", {"provider_type": "name"})
    return latest.top1(p, ["person_id"], ["provider_id"])


def users(c: Clinic) -> DataFrame:
    u = enrich.decode(_accounts(c), _roles(c), "person_id", "person_id", {"provider_type": "provider_type"})
    prop = c.table("user_property").filter("property = 'authentication.secondaryType'")
    u = enrich.decode(u, prop, "user_id", "user_id", {"_mfa": "property_value"})
    u = enrich.decode(u, c.table("users"), "user_id", "user_id", {"email": "email"})
    mfa = F.coalesce(F.nullif(F.col("_mfa"), F.lit("")), F.lit("disabled"))
    mfa = F.when(mfa == "secret", "question").when(mfa == "totp", "authenticator").otherwise(mfa)
    return u.select(
        "username", "first_name", "last_name", "email", "account_enabled", "created_date", "created_by", "provider_type",
        "last_login_date", "num_logins_recorded", mfa.alias("mfa_status"),
    )


def user_roles(c: Clinic) -> DataFrame:
    """One row per role of a user; the role's prefix tells its type."""
    r = c.table("user_role").select("user_id", "role")
    app, level = "Application Role: ", "Privilege Level: "
    r = r.select(
        "user_id",
        F.when(F.col("role").startswith(app), "Application Role").otherwise("Privilege Level").alias("role_type"),
        F.when(F.col("role").startswith(app), F.substring_index("role", app, -1))
        .when(F.col("role").startswith(level), F.substring_index("role", level, -1))
        .otherwise(F.col("role"))
        .alias("role_value"),
    )
    p = c.table("provider").select("person_id", "provider_role_id")
    p = enrich.decode(p, c.table("provider_role"), "provider_role_id", "provider_role_id", {"role_value": "name"})
    p = p.join(c.table("users").select("user_id", "person_id"), "person_id").select(
        "user_id", F.lit("Provider Type").alias("role_type"), "role_value"
    )
    out = union_rows([r, p]).join(_accounts(c), "user_id", "left")
    return out.select(
        "username", "first_name", "last_name", "role_type", "role_value", "account_enabled", "created_date", "created_by",
        "last_login_date", "num_logins_recorded",
    )


def user_logins(c: Clinic, idle: int = 30) -> DataFrame:
    log = c.table("authentication_event_log")
    kind, at = F.col("event_type"), F.col("event_datetime")
    ends = log.groupBy("login_id").agg(
        F.max(F.when(kind == "LOGIN_EXPIRED", at)).alias("date_expired"),
        F.max(F.when(kind == "LOGOUT_SUCCEEDED", at)).alias("date_logged_out"),
    )
    s = log.filter("event_type = 'LOGIN_SUCCEEDED'").select(
        "login_id", "username", F.col("event_datetime").alias("date_logged_in"), "ip_address"
    )
    s = s.join(ends, "login_id", "left")
    out = minutes_between(F.col("date_logged_in"), F.col("date_logged_out"))
    exp = minutes_between(F.col("date_logged_in"), F.col("date_expired"))
    first = F.coalesce(out, exp - idle)
    null = F.lit(None).cast("int")
    return s.select(
        "login_id", "username", "date_logged_in", "date_logged_out", "date_expired",
        F.when(first < 0, exp).otherwise(first).cast("int").alias("active_duration_minutes"), "ip_address",
        null.alias("index_asc"), null.alias("index_desc"),
    )


