"""The smaller derived tables: ordinals, de-duplication, freshness, oncology and dispensing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import years_crossed
from wardmill.operators import latest, merge, ordered
from wardmill.operators.enrich import decode


@dataclass(frozen=True)
class Ordinals:
    """One pair of ordinal columns; the order ends in a unique column."""

    table: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    names: tuple[str, str] = ("index_asc", "index_desc")


PROGRAM = ("index_program_asc", "index_program_desc")

ORDINALS = (
    Ordinals("all_visits", ("patient_id",), ("visit_date_started", "visit_id")),
    Ordinals("all_encounters", ("patient_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("mh_patients", ("patient_id",), ("program_enrollment_date", "patient_program_id")),
    Ordinals("mh_encounters", ("patient_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("all_vitals", ("emr_id",), ("encounter_datetime", "date_entered", "all_vitals_id")),
    Ordinals("covid_disposition", ("emr_id",), ("encounter_id",)),
    Ordinals("covid_visit", ("emr_id",), ("encounter_id",)),
    Ordinals("eid_visit", ("emr_id",), ("encounter_id",)),
    Ordinals(
        "hiv_regimens",
        ("emr_id", "drug_category"),
        ("order_id", "start_date"),
        ("index_ascending_category", "index_descending_category"),
    ),
    Ordinals(
        "hiv_regimens", ("emr_id",), ("order_id", "start_date"), ("index_ascending_patient", "index_descending_patient")
    ),
    Ordinals("hiv_patient_program", ("emr_id",), ("date_enrolled", "_open_last", "date_completed", "hiv_program_id")),
    Ordinals(
        "hiv_status",
        ("hiv_program_id",),
        ("start_date", "status_id"),
        ("index_program_ascending", "index_program_descending"),
    ),
    Ordinals(
        "hiv_status",
        ("emr_id",),
        ("start_date", "hiv_program_id", "status_id"),
        ("index_patient_ascending", "index_patient_descending"),
    ),
    Ordinals("hiv_tests", ("emr_id",), ("encounter_id", "specimen_collection_date", "date_created", "test_type")),
    Ordinals(
        "hiv_viral_load",
        ("emr_id",),
        ("vl_sample_taken_date", "_has_result", "vl_result_date", "hiv_vl_id"),
        ("order_asc", "order_desc"),
    ),
    Ordinals("hiv_visit", ("emr_id",), ("visit_date", "encounter_id")),
    Ordinals("hiv_visit", ("hiv_program_id",), ("visit_date", "encounter_id"), PROGRAM),
    Ordinals("mch_status", ("emr_id",), ("program_date_enrolled", "status_start_date", "patient_state_id")),
    Ordinals("mch_visit", ("emr_id",), ("visit_date", "encounter_id")),
    Ordinals(
        "mch_visit",
        ("emr_id", "consultation_type"),
        ("visit_date", "encounter_id"),
        ("index_asc_consult", "index_desc_consult"),
    ),
    Ordinals("pmtct_pregnancy", ("emr_id",), ("pmtct_enrollment_date", "encounter_id")),
    Ordinals("pmtct_visits", ("emr_id",), ("visit_date", "visit_id", "encounter_id")),
    Ordinals("pmtct_visits", ("hiv_program_id",), ("visit_date", "visit_id", "encounter_id"), PROGRAM),
    Ordinals("ed_triage", ("emr_id",), ("triage_datetime", "encounter_id")),
    Ordinals("outpatient_encounters", ("emr_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("chemo_session_encounter", ("emr_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("adt_encounters", ("emr_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("consult_encounters", ("emr_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("hiv_psychosocial_encounter", ("emr_id",), ("encounter_datetime", "encounter_id")),
    Ordinals("hiv_pmtct_visit", ("hiv_program_id",), ("visit_date", "encounter_id"), PROGRAM),
)
"""Which tables get ordinals, over which keys and in which order.

Where the reference orders by dates alone a unique id is added, so that ties
get a stable place.
"""


def update_index_numbers(table: str, df: DataFrame, sizes: ordered.KeyStats | None = None) -> DataFrame:
    """``df`` with all ordinal columns its table is declared to have.

    ``sizes``: statistics of a job, of the keys and the leading order column. Without, each key is counted once and
    serves all ordinals over it that lead with the same column.
    """
    specs = [s for s in ORDINALS if s.table == table]
    if not specs:
        raise KeyError(table)
    if any("_open_last" in s.order for s in specs):
        df = df.withColumn("_open_last", F.col("date_completed").isNull().cast("int"))
    if any("_has_result" in s.order for s in specs):
        df = df.withColumn("_has_result", F.col("vl_coded_results").isNotNull().cast("int"))
    out = df.drop(*[n for s in specs for n in s.names])
    known: dict[tuple, ordered.KeyStats] = {}
    for s in specs:
        counted = sizes
        if counted is None:
            lead = (s.keys, s.order[0])
            if lead not in known:
                known[lead] = ordered.KeyStats.of([(df, list(s.keys), ordered.lead_columns(list(s.order)))])
            counted = known[lead]
        out = ordered.index_pair(out, list(s.keys), list(s.order), s.names, sizes=counted)
    return out.drop("_open_last", "_has_result")


NCD_FLAGS = [
    "htn", "diabetes", "respiratory", "epilepsy", "heart_failure", "cerebrovascular_accident", "renal_failure",
    "liver_failure", "rehabilitation", "sickle_cell", "other_ncd",
]
NCD_COLUMNS = [
    "birthdate", "sex", "department", "commune", "ncd_enrollment_date", "ncd_first_encounter_date",
    "ncd_latest_encounter_date", "ncd_enrollment_location", "ncd_current_location", "dm_type",
    "heart_failure_category", "cardiomyopathy", "nyha_class", "heart_failure_improbable", "ncd_status",
    "ncd_status_date", "deceased", "date_of_death", "site", "partition_num",
]
HF_FLAGS = ["ncd_enrolled", "hf_ncd", "hf_broad", "hf_left", "hf_isolated_right", "hf_congestive", "hf_rheumatic"]
HF_COLUMNS = ["sex", "birthdate", "hf_diagnosis_date", "last_visit_date", "deceased", "partition_num"]


def ncd_patient_table(staging: DataFrame) -> DataFrame:
    """One row per patient over all sites: flags ORed, the rest from the latest encounter's site."""
    return merge.dedup_merge(
        staging, ["emr_id"], NCD_FLAGS, "ncd_latest_encounter_date", NCD_COLUMNS, ["partition_num"]
    )


def ncd_heart_failure_patient(staging: DataFrame, ncd_patients: DataFrame) -> DataFrame:
    """Flags ORed over sites; attributes from the site chosen for the patient's NCD row."""
    return merge.dedup_by_ref(
        staging, ["emr_id"], HF_FLAGS, ncd_patients, ["site"], HF_COLUMNS, ["-last_visit_date", "partition_num"]
    )


def mch_patient_latest(patients: DataFrame) -> DataFrame:
    return latest.keep_latest_ties(patients, ["emr_id"], "latest_encounter_date")


# Domain, its location column and its entry date column.
ENTRY_SOURCES = {
    "mch": ("mch_visit", "encounter_location", "date_entered"),
    "hiv": ("hiv_visit", "visit_location", "date_entered"),
    "pmtct": ("pmtct_visits", "health_facility", "date_entered"),
    "covid": ("covid_visit", "location", "date_entered"),
    "pathology": ("pathology_encounters", "encounter_location", "order_datetime"),
    "vitals": ("all_vitals", "encounter_location", "date_entered"),
    "lab_results": ("all_lab_results", "encounter_location", "results_entry_date"),
}


def visit_entry_dates(tables: dict[str, DataFrame], by_location_site: str = "hiv") -> DataFrame:
    """Latest entry date per site (per location for one site) in seven domains.

    A null location gets a row but no dates, since it matches nothing.
    """
    parts = {}
    for domain, (table, place, ts) in ENTRY_SOURCES.items():
        df = tables[table]
        loc = F.when(F.col("site") == by_location_site, F.col(place).cast("string")).otherwise(F.col("site"))
        df = df.select("site", loc.alias("visit_location"), F.col(ts).cast("timestamp_ntz").alias("_ts"))
        df = df.withColumn("_ts", F.when(F.col("visit_location").isNotNull(), F.col("_ts")))
        parts[f"{domain}_max_date_entered"] = (df, ["site", "visit_location"], "_ts")
    return latest.freshness(parts, ["site", "visit_location"])


def chemo_session_summary(encounters: DataFrame, regimens: DataFrame, patients: DataFrame) -> DataFrame:
    e = encounters.drop("index_asc", "index_desc")
    r = regimens.select("encounter_id", "obs_id", "chemo_regimen_name")
    p = patients.select("emr_id", "dob", "gender")
    out = e.join(r, "encounter_id").join(p, "emr_id")
    out = out.select(
        "emr_id",
        "obs_id",
        "encounter_id",
        "visit_id",
        "dob",
        years_crossed(F.col("dob"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "gender",
        "encounter_datetime",
        "provider_name",
        "user_entered",
        "date_created",
        "encounter_location",
        "cycle_number",
        "planned_chemo_sessions",
        "treatment_plan",
        "visit_information_comments",
        "chemo_regimen_name",
    )
    return ordered.index_pair(out, ["emr_id"], ["encounter_datetime", "obs_id"])


def oncology_treatment_plan_summary(
    plans: DataFrame, diagnoses: DataFrame, patients: DataFrame, primary: str = "Primaire"
) -> DataFrame:
    """Plans with up to three distinct cancer diagnoses, primary ones first."""
    d = diagnoses.filter(F.col("oncology")).select(
        F.col("encounter_id").alias("_enc"),
        "obs_id",
        "diagnosis_coded_fr",
        F.coalesce((F.col("dx_order") == primary).cast("int"), F.lit(0)).alias("is_primary"),
    )
    three = latest.top_k_columns(
        d, ["_enc"], "diagnosis_coded_fr", ["-is_primary", "obs_id"], 3, "diagnosis", ["is_primary"], True
    )
    out = decode(plans, patients, "emr_id", "emr_id", {"dob": "dob", "gender": "gender"})
    out = out.join(three, F.col("encounter_id") == F.col("_enc"), "left")
    pairs = []
    for i in (1, 2, 3):
        pairs += [f"diagnosis_{i}", F.col(f"is_primary_{i}").alias(f"diagnosis_{i}_primary")]
    out = out.select(
        "emr_id",
        "encounter_id",
        "visit_id",
        "dob",
        years_crossed(F.col("dob"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "gender",
        "encounter_datetime",
        "encounter_provider",
        "user_entered",
        "date_entered",
        "cancer_stage",
        "treatment_intent",
        *pairs,
    )
    return ordered.index_pair(out, ["emr_id"], ["encounter_datetime", "encounter_id"])


OUTPATIENT_CHEMO = ("Tamoxifen, 10mg, tablet", "Tamoxifen, 20mg tablet")


def outpatient_chemo_summary(
    dispensing: DataFrame, patients: DataFrame, drugs: tuple[str, ...] = OUTPATIENT_CHEMO
) -> DataFrame:
    """Chemotherapy drugs given to outpatients; the row id is stable over reruns."""
    d = dispensing.filter(F.col("drug_name").isin(list(drugs)))
    out = d.join(patients.select("emr_id", "dob", "gender"), "emr_id").select(
        F.col("dispensing_id").alias("outpatient_chemo_id"),
        "emr_id",
        "encounter_id",
        "dob",
        years_crossed(F.col("dob"), F.col("encounter_datetime")).alias("age_at_encounter"),
        "gender",
        "encounter_datetime",
        "encounter_provider",
        "encounter_location",
        "facility",
        "drug_name",
    )
    return ordered.index_pair(out, ["emr_id"], ["encounter_datetime", "outpatient_chemo_id"])


def dispensed_medication_summary(dispensing: DataFrame) -> DataFrame:
    return dispensing.groupBy(
        "site", "facility", F.to_date("encounter_datetime").alias("date"), "drug_name", "drug_product_code"
    ).agg(F.sum("quantity_dispensed").alias("daily_quantity"))
