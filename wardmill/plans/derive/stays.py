"""Admissions, the inpatient census and the emergency summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators import asof, intervals, latest, ordered, spine
from wardmill.operators.enrich import decode
from wardmill.operators.rules import waterfall
from wardmill.sources.reference import literal_table

EXIT_TYPE = "Exit from Inpatient Care"
CATEGORIES = ["pediatric", "internal_medicine", "surgery", "maternity", "mental_health", "other"]
INDICATORS = [
    "patient_days",
    "hospitalizations",
    "discharges",
    "deaths_less_than_48_hours",
    "deaths_greater_than_48_hours",
    "days_hospitalized",
]
DISCHARGED = ["Transfer out of hospital", "Discharged"]
DEATH = "Death"

# Final disposition and the outcome reported for it.
OUTCOMES = [
    ("Death", "Deceased"),
    ("Transfer out of hospital", "Referred"),
    ("Left without completion of treatment", "Left Without Authorization"),
    ("Left without seeing a clinician", "Left Without Authorization"),
    ("Discharged", "Discharged"),
    ("Admit to hospital", "Unknown"),
    ("Transfer within hospital", "Unknown"),
    ("Emergency Department observation", "Unknown"),
    ("Still hospitalized", "Unknown"),
]


def all_admissions(adt: DataFrame, visits: DataFrame, encounters: DataFrame, exit_type: str = EXIT_TYPE) -> DataFrame:
    """One row per admission or transfer with its end and the dispositions around it.

    Order matters: a stay ends at the patient's next event, exits included, and
    exits go only afterwards; the end is cut to the visit's stop; dispositions
    are looked up; only then is an open end filled from a closed visit.
    """
    events = adt.select(
        "emr_id",
        "encounter_id",
        "visit_id",
        "encounter_type",
        F.col("encounter_datetime").alias("start_datetime"),
        "user_entered",
        F.to_date("datetime_created").alias("date_entered"),
        "encounter_location",
        "visit_location",
        "facility",
        "provider",
        "site",
        "partition_num",
    )
    known = encounters.filter(F.col("disposition").isNotNull())
    kind = [events.schema["emr_id"].dataType]
    sizes = ordered.KeyStats.of([asof.time_line(adt, ["emr_id"], "encounter_datetime", kind), asof.time_line(known, ["emr_id"], "encounter_datetime", kind)])
    stays = ordered.episodes(events, ["emr_id"], "start_datetime", ["start_datetime", "encounter_id"], "end_datetime", sizes)
    stays = stays.filter(F.col("encounter_type") != exit_type)
    stays = decode(stays, visits, "visit_id", "visit_id", {"_stop": "visit_date_stopped"})
    cut = F.when(F.col("_stop") < F.col("end_datetime"), F.col("_stop")).otherwise(F.col("end_datetime"))
    stays = stays.withColumn("end_datetime", cut)
    for prefix, at in (("previous", "start_datetime"), ("ending", "end_datetime")):
        stays = asof.asof_latest(
            stays,
            known,
            ["emr_id"],
            at,
            "encounter_datetime",
            {
                f"{prefix}_disposition_encounter_id": "encounter_id",
                f"{prefix}_disposition_datetime": "encounter_datetime",
                f"{prefix}_disposition": "disposition",
            },
            ["encounter_id"],
            left_sizes=sizes,
        )
    return stays.withColumn("end_datetime", F.coalesce("end_datetime", "_stop")).drop("_stop")


def inpatient_census(admissions: DataFrame, ward_map: DataFrame, as_of) -> DataFrame:
    """Site x month x category x indicator totals for the last twelve months and the current one.

    ``ward_map`` has site, location and clinical_category.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    day = F.to_date(now)
    first, last = F.trunc(F.add_months(day, -12), "MM"), F.trunc(day, "MM")
    wards = ward_map.select(
        F.col("site").alias("_site"), F.col("location").alias("_location"), "clinical_category"
    )
    stays = admissions.select(
        "site", "encounter_location", "start_datetime", "end_datetime", "ending_disposition"
    ).join(wards, (F.col("site") == F.col("_site")) & (F.col("encounter_location") == F.col("_location")))
    touched = intervals.months_touched(stays, "start_datetime", "end_datetime", first, last, "_month")
    month_end = F.last_day("_month")
    _, _, days = intervals.clip_days(
        F.col("start_datetime"), F.col("end_datetime"), F.col("_month"), month_end, now
    )
    ends_here = F.trunc("end_datetime", "MM") == F.col("_month")
    died = ends_here & (F.col("ending_disposition") == DEATH)
    slots = touched.select("site", "clinical_category", "_month", days.alias("_days"), ends_here.alias("_ends"), died.alias("_died"), "ending_disposition")
    keys = ["site", "clinical_category", "_month"]
    totals = slots.groupBy(*keys).agg(
        F.sum("_days").alias("patient_days"),
        F.count(F.lit(1)).alias("hospitalizations"),
        F.count(F.when(F.col("_ends") & F.col("ending_disposition").isin(DISCHARGED), 1)).alias("discharges"),
        F.count(F.when(F.col("_died") & (F.col("_days") <= 2), 1)).alias("deaths_less_than_48_hours"),
        F.count(F.when(F.col("_died") & (F.col("_days") > 2), 1)).alias("deaths_greater_than_48_hours"),
        F.sum(F.when(F.col("_days") == 0, 1).otherwise(F.col("_days"))).alias("days_hospitalized"),
    )
    frame = spine.skeleton(
        ward_map.select("site").distinct(),
        _month=F.sequence(first, last, F.expr("INTERVAL 1 MONTH")),
        clinical_category=CATEGORIES,
        indicator=INDICATORS,
    )
    out = spine.kpi_long(totals, keys, INDICATORS, frame, "indicator", "total")
    return out.select(
        "site",
        F.year("_month").alias("reporting_year"),
        F.month("_month").alias("reporting_month"),
        "indicator",
        "clinical_category",
        F.col("total").cast("int").alias("total"),
    )


def _notes(triage: DataFrame, consults: DataFrame, diagnoses: DataFrame, prefix: str, trauma_known: bool) -> DataFrame:
    """Latest note at or after triage in the same visit, with up to three coded diagnoses."""
    known = F.col("trauma").isNotNull()
    got = asof.latest_at_or_after(
        triage.select("encounter_id", "visit_id", "triage_datetime"),
        consults.select(
            "visit_id", F.col("encounter_id").alias("_note"), "encounter_datetime", "disposition", "trauma"
        ),
        ["visit_id"],
        "triage_datetime",
        "encounter_datetime",
        {f"{prefix}_note": "_note", f"{prefix}_datetime": "encounter_datetime", f"{prefix}_disposition": "disposition"},
        ["_note"],
        known if trauma_known else ~known,
    )
    coded = diagnoses.filter(F.col("coded"))
    three = latest.top_k_columns(
        coded, ["encounter_id"], "diagnosis_coded_fr", ["-obs_id"], 3, f"{prefix}_diagnosis", first_null_stops=True
    ).withColumnRenamed("encounter_id", "_enc")
    free = latest.top1(diagnoses.filter(~F.col("coded")), ["encounter_id"], ["-obs_id"]).select(
        F.col("encounter_id").alias("_enc2"), F.col("diagnosis_entered").alias(f"{prefix}_diagnosis_noncoded")
    )
    return (
        got.join(three, F.col(f"{prefix}_note") == F.col("_enc"), "left")
        .join(free, F.col(f"{prefix}_note") == F.col("_enc2"), "left")
        .drop("visit_id", "triage_datetime", "_enc", "_enc2")
    )


def ed_summary(triage: DataFrame, consults: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Each triage with its emergency note, consult, diagnoses and the outcome of the visit.

    The later of the two notes decides the disposition; on a tie the emergency note does.
    """
    ed = _notes(triage, consults, diagnoses, "ed", True)
    con = _notes(triage, consults, diagnoses, "consult", False)
    out = triage.join(ed, "encounter_id", "left").join(con, "encounter_id", "left")
    never = F.lit("1900-01-01").cast("timestamp_ntz")
    later = F.coalesce(F.col("consult_datetime"), never) > F.coalesce(F.col("ed_datetime"), never)
    final = F.when(later, F.col("consult_disposition")).otherwise(F.col("ed_disposition"))
    outcome = waterfall([(final == d, F.lit(o)) for d, o in OUTCOMES])
    return out.select(
        "emr_id",
        "encounter_id",
        "triage_datetime",
        "date_entered",
        "user_entered",
        "visit_id",
        "dossier_id",
        "loc_registered",
        "unknown_patient",
        "ed_visit_start_datetime",
        "encounter_location",
        "provider",
        "triage_queue_status",
        "triage_color",
        "triage_score",
        "index_asc",
        "index_desc",
        F.col("ed_note").alias("ed_note_enc_id"),
        F.col("ed_datetime").alias("ednote_datetime"),
        F.col("ed_disposition").alias("ednote_disposition"),
        F.col("ed_diagnosis_1").alias("ed_diagnosis1"),
        F.col("ed_diagnosis_2").alias("ed_diagnosis2"),
        F.col("ed_diagnosis_3").alias("ed_diagnosis3"),
        "ed_diagnosis_noncoded",
        F.col("consult_note").alias("consult_enc_id"),
        "consult_datetime",
        "consult_disposition",
        F.col("consult_diagnosis_1").alias("consult_diagnosis1"),
        F.col("consult_diagnosis_2").alias("consult_diagnosis2"),
        F.col("consult_diagnosis_3").alias("consult_diagnosis3"),
        "consult_diagnosis_noncoded",
        outcome.alias("visit_outcome"),
    )


def ward_table(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return literal_table(spark, "site string, location string, clinical_category string", rows)
