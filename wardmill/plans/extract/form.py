"""Extraction jobs that give one row per encounter of some form types.

A job is data: which encounters, which answers, which columns in which order.
``run`` turns it into one plan: filter encounters, add only the lookups whose
columns are asked for, and join one aggregate over the observations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.operators import enrich
from wardmill.operators.ordered import index_pair
from wardmill.plans.extract.clinic import Clinic, Q, row_ids


@dataclass(frozen=True)
class FormJob:
    name: str
    types: tuple[str, ...]
    """Encounter types; empty means all."""
    columns: tuple[str, ...]
    """Output columns in order: a lookup, an answer, or ``name=lookup`` to rename."""
    answers: dict[str, Q] = field(default_factory=dict)
    patient_answers: dict[str, Q] = field(default_factory=dict)
    """Answers looked for in all of the patient's encounters of the job."""
    by: str = "uuid"
    """Column of the encounter type table that ``types`` refers to."""
    no_test_patients: bool = False
    windowed: bool = False
    """Keep only encounters inside the run's start and end day."""
    index_order: tuple[str, ...] = ()
    """If given, ordinals per patient are computed here; otherwise the column stays null."""
    finish: Callable[[Clinic, DataFrame], DataFrame] | None = None
    finish_sql: dict[str, str] = field(default_factory=dict)
    """Columns that ``finish`` adds, as SQL over the other columns (for the SQL twin)."""
    drop: tuple[str, ...] = ()


def wanted(job: FormJob) -> set[str]:
    out = {c.split("=")[-1] for c in job.columns}
    return out | set(job.drop)


def base(c: Clinic, e: DataFrame, need: set[str]) -> DataFrame:
    """Encounters with the lookups named in ``need``."""
    if need & {"encounter_type"}:
        e = c.with_type_name(e, "_type_name")
    kinds = {"dossier_id": "dossier", "hiv_emr_id": "hiv"}
    ids = ({"emr_id": "emr"} if need & {"emr_id", "index_asc", "index_desc"} else {}) | {n: k for n, k in kinds.items() if n in need}
    if ids:
        e = c.with_identifiers(e, ids)
    if need & {"visit_location", "facility"}:
        e = c.with_facility(e)
    elif "encounter_location" in need:
        e = c.with_place(e)
    if "user_entered" in need:
        e = c.with_user(e)
    if "username" in need:
        e = c.with_user(e, "creator", "username", login=True)
    if "provider" in need:
        e = c.with_provider(e)
    if "loc_registered" in need:
        e = c.with_registration_place(e)
    if "unknown_patient" in need:
        e = c.with_unknown_flag(e)
    if need & {"gender", "birthdate", "age_at_encounter"}:
        e = c.with_person(e, {"gender": "gender", "birthdate": "birthdate"})
    if need & {"visit_date", "visit_start"}:
        v = c.live("visit").select(
            "visit_id", F.to_date("date_started").alias("visit_date"), F.col("date_started").alias("visit_start")
        )
        e = enrich.decode(e, v, "visit_id", "visit_id", {n: n for n in ("visit_date", "visit_start")}, row_ids(e))
    address = {
        "department": "state_province",
        "commune": "city_village",
        "section": "address3",
        "locality": "address1",
        "street_landmark": "address2",
    }
    if need & set(address):
        e = c.with_address(e, {k: v for k, v in address.items() if k in need})
    return e


def run(c: Clinic, job: FormJob) -> DataFrame:
    from wardmill.functions.dates import complete_years

    need = wanted(job)
    e = c.encounters(list(job.types) or None, job.by)
    if job.windowed:
        e = c.window(e, "encounter_datetime")
    # only the form's own observations reach the pivots
    mine = e.select("encounter_id") if job.types or job.windowed else None
    if job.no_test_patients:
        e = c.without_test_patients(e)
    e = e.select(
        "encounter_id", "patient_id", "visit_id", "encounter_type", "location_id", "form_id",
        "encounter_datetime", "date_created", "creator",
    )
    if job.index_order:
        # on the bare encounters, before any lookup widens the plan
        e = index_pair(e, ["patient_id"], list(job.index_order))
    e = base(c, e, need)
    if job.answers:
        e = c.with_answers(e, job.answers, within=mine)
    if job.patient_answers:
        e = c.with_answers(e, job.patient_answers, "patient_id", None, "person_id", mine, within_key="encounter_id")
    if not job.index_order:
        e = e.withColumns({i: F.lit(None).cast("int") for i in ("index_asc", "index_desc") if i in need})
    e = e.withColumns(
        {
            "raw_encounter_id": F.col("encounter_id"),
            "raw_patient_id": F.col("patient_id"),
            "raw_visit_id": F.col("visit_id"),
            "date_entered": F.col("date_created"),
            "encounter_date": F.to_date("encounter_datetime"),
            "encounter_type_id": F.col("encounter_type"),
        }
    )
    if "encounter_type" in need:
        e = e.withColumn("encounter_type", F.col("_type_name"))
    if "age_at_encounter" in need:
        e = e.withColumn("age_at_encounter", complete_years(F.col("birthdate"), F.col("encounter_datetime")))
    e = e.withColumns({k: c.key(k) for k in ("encounter_id", "patient_id", "visit_id")})
    if job.finish:
        e = job.finish(c, e)
    cols = [F.col(x.split("=")[-1]).alias(x.split("=")[0]) for x in job.columns]
    return e.select(*cols)
