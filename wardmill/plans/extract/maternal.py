"""HIV and PMTCT visits, pregnancies, obstetric diagnoses, vaccinations, COVID tests and maternal programme extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import complete_years, minutes_between
from wardmill.operators import asof, enrich, latest, ordered
from wardmill.operators.eav import text_list
from wardmill.operators.intervals import join_containing
from wardmill.operators.merge import union_rows
from wardmill.operators.rules import code_flags
from wardmill.plans.extract.clinic import Clinic, Q, coded, date, listed, mark, num, text, yn
from wardmill.plans.extract.form import FormJob, run
from wardmill.plans.extract.programs import (
    DELIVERY, HIV, MATERNAL, OBGYN, PMTCT_FOLLOWUP, PMTCT_INITIAL, PRESENT, SYMPTOMS, _group_answers, _grouped,
)
from wardmill.plans.extract.records import HIV_FOLLOWUP_TYPE, HIV_INTAKE_TYPE, NON_CODED, icd10
from wardmill.sources.staging import staged

# A concept, a workflow and an attribute type.
RISK = "11046"
MATERNAL_WORKFLOW = "41a277d0-8a14-11e8-9a94-a6cf71072f73"
TELEPHONE = "14d4f066-15f5-102d-96e4-000c29c2a5d7"
# Answer concepts of pregnancy risk factors.
RISKS = {
    "sexually_active_with_men": "10870",
    "sexually_active_with_women": "10872",
    "intravenous_drug_use": "105",
    "blood_transfusion": "1063",
    "maternal_to_fetal_transmission": "11042",
    "accidental_exposure_to_blood": "11044",
    "sex_with_infected": "11060",
    "sex_with_drug_user": "11534",
    "heterosexual_sex_bisexual": "13001",
    "heterosexual_sex_blood_transfusion": "13000",
    "other_mode_of_transmission": "5622",
    "other_risk_factor": "11406",
}
# Answer concepts of obstetric history.
HISTORY = {
    "history_of_syphilis": "11050",
    "history_of_other_sti": "11047",
    "victim_of_gbv": "11049",
    "multiple_partners": "5567",
    "without_condom": "11048",
    "anal_sex": "11051",
    "with_sex_worker": "11045",
}
VISIT_ANSWERS = {
    "chw": text("11631"),
    "who_stage": coded("5356"),
    "pregnant": yn("PREGNANCY STATUS"),
    "next_visit_date": date("RETURN VISIT DATE"),
    "referred_by_womens_health_in": yn("13679"),
    "referral_transfer_pepfar_partner_in": yn("13168"),
    "_in": Q("obs", "13169"),
    "_out": Q("obs", "13170"),
    "reason_not_on_arv": coded("11337", ("3580", "7262", "2222", "14842", "14666")),
    "breastfeeding_status": coded("13642"),
    "last_breastfeeding_date": date("6889"),
    **{n: mark(RISK, k) for n, k in RISKS.items()},
    **{n: yn(k) for n, k in HISTORY.items()},
}
VISIT_COLUMNS = (
    "encounter_id", "visit_id", "hiv_program_id", "emr_id", "hivemr_v1=hiv_emr_id", "encounter_type", "date_entered",
    "user_entered=username", "chw", "who_stage", "pregnant", "referral_transfer_in", "internal_external_in",
    "referral_transfer_location_in", "referred_by_womens_health_in", "referral_transfer_pepfar_partner_in", "referral_transfer_out",
    "internal_external_out", "referral_transfer_location_out", "referral_transfer_pepfar_partner_out", "reason_not_on_arv",
    "breastfeeding_status", "last_breastfeeding_date", "inh_line", "inh_start_date", "inh_end_date",
)
VISIT_TAIL = ("visit_date=encounter_date", "next_visit_date", "visit_location", "facility", *RISKS, *HISTORY)
INTERNAL = "8855"
PROPHYLAXIS = {"inh": "ISONIAZID", "rif_and_inh": "20468"}


def _prophylaxis(c: Clinic, drug: str) -> DataFrame:
    """Latest prophylaxis group of a drug per encounter, with its course and dates."""
    heads = c.obs("PREVIOUS TREATMENT PROPHYLAXIS CONSTRUCT", "CURRENT PROPHYLAXIS TREATMENT CONSTRUCT")
    heads = heads.select(F.col("obs_id").alias("_g"))
    g = c.live("obs").filter(c.is_code("value_coded", drug)).join(heads, F.col("obs_group_id") == F.col("_g"))
    g = latest.top1(g, ["encounter_id"], ["-date_created", "-obs_id"]).select("encounter_id", "_g")
    g = _group_answers(
        c, g,
        {"line": coded("13786"), "_s1": date("HISTORICAL DRUG START DATE"), "_s2": date("11131"),
         "_e1": date("HISTORICAL DRUG STOP DATE"), "_e2": date("12748")},
        "_g",
    )
    return g.select(
        "encounter_id", "line", F.to_date(F.coalesce("_s2", "_s1")).alias("start"), F.to_date(F.coalesce("_e2", "_e1")).alias("end")
    )


def _visit_finish(c: Clinic, e: DataFrame) -> DataFrame:
    for side, kind in (("in", "6401"), ("out", "8854")):
        spec = {
            f"referral_transfer_{side}": coded("13712"),
            f"internal_external_{side}": coded(kind),
            "_kind": Q("code", kind),
            "_place": Q("place", "8621"),
            "_named": text("11483"),
        }
        if side == "out":
            spec["referral_transfer_pepfar_partner_out"] = yn("13168")
        e = _group_answers(c, e, spec, f"_{side}", sparse=True)
        inside = c.is_code("_kind", INTERNAL)
        where = F.when(inside, F.col("_place")).when(F.col("_kind").isNotNull(), F.col("_named"))
        e = e.withColumn(f"referral_transfer_location_{side}", where).drop("_kind", "_place", "_named")
    for name, drug in PROPHYLAXIS.items():
        e = enrich.decode(
            e, _prophylaxis(c, drug), "raw_encounter_id", "encounter_id",
            {f"{name}_line": "line", f"{name}_start_date": "start", f"{name}_end_date": "end"},
        )
    bare = c.encounters([HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PMTCT_INITIAL, PMTCT_FOLLOWUP])
    bare = bare.select(F.col("encounter_id").alias("raw_encounter_id"), "patient_id", "encounter_datetime")
    e = c.enrolment_at(e, HIV, ["raw_encounter_id"], "_program", events=bare)
    flags = {n: F.col(n).cast("boolean") for n in RISKS}
    return e.withColumns({"hiv_program_id": c.key("_program"), "next_visit_date": F.to_date("next_visit_date"), **flags})


INDEXES = ("index_asc", "index_desc", "index_program_asc=index_asc", "index_program_desc=index_desc")


def hiv_visit(c: Clinic) -> DataFrame:
    job = FormJob(
        "hiv_visit",
        (HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE),
        (*VISIT_COLUMNS, "rif_and_inh_start_date", "rif_and_inh_end_date", *VISIT_TAIL, *INDEXES),
        VISIT_ANSWERS,
        no_test_patients=True,
        finish=_visit_finish,
    )
    return run(c, job)


def hiv_pmtct_visit(c: Clinic) -> DataFrame:
    """HIV and PMTCT visits in one table, with the pregnancy columns of the latter."""

    def finish(c: Clinic, e: DataFrame) -> DataFrame:
        s = c.live("obs").filter(c.is_code("value_coded", *SYMPTOMS.values())).groupBy("encounter_id").agg(
            F.max("obs_datetime").alias("_on"), F.max(F.when(c.is_code("concept_id", PRESENT), 1)).alias("_present")
        )
        contact = c.obs("13265", "FIRST NAME", "LAST NAME", "TELEPHONE NUMBER OF CONTACT").select("encounter_id", F.lit(True).alias("_c")).distinct()
        e = enrich.decode(e, s, "raw_encounter_id", "encounter_id", {"_on": "_on", "_present": "_present"})
        e = enrich.decode(e, contact, "raw_encounter_id", "encounter_id", {"has_provided_contact": "_c"})
        e = e.withColumn("tb_screening_date", F.to_date(F.when(F.col("_present") == 1, F.col("_on"))))
        return _visit_finish(c, e).withColumns({n: F.to_date(f"_{n}") for n in ("hiv_test_date", "expected_delivery_date")})

    job = FormJob(
        "hiv_pmtct_visit",
        (HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PMTCT_INITIAL, PMTCT_FOLLOWUP),
        (
            *VISIT_COLUMNS, *VISIT_TAIL, "hiv_test_date", "expected_delivery_date", "tb_screening_date", "has_provided_contact", "delivery",
            "delivery_datetime", *INDEXES,
        ),
        VISIT_ANSWERS
        | {"_hiv_test_date": date("HIV TEST DATE"), "_expected_delivery_date": date("5596"), "delivery": yn("14990"), "delivery_datetime": date("5599")},
        no_test_patients=True,
        finish=finish,
    )
    return run(c, job)


PREGNANCY_GROUP = "CIEL:163588"


def mch_pregnancy(c: Clinic, slots: int = 10) -> DataFrame:
    """Latest antenatal encounter per patient with up to ten earlier pregnancies as columns."""
    last = c.encounters([OBGYN]).groupBy("patient_id").agg(F.max("encounter_id").alias("encounter_id"))
    o = c.obs("Type of HUM visit").filter(c.is_code("value_coded", "ANC VISIT"))
    o = o.select("encounter_id", F.col("obs_id").alias("pregnancy_id")).join(last.select("encounter_id"), "encounter_id", "left_semi")
    e = c.table("encounter").select("encounter_id", "patient_id", "visit_id", "location_id", "encounter_datetime", "date_created", "creator")
    o = o.join(e, "encounter_id")
    bare = o
    o = c.with_identifier(c.with_facility(c.with_user(o, "creator", "user_entered", login=True)))
    o = c.enrolment_at(o, MATERNAL, ["pregnancy_id"], "mch_program_id", events=bare)
    o = c.with_answers(
        o,
        {
            "gravidity": num("GRAVIDITY"),
            "parity": num("PARITY"),
            "num_abortions": num("NUMBER OF ABORTIONS"),
            "num_living_children": num("CIEL:1825"),
            "_lmp": date("DATE OF LAST MENSTRUAL PERIOD"),
            "_edd": date("ESTIMATED DATE OF CONFINEMENT"),
            "pmtct_club": listed("13262"),
            "delivery_location_plan": listed("CIEL:159758"),
        },
        within=bare,
    )
    g = latest.top_n(c.obs(PREGNANCY_GROUP), ["encounter_id"], ["-date_created", "-obs_id"], slots).select("encounter_id", "obs_id", "position")
    g = _group_answers(c, g, {"birth_order": num("CIEL:163460"), "delivery_type": listed("11663"), "outcome": listed("CIEL:161033")}, "obs_id")
    kinds = ("birth_order", "delivery_type", "outcome")
    g = g.groupBy("encounter_id").agg(
        *[F.max(F.when(F.col("position") == i, F.col(k))).alias(f"pregnancy_{i}_{k}") for i in range(1, slots + 1) for k in kinds]
    )
    o = o.join(g, "encounter_id", "left")
    day = F.to_date("encounter_datetime")
    return o.select(
        "pregnancy_id", c.key("encounter_id"), c.key("mch_program_id"), "emr_id", day.alias("encounter_date"), F.col("date_created").alias("date_entered"),
        "user_entered", "facility", c.key("visit_id", True), "visit_location", "gravidity", "parity", "num_abortions", "num_living_children",
        F.to_date("_lmp").alias("last_period_date"), F.to_date("_edd").alias("expected_delivery_date"),
        F.round(F.datediff(day, F.to_date("_lmp")) / 7, 0).alias("calculated_gestational_age"),
        *[f"pregnancy_{i}_{k}" for i in range(1, slots + 1) for k in kinds], "pmtct_club", "delivery_location_plan",
    )


# Diagnosis codes behind each flag.
MCH_FLAGS = {
    "abortion": ["8001", "7697", "9334"],
    "abortion_with_complication": ["9334"],
    "abortion_with_sepsis": ["8018"],
    "anemia": ["9325", "3703", "1226", "9052", "9087", "9088", "9089", "3", "9431"],
    "cervical_cancer": ["CIEL:116023"],
    "cervical_laceration": ["CIEL:145804"],
    "complete_abortion": ["CIEL:120295"],
    "diabetes": [
        "7961", "6693", "6691", "6692", "8538", "11943", "11944", "12227", "12228", "12251", "8574", "11441", "9562", "12632", "3720", "225",
    ],
    "dystocia": ["8017", "8031"],
    "eclampsia": ["7696"],
    "hemorrhage": ["228", "7235", "7102"],
    "hypertension": ["6847", "903", "12629", "12634", "7166", "9058"],
    "incomplete_abortion": ["9333", "9727", "905", "9335", "8319"],
    "induced_abortion": ["9727"],
    "intrapartum_hemorrhage": ["13562"],
    "postpartum_hemorrhage": ["49"],
    "laceration_of_perineum": ["7230", "12372"],
    "malaria": ["7568", "CIEL:11487", "7134", "7646", "123"],
    "postnatal_complication": ["7252"],
    "preeclampsia": ["8354", "9344", "47"],
    "puerperal_infection": ["130", "7252"],
    "spontaneous_abortion": ["9333", "7238"],
    "sti": ["174", "14363", "2155", "893", "7247", "7120", "11194", "3728"],
    "threatened_abortion": ["7993"],
}


def mch_diagnoses(c: Clinic) -> DataFrame:
    """Visit diagnoses of delivery and obstetric encounters with category flags."""
    heads = c.obs("Visit Diagnoses").select(F.col("obs_id").alias("_g"))
    e = c.encounters([DELIVERY, OBGYN]).select("encounter_id", "patient_id", "visit_id", "location_id", "encounter_type", "creator")
    o = c.table("obs").filter(c.is_code("concept_id", "DIAGNOSIS", NON_CODED)).join(heads, F.col("obs_group_id") == F.col("_g"))
    o = o.select("encounter_id", "obs_id", "_g", "obs_datetime", "date_created", "value_coded", "value_text").join(e, "encounter_id")
    o = _group_answers(c, o, {"dx_order": coded("7537"), "certainty": coded("1379")}, "_g")
    o = c.with_concept_name(c.with_concept_name(o, "value_coded", "_en", "en"), "value_coded", "diagnosis_coded_fr", "fr")
    o = enrich.decode(o, icd10(c), "value_coded", "concept_id", {"icd10_code": "code"})
    o = c.with_provider(c.with_user(c.with_facility(c.with_type_name(o)), "creator", "entered_by"))
    flags = {n: [i for i in c.codes(cs).values() if i is not None] for n, cs in MCH_FLAGS.items()}
    o = code_flags(c.with_identifier(o), "value_coded", flags)
    coded_ = F.col("value_coded").isNotNull()
    late = minutes_between(F.col("obs_datetime"), F.col("date_created")) > 30
    return o.select(
        "emr_id", "encounter_id", "encounter_location", "facility", "obs_id", "obs_datetime", "visit_id", "visit_location",
        F.col("encounter_type_name").alias("encounter_type"), "entered_by", "provider", F.col("value_coded").alias("diagnosis_concept"),
        F.when(coded_, F.col("_en")).otherwise(F.col("value_text")).alias("diagnosis_entered"), "diagnosis_coded_fr", "icd10_code", "dx_order",
        "certainty", coded_.cast("int").alias("coded"), late.cast("int").alias("retrospective"), "date_created", *MCH_FLAGS,
    )


PRIMARY_CARE_NAMES = (
    "Primary Care Adult Initial Consult", "Primary Care Adult Followup Consult", "Primary Care Pediatric Initial Consult",
    "Primary Care Pediatric Followup Consult", "ANC Intake", "ANC Followup",
)
# Vaccines by dictionary id, with the doses that get a column.
VACCINES = {
    "bcg": (("UUID:3cd4e004-26fe-102b-80cb-0017a47871b2",), (1,)),
    "polio": (("UUID:3cd42c36-26fe-102b-80cb-0017a47871b2",), (0, 1, 2, 3, 11, 12)),
    "pentavalent": (("UUID:1423AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA",), (1, 2, 3)),
    "rotavirus": (("UUID:83531AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA",), (1, 2)),
    "mmr": (("UUID:162586AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA",), (1,)),
    "tetanus": (("UUID:3ccc6b7c-26fe-102b-80cb-0017a47871b2",), (0, 1, 2, 3, 11, 12)),
}
VACCINATIONS = "UUID:2dc6c690-a5fe-4cc4-97cc-32c70200a2eb"
SEQUENCE = "UUID:ef6b45b4-525e-4d74-bf81-a65a41f3feb9"
VACCINE_DATE = "UUID:1410AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"


def dose_column(vaccine: str, dose: int) -> str:
    return f"{vaccine}_booster_{dose - 10}" if dose > 10 else f"{vaccine}_{dose}"


def vaccinations_anc(c: Clinic, program: str = "MCH", types: tuple[str, ...] = PRIMARY_CARE_NAMES) -> DataFrame:
    """Encounters of programme patients with the date of each vaccine dose as a column.

    A dose is one observation group (vaccine, sequence number, date), so the
    update-or-insert by group is one aggregate.
    """
    ids = c.metadata_ids("program", "program_id", "name", [program])
    p = c.live("patient_program").filter(F.col("program_id").isin(ids) if ids else F.lit(False)).select("patient_id").distinct()
    p = c.without_test_patients(p)
    e = c.encounters(list(types), "name").join(p, "patient_id", "left_semi").join(vaccine_doses(c), "encounter_id")
    e = c.with_registration_place(c.with_identifiers(e, {"emr_id": "emr", "dossier_id": "dossier"}))
    e = c.with_provider(c.with_user(c.with_facility(c.with_type_name(e)), "creator", "user_entered", login=True))
    return e.filter("provider is not null").select(
        "dossier_id", "emr_id", "loc_registered", c.key("encounter_id"), "encounter_datetime", "encounter_location", "facility", c.key("visit_id"),
        "visit_location", F.col("encounter_type_name").alias("encounter_type"), "provider", F.col("date_created").alias("date_entered"), "user_entered",
        *[dose_column(v, d) for v, (_, nums) in VACCINES.items() for d in nums],
    )


def vaccine_doses(c: Clinic, within: DataFrame | None = None, any_dose: tuple[str, ...] = ()) -> DataFrame:
    """One row per encounter with the date of each vaccine dose as a column.

    ``any_dose``: vaccines whose number in the series does not matter. ``within`` has the encounters that count.
    """
    o = c.obs(VACCINATIONS, SEQUENCE, VACCINE_DATE).filter("obs_group_id is not null")
    if within is not None:
        o = o.join(within.select("encounter_id"), "encounter_id", "left_semi")
    is_vaccine = c.is_code("concept_id", VACCINATIONS)
    doses = o.groupBy("obs_group_id").agg(
        F.max(F.when(is_vaccine, F.col("encounter_id"))).alias("encounter_id"),
        F.max(F.when(is_vaccine, F.col("value_coded"))).alias("vaccine"),
        F.max(F.when(c.is_code("concept_id", SEQUENCE), F.col("value_numeric"))).alias("dose"),
        F.max(F.when(c.is_code("concept_id", VACCINE_DATE), F.col("value_datetime"))).alias("given"),
    ).filter("encounter_id is not null")
    return doses.groupBy("encounter_id").agg(
        *[
            F.max(F.when(c.is_code("vaccine", *codes) & (F.lit(v in any_dose) | (F.col("dose") == d)), F.col("given"))).alias(dose_column(v, d))
            for v, (codes, nums) in VACCINES.items()
            for d in nums
        ]
    )


COVID = ("COVID-19 Admission", "COVID-19 Progress", "COVID-19 Discharge")


def covid_diagnoses(c: Clinic) -> DataFrame:
    """Visit diagnoses of COVID encounters; an encounter without one keeps a row."""
    job = FormJob(
        "covid_diagnoses",
        COVID,
        ("emr_id", "encounter_id", "encounter_type", "location=encounter_location", "encounter_date", "date_entered", "user_entered=username",
         "visit_id", "visit_location", "facility", "covid19_diagnosis", "_enc=raw_encounter_id"),
        {"covid19_diagnosis": listed("CIEL:165793")},
        by="name",
        no_test_patients=True,
    )
    heads = c.obs("Visit Diagnoses").select(F.col("obs_id").alias("_g"))
    d = c.obs("DIAGNOSIS", NON_CODED).join(heads, F.col("obs_group_id") == F.col("_g"))
    d = c.with_concept_name(d, "value_coded", "_name", "en").select("encounter_id", "_g", F.coalesce("_name", "value_text").alias("diagnosis"))
    d = _group_answers(
        c, d, {"diagnosis_confirmation": coded("CLINICAL IMPRESSION DIAGNOSIS CONFIRMED"), "diagnosis_order": coded("Diagnosis order")}, "_g"
    )
    out = run(c, job).join(d.withColumnRenamed("encounter_id", "_e2"), F.col("_enc") == F.col("_e2"), "left")
    return out.drop("_enc", "_e2", "_g")


COVID_TESTS = {"antibody": "CIEL:165853", "antigen": "CIEL:165852", "pcr": "CIEL:165840", "genexpert": "CIEL:165865"}


def covid_lab_test(c: Clinic) -> DataFrame:
    """Specimens of COVID encounters with the tests ordered on them, plus results entered in the laboratory."""
    results = {f"{n}_results": coded(k) for n, k in COVID_TESTS.items()}
    columns = (
        "emr_id", "encounter_id", "encounter_date", "location=encounter_location", "encounter_type", "date_entered", "user_entered=username",
        "visit_id", "visit_location", "facility", "_enc=raw_encounter_id",
    )
    forms = run(c, FormJob("forms", COVID[:2], columns, by="name", no_test_patients=True))
    heads = c.obs("12973").select(F.col("encounter_id").alias("_e2"), "obs_id")
    spec = {"specimen_source": listed("CIEL:159959"), "_taken": date("SPUTUM COLLECTION DATE"), **results}
    spec |= {n: mark("Lab test ordered coded", k) for n, k in COVID_TESTS.items()}
    s = _group_answers(c, heads, spec, "obs_id").join(forms, F.col("_e2") == F.col("_enc")).drop("_e2", "_enc")
    s = s.withColumns({n: F.when(F.col(n) == 1, "Yes") for n in COVID_TESTS} | {"specimen_date": F.to_date("_taken")})
    s = s.withColumn("date_for_reporting", F.coalesce("specimen_date", "encounter_date")).drop("_taken")
    lab = run(c, FormJob("lab", ("Laboratory Results",), columns, results, by="name", no_test_patients=True))
    in_lab = c.live("obs").join(c.encounters(["Laboratory Results"], "name").select("encounter_id"), "encounter_id", "left_semi")
    done = c.answers(["encounter_id"], results, in_lab).withColumnRenamed("encounter_id", "_e2")
    lab = lab.join(done, F.col("_enc") == F.col("_e2")).drop("_enc", "_e2")
    lab = lab.withColumns({"specimen_date": F.col("encounter_date"), "date_for_reporting": F.col("encounter_date")})
    cols = [
        "emr_id", "encounter_id", "obs_id", "encounter_date", "location", "encounter_type", "date_entered", "user_entered", "visit_id",
        "visit_location", "facility", "specimen_date", "date_for_reporting", "specimen_source",
        *[x for n in COVID_TESTS for x in (n, f"{n}_results")],
    ]
    return union_rows([s, lab]).select(*cols)


OVC = "e1b2f0b5-6d56-4500-8523-0ba71e75d897"


def ovc_program_encounters(c: Clinic, types: tuple[str, ...] = ("OVC Intake", "OVC Follow-up")) -> DataFrame:
    """Encounters, programme states and enrolments without either, with run numbers per enrolment."""
    pp = c.without_test_patients(c.enrolments(OVC)).select(
        "patient_id", "patient_program_id", "location_id", F.to_date("date_enrolled").alias("date_enrolled"),
        F.to_date("date_completed").alias("date_completed"), "outcome_concept_id", F.col("date_created").alias("program_date_created"),
    )
    pp = c.with_concept_name(pp, "outcome_concept_id", "program_outcome", "en")
    bare_pp = pp.select("patient_id", "patient_program_id", "date_enrolled", "date_completed")
    pp = ordered.index_pair(
        pp, ["patient_id"], ["date_enrolled", "patient_program_id"], ("index_asc_enrollment", "index_desc_enrollment"), sizes=bare_pp
    )
    own = {
        "location_id": "location_id", "ovc_program_enrollment_date": "date_enrolled", "ovc_program_completion_date": "date_completed",
        "program_outcome": "program_outcome", "index_asc_enrollment": "index_asc_enrollment", "index_desc_enrollment": "index_desc_enrollment",
    }
    e = c.encounters(list(types), "name").select("encounter_id", "patient_id", "encounter_datetime", "date_created", "creator")
    e = e.join(c.live("obs").select("encounter_id"), "encounter_id", "left_semi")
    seen = c.encounters(list(types), "name").select("encounter_id", "patient_id", F.to_date("encounter_datetime").alias("encounter_date"))
    e = c.with_answers(
        e,
        {"services": listed("Service or program", sep=","), "other_services": text("Service or program non-coded"),
         "hiv_status": coded("CIEL:1169"), "_tested": date("HIV TEST DATE")},
        within=seen,
    )
    e = c.with_user(e, "creator", "user_entered", login=True).withColumn("encounter_date", F.to_date("encounter_datetime"))
    at = lambda spans, name: join_containing(
        seen, spans, ["patient_id"], "encounter_date", "date_enrolled", "date_completed", {name: "patient_program_id"}, ["encounter_id"], True,
        ["patient_program_id"], days=180,
    ).select("encounter_id", name)
    # a closed enrolment that contains the day goes before an open one
    closed, open_ = at(bare_pp.filter("date_completed is not null"), "_closed"), at(bare_pp.filter("date_completed is null"), "_open")
    hit = closed.join(open_, "encounter_id", "full_outer").select("encounter_id", F.coalesce("_closed", "_open").alias("patient_program_id"))
    e = e.join(hit, "encounter_id", "left")
    e = enrich.decode(e, pp, "patient_program_id", "patient_program_id", own)
    known = e.filter("hiv_status is not null and patient_program_id is not null").select("encounter_id", "patient_program_id", "encounter_date", "hiv_status")
    runs = ordered.run_pair(
        known, ["patient_program_id"], ["encounter_date", "encounter_id"], "hiv_status", ("index_asc_hiv_status", "index_desc_hiv_status")
    )
    e = e.join(runs.select("encounter_id", "index_asc_hiv_status", "index_desc_hiv_status"), "encounter_id", "left")
    s = c.states().join(pp.select("patient_program_id", "patient_id"), "patient_program_id")
    s = s.select("patient_id", "patient_program_id", "patient_state_id", "state", "state_concept_id", "start_date", "end_date")
    s = ordered.run_pair(
        s, ["patient_program_id"], ["start_date", "patient_state_id"], "state", ("index_asc_program_status", "index_desc_program_status"),
        sizes=c.live("patient_state"),
    )
    s = c.with_concept_name(s, "state_concept_id", "program_status", "en")
    s = enrich.decode(s, pp, "patient_program_id", "patient_program_id", {k: v for k, v in own.items() if k != "program_outcome"})
    s = s.withColumnsRenamed({"start_date": "program_status_start_date", "end_date": "program_status_end_date"})
    bare = enrich.anti(enrich.anti(pp, s, ["patient_program_id"]), e.filter("patient_program_id is not null"), ["patient_program_id"])
    bare = bare.withColumnsRenamed({"date_enrolled": "ovc_program_enrollment_date", "date_completed": "ovc_program_completion_date"})
    out = union_rows([e, s, bare.drop("outcome_concept_id", "program_date_created")])
    out = c.with_identifier(c.with_place(out, "location"))
    return out.select(
        "emr_id", "patient_program_id", "location", c.key("encounter_id"), "encounter_date", F.col("date_created").alias("date_entered"),
        "user_entered", "ovc_program_enrollment_date", "ovc_program_completion_date", "program_status_start_date", "program_status_end_date",
        "program_status", "program_outcome", F.to_date("_tested").alias("hiv_test_date"), "hiv_status", "services", "other_services",
        "index_asc_hiv_status", "index_desc_hiv_status", "index_asc_program_status", "index_desc_program_status", "index_asc_enrollment",
        "index_desc_enrollment",
    )


MATERNAL_HISTORY = {
    "history_pre_eclampsia": "47", "history_eclampsia": "7696", "history_gender_based_violence": "11550", "history_type_1_diabetes": "6691",
    "history_type_2_diabetes": "6692", "history_gestational_diabetes": "6693", "history_post_partum_hemorrhage": "49",
    "history_hypertension": "903", "history_gestational_hypertenson": "9752",
}
MATERNAL_VISITS = {
    "number_anc_visit": "6259", "number_obgyn_visits": "13254", "number_postpartum_visits": "6261", "number_family_planning_visits": "5483",
}
# Latest answer inside an enrolment: question and column of the value.
MATERNAL_LATEST = {
    "mothers_group": ("11665", "value_text"), "number_living_children": ("11117", "value_numeric"), "traditional_healer": ("13242", "_name"),
    "prenatal_teas": ("13737", "_name"), "expected_delivery_date": ("5596", "value_datetime"),
}
REFERRALS = ("Type of referring service", "CIEL:160535")
MATERNAL_OBS = (
    "obs_id", "obs_group_id", "concept_id", "obs_datetime", "date_created", "value_coded", "value_numeric", "value_text", "value_datetime", "comments",
)


def _current_state(c: Clinic, enrolments: DataFrame, workflow: str, name: str) -> DataFrame:
    """Newest state of a workflow that is open or ended with the enrolment."""
    flow = c.metadata_ids("program_workflow", "program_workflow_id", "uuid", [workflow])
    s = c.states().filter(F.col("program_workflow_id").isin(flow) if flow else F.lit(False))
    s = s.join(enrolments.select("patient_program_id", F.col("date_completed").alias("_done")), "patient_program_id")
    s = s.filter(F.col("end_date").isNull() | (F.col("end_date").cast("timestamp_ntz") == F.col("_done")))
    s = latest.top1(s, ["patient_program_id"], ["-start_date", "-patient_state_id"])
    return c.with_concept_name(s, "state_concept_id", name).select("patient_program_id", name)


def mch_j9_data(c: Clinic, workflow: str = MATERNAL_WORKFLOW) -> DataFrame:
    """Maternal enrolments with the answers, counts and lists that fall inside each enrolment."""
    pp = c.enrolments(MATERNAL).select("patient_id", "patient_program_id", "date_enrolled", "date_completed")
    e = c.encounters([OBGYN]).select("encounter_id")
    # all that is asked of the visits' observations, written once: each use would join them with the encounters again
    o = c.obs(*[code for code, _ in MATERNAL_LATEST.values()], "8879", *REFERRALS, "13126", "10140", "11673")
    o = o.join(e, "encounter_id", "left_semi").select(F.col("person_id").alias("patient_id"), *MATERNAL_OBS)
    o = staged(o, "maternal-obs")
    named = c.with_concept_name(o, "value_coded", "_name")
    kind = [pp.schema["patient_id"].dataType]
    sizes = ordered.KeyStats.of(
        [asof.time_line(o, ["patient_id"], "obs_datetime", kind), (*asof.time_line(pp, ["patient_id"], "date_enrolled", kind), 2)]
    )
    t = pp.join(_current_state(c, pp, workflow, "program_state"), "patient_program_id", "left")
    found = [
        asof.Lookup(named, ["patient_id"], "obs_datetime", {name: value}, ["obs_id"], where=c.is_code("concept_id", code))
        for name, (code, value) in MATERNAL_LATEST.items()
    ]
    got = asof.latest_between_many(pp, ["patient_id"], "date_enrolled", "date_completed", found, c.as_of, sizes)
    # where an id repeats, each column is joined for itself
    repeats = pp.groupBy("patient_program_id").count().filter("patient_program_id IS NOT NULL AND count > 1").first() is not None
    for names in [[n] for n in MATERNAL_LATEST] if repeats else [list(MATERNAL_LATEST)]:
        t = t.join(got.select("patient_program_id", *names), "patient_program_id", "left")
    visits = o.filter(c.is_code("concept_id", "8879")).select("patient_id", "obs_datetime", "value_coded")
    counts = asof.count_within(
        pp, ["patient_program_id"], visits, ["patient_id"], "date_enrolled", "date_completed", "obs_datetime",
        {n: c.is_code("value_coded", k) for n, k in MATERNAL_VISITS.items()}, c.as_of, sizes=sizes,
    ).select("patient_program_id", *MATERNAL_VISITS)
    t = t.join(counts, "patient_program_id", "left")
    ref = named.filter(c.is_code("concept_id", *REFERRALS))
    places = c.table("location").select(F.col("location_id").cast("string").alias("_lid"), F.col("name").alias("_lname"))
    ref = enrich.decode(ref, places, "value_text", "_lid", {"_lname": "_lname"})
    kind = c.is_code("concept_id", "Type of referring service")
    ref = ref.select(
        "patient_id", "obs_datetime", F.when(kind, F.col("_name")).alias("_type"),
        F.when(kind & c.is_code("value_coded", "OTHER"), F.col("comments")).alias("_other"), F.when(~kind, F.col("_lname")).alias("_from"),
    )
    until = pp.withColumn("_until", F.coalesce("date_completed", F.lit(c.as_of).cast("timestamp_ntz")))
    inside = join_containing(ref, until, ["patient_id"], "obs_datetime", "date_enrolled", "_until", {"patient_program_id": "patient_program_id"}, days=180)
    lists = inside.groupBy("patient_program_id").agg(
        text_list(F.col("_type")).alias("referral_type"), text_list(F.col("_other")).alias("referral_type_other"),
        text_list(F.col("_from")).alias("referred_from_facility"),
    )
    t = t.join(lists, "patient_program_id", "left")
    # highest birth number known by the end of the enrolment: a running maximum over both time lines
    births = o.filter(c.is_code("concept_id", "13126") & F.col("value_numeric").isNotNull())
    line = union_rows(
        [
            births.select("patient_id", F.col("obs_datetime").alias("_ts"), F.lit(0).alias("_side"), F.struct("value_numeric", "obs_datetime", "obs_id", "obs_group_id").alias("_b")),
            until.select("patient_id", F.col("_until").alias("_ts"), F.lit(1).alias("_side"), "patient_program_id"),
        ]
    )
    top = ordered.Ordered(line, ["patient_id"], ["_ts", "_side"], sizes=sizes).scan(_top=ordered.max_before(F.col("_b"))).frame()
    top = staged(top.filter("_side = 1").select("patient_program_id", F.col("_top.obs_group_id").alias("_group")), "birth-groups")
    t = t.join(top, "patient_program_id", "left")
    t = c.with_answers(
        t, {"prior_birth_delivery_type": coded("11663"), "prior_birth_neonatal_status": listed("12899")}, "_group", _grouped(c), "obs_group_id",
        within=top.filter("_group IS NOT NULL"), sparse=True,
    )
    ever = {n: mark("10140", k) for n, k in MATERNAL_HISTORY.items()}
    t = c.with_answers(t, ever, "patient_id", o.withColumnRenamed("patient_id", "person_id"), "person_id")
    risk = o.filter(c.is_code("concept_id", "11673") & c.is_code("value_coded", "903")).groupBy("patient_id").agg(F.max("obs_datetime").alias("_risk"))
    t = enrich.decode(t, risk, "patient_id", "patient_id", {"_risk": "_risk"})
    reg = c.live("obs").join(c.registrations().select("encounter_id"), "encounter_id", "left_semi")
    t = c.with_answers(t, {"marital_status": coded("CIEL:1054"), "religion": coded("10154")}, "patient_id", reg, "person_id")
    t = c.with_identifier(c.with_person(t, {"_birth": "birthdate"}))
    t = enrich.decode(
        t, c.addresses(voided_too=False), "patient_id", "person_id",
        {"address_department": "state_province", "address_commune": "city_village", "address_section_communale": "address3",
         "address_locality": "address1", "address_street_landmark": "address2"},
    )
    return t.select(
        c.key("patient_program_id").alias("mch_program_id"), "emr_id", complete_years(F.col("_birth"), F.lit(c.as_of)).alias("patient_age"),
        "date_enrolled", "date_completed", "program_state", "mothers_group", F.to_date("expected_delivery_date").alias("expected_delivery_date"),
        "prior_birth_delivery_type", "prior_birth_neonatal_status", *[F.col(n).cast("boolean").alias(n) for n in MATERNAL_HISTORY],
        F.when(F.col("_risk") >= F.col("date_enrolled"), True).alias("current_hypertension_risk"), *MATERNAL_VISITS, "marital_status", "religion",
        "number_living_children", "address_department", "address_commune", "address_section_communale", "address_locality",
        "address_street_landmark", "traditional_healer", "prenatal_teas", "referral_type", "referral_type_other", "referred_from_facility",
    )


def mch_j9_case_registration(
    c: Clinic, workflow: str = MATERNAL_WORKFLOW, max_months: int | None = None, parent: str = "Parent"
) -> DataFrame:
    """Living patients with an open maternal enrolment, by their latest one."""
    open_ = c.enrolments(MATERNAL).filter("date_completed is null")
    if max_months is not None:
        open_ = open_.filter(F.col("date_enrolled") >= F.add_months(F.lit(c.as_of).cast("date"), -max_months).cast("timestamp_ntz"))
    p = latest.top1(open_, ["patient_id"], ["-date_enrolled", "-patient_program_id"])
    p = p.join(_current_state(c, p, workflow, "j9_program"), "patient_program_id", "left")
    person = c.table("person").filter(~F.coalesce("dead", F.lit(False)))
    p = p.join(person.select(F.col("person_id").alias("patient_id"), F.col("uuid").alias("patient_uuid"), "birthdate"), "patient_id")
    e = c.encounters([OBGYN, DELIVERY]).select("encounter_id")
    o = c.live("obs").join(e, "encounter_id", "left_semi")
    newest = lambda code: latest.top1(o.filter(c.is_code("concept_id", code)), ["person_id"], ["-obs_datetime", "-obs_id"])
    p = enrich.decode(p, newest("mothers group"), "patient_id", "person_id", {"j9_group": "value_text"})
    p = enrich.decode(p, newest("5596"), "patient_id", "person_id", {"_edd": "value_datetime"})
    p = enrich.decode(p, newest("5599"), "patient_id", "person_id", {"_add": "value_datetime"})
    p = c.with_attribute(p, "telephone", TELEPHONE, "uuid")
    p = c.with_identifiers(p, {"emr_id": "emr", "dossier_id": "dossier"})
    p = enrich.decode(p, c.names(), "patient_id", "person_id", {"given_name": "given_name", "family_name": "family_name"})
    p = enrich.decode(
        p, c.addresses(voided_too=False), "patient_id", "person_id",
        {"department": "state_province", "commune": "city_village", "section_communal": "address3", "locality": "address1", "street_landmark": "address2"},
    )
    kinds = c.metadata_ids("relationship_type", "relationship_type_id", "a_is_to_b", [parent])
    women = c.table("person").filter("gender = 'F'").select(F.col("person_id").alias("person_a"))
    r = c.live("relationship").filter(F.col("relationship").isin(kinds)).join(women, "person_a", "left_semi")
    p = enrich.related(p, r, "patient_id", "person_b", "person_a", ["-date_created", "-relationship_id"], "_mother")
    p = c.with_identifier(p, "_mama", "dossier", "_mother")
    age = complete_years(F.col("birthdate"), F.lit(c.as_of))
    return p.select(
        c.key("patient_id", True), "patient_uuid", "given_name", "family_name", "emr_id", "dossier_id", "j9_group", "j9_program", "telephone",
        "birthdate", age.alias("age"), F.to_date("_edd").alias("estimated_delivery_date"), F.to_date("_add").alias("actual_delivery_date"),
        F.when(age < 1, F.col("_mama")).alias("mama_dossier"), "department", "commune", "section_communal", "locality", "street_landmark",
        F.to_date("date_enrolled").alias("j9_enrollment_date"),
    )


