"""Extracts with repeating groups or evidence of several kinds side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import age_tenths, complete_days, complete_months, complete_years
from wardmill.operators import enrich, latest, rules, tree
from wardmill.operators.eav import Answer, pivot, text_list
from wardmill.operators.merge import union_rows
from wardmill.plans.extract.clinic import HEALTH_CENTER_ATTRIBUTE, Clinic, Q, coded, comment, date, listed, mark, max_either, num, row_ids, text, yn
from wardmill.plans.extract.forms import ECHO
from wardmill.plans.extract.maternal import VACCINES, dose_column, vaccine_doses
from wardmill.plans.extract.programs import DELIVERY, HIV, MATERNAL, OBGYN, _group_answers
from wardmill.sources.staging import staged

# Questions and answers of the delivery note.
DIAGNOSIS, PROCEDURE = "3064", "CIEL:1651"
DELIVERY_MARKS = {
    "Postpartum_hemorrhage": "CIEL:230",
    "Intrapartum_hemorrhage": "CIEL:136601",
    "Placental_abruption": "CIEL:130108",
    "Placenta_praevia": "CIEL:114127",
    "Rupture_of_uterus": "CIEL:127259",
    "Other_hemorrhage": "CIEL:150802",
    "baby_Malpresentation_of_fetus": "CIEL:115939",
    "baby_Cephalopelvic_disproportion": "CIEL:145935",
    "baby_Extreme_premature": "CIEL:111523",
    "baby_Very_premature": "11789",
    "baby_Moderate_to_late_preterm": "11790",
    "baby_Respiratory_distress": "CIEL:127639",
    "baby_Birth_asphyxia": "7557",
    "baby_Acute_fetal_distress": "CIEL:118256",
    "baby_Intrauterine_growth_retardation": "CIEL:118245",
    "baby_Congenital_malformation": "CIEL:143849",
    "baby_Meconium_aspiration": "CIEL:115866",
    "mom_Premature_rupture_of_membranes": "CIEL:129211",
    "mom_Chorioamnionitis": "CIEL:145548",
    "mom_Placental_abnormality": "CIEL:130109",
    "mom_Hypertension": "CIEL:117399",
    "mom_Severe_pre_eclampsia": "CIEL:113006",
    "mom_Eclampsia": "CIEL:118744",
    "mom_Acute_pulmonary_edema": "CIEL:121856",
    "mom_Puerperal_infection": "CIEL:130",
    "mom_Victim_of_GBV": "CIEL:165088",
    "mom_Herpes_simplex": "CIEL:138706",
    "mom_Syphilis": "CIEL:112493",
    "mom_Other_STI": "CIEL:112992",
    "mom_Other_finding": "CIEL:5622",
}
DELIVERY_PROCEDURES = {
    "Perineal_suture": "CIEL:164157",
    "Episiotomy": "CIEL:5577",
    "C_section_with_tubal_ligation": "CIEL:161890",
    "Caesarean_hysterectomy": "CIEL:161848",
}
DELIVERY_ANSWERS = {
    "delivery_datetime": Q("max_date", "5599"),
    "partogram_completed": max_either("13964"),
    "dystocia": Q("max_coded", "CIEL:163449"),
    "prolapsed_cord": max_either("CIEL:113617"),
    "late_cord_clamping": max_either("CIEL:163450"),
    "placenta_delivery": Q("max_coded", "13550"),
    "AMTSL": max_either("CIEL:163452"),
    "Placenta_completeness": Q("max_coded", "CIEL:163454"),
    "Intact_membranes": max_either("CIEL:164900", "CIEL:164899", "CIEL:127244"),
    "Retained_placenta": max_either("CIEL:127592"),
    "Perineal_laceration": max_either("CIEL:114244"),
    "Postpartum_blood_loss": Q("max_coded", "CIEL:162092"),
    "Transfusion": max_either("CIEL:1063"),
    "maternal_delivery_type_deprecated": listed("11663"),
    **{n: mark(DIAGNOSIS, a) for n, a in DELIVERY_MARKS.items()},
    **{n: mark(PROCEDURE, a) for n, a in DELIVERY_PROCEDURES.items()},
    "mom_Other_finding_details": Q("max_comment", "6644", "5622"),
    "Mental_health_assessment": listed("10594"),
    "number_prenatal_visits": Q("max_num", "CIEL:1590"),
    "referred_by": listed("10635"),
    "referred_by_other_details": Q("max_comment", "10635", "5622"),
    "nutrition_newborn_counseling": max_either("CIEL:161651"),
    "family_planning_after_delivery": max_either("13564"),
    "disposition": Q("max_coded", "8620"),
    "disposition_comment": Q("max_text", "DISPOSITION COMMENTS"),
    "return_visit_date": Q("max_date", "5096"),
}
BIRTH, BIRTHS = "CIEL:1585", 4
BIRTH_ANSWERS = {
    "outcome": Q("max_coded", "CIEL:161033"),
    "weight": Q("max_num", "CIEL:5916"),
    "APGAR_5_minute": Q("max_num", "CIEL:1504"),
    "APGAR_1_minute": Q("max_num", "14419"),
    "APGAR_10_minute": Q("max_num", "14785"),
    "neonatal_resuscitation": max_either("CIEL:162131"),
    "macerated_fetus": max_either("CIEL:135437"),
}
VISIT_DIAGNOSES, DIAGNOSES, PRIMARY = "7539", 10, "7534"
DIAGNOSIS_ANSWERS = {"": coded(DIAGNOSIS), "_confirmed": coded("1379"), "_primary": Q("code", "7537")}
DELIVERY_COLUMNS = (
    "dossierId", "emr_id", "loc_registered", "mch_program_id", "encounter_datetime", "encounter_location", "facility", "visit_id",
    "visit_location", "encounter_type", "date_entered", "provider", "encounter_id", "delivery_datetime", "partogram_completed", "dystocia",
    "prolapsed_cord", *list(DELIVERY_MARKS)[:6], "Other_hemorrhage_details", "late_cord_clamping", "placenta_delivery", "AMTSL",
    "Placenta_completeness", "Intact_membranes", "Retained_placenta", "Perineal_laceration", "Perineal_suture", "Episiotomy",
    "Postpartum_blood_loss", "Transfusion", "maternal_delivery_type_deprecated", "Caesarean_hysterectomy", "C_section_with_tubal_ligation",
    *list(DELIVERY_MARKS)[6:], "mom_Other_finding_details", "Mental_health_assessment",
    *[f"Birth_{i}_{n}" for i in range(1, BIRTHS + 1) for n in BIRTH_ANSWERS],
    "number_prenatal_visits", "referred_by", "referred_by_other_details", "nutrition_newborn_counseling", "family_planning_after_delivery",
    *[f"diagnosis_{i}{n}" for i in range(1, DIAGNOSES + 1) for n in DIAGNOSIS_ANSWERS],
    "disposition", "disposition_comment", "return_visit_date",
)


def _with_diagnoses(c: Clinic, df: DataFrame, e: DataFrame) -> DataFrame:
    """Up to ten diagnosis groups in the order they were entered, with certainty and whether primary."""
    df = c.with_numbered_groups(df, VISIT_DIAGNOSES, DIAGNOSIS_ANSWERS, DIAGNOSES, "diagnosis_{i}{n}", ("obs_id",), within=e)
    said = {f"diagnosis_{i}_primary": F.col(f"diagnosis_{i}_primary") for i in range(1, DIAGNOSES + 1)}
    return df.withColumns({n: F.when(v.isNotNull(), (v == c.code(PRIMARY)).cast("int")) for n, v in said.items()})


def mch_delivery(c: Clinic) -> DataFrame:
    """One row per delivery note: mother, placenta, up to four births and ten diagnoses side by side."""
    e = c.window(c.encounters([DELIVERY]), "encounter_datetime").select(
        "encounter_id", "patient_id", "visit_id", "encounter_type", "location_id", "encounter_datetime", "date_created"
    )
    d = c.with_answers(e, DELIVERY_ANSWERS, within=e)
    other = c.live("obs").filter(c.is_code("value_coded", DELIVERY_MARKS["Other_hemorrhage"]))
    other = latest.top1(other.join(e.select("encounter_id"), "encounter_id", "left_semi"), ["encounter_id"], ["-obs_datetime", "-obs_id"])
    said = c.live("obs").filter(c.is_code("concept_id", DIAGNOSIS)).groupBy("obs_group_id").agg(F.max("comments").alias("Other_hemorrhage_details"))
    d = d.join(other.select("encounter_id", "obs_group_id").join(said, "obs_group_id").drop("obs_group_id"), "encounter_id", "left")
    d = c.with_numbered_groups(d, BIRTH, BIRTH_ANSWERS, BIRTHS, "Birth_{i}_{n}", within=e)
    d = _with_diagnoses(c, d, e)
    d = c.enrolment_at(d, MATERNAL, ["encounter_id"], "mch_program_id", events=e)
    d = c.with_provider(c.with_facility(c.with_type_name(c.with_registration_place(d))))
    d = c.with_identifiers(d, {"emr_id": "emr", "dossierId": "dossier"})
    whole = ["number_prenatal_visits", *[f"Birth_{i}_{n}" for i in range(1, BIRTHS + 1) for n in BIRTH_ANSWERS if n.startswith("APGAR")]]
    d = d.withColumns({n: F.rint(n).cast("int") for n in whole})
    d = d.withColumns({"date_entered": F.col("date_created"), "encounter_type": F.col("encounter_type_name")})
    keys = {"encounter_id": c.key("encounter_id", True), "visit_id": c.key("visit_id", True), "mch_program_id": c.key("mch_program_id")}
    return d.withColumns(keys).select(*DELIVERY_COLUMNS)


# Dispensing encounters, questions and answers behind the echo summary.
DISPENSING = "8ff50dea-18a1-4609-b4c9-3f8f2d611b84"
MEDICINE = "1282"
FUNCTION, NYHA, SYSTOLIC, DIASTOLIC = "11994", "3139", "5085", "5086"
EVER = {"heart_failure": (DIAGNOSIS, "3468"), "mitral_stenosis": ("11998", "3175"), "cardiomyopathy": ("11499", "5016")}
MEDICINES = {
    "beta_blocker_atenolol": ("3186",),
    "beta_blocker_metoprolol": ("12491",),
    "beta_blocker_carvedilol": ("3185",),
    "ace_inhibitor": ("9185", "9230", "1242", "13740", "6769", "10601", "3183"),
    "penicillin": ("3183", "12345", "4034"),
    "spironolactone": ("4061",),
    "hydralazine_hydrochloride": ("9084",),
    "isosorbide_dinitrate": ("3428",),
    "diuretic": ("1243", "99"),
    "calcium_channel_blocker": ("9083", "250"),
}
COMORBIDITIES = {
    "hypertension": ("12697", "12698", "8885", "903", "12629", "12634"),
    "asthma": ("7401", "7400", "7402", "7403", "7404", "5", "13541", "4", "7953", "11731"),
    "sickle_cell": ("7908", "8573", "8570"),
    "copd": ("3716",),
}
DIABETES_SET = "11501"
DIABETES = {"dm1": ("6691",), "dm2": ("6692", "12228", "11943", "12227", "12251")}
#: Change of the ventricle's function: (class, [(pattern of the latest, pattern of the prior)]), tried in order.
BETTER = (("%normal%", "%very%low%"), ("%normal%", "%mildly%depressed%"), ("%mildly%depressed%", "%very%low%"))
FUNCTION_CHANGES = (("Improved", BETTER), ("Reduced", tuple((b, a) for a, b in BETTER)))


def function_change(now, before):
    """How two texts of coded findings compare; a text may hold several findings, and null is no comparison."""
    either = lambda p: now.ilike(p) | before.ilike(p)
    steps = [(now.isNull() | before.isNull(), F.lit("Not Available")), (either("%impossible%"), F.lit("Impossible to evaluate")), (now == before, F.lit("No Change"))]
    for name, pairs in FUNCTION_CHANGES:
        hit = F.lit(False)
        for a, b in pairs:
            hit = hit | (now.ilike(a) & before.ilike(b))
        steps.append((hit, F.lit(name)))
    return rules.waterfall(steps, F.lit(None).cast("string"))


def echo_summary_table(c: Clinic) -> DataFrame:
    """One row per patient with an echocardiogram: the latest and the one before, medicines ever dispensed, other diseases."""
    echoes = c.encounters([ECHO]).select("patient_id", "encounter_id", "encounter_datetime")
    totals = echoes.groupBy("patient_id").agg(F.count("*").cast("int").alias("total_echos"))
    two = latest.top_n(echoes, ["patient_id"], ["-encounter_datetime", "-encounter_id"], 2)
    # one aggregate for both echoes: the position tells the latest from the one before
    o = c.obs(FUNCTION, NYHA, SYSTOLIC, DIASTOLIC).join(two.select("encounter_id", "patient_id", "position"), "encounter_id")
    o = c.with_concept_name(o, "value_coded", "_name", "en")
    at = lambda i, code: (F.col("position") == i) & c.is_code("concept_id", code)
    found = pivot(
        o, ["patient_id"],
        {
            "lvsf_most_recent": Answer(at(1, FUNCTION), F.col("_name"), "list"),
            "lvsf_prior": Answer(at(2, FUNCTION), F.col("_name"), "list"),
            "nyha_class_most_recent": Answer(at(1, NYHA), F.col("_name"), "list"),
            "bp_systolic_most_recent": Answer(at(1, SYSTOLIC), F.col("value_numeric")),
            "bp_diastolic_most_recent": Answer(at(1, DIASTOLIC), F.col("value_numeric")),
        },
    )
    days = two.groupBy("patient_id").agg(
        F.max(F.when(F.col("position") == 1, F.col("encounter_datetime"))).alias("_now"),
        F.max(F.when(F.col("position") == 2, F.to_date("encounter_datetime"))).alias("echo_date_prior"),
    )
    # what was ever answered: one aggregate over the patients' observations with any of the answers
    dispensed = c.encounters([DISPENSING]).select("encounter_id", F.lit(True).alias("_dispensed"))
    every = [a for _, a in EVER.values()] + [a for m in (MEDICINES, COMORBIDITIES) for codes in m.values() for a in codes]
    mine = c.live("obs").filter(c.is_code("value_coded", *every))
    mine = mine.join(echoes.select(F.col("patient_id").alias("person_id")), "person_id", "left_semi").join(dispensed, "encounter_id", "left")
    flags = {n: c.is_code("concept_id", q) & c.is_code("value_coded", a) for n, (q, a) in EVER.items()}
    flags |= {n: F.col("_dispensed") & c.is_code("concept_id", MEDICINE) & c.is_code("value_coded", *codes) for n, codes in MEDICINES.items()}
    flags |= {n: c.is_code("value_coded", *codes) for n, codes in COMORBIDITIES.items()}
    ever = pivot(mine, ["person_id"], {n: Answer(w, F.lit(True), "max") for n, w in flags.items()})
    roots = c.table("report_mapping").select("concept_id").filter(F.col("concept_id") == c.code(DIABETES_SET)).distinct()
    kinds = tree.set_closure(c.table("concept_set"), "concept_set", "concept_id", roots, 2).select(F.col("member").alias("value_coded"))
    sugar = c.obs(DIAGNOSIS).join(kinds, "value_coded", "left_semi").join(echoes.select(F.col("patient_id").alias("person_id")), "person_id", "left_semi")
    sugar = latest.top1(sugar, ["person_id"], ["-date_created", "-obs_id"]).select(
        "person_id", *[c.is_code("value_coded", *codes).alias(n) for n, codes in DIABETES.items()]
    )
    t = totals.join(days, "patient_id").join(found, "patient_id", "left")
    t = t.join(ever.withColumnRenamed("person_id", "patient_id"), "patient_id", "left")
    t = t.join(sugar.withColumnRenamed("person_id", "patient_id"), "patient_id", "left")
    told = [*flags, *DIABETES]
    t = t.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in told})
    t = c.with_person(c.with_identifier(t, "emrid"), {"sex": "gender", "_birth": "birthdate"})
    t = c.with_address(t, {"department": "state_province", "commune": "city_village", "section_communal": "address3", "locality": "address1"})
    recent = F.to_date("_now")
    months = 12 * (F.year("_now") - F.year("echo_date_prior")) + F.month("_now") - F.month("echo_date_prior")
    sick = F.lit(False)
    for n in (*DIABETES, *COMORBIDITIES):
        sick = sick | F.col(n)
    return t.select(
        "patient_id", "emrid", complete_years(F.col("_birth"), F.col("_now")).alias("age"), "sex", "department", "commune", "section_communal",
        "locality", "heart_failure", recent.alias("echo_date_most_recent"), "echo_date_prior", "total_echos", "lvsf_most_recent", "lvsf_prior",
        function_change(F.col("lvsf_most_recent"), F.col("lvsf_prior")).alias("lvsf_change"), "mitral_stenosis", "nyha_class_most_recent",
        "cardiomyopathy", *MEDICINES, F.coalesce(months < 24, F.lit(False)).alias("follow_up_echo"),
        F.rint("bp_systolic_most_recent").cast("int").alias("bp_systolic_most_recent"),
        F.rint("bp_diastolic_most_recent").cast("int").alias("bp_diastolic_most_recent"), sick.alias("ncd_comorbidity"), *DIABETES, *COMORBIDITIES,
    )


# Questions and answers of the obstetric visit.
FAMILY_PLANNING = "METHOD OF FAMILY PLANNING"
SUSPECTED = "14365"
SUSPECTED_STI = {
    "chlamydia": "CIEL:120733",
    "gonorrhea": "CIEL:117767",
    "genital_herpes": "CIEL:117829",
    "hep_b": "CIEL:111759",
    "hpv": "CIEL:1213",
    "trichomoniasis": "CIEL:117146",
    "bacterial_vaginosis": "CIEL:148002",
}
WOMENS_EXAMS = ("CIEL:1439", "CIEL:160090", "CIEL:163749", "CIEL:1440", "CIEL:163750", "CIEL:160968")
HISTORY_GROUP, STI_QUESTION, COMPLETED = "CIEL:1633", "13076", "1267"
VISIT_ANSWERS = {
    "visit_type": coded("CIEL:164181"),
    "consultation_type": coded("Type of HUM visit"),
    "consultation_type_fp": coded("REASON FOR VISIT"),
    "pregnant": mark("8879", "ANC VISIT"),
    "_breastfeeding": mark(FAMILY_PLANNING, "CIEL:136163"),
    "pregnant_lmp": date("DATE OF LAST MENSTRUAL PERIOD"),
    "pregnant_edd": date("ESTIMATED DATE OF CONFINEMENT"),
    "next_visit_date": date("RETURN VISIT DATE"),
    "triage_level": coded("Triage color classification"),
    "referral_type": listed("Type of referring service"),
    "referral_type_other": comment("Type of referring service", "OTHER"),
    "referred_from_facility": Q("place", "CIEL:160535"),
    "implant_inserted": mark(FAMILY_PLANNING, "CIEL:1873"),
    "IUD_inserted": mark(FAMILY_PLANNING, "INTRAUTERINE DEVICE"),
    "tubal_ligation_completed": mark(FAMILY_PLANNING, "TUBAL LIGATION"),
    "gyno_exam": Q("mark", "13229"),
    **{f"_exam {q}": Q("mark", q) for q in WOMENS_EXAMS},
    "pap_test_performed": mark("11319", COMPLETED),
    "via": coded("9759"),
    "hiv_test_admin": yn("HIV test done"),
    "hiv_test_date": date("CIEL:164400"),
    "hiv_test_result": listed("CIEL:159427"),
    "received_post_test_counseling": listed("CIEL:159382"),
    "post_test_counseling_date": date("CIEL:11525"),
    "cervical_cancer_screening_date": date("CIEL:165429"),
    "cervical_cancer_screening_result": mark("CIEL:163560", "CIEL:151185"),
    "diagnosis_non_coded": text("Diagnosis or problem, non-coded"),
    "procedures": listed("CIEL:1651"),
    "procedures_other": text("CIEL:165264"),
    "family_planning_use": mark("CIEL:965", "1065"),
    "family_planning_patient_type": coded("14321"),
    "_planning": Q("obs", "Family planning construct"),
    "_counseling": coded("CIEL:165309"),
    "fp_start_date": date("11466"),
    "fp_end_date": date("11465"),
    "implant_date": date("3203"),
    "condoms_provided": coded("13006"),
    "number_of_condoms": num("20151"),
    "location_of_delivery": coded("11348"),
    "delivery_datetime": date("CIEL:5599"),
    "risk_factors": listed("CIEL:160079"),
    "sti_treatment": mark("CIEL:160742", "CIEL:167125"),
    "_syphilis": Q("code", "13024"),
    "_syphilis_name": coded("13024"),
    **{n: mark(SUSPECTED, a) for n, a in SUSPECTED_STI.items()},
}
VISIT_DAYS = (
    "pregnant_lmp", "pregnant_edd", "next_visit_date", "hiv_test_date", "post_test_counseling_date", "cervical_cancer_screening_date",
    "fp_start_date", "fp_end_date", "implant_date",
)
DOSES = tuple(dose_column(v, d) for v, (_, nums) in VACCINES.items() for d in nums)
VISIT_COLUMNS = (
    "emr_id", "encounter_id", "mch_program_id", "visit_date", "encounter_location", "facility", "visit_id", "visit_location", "visit_type",
    "consultation_type", "consultation_type_fp", "age_at_visit", "date_entered", "user_entered", "examining_doctor", "pregnant", "breastfeeding",
    "pregnant_lmp", "pregnant_edd", "next_visit_date", "triage_level", "referral_type", "referral_type_other", "referred_from_facility",
    "implant_inserted", "IUD_inserted", "tubal_ligation_completed", "abortion_completed", *DOSES, "gyno_exam", "wh_exam", "pap_test_performed",
    "via", "previous_history", "hiv_test_admin", "hiv_test_date", "hiv_test_result", "received_post_test_counseling", "post_test_counseling_date",
    "cervical_cancer_screening_date", "cervical_cancer_screening_result", "primary_diagnosis", "secondary_diagnosis", "diagnosis_non_coded",
    "procedures", "procedures_other", "medication_order", "family_planning_use", "family_planning_patient_type", "family_planning_method",
    "fp_counseling_received", "fp_start_date", "fp_end_date", "implant_date", "condoms_provided", "number_of_condoms", "location_of_delivery",
    "delivery_datetime", "risk_factors", "sti_treatment", "syphilis_treatment_status", "other_sti", *SUSPECTED_STI, "index_patient_asc",
    "index_patient_desc", "index_type_asc", "index_type_desc",
)


def _visit_diagnoses(c: Clinic, e: DataFrame) -> DataFrame:
    """encounter_id with the primary and the secondary diagnoses, of encounters that have a diagnosis group at all.

    A group says whether it is primary; its diagnoses take that over: the members of a group meet in one aggregate.
    """
    o = c.obs("DIAGNOSIS", "Diagnosis order", "Visit Diagnoses").join(e.select("encounter_id"), "encounter_id", "left_semi")
    heads = o.filter(c.is_code("concept_id", "Visit Diagnoses")).select("encounter_id").distinct()
    o = c.with_concept_name(o.filter("obs_group_id IS NOT NULL").join(heads, "encounter_id", "left_semi"), "value_coded", "_name", "en")
    order = c.is_code("concept_id", "Diagnosis order")
    g = o.groupBy("obs_group_id", "encounter_id").agg(
        F.max(order & c.is_code("value_coded", "primary")).alias("_first"),
        F.max(order & c.is_code("value_coded", "secondary")).alias("_second"),
        F.collect_set(F.when(c.is_code("concept_id", "DIAGNOSIS"), F.col("_name"))).alias("_names"),
    )
    g = g.select("encounter_id", "_first", "_second", F.explode("_names").alias("_name"))
    return g.groupBy("encounter_id").agg(
        text_list(F.when(F.col("_first"), F.col("_name"))).alias("primary_diagnosis"),
        text_list(F.when(F.col("_second"), F.col("_name"))).alias("secondary_diagnosis"),
    )


def mch_visit(c: Clinic) -> DataFrame:
    """One row per obstetric encounter with observations, with vaccine doses, diagnoses and family planning side by side."""
    e = c.encounters([OBGYN]).select("encounter_id", "patient_id", "visit_id", "location_id", "encounter_datetime", "date_created", "creator")
    e = c.without_test_patients(e.join(c.live("obs").select("encounter_id"), "encounter_id", "left_semi"))
    mine = c.live("obs").join(c.encounters([OBGYN]).select("encounter_id"), "encounter_id", "left_semi")
    v = c.with_answers(e, VISIT_ANSWERS, obs=mine)
    v = v.join(vaccine_doses(c, c.encounters([OBGYN]), ("bcg",)), "encounter_id", "left")
    v = v.join(_visit_diagnoses(c, c.encounters([OBGYN])), "encounter_id", "left")
    named = c.with_concept_name(mine, "value_coded", "_name", "en")
    heads = c.obs(HISTORY_GROUP).select(F.col("obs_id").alias("_head"))
    past = named.join(heads, F.col("obs_group_id") == F.col("_head"), "left_semi")
    v = v.join(past.groupBy("encounter_id").agg(text_list(F.col("_name")).alias("previous_history")), "encounter_id", "left")
    answers = c.table("concept_answer").filter(F.col("concept_id") == c.code(STI_QUESTION)).select(F.col("answer_concept").alias("value_coded"))
    sti = named.filter(c.is_code("concept_id", "DIAGNOSIS")).join(answers, "value_coded", "left_semi")
    v = v.join(sti.groupBy("encounter_id").agg(text_list(F.col("_name")).alias("other_sti")), "encounter_id", "left")
    planned = mine.filter(c.is_code("concept_id", FAMILY_PLANNING) & F.col("obs_group_id").isNotNull())
    method = c.answers(["obs_group_id"], {"family_planning_method": coded(FAMILY_PLANNING)}, planned)
    v = enrich.decode(v, method, "_planning", "obs_group_id", {"family_planning_method": "family_planning_method"}, row_ids(v))
    ordered = c.with_concept_name(c.live("orders").join(e.select("encounter_id"), "encounter_id", "left_semi"), "concept_id", "_name", "en")
    v = v.join(ordered.groupBy("encounter_id", "patient_id").agg(text_list(F.col("_name")).alias("medication_order")), ["encounter_id", "patient_id"], "left")
    v = c.enrolment_at(v, MATERNAL, ["encounter_id"], "mch_program_id", events=e)
    v = c.with_identifier(c.with_provider(c.with_user(c.with_facility(v)), "examining_doctor"))
    v = c.with_age(v, "_age")
    exams = [F.col(f"_exam {q}") for q in WOMENS_EXAMS]
    none = F.lit(None).cast("int")
    v = v.withColumns({n: F.to_date(n) for n in VISIT_DAYS} | {n: F.to_date(n) for n in DOSES})
    v = v.withColumns(
        {
            "visit_date": F.to_date("encounter_datetime"),
            "age_at_visit": F.col("_age").cast("double"),
            "date_entered": F.col("date_created"),
            "breastfeeding": F.when(F.col("_breastfeeding") == 1, "Yes"),
            "wh_exam": F.coalesce(*exams),
            "abortion_completed": none,
            "fp_counseling_received": F.when(F.col("_counseling").ilike("%Family planning counseling%"), 1),
            "number_of_condoms": F.rint("number_of_condoms").cast("int"),
            "syphilis_treatment_status": F.when(c.is_code("_syphilis", COMPLETED), "Stopped").otherwise(F.col("_syphilis_name")),
            **{n: none for n in ("index_patient_asc", "index_patient_desc", "index_type_asc", "index_type_desc")},
        }
    )
    keys = {"encounter_id": c.key("encounter_id"), "visit_id": c.key("visit_id", True), "mch_program_id": c.key("mch_program_id")}
    return v.withColumns(keys).select(*VISIT_COLUMNS)


# Encounter types by name, questions and answers behind the HIV patient.
INTAKE, FOLLOWUP, PICKUP, ORPHAN, SOCIAL = "HIV Intake", "HIV Followup", "HIV drug dispensing", "OVC Intake", "Socio-economics"
BIRTHPLACE = {
    "birthplace_commune": "City Village",
    "birthplace_sc": "Address3",
    "birthplace_locality": "Address1",
    "birthplace_province": "State Province",
}
KEY_POPULATIONS = {
    "patient_msm": "CIEL:160578",
    "patient_sw": "CIEL:160579",
    "patient_pris": "CIEL:156761",
    "patient_trans": "11561",
    "patient_idu": "CIEL:105",
}
HOUSEHOLD = {
    "socio_people_in_house": num("NUMBER OF PEOPLE WHO LIVE IN HOUSE INCLUDING PATIENT"),
    "socio_rooms_in_house": num("NUMBER OF ROOMS IN HOUSE"),
    "socio_roof_type": listed("ROOF MATERIAL"),
    "socio_floor_type": listed("1315"),
    "socio_has_latrine": listed("Latrine"),
    "socio_has_radio": listed("1318"),
    "socio_years_of_education": listed("HIGHEST LEVEL OF SCHOOL COMPLETED"),
    "socio_transport_method": listed("975"),
    "socio_transport_time": listed("CLINIC TRAVEL TIME"),
}
HABITS = {
    "socio_smoker": coded("HISTORY OF TOBACCO USE"),
    "socio_smoker_years": num("CIEL:159931"),
    "socio_smoker_cigarette_per_day": num("11949"),
    "socio_alcohol": coded("HISTORY OF ALCOHOL USE"),
    "socio_alcohol_type": comment("3342", "OTHER"),
    "socio_alcohol_drinks_per_day": num("ALCOHOLIC DRINKS PER DAY"),
    "socio_alcohol_days_per_week": num("NUMBER OF DAYS PER WEEK ALCOHOL IS USED"),
}
MEASURES = {"weight": "WEIGHT (KG)", "height": "HEIGHT (CM)"}
DISPENSED, ARVS, ART_REASON = "1535", ("3013", "2848", "13960"), "CIEL:138405"
PARTNER, PARTNER_POSITIVE, POSITIVE = "CIEL:1436", "PARTNER CONFIRMED HIV+", "POSITIVE"
CONTACT, CONTACT_KIND, SPOUSE, CONTACT_RESULT = "Contact construct", "13265", "5617", "2169"
TRANSFERRED = "13275"
WHOLE = (
    "socio_people_in_house", "socio_rooms_in_house", "socio_smoker_cigarette_per_day", "socio_alcohol_drinks_per_day", "socio_alcohol_days_per_week",
)


def partner_status(c: Clinic) -> DataFrame:
    """patient_id and the newest HIV result of a partner, of two kinds of evidence.

    The answer about the partner counts as it is, a confirmed partner as positive; a contact group counts with its result
    if the contact is the partner. Of all evidence the newest decides, then the higher observation.
    """
    said = c.obs(PARTNER).withColumn("_coded", F.when(c.is_code("value_coded", PARTNER_POSITIVE), c.code(POSITIVE)).otherwise(F.col("value_coded")))
    spouses = c.obs(CONTACT_KIND).filter(c.is_code("value_coded", SPOUSE)).select(F.col("obs_group_id").alias("_group"))
    tested = c.obs(CONTACT_RESULT).join(spouses, F.col("obs_group_id") == F.col("_group"), "left_semi").withColumn("_coded", F.col("value_coded"))
    cols = [F.col("person_id").alias("patient_id"), "obs_datetime", "obs_id", "_coded"]
    newest = latest.top1(union_rows([said.select(*cols), tested.select(*cols)]), ["patient_id"], ["-obs_datetime", "-obs_id"])
    return c.with_concept_name(newest, "_coded", "partner_hiv_status", "en").select("patient_id", "partner_hiv_status")


def art_dispensing(c: Clinic, pickups: DataFrame) -> DataFrame:
    """patient_id, first day of dispensed treatment and its medicines: the earliest group of each of three slots."""
    o = c.obs(DISPENSED).filter(c.is_code("value_coded", *ARVS)).join(pickups.select("encounter_id"), "encounter_id", "left_semi")
    first = latest.top1(o, ["person_id", "value_coded"], ["obs_datetime", "obs_id"]).select("person_id", "value_coded", "obs_datetime", "obs_group_id")
    first = _group_answers(c, first, {"_drugs": listed(MEDICINE)}, "obs_group_id")
    at = [c.is_code("value_coded", a) for a in ARVS]
    slots = first.groupBy("person_id").agg(
        *[F.max(F.when(w, F.col("obs_datetime"))).alias(f"_d{i}") for i, w in enumerate(at)],
        *[F.max(F.when(w, F.col("_drugs"))).alias(f"_m{i}") for i, w in enumerate(at)],
    )
    rest = [F.coalesce(F.concat(F.lit(","), f"_m{i}"), F.lit("")) for i in (1, 2)]
    return slots.select(
        F.col("person_id").alias("patient_id"),
        F.coalesce("_d0", "_d1", "_d2").alias("art_dispensing_start_date"),
        F.concat(F.coalesce("_m0", F.lit("")), *rest).alias("first_art_dispensing_regimen"),
    )


def art_orders(c: Clinic) -> DataFrame:
    """patient_id with the first order for treatment and the medicines of those not stopped."""
    o = c.table("orders").filter(c.is_code("order_reason", ART_REASON))
    o = c.with_concept_name(o, "concept_id", "_name", "en")
    first = latest.top1(o, ["patient_id"], ["date_activated", "date_created", "order_id"]).select(
        "patient_id", F.to_date("date_activated").alias("art_order_start_date"), F.col("_name").alias("initial_art_regimen_order")
    )
    now = o.filter("date_stopped IS NULL AND NOT voided").groupBy("patient_id").agg(text_list(F.col("_name"), ",").alias("art_regimen"))
    return first.join(now, "patient_id", "left")


def hiv_patient(c: Clinic) -> DataFrame:
    """One row per live patient: person, addresses, key populations, household, last measures, visits, treatment and partner.

    Each source is cut to one row per patient before it joins the patients. The patients are written after every few
    joins: all joins are on the patient and would run in one stage, where each sort holds memory until the stage ends.
    """
    now = F.lit(c.as_of).cast("timestamp_ntz")
    none = F.lit(None).cast("string")
    p = c.without_test_patients(c.live("patient").select("patient_id"))
    p = c.with_identifier(p)
    for name, kind in (("hivemr_v1_id", "hiv"), ("hiv_dossier_id", "hiv_dossier")):
        p = enrich.decode(p, c.identifier_list(kind), "patient_id", "patient_id", {name: "identifiers"})
    p = staged(p, "hiv-patient")
    person = enrich.active(c.table("person", {"cause_of_death_non_coded": "string"}))
    p = enrich.decode(
        p, person, "patient_id", "person_id",
        {"gender": "gender", "birthdate": "birthdate", "_dead": "dead", "_died": "death_date", "_cause": "cause_of_death", "_cause_text": "cause_of_death_non_coded"},
    )
    p = c.with_concept_name(p, "_cause", "_cause_name", "en")
    p = enrich.decode(p, c.names(), "patient_id", "person_id", {"given_name": "given_name", "family_name": "family_name", "nickname": "middle_name"})
    p = c.with_address(
        p,
        {"address": "address2", "street_landmark": "address2", "department": "state_province", "commune": "city_village",
         "section_communal": "address3", "locality": "address1"},
    )
    p = staged(p, "hiv-patient")
    for name, e in (("initial_enrollment_location", c.first_enrolment(HIV)), ("latest_enrollment_location", c.last_enrolment(HIV))):
        p = enrich.decode(p, c.with_place(e, "_place"), "patient_id", "patient_id", {name: "_place"})
    told = {n: text(q) for n, q in BIRTHPLACE.items()} | {"marital_status": coded("CIVIL STATUS"), "occupation": coded("Occupation")}
    p = c.with_answers(p, told, "patient_id", c.live("obs"), "person_id")
    p = staged(p, "hiv-patient")
    reg = latest.top1(c.registrations_all(), ["patient_id"], ["encounter_datetime", "encounter_id"])
    reg = c.with_user(reg).withColumn("_day", F.to_date("encounter_datetime"))
    p = enrich.decode(p, reg, "patient_id", "patient_id", {"patient_registration_date": "_day", "user_entered": "user_entered"})
    told = c.attribute_values(
        {"mothers_first_name": ("name", "First Name of Mother"), "telephone_number": ("name", "Telephone Number"), "_hc": ("uuid", HEALTH_CENTER_ATTRIBUTE)}
    )
    places = c.table("location").select(F.col("location_id").cast("string").alias("_lid"), "name")
    told = enrich.decode(told, places, "_hc", "_lid", {"health_center": "name"})
    p = enrich.decode(p, told, "patient_id", "person_id", {n: n for n in ("mothers_first_name", "telephone_number", "health_center")})
    p = staged(p, "hiv-patient")

    intakes = c.encounters([INTAKE], "name").select("encounter_id", "patient_id", "encounter_datetime")
    groups = c.obs(*KEY_POPULATIONS.values()).join(intakes.select("encounter_id", F.to_date("encounter_datetime").alias("_day")), "encounter_id")
    groups = c.with_concept_name(groups, "value_coded", "_name", "en")
    keys = {n: Answer(c.is_code("concept_id", q), F.col("_name"), order=("_day", "obs_id")) for n, q in KEY_POPULATIONS.items()}
    p = p.join(pivot(groups, ["person_id"], keys).withColumnRenamed("person_id", "patient_id"), "patient_id", "left")

    orphans = c.encounters([ORPHAN], "name").select("encounter_id")
    contact = c.obs(CONTACT).join(orphans, "encounter_id", "left_semi").groupBy("person_id").agg(F.max("obs_id").alias("_contact"))
    spec = {"parent_firstname": text("FIRST NAME"), "parent_lastname": text("LAST NAME"), "parent_relationship": coded("RELATIONSHIP OF RELATIVE TO PATIENT")}
    contact = _group_answers(c, contact, spec, "_contact").drop("_contact").withColumnRenamed("person_id", "patient_id")
    p = p.join(contact, "patient_id", "left").join(partner_status(c), "patient_id", "left")
    p = staged(p, "hiv-patient")

    for kind, spec in ((SOCIAL, HOUSEHOLD), (INTAKE, HABITS)):
        e = c.encounters([kind], "name").select("encounter_id", "patient_id")
        last = e.groupBy("patient_id").agg(F.max("encounter_id").alias("encounter_id"))
        p = p.join(c.with_answers(last, spec, within=e).drop("encounter_id"), "patient_id", "left")
    p = staged(p, "hiv-patient")
    at = c.live("encounter").select("encounter_id", F.to_date("encounter_datetime").alias("_at"))
    for name, question in MEASURES.items():
        o = c.obs(question)
        last = latest.top1(o, ["person_id"], ["-encounter_id", "-date_created", "-obs_id"])
        last = last.select("person_id", "encounter_id", F.col("value_numeric").alias("_value")).join(at, "encounter_id", "left")
        p = enrich.decode(p, last, "patient_id", "person_id", {f"last_{name}": "_value", f"last_{name}_date": "_at"})
    p = staged(p, "hiv-patient")

    care = c.encounters([INTAKE, FOLLOWUP], "name").select("encounter_id", "patient_id", "encounter_datetime")
    seen = care.groupBy("patient_id").agg(F.max("encounter_datetime").alias("_seen"))
    due = c.obs("RETURN VISIT DATE").join(care.select("encounter_id"), "encounter_id", "left_semi").groupBy("person_id").agg(F.max("value_datetime").alias("_due"))
    found = c.obs("CIEL:164400").groupBy("person_id").agg(F.to_date(F.min("value_datetime")).alias("hiv_diagnosis_date"))
    p = p.join(seen, "patient_id", "left")
    for df in (due, found):
        p = p.join(df.withColumnRenamed("person_id", "patient_id"), "patient_id", "left")
    p = staged(p, "hiv-patient")

    pickups = c.encounters([PICKUP], "name").select("encounter_id", "patient_id", "encounter_datetime")
    real = pickups.join(c.obs(DISPENSED).select("encounter_id"), "encounter_id", "left_semi").select("patient_id").distinct()
    last = latest.top1(pickups.join(real, "patient_id", "left_semi"), ["patient_id"], ["-encounter_datetime", "-encounter_id"])
    last = c.with_answers(
        last,
        {"last_pickup_months_dispensed": num("3102"), "last_pickup_treatment_line": listed("CIEL:166073"), "_next": date("CIEL:5096"), "agent": text("CIEL:164141")},
        within=pickups,
    ).select("patient_id", F.to_date("encounter_datetime").alias("last_pickup_date"), F.to_date("_next").alias("next_pickup_date"), "last_pickup_months_dispensed", "last_pickup_treatment_line", "agent")
    p = p.join(last, "patient_id", "left").join(art_dispensing(c, pickups), "patient_id", "left").join(art_orders(c), "patient_id", "left")
    p = staged(p, "hiv-patient")

    prints = c.with_user(c.identifiers("biometrics")).select(
        "patient_id", F.col("identifier").alias("latest_biometrics_reference_code"), F.col("date_created").alias("latest_biometrics_collection_date"),
        F.col("user_entered").alias("biometrics_collector"),
    )
    p = p.join(prints, "patient_id", "left")
    moved = c.live("patient_program").filter(c.is_code("outcome_concept_id", TRANSFERRED))
    moved = c.with_place(latest.top1(moved, ["patient_id"], ["-date_enrolled", "-patient_program_id"]), "transfer_from_location")
    p = p.join(moved.select("patient_id", "transfer_from_location", F.to_date("date_completed").alias("transfer_from_date")), "patient_id", "left")

    dispensed, ordered = F.to_date("art_dispensing_start_date"), F.col("art_order_start_date")
    by_order = F.coalesce(ordered <= F.col("art_dispensing_start_date"), F.lit(False))
    started = F.when(by_order, ordered).otherwise(dispensed)
    late = lambda d: F.greatest(F.coalesce(complete_days(d, now), F.lit(0)), F.lit(0)).cast("double")
    dead = F.coalesce(F.col("_dead"), F.lit(False))
    p = p.withColumns({n: F.rint(n).cast("int") for n in WHOLE})
    return p.select(
        "emr_id", "hivemr_v1_id", "hiv_dossier_id", "given_name", "family_name", "nickname", "gender", "birthdate",
        age_tenths(F.col("birthdate"), F.lit(c.as_of).cast("date")).alias("age"), *BIRTHPLACE, "patient_registration_date", "user_entered",
        "initial_enrollment_location", "latest_enrollment_location", "marital_status", "occupation", "agent", "mothers_first_name", "telephone_number",
        "health_center", "address", "department", "commune", "section_communal", "locality", "street_landmark", F.when(dead, "Y").alias("dead"),
        F.when(dead, F.to_date("_died")).alias("death_date"), F.when(dead, F.col("_cause_name")).alias("cause_of_death"),
        F.when(dead, F.col("_cause_text")).alias("cause_of_death_non_coded"), *KEY_POPULATIONS, "parent_firstname", "parent_lastname",
        "parent_relationship", "partner_hiv_status", *HOUSEHOLD, none.alias("socio_transport_walking_time"), *HABITS, "last_weight", "last_weight_date",
        "last_height", "last_height_date", F.to_date("_seen").alias("last_visit_date"), F.to_date("_due").alias("next_visit_date"),
        late(F.col("_due")).alias("days_late_to_visit"), "hiv_diagnosis_date", dispensed.alias("art_dispensing_start_date"),
        "first_art_dispensing_regimen", "art_order_start_date", "initial_art_regimen_order", started.alias("art_start_date"),
        complete_months(started, now).cast("double").alias("months_on_art"),
        F.when(by_order, F.col("initial_art_regimen_order")).otherwise(F.col("first_art_dispensing_regimen")).alias("initial_art_regimen"), "art_regimen",
        "last_pickup_date", "last_pickup_months_dispensed", "last_pickup_treatment_line", "next_pickup_date",
        late(F.col("next_pickup_date")).alias("days_late_to_pickup"), F.col("latest_biometrics_reference_code").isNotNull().alias("biometrics_collected"),
        "latest_biometrics_collection_date", "biometrics_collector", "latest_biometrics_reference_code", "transfer_from_location", "transfer_from_date",
    )
