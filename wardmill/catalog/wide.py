"""Extracts with repeating groups on the driver clinic, each with a hand-written twin."""

from __future__ import annotations

from wardmill.catalog.clinic_tables import Dictionary
from wardmill.catalog.extracts import ADDRESS, AS_OF, attribute, identifier, registered, years
from wardmill.catalog.programs import GRP, TESTP, _list
from wardmill.catalog.records import EMR, ET, FAC, HC, PR, K, U, V, _last, extract
from wardmill.plans.extract import maternal as M, wide as X
from wardmill.plans.extract.clinic import IDENTIFIER_TYPES, REGISTRATION
from wardmill.plans.extract.forms import ECHO
from wardmill.plans.extract.programs import DELIVERY, HIV, MATERNAL, OBGYN

DOSSIER = f"LEFT JOIN {identifier('dossier')} dossier ON dossier.patient_id = e.patient_id"
OBS = "FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided"


def _enrolment(program_id: int = 1) -> str:
    return f"""(SELECT p.patient_program_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = {program_id} AND p.patient_id = e.patient_id AND CAST(p.date_enrolled AS DATE) <= CAST(e.encounter_datetime AS DATE)
      AND (CAST(p.date_completed AS DATE) >= CAST(e.encounter_datetime AS DATE) OR p.date_completed IS NULL) ORDER BY CAST(p.date_enrolled AS DATE) DESC, p.patient_program_id DESC LIMIT 1)"""


def _most(value: str, code: str) -> str:
    return f"max({value}) FILTER (o.concept_id = {{{code}}})"


def _pair(code: str, yes: str = "1065", no: str = "1066") -> str:
    return f"bool_or(CASE o.value_coded WHEN {{{yes}}} THEN TRUE WHEN {{{no}}} THEN FALSE END) FILTER (o.concept_id = {{{code}}})"


def _mark(code: str, answer: str) -> str:
    return f"CAST(max(1) FILTER (o.concept_id = {{{code}}} AND o.value_coded = {{{answer}}}) AS INTEGER)"


def _said(code: str, answer: str) -> str:
    return f"max(o.comments) FILTER (o.concept_id = {{{code}}} AND o.value_coded = {{{answer}}})"


def _columns(parts: dict[str, str]) -> str:
    return ", ".join(f'{v} AS "{n}"' for n, v in parts.items())


DELIVERY_SQL = {
    "delivery_datetime": _most("o.value_datetime", "5599"), "partogram_completed": _pair("13964"), "dystocia": _most("nm.name", "CIEL:163449"),
    "prolapsed_cord": _pair("CIEL:113617"), "late_cord_clamping": _pair("CIEL:163450"), "placenta_delivery": _most("nm.name", "13550"),
    "AMTSL": _pair("CIEL:163452"), "Placenta_completeness": _most("nm.name", "CIEL:163454"),
    "Intact_membranes": _pair("CIEL:164900", "CIEL:164899", "CIEL:127244"), "Retained_placenta": _pair("CIEL:127592"),
    "Perineal_laceration": _pair("CIEL:114244"), "Postpartum_blood_loss": _most("nm.name", "CIEL:162092"), "Transfusion": _pair("CIEL:1063"),
    "maternal_delivery_type_deprecated": _list("11663"), **{n: _mark("3064", a) for n, a in X.DELIVERY_MARKS.items()},
    **{n: _mark("CIEL:1651", a) for n, a in X.DELIVERY_PROCEDURES.items()}, "mom_Other_finding_details": _said("6644", "5622"),
    "Mental_health_assessment": _list("10594"), "number_prenatal_visits": f"CAST({_most('o.value_numeric', 'CIEL:1590')} AS INTEGER)",
    "referred_by": _list("10635"), "referred_by_other_details": _said("10635", "5622"), "nutrition_newborn_counseling": _pair("CIEL:161651"),
    "family_planning_after_delivery": _pair("13564"), "disposition": _most("nm.name", "8620"),
    "disposition_comment": _most("o.value_text", "DISPOSITION COMMENTS"), "return_visit_date": _most("o.value_datetime", "5096"),
}
BIRTH_SQL = {
    "outcome": _most("nm.name", "CIEL:161033"), "weight": _most("o.value_numeric", "CIEL:5916"),
    "APGAR_5_minute": f"CAST({_most('o.value_numeric', 'CIEL:1504')} AS INTEGER)", "APGAR_1_minute": f"CAST({_most('o.value_numeric', '14419')} AS INTEGER)",
    "APGAR_10_minute": f"CAST({_most('o.value_numeric', '14785')} AS INTEGER)", "neonatal_resuscitation": _pair("CIEL:162131"),
    "macerated_fetus": _pair("CIEL:135437"),
}
DIAGNOSIS_SQL = {"": _last("nm.name", "3064"), "_confirmed": _last("nm.name", "1379"), "_primary": f"CAST({_last('o.value_coded', '7537')} = {{7534}} AS INTEGER)"}


def _slots(name: str, columns: dict[str, str], head: str, order: str, slots: int, pattern: str) -> str:
    """CTE ``name``: per encounter the first groups under a head, side by side."""
    wide = ", ".join(f"""any_value("{n}x") FILTER (r = {i}) AS "{pattern.format(i=i, n=n)}" """ for i in range(1, slots + 1) for n in columns)
    inner = ", ".join(f'{v} AS "{n}x"' for n, v in columns.items())
    return f"""{name}_g AS (SELECT obs_group_id, {inner} {GRP}),
    {name} AS (SELECT h.encounter_id, {wide} FROM (SELECT encounter_id, obs_id, row_number() OVER (PARTITION BY encounter_id ORDER BY {order}) AS r FROM c_obs WHERE NOT voided AND concept_id = {{{head}}}) h
      LEFT JOIN {name}_g g ON g.obs_group_id = h.obs_id WHERE r <= {slots} GROUP BY 1)"""


BIRTHS = _slots("births", BIRTH_SQL, "CIEL:1585", "date_created DESC, obs_id DESC", 4, "Birth_{i}_{n}")
DIAGNOSES = _slots("dx", DIAGNOSIS_SQL, "7539", "obs_id", 10, "diagnosis_{i}{n}")
DLQ = [q.code for q in (*X.DELIVERY_ANSWERS.values(), *X.BIRTH_ANSWERS.values(), *X.DIAGNOSIS_ANSWERS.values())] + ["CIEL:1585", "7539"]
DLA = [*X.DELIVERY_MARKS.values(), *X.DELIVERY_PROCEDURES.values(), "CIEL:164899", "CIEL:127244", "5622", "7534"]
extract(
    "mch_delivery",
    "X48 R24 R25 R41 R18",
    Dictionary(DLQ, DLA, [DELIVERY, "t-2"], programs=[MATERNAL, "p-2"]),
    f""", oa AS (SELECT o.encounter_id, {_columns(DELIVERY_SQL)} {OBS} GROUP BY 1), {BIRTHS}, {DIAGNOSES},
    oh AS (SELECT x.encounter_id, s.c AS details FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY obs_datetime DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND value_coded = {{CIEL:150802}}) x
      JOIN (SELECT obs_group_id, max(comments) AS c FROM c_obs WHERE NOT voided AND concept_id = {{3064}} GROUP BY 1) s ON s.obs_group_id = x.obs_group_id WHERE x.r = 1)
    SELECT dossier.identifier AS "dossierId", emr.identifier AS emr_id, reg.name AS loc_registered, {K}{_enrolment()} AS mch_program_id, e.encounter_datetime, el.location_name AS encounter_location, {FAC} AS facility,
      {K}e.visit_id AS visit_id, vl.name AS visit_location, et.name AS encounter_type, e.date_created AS date_entered, prov.person_name AS provider, {K}e.encounter_id AS encounter_id, oh.details AS "Other_hemorrhage_details",
      oa.* EXCLUDE (encounter_id), births.* EXCLUDE (encounter_id), dx.* EXCLUDE (encounter_id)
    FROM c_encounter e {V} {ET} {EMR} {DOSSIER} {PR} LEFT JOIN {registered(None)} reg ON reg.patient_id = e.patient_id LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN births ON births.encounter_id = e.encounter_id
      LEFT JOIN dx ON dx.encounter_id = e.encounter_id LEFT JOIN oh ON oh.encounter_id = e.encounter_id
    WHERE NOT e.voided AND e.encounter_type = 1""",
    X.mch_delivery,
    "patient_program program",
)

# answers whose names hold the words that the classes of change look for
LVSF = ["lvsf normal", "lvsf very low", "lvsf mildly depressed", "lvsf impossible to evaluate"]
ECQ = [X.FUNCTION, X.NYHA, X.SYSTOLIC, X.DIASTOLIC, X.MEDICINE, *dict.fromkeys(q for q, _ in X.EVER.values())]
MEMBERS = ["6691", "6692", "12228", "11943", "12227", "12251", "sugar subset"]
ECA = [*LVSF, *[a for _, a in X.EVER.values()], *[a for m in (X.MEDICINES, X.COMORBIDITIES, X.DIABETES) for codes in m.values() for a in codes], "sugar subset", "sugar low", X.DIABETES_SET]
EVER_SQL = {n: f"bool_or(o.concept_id = {{{q}}} AND o.value_coded = {{{a}}})" for n, (q, a) in X.EVER.items()}
EVER_SQL |= {n: f"bool_or(d.encounter_id IS NOT NULL AND o.concept_id = {{1282}} AND o.value_coded IN ({', '.join('{' + a + '}' for a in codes)}))" for n, codes in X.MEDICINES.items()}
EVER_SQL |= {n: f"bool_or(o.value_coded IN ({', '.join('{' + a + '}' for a in codes)}))" for n, codes in X.COMORBIDITIES.items()}
DM = {n: f"value_coded IN ({', '.join('{' + a + '}' for a in codes)})" for n, codes in X.DIABETES.items()}
SICK = " OR ".join(f"coalesce({n}, FALSE)" for n in (*X.DIABETES, *X.COMORBIDITIES))
extract(
    "echo_summary_table",
    "X30 R15 R60 R38 R39",
    Dictionary(ECQ, ECA, [ECHO, X.DISPENSING], sets=[(X.DIABETES_SET, m) for m in MEMBERS] + [("sugar subset", "sugar low")]),
    f""", en AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r, count(*) OVER (PARTITION BY patient_id) AS n FROM c_encounter WHERE NOT voided AND encounter_type = 1),
    oa AS (SELECT o.encounter_id, {_list("11994")} AS lvsf, {_list("3139")} AS nyha, CAST({_last("o.value_numeric", "5085")} AS INTEGER) AS sys, CAST({_last("o.value_numeric", "5086")} AS INTEGER) AS dia {OBS} GROUP BY 1),
    ev AS (SELECT o.person_id, {_columns(EVER_SQL)} FROM c_obs o LEFT JOIN c_encounter d ON d.encounter_id = o.encounter_id AND NOT d.voided AND d.encounter_type = 2 WHERE NOT o.voided GROUP BY 1),
    dm AS (SELECT person_id, {_columns(DM)} FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY date_created DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND concept_id = {{3064}} AND value_coded IN
      (SELECT a.concept_id FROM c_concept_set a WHERE a.concept_set = {{11501}} UNION SELECT b.concept_id FROM c_concept_set a JOIN c_concept_set b ON b.concept_set = a.concept_id WHERE a.concept_set = {{11501}})) WHERE r = 1)
    SELECT e.patient_id, emr.identifier AS emrid, {years("p.birthdate", "e.encounter_datetime")} AS age, p.gender AS sex, ad.state_province AS department, ad.city_village AS commune, ad.address3 AS section_communal, ad.address1 AS locality,
      CAST(e.encounter_datetime AS DATE) AS echo_date_most_recent, CAST(b.encounter_datetime AS DATE) AS echo_date_prior, CAST(e.n AS INTEGER) AS total_echos, x.lvsf AS lvsf_most_recent, y.lvsf AS lvsf_prior,
      CASE WHEN x.lvsf IS NULL OR y.lvsf IS NULL THEN 'Not Available' WHEN x.lvsf ILIKE '%impossible%' OR y.lvsf ILIKE '%impossible%' THEN 'Impossible to evaluate' WHEN x.lvsf = y.lvsf THEN 'No Change'
        WHEN x.lvsf ILIKE '%normal%' AND y.lvsf ILIKE '%very%low%' OR x.lvsf ILIKE '%normal%' AND y.lvsf ILIKE '%mildly%depressed%' OR x.lvsf ILIKE '%mildly%depressed%' AND y.lvsf ILIKE '%very%low%' THEN 'Improved'
        WHEN x.lvsf ILIKE '%very%low%' AND y.lvsf ILIKE '%normal%' OR x.lvsf ILIKE '%mildly%depressed%' AND y.lvsf ILIKE '%normal%' OR x.lvsf ILIKE '%very%low%' AND y.lvsf ILIKE '%mildly%depressed%' THEN 'Reduced' END AS lvsf_change,
      x.nyha AS nyha_class_most_recent, {", ".join(f"coalesce(ev.{n}, FALSE) AS {n}" for n in EVER_SQL)}, coalesce(date_diff('month', b.encounter_datetime, e.encounter_datetime) < 24, FALSE) AS follow_up_echo,
      x.sys AS bp_systolic_most_recent, x.dia AS bp_diastolic_most_recent, {SICK} AS ncd_comorbidity, {", ".join(f"coalesce(dm.{n}, FALSE) AS {n}" for n in DM)}
    FROM en e {EMR} LEFT JOIN c_person p ON p.person_id = e.patient_id AND NOT p.voided LEFT JOIN {ADDRESS} ad ON ad.person_id = e.patient_id LEFT JOIN en b ON b.patient_id = e.patient_id AND b.r = 2
      LEFT JOIN oa x ON x.encounter_id = e.encounter_id LEFT JOIN oa y ON y.encounter_id = b.encounter_id LEFT JOIN ev ON ev.person_id = e.patient_id LEFT JOIN dm ON dm.person_id = e.patient_id
    WHERE e.r = 1""",
    X.echo_summary_table,
    "concept_set report_mapping",
)


def _asked(code: str) -> str:
    return f"CAST(max(1) FILTER (o.concept_id = {{{code}}}) AS INTEGER)"


def _day(code: str) -> str:
    return f"CAST({_last('o.value_datetime', code)} AS DATE)"


def _comment(code: str, answer: str) -> str:
    return f"last(o.comments ORDER BY o.date_created, o.obs_id) FILTER (o.concept_id = {{{code}}} AND o.value_coded = {{{answer}}})"


FP = "METHOD OF FAMILY PLANNING"
VISIT_SQL = {
    "visit_type": _last("nm.name", "CIEL:164181"), "consultation_type": _last("nm.name", "Type of HUM visit"), "consultation_type_fp": _last("nm.name", "REASON FOR VISIT"),
    "pregnant": _mark("8879", "ANC VISIT"), "breastfeeding": f"CASE WHEN {_mark(FP, 'CIEL:136163')} = 1 THEN 'Yes' END", "pregnant_lmp": _day("DATE OF LAST MENSTRUAL PERIOD"),
    "pregnant_edd": _day("ESTIMATED DATE OF CONFINEMENT"), "next_visit_date": _day("RETURN VISIT DATE"), "triage_level": _last("nm.name", "Triage color classification"),
    "referral_type": _list("Type of referring service"), "referral_type_other": _comment("Type of referring service", "OTHER"), "referred_from_facility": _last("pl.name", "CIEL:160535"),
    "implant_inserted": _mark(FP, "CIEL:1873"), "IUD_inserted": _mark(FP, "INTRAUTERINE DEVICE"), "tubal_ligation_completed": _mark(FP, "TUBAL LIGATION"), "gyno_exam": _asked("13229"),
    "wh_exam": f"coalesce({', '.join(_asked(q) for q in ('CIEL:1439', 'CIEL:160090', 'CIEL:163749', 'CIEL:1440', 'CIEL:163750', 'CIEL:160968'))})", "pap_test_performed": _mark("11319", "1267"),
    "via": _last("nm.name", "9759"), "hiv_test_admin": f"CASE {_last('o.value_coded', 'HIV test done')} WHEN {{1065}} THEN TRUE WHEN {{1066}} THEN FALSE END", "hiv_test_date": _day("CIEL:164400"),
    "hiv_test_result": _list("CIEL:159427"), "received_post_test_counseling": _list("CIEL:159382"), "post_test_counseling_date": _day("CIEL:11525"), "cervical_cancer_screening_date": _day("CIEL:165429"),
    "cervical_cancer_screening_result": _mark("CIEL:163560", "CIEL:151185"), "diagnosis_non_coded": _last("o.value_text", "Diagnosis or problem, non-coded"), "procedures": _list("CIEL:1651"),
    "procedures_other": _last("o.value_text", "CIEL:165264"), "family_planning_use": _mark("CIEL:965", "1065"), "family_planning_patient_type": _last("nm.name", "14321"),
    "_planning": _last("o.obs_id", "Family planning construct"), "fp_counseling_received": f"CASE WHEN {_last('nm.name', 'CIEL:165309')} ILIKE '%Family planning counseling%' THEN 1 END",
    "fp_start_date": _day("11466"), "fp_end_date": _day("11465"), "implant_date": _day("3203"), "condoms_provided": _last("nm.name", "13006"), "number_of_condoms": f"CAST({_last('o.value_numeric', '20151')} AS INTEGER)",
    "location_of_delivery": _last("nm.name", "11348"), "delivery_datetime": _last("o.value_datetime", "CIEL:5599"), "risk_factors": _list("CIEL:160079"), "sti_treatment": _mark("CIEL:160742", "CIEL:167125"),
    "syphilis_treatment_status": f"CASE WHEN {_last('o.value_coded', '13024')} = {{1267}} THEN 'Stopped' ELSE {_last('nm.name', '13024')} END",
    **{n: _mark("14365", a) for n, a in X.SUSPECTED_STI.items()},
}
DOSE = ", ".join(
    f"CAST(max(given) FILTER (vaccine = {{{codes[0]}}}{'' if v == 'bcg' else f' AND dose = {d}'}) AS DATE) AS {M.dose_column(v, d)}" for v, (codes, nums) in M.VACCINES.items() for d in nums
)
MVQ = list(dict.fromkeys([q.code for q in X.VISIT_ANSWERS.values()] + [M.VACCINATIONS, M.SEQUENCE, M.VACCINE_DATE, "DIAGNOSIS", "Diagnosis order", "Visit Diagnoses", X.HISTORY_GROUP]))
MVA = [a for q in X.VISIT_ANSWERS.values() if isinstance(a := q.answer, str)] + [c for codes, _ in M.VACCINES.values() for c in codes] + ["primary", "secondary", "Family planning counseling", "sti a", "sti b", X.STI_QUESTION]
NI4 = ", ".join(f"CAST(NULL AS INTEGER) AS {n}" for n in ("abortion_completed", "index_patient_asc", "index_patient_desc", "index_type_asc", "index_type_desc"))
extract(
    "mch_visit",
    "X55 R21 R24 R25 R41 F11",
    Dictionary(MVQ, MVA, [OBGYN, "t-2"], programs=[MATERNAL, "p-2"], offered=[(X.STI_QUESTION, "sti a"), (X.STI_QUESTION, "sti b"), (X.STI_QUESTION, "primary")]),
    f""", lc AS (SELECT CAST(location_id AS VARCHAR) AS lid, name FROM c_location),
    oa AS (SELECT o.encounter_id, {_columns(VISIT_SQL)} FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN lc pl ON pl.lid = o.value_text WHERE NOT voided GROUP BY 1),
    vg AS (SELECT obs_group_id, max(encounter_id) FILTER (concept_id = {{{M.VACCINATIONS}}}) AS encounter_id, max(value_coded) FILTER (concept_id = {{{M.VACCINATIONS}}}) AS vaccine, max(value_numeric) FILTER (concept_id = {{{M.SEQUENCE}}}) AS dose,
      max(value_datetime) FILTER (concept_id = {{{M.VACCINE_DATE}}}) AS given FROM c_obs WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1),
    vd AS (SELECT encounter_id, {DOSE} FROM vg WHERE encounter_id IS NOT NULL GROUP BY 1),
    hd AS (SELECT DISTINCT encounter_id FROM c_obs WHERE NOT voided AND concept_id = {{Visit Diagnoses}}),
    pd AS (SELECT o.encounter_id, string_agg(DISTINCT nm.name, ' | ' ORDER BY nm.name) FILTER (EXISTS (SELECT 1 FROM c_obs g WHERE NOT g.voided AND g.obs_group_id = o.obs_group_id AND g.concept_id = {{Diagnosis order}} AND g.value_coded = {{primary}})) AS primary_diagnosis,
      string_agg(DISTINCT nm.name, ' | ' ORDER BY nm.name) FILTER (EXISTS (SELECT 1 FROM c_obs g WHERE NOT g.voided AND g.obs_group_id = o.obs_group_id AND g.concept_id = {{Diagnosis order}} AND g.value_coded = {{secondary}})) AS secondary_diagnosis
      {OBS} AND o.concept_id = {{DIAGNOSIS}} AND o.encounter_id IN (SELECT encounter_id FROM hd) GROUP BY 1),
    ph AS (SELECT o.encounter_id, string_agg(DISTINCT nm.name, ' | ' ORDER BY nm.name) AS previous_history {OBS} AND o.obs_group_id IN (SELECT obs_id FROM c_obs WHERE NOT voided AND concept_id = {{CIEL:1633}}) GROUP BY 1),
    st AS (SELECT o.encounter_id, string_agg(DISTINCT nm.name, ' | ' ORDER BY nm.name) AS other_sti {OBS} AND o.concept_id = {{DIAGNOSIS}} AND o.value_coded IN (SELECT answer_concept FROM c_concept_answer WHERE concept_id = {{13076}}) GROUP BY 1),
    fm AS (SELECT o.obs_group_id, {_last("nm.name", FP)} AS family_planning_method {GRP}),
    mo AS (SELECT o.encounter_id, o.patient_id, string_agg(DISTINCT nm.name, ' | ' ORDER BY nm.name) AS medication_order FROM c_orders o LEFT JOIN nm ON nm.concept_id = o.concept_id WHERE NOT o.voided GROUP BY 1, 2)
    SELECT emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, {K}{_enrolment()} AS mch_program_id, CAST(e.encounter_datetime AS DATE) AS visit_date, el.location_name AS encounter_location, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location,
      CAST({years("p.birthdate", "e.encounter_datetime")} AS DOUBLE) AS age_at_visit, e.date_created AS date_entered, cu.person_name AS user_entered, prov.person_name AS examining_doctor, oa.* EXCLUDE (encounter_id, _planning), vd.* EXCLUDE (encounter_id),
      pd.primary_diagnosis, pd.secondary_diagnosis, ph.previous_history, st.other_sti, fm.family_planning_method, mo.medication_order, {NI4}
    FROM c_encounter e {V} {EMR} {U} {PR} LEFT JOIN c_person p ON p.person_id = e.patient_id AND NOT p.voided LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN vd ON vd.encounter_id = e.encounter_id LEFT JOIN pd ON pd.encounter_id = e.encounter_id
      LEFT JOIN ph ON ph.encounter_id = e.encounter_id LEFT JOIN st ON st.encounter_id = e.encounter_id LEFT JOIN fm ON fm.obs_group_id = oa._planning LEFT JOIN mo ON mo.encounter_id = e.encounter_id AND mo.patient_id = e.patient_id
    WHERE NOT e.voided AND e.encounter_type = 1 AND EXISTS (SELECT 1 FROM c_obs h WHERE NOT h.voided AND h.encounter_id = e.encounter_id) AND {TESTP}""",
    X.mch_visit,
    "patient_program program orders concept_answer",
)


def _identifiers(kind: str) -> str:
    i = list(IDENTIFIER_TYPES).index(kind) + 1
    return f"(SELECT patient_id, string_agg(DISTINCT identifier, ',' ORDER BY identifier) AS ids FROM c_patient_identifier WHERE NOT voided AND identifier_type = {i} GROUP BY 1)"


TYPES = [X.INTAKE, X.FOLLOWUP, X.PICKUP, X.ORPHAN, X.SOCIAL]
T = {t: i for i, t in enumerate(TYPES, 1)}
HPQ = list(dict.fromkeys([
    *X.BIRTHPLACE.values(), "CIVIL STATUS", "Occupation", *X.KEY_POPULATIONS.values(), X.CONTACT, "FIRST NAME", "LAST NAME", "RELATIONSHIP OF RELATIVE TO PATIENT", X.PARTNER, X.CONTACT_KIND, X.CONTACT_RESULT,
    *[q.code for q in (*X.HOUSEHOLD.values(), *X.HABITS.values())], *X.MEASURES.values(), "RETURN VISIT DATE", "CIEL:164400", X.DISPENSED, X.MEDICINE, "3102", "CIEL:166073", "CIEL:5096", "CIEL:164141",
]))
HPA = [*X.ARVS, X.ART_REASON, X.PARTNER_POSITIVE, X.POSITIVE, X.SPOUSE, X.TRANSFERRED, "OTHER"]
HOME_SQL = {n: _list(q.code) if q.kind == "list" else f"CAST({_last('o.value_numeric', q.code)} AS INTEGER)" for n, q in X.HOUSEHOLD.items()}
HABIT_SQL = {
    "socio_smoker": _last("nm.name", "HISTORY OF TOBACCO USE"), "socio_smoker_years": _last("o.value_numeric", "CIEL:159931"), "socio_smoker_cigarette_per_day": f"CAST({_last('o.value_numeric', '11949')} AS INTEGER)",
    "socio_alcohol": _last("nm.name", "HISTORY OF ALCOHOL USE"), "socio_alcohol_type": _comment("3342", "OTHER"), "socio_alcohol_drinks_per_day": f"CAST({_last('o.value_numeric', 'ALCOHOLIC DRINKS PER DAY')} AS INTEGER)",
    "socio_alcohol_days_per_week": f"CAST({_last('o.value_numeric', 'NUMBER OF DAYS PER WEEK ALCOHOL IS USED')} AS INTEGER)",
}
POPULATION_SQL = {n: f"last(nm.name ORDER BY CAST(e.encounter_datetime AS DATE), o.obs_id) FILTER (o.concept_id = {{{q}}} AND nm.name IS NOT NULL)" for n, q in X.KEY_POPULATIONS.items()}
PERSON_SQL = {n: _last("o.value_text", q) for n, q in X.BIRTHPLACE.items()} | {"marital_status": _last("nm.name", "CIVIL STATUS"), "occupation": _last("nm.name", "Occupation")}
PARENT_SQL = {"parent_firstname": _last("o.value_text", "FIRST NAME"), "parent_lastname": _last("o.value_text", "LAST NAME"), "parent_relationship": _last("nm.name", "RELATIONSHIP OF RELATIVE TO PATIENT")}
PICKUP_SQL = {"last_pickup_months_dispensed": _last("o.value_numeric", "3102"), "last_pickup_treatment_line": _list("CIEL:166073"), "next_pickup_date": _day("CIEL:5096"), "agent": _last("o.value_text", "CIEL:164141")}


def _newest(types: tuple[str, ...], columns: str = "max(encounter_id) AS encounter_id") -> str:
    return f"(SELECT patient_id, {columns} FROM c_encounter WHERE NOT voided AND encounter_type IN ({', '.join(str(T[t]) for t in types)}) GROUP BY 1)"


def _measure(name: str, question: str) -> str:
    return f"""{name} AS (SELECT x.person_id, x.value_numeric AS value, CAST(e.encounter_datetime AS DATE) AS day FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY encounter_id DESC, date_created DESC, obs_id DESC) AS r FROM c_obs
      WHERE NOT voided AND concept_id = {{{question}}}) x LEFT JOIN c_encounter e ON e.encounter_id = x.encounter_id AND NOT e.voided WHERE r = 1)"""


def _place(order: str) -> str:
    return f"(SELECT l.name FROM c_patient_program pp LEFT JOIN c_location l ON l.location_id = pp.location_id WHERE NOT pp.voided AND pp.program_id = 1 AND pp.patient_id = p.patient_id ORDER BY {order} LIMIT 1)"


ARV_SQL = ", ".join(f"max(obs_datetime) FILTER (value_coded = {{{a}}}) AS d{i}, max(drugs) FILTER (value_coded = {{{a}}}) AS m{i}" for i, a in enumerate(X.ARVS))
REG = f"(SELECT min(encounter_type_id) FROM c_encounter_type WHERE uuid = '{REGISTRATION}')"
LATE = f"CAST(greatest(coalesce(date_sub('day', {{}}, TIMESTAMP '{AS_OF} 00:00:00'), 0), 0) AS DOUBLE)"
extract(
    "hiv_patient",
    "X36 R2 R5 R25 R29 R48 R54 R58 F4 F16 F19",
    Dictionary(HPQ, HPA, TYPES, "name", programs=[HIV, "p-2"]),
    f""", oa AS (SELECT o.encounter_id, {_columns(HOME_SQL | HABIT_SQL | PICKUP_SQL)} {OBS} GROUP BY 1), op AS (SELECT o.person_id, {_columns(PERSON_SQL)} {OBS} GROUP BY 1),
    kp AS (SELECT o.person_id, {_columns(POPULATION_SQL)} FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = {T[X.INTAKE]} LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT o.voided GROUP BY 1),
    cg AS (SELECT o.obs_group_id, {_columns(PARENT_SQL)} {GRP}),
    ct AS (SELECT o.person_id, max(o.obs_id) AS head FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = {T[X.ORPHAN]} WHERE NOT o.voided AND o.concept_id = {{Contact construct}} GROUP BY 1),
    ps AS (SELECT person_id, obs_datetime, obs_id, CASE WHEN value_coded = {{PARTNER CONFIRMED HIV+}} THEN {{POSITIVE}} ELSE value_coded END AS c FROM c_obs WHERE NOT voided AND concept_id = {{CIEL:1436}}
      UNION ALL SELECT person_id, obs_datetime, obs_id, value_coded FROM c_obs WHERE NOT voided AND concept_id = {{2169}} AND obs_group_id IN (SELECT obs_group_id FROM c_obs WHERE NOT voided AND concept_id = {{13265}} AND value_coded = {{5617}})),
    pa AS (SELECT person_id, nm.name AS status FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY obs_datetime DESC, obs_id DESC) AS r FROM ps) x LEFT JOIN nm ON nm.concept_id = x.c WHERE r = 1),
    {_measure("wt", "WEIGHT (KG)")}, {_measure("ht", "HEIGHT (CM)")},
    pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type = {T[X.PICKUP]}) WHERE r = 1 AND patient_id IN
      (SELECT e.patient_id FROM c_encounter e JOIN c_obs o ON o.encounter_id = e.encounter_id AND NOT o.voided AND o.concept_id = {{1535}} WHERE NOT e.voided AND e.encounter_type = {T[X.PICKUP]})),
    dg AS (SELECT o.obs_group_id, {_list("1282")} AS drugs {GRP}),
    ar AS (SELECT person_id, {ARV_SQL} FROM (SELECT o.person_id, o.value_coded, o.obs_datetime, dg.drugs, row_number() OVER (PARTITION BY o.person_id, o.value_coded ORDER BY o.obs_datetime, o.obs_id) AS r FROM c_obs o
      JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = {T[X.PICKUP]} LEFT JOIN dg ON dg.obs_group_id = o.obs_group_id WHERE NOT o.voided AND o.concept_id = {{1535}} AND o.value_coded IN ({{3013}}, {{2848}}, {{13960}})) WHERE r = 1 GROUP BY 1),
    ad2 AS (SELECT person_id, coalesce(d0, d1, d2) AS d, coalesce(m0, '') || coalesce(',' || m1, '') || coalesce(',' || m2, '') AS m FROM ar),
    ro AS (SELECT patient_id, CAST(date_activated AS DATE) AS d, name FROM (SELECT o.*, nm.name, row_number() OVER (PARTITION BY patient_id ORDER BY date_activated, date_created, order_id) AS r FROM c_orders o LEFT JOIN nm ON nm.concept_id = o.concept_id WHERE order_reason = {{CIEL:138405}}) WHERE r = 1),
    rn AS (SELECT patient_id, string_agg(DISTINCT nm.name, ',' ORDER BY nm.name) AS names FROM c_orders o LEFT JOIN nm ON nm.concept_id = o.concept_id WHERE NOT o.voided AND order_reason = {{CIEL:138405}} AND date_stopped IS NULL GROUP BY 1),
    bi AS (SELECT b.patient_id, b.identifier, b.date_created, pn.person_name FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY preferred DESC, date_created DESC, identifier) AS r FROM c_patient_identifier WHERE NOT voided AND identifier_type = 5) b
      LEFT JOIN c_users u ON u.user_id = b.creator LEFT JOIN pn ON pn.person_id = u.person_id WHERE b.r = 1),
    tr AS (SELECT patient_id, l.name, CAST(date_completed AS DATE) AS day FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY date_enrolled DESC, patient_program_id DESC) AS r FROM c_patient_program WHERE NOT voided AND outcome_concept_id = {{13275}}) x LEFT JOIN c_location l ON l.location_id = x.location_id WHERE r = 1),
    rg AS (SELECT r.patient_id, CAST(r.encounter_datetime AS DATE) AS day, pn.person_name FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime, encounter_id) AS r FROM c_encounter WHERE NOT voided AND encounter_type = {REG}) r
      LEFT JOIN c_users u ON u.user_id = r.creator LEFT JOIN pn ON pn.person_id = u.person_id WHERE r.r = 1),
    x AS (SELECT p.patient_id, ro.d IS NOT NULL AND coalesce(ro.d <= ad2.d, FALSE) AS by_order FROM c_patient p LEFT JOIN ro ON ro.patient_id = p.patient_id LEFT JOIN ad2 ON ad2.person_id = p.patient_id)
    SELECT emr.identifier AS emr_id, hi.ids AS hivemr_v1_id, hd.ids AS hiv_dossier_id, pn.given_name, pn.family_name, pn.middle_name AS nickname, pe.gender, pe.birthdate, round((DATE '{AS_OF}' - pe.birthdate) / 365.25, 1) AS age, op.* EXCLUDE (person_id),
      rg.day AS patient_registration_date, rg.person_name AS user_entered, {_place("date_enrolled, coalesce(date_completed, TIMESTAMP '9999-12-31'), patient_program_id")} AS initial_enrollment_location,
      {_place("date_enrolled DESC, coalesce(date_completed, TIMESTAMP '9999-12-31') DESC, patient_program_id DESC")} AS latest_enrollment_location, pa1.value AS mothers_first_name, pa2.value AS telephone_number, hc.name AS health_center,
      ad.address2 AS address, ad.state_province AS department, ad.city_village AS commune, ad.address3 AS section_communal, ad.address1 AS locality, ad.address2 AS street_landmark, CASE WHEN pe.dead THEN 'Y' END AS dead, CASE WHEN pe.dead THEN CAST(pe.death_date AS DATE) END AS death_date,
      CASE WHEN pe.dead THEN cd.name END AS cause_of_death, CAST(NULL AS VARCHAR) AS cause_of_death_non_coded, kp.* EXCLUDE (person_id), cg.* EXCLUDE (obs_group_id), pa.status AS partner_hiv_status, {", ".join(f"h.{n}" for n in HOME_SQL)}, CAST(NULL AS VARCHAR) AS socio_transport_walking_time,
      {", ".join(f"i.{n}" for n in HABIT_SQL)}, wt.value AS last_weight, wt.day AS last_weight_date, ht.value AS last_height, ht.day AS last_height_date, CAST(lv.at AS DATE) AS last_visit_date, CAST(nv.at AS DATE) AS next_visit_date, {LATE.format("nv.at")} AS days_late_to_visit, hx.day AS hiv_diagnosis_date,
      CAST(ad2.d AS DATE) AS art_dispensing_start_date, ad2.m AS first_art_dispensing_regimen, ro.d AS art_order_start_date, ro.name AS initial_art_regimen_order, CASE WHEN x.by_order THEN ro.d ELSE CAST(ad2.d AS DATE) END AS art_start_date,
      CAST(date_sub('month', CASE WHEN x.by_order THEN ro.d ELSE CAST(ad2.d AS DATE) END, DATE '{AS_OF}') AS DOUBLE) AS months_on_art, CASE WHEN x.by_order THEN ro.name ELSE ad2.m END AS initial_art_regimen, CASE WHEN ro.patient_id IS NOT NULL THEN rn.names END AS art_regimen,
      CAST(pk.encounter_datetime AS DATE) AS last_pickup_date, {", ".join(f"k.{n}" for n in PICKUP_SQL)}, {LATE.format("CAST(k.next_pickup_date AS TIMESTAMP)")} AS days_late_to_pickup, bi.identifier IS NOT NULL AS biometrics_collected, bi.date_created AS latest_biometrics_collection_date,
      bi.person_name AS biometrics_collector, bi.identifier AS latest_biometrics_reference_code, tr.name AS transfer_from_location, tr.day AS transfer_from_date
    FROM c_patient p JOIN x ON x.patient_id = p.patient_id {EMR.replace("e.patient_id", "p.patient_id")} LEFT JOIN {_identifiers("hiv")} hi ON hi.patient_id = p.patient_id LEFT JOIN {_identifiers("hiv_dossier")} hd ON hd.patient_id = p.patient_id LEFT JOIN pn ON pn.person_id = p.patient_id
      LEFT JOIN c_person pe ON pe.person_id = p.patient_id AND NOT pe.voided LEFT JOIN nm cd ON cd.concept_id = pe.cause_of_death LEFT JOIN {ADDRESS} ad ON ad.person_id = p.patient_id LEFT JOIN op ON op.person_id = p.patient_id LEFT JOIN rg ON rg.patient_id = p.patient_id
      LEFT JOIN {attribute(4)} pa1 ON pa1.person_id = p.patient_id LEFT JOIN {attribute(3)} pa2 ON pa2.person_id = p.patient_id LEFT JOIN {HC} hc ON hc.person_id = p.patient_id LEFT JOIN kp ON kp.person_id = p.patient_id LEFT JOIN ct ON ct.person_id = p.patient_id LEFT JOIN cg ON cg.obs_group_id = ct.head
      LEFT JOIN pa ON pa.person_id = p.patient_id LEFT JOIN {_newest((X.SOCIAL,))} se ON se.patient_id = p.patient_id LEFT JOIN oa h ON h.encounter_id = se.encounter_id LEFT JOIN {_newest((X.INTAKE,))} ie ON ie.patient_id = p.patient_id LEFT JOIN oa i ON i.encounter_id = ie.encounter_id
      LEFT JOIN wt ON wt.person_id = p.patient_id LEFT JOIN ht ON ht.person_id = p.patient_id LEFT JOIN {_newest((X.INTAKE, X.FOLLOWUP), "max(encounter_datetime) AS at")} lv ON lv.patient_id = p.patient_id
      LEFT JOIN (SELECT o.person_id, max(o.value_datetime) AS at FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type IN ({T[X.INTAKE]}, {T[X.FOLLOWUP]}) WHERE NOT o.voided AND o.concept_id = {{RETURN VISIT DATE}} GROUP BY 1) nv ON nv.person_id = p.patient_id
      LEFT JOIN (SELECT person_id, CAST(min(value_datetime) AS DATE) AS day FROM c_obs WHERE NOT voided AND concept_id = {{CIEL:164400}} GROUP BY 1) hx ON hx.person_id = p.patient_id LEFT JOIN ad2 ON ad2.person_id = p.patient_id LEFT JOIN ro ON ro.patient_id = p.patient_id LEFT JOIN rn ON rn.patient_id = p.patient_id
      LEFT JOIN pk ON pk.patient_id = p.patient_id LEFT JOIN oa k ON k.encounter_id = pk.encounter_id LEFT JOIN bi ON bi.patient_id = p.patient_id LEFT JOIN tr ON tr.patient_id = p.patient_id
    WHERE NOT p.voided AND {TESTP.replace("e.patient_id", "p.patient_id")}""",
    X.hiv_patient,
    "patient patient_program program orders patient_identifier",
)
