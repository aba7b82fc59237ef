"""HIV visit, maternal, COVID and orphan programme extracts on the driver clinic."""

from __future__ import annotations

from wardmill.catalog import twins as T
from wardmill.catalog.clinic_tables import Dictionary
from wardmill.catalog.extracts import NAMES_FR, tup
from wardmill.catalog.programs import GRP, TESTP, _list
from wardmill.catalog.records import EMR, ET, FAC, PR, U, V, K, _last, extract
from wardmill.plans.extract import maternal as M
from wardmill.plans.extract.programs import DELIVERY, HIV, MATERNAL, OBGYN, PMTCT_FOLLOWUP, PMTCT_INITIAL, SYMPTOMS
from wardmill.plans.extract.records import HIV_FOLLOWUP_TYPE, HIV_INTAKE_TYPE, NON_CODED

HV_Q = [q.code for q in M.VISIT_ANSWERS.values()] + [
    "13712", "6401", "8854", "8621", "11483", "13786", "HISTORICAL DRUG START DATE", "11131", "HISTORICAL DRUG STOP DATE", "12748",
    "PREVIOUS TREATMENT PROPHYLAXIS CONSTRUCT", "CURRENT PROPHYLAXIS TREATMENT CONSTRUCT",
]
HV_A = [a for q in M.VISIT_ANSWERS.values() for a in tup(q.answer)] + [M.INTERNAL, *M.PROPHYLAXIS.values()]
HV = Dictionary(HV_Q, HV_A, [HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, "t-3"], programs=[HIV, "p-2"])


def _yn(expr: str) -> str:
    return f"CASE {expr} WHEN {{1065}} THEN TRUE WHEN {{1066}} THEN FALSE END"


NM = "FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN c_location pl ON CAST(pl.location_id AS VARCHAR) = o.value_text WHERE NOT voided"
REASON = ", ".join("{" + a + "}" for a in M.VISIT_ANSWERS["reason_not_on_arv"].answer)
HV_ANS = ", ".join(
    [
        f"{_last('o.value_text', '11631')} AS chw, {_last('nm.name', '5356')} AS who_stage, {_yn(_last('o.value_coded', 'PREGNANCY STATUS'))} AS pregnant, CAST({_last('o.value_datetime', 'RETURN VISIT DATE')} AS DATE) AS next_visit_date",
        f"{_yn(_last('o.value_coded', '13679'))} AS referred_by_womens_health_in, {_yn(_last('o.value_coded', '13168'))} AS referral_transfer_pepfar_partner_in, {_last('o.obs_id', '13169')} AS gi, {_last('o.obs_id', '13170')} AS go",
        f"last(nm.name ORDER BY o.date_created, o.obs_id) FILTER (o.concept_id = {{11337}} AND o.value_coded IN ({REASON})) AS reason_not_on_arv, {_last('nm.name', '13642')} AS breastfeeding_status, {_last('o.value_datetime', '6889')} AS last_breastfeeding_date",
        *[f"CASE WHEN count(*) FILTER (o.concept_id = {{{M.RISK}}} AND o.value_coded = {{{k}}}) > 0 THEN TRUE END AS {n}" for n, k in M.RISKS.items()],
        *[f"{_yn(_last('o.value_coded', k))} AS {n}" for n, k in M.HISTORY.items()],
    ]
)
HV_GRP = f"""g AS (SELECT obs_group_id, {_last("nm.name", "13712")} AS rt, {_last("nm.name", "6401")} AS ki, {_last("o.value_coded", "6401")} AS kic, {_last("nm.name", "8854")} AS ko, {_last("o.value_coded", "8854")} AS koc, {_last("pl.name", "8621")} AS place, {_last("o.value_text", "11483")} AS nam,
  {_yn(_last("o.value_coded", "13168"))} AS pep, {_last("nm.name", "13786")} AS line, CAST(coalesce({_last("o.value_datetime", "11131")}, {_last("o.value_datetime", "HISTORICAL DRUG START DATE")}) AS DATE) AS st, CAST(coalesce({_last("o.value_datetime", "12748")}, {_last("o.value_datetime", "HISTORICAL DRUG STOP DATE")}) AS DATE) AS en
  {NM} AND obs_group_id IS NOT NULL GROUP BY 1)"""


def _ph(name: str, drug: str) -> str:
    return f"""{name} AS (SELECT encounter_id, g.line, g.st, g.en FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY date_created DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND value_coded = {{{drug}}} AND obs_group_id IN (SELECT obs_id FROM c_obs WHERE NOT voided
      AND concept_id IN ({{PREVIOUS TREATMENT PROPHYLAXIS CONSTRUCT}}, {{CURRENT PROPHYLAXIS TREATMENT CONSTRUCT}}))) x LEFT JOIN g ON g.obs_group_id = x.obs_group_id WHERE r = 1)"""


NI = "CAST(NULL AS INTEGER)"
KEEP = ["chw", "who_stage", "pregnant", "next_visit_date", "referred_by_womens_health_in", "referral_transfer_pepfar_partner_in", "reason_not_on_arv", "breastfeeding_status", "last_breastfeeding_date", *M.RISKS, *M.HISTORY]
extract(
    "hiv_visit",
    "X44 R24b R41 F16",
    HV,
    f""", oa AS (SELECT o.encounter_id, {HV_ANS} {NM} GROUP BY 1), {HV_GRP}, {_ph("pi", "ISONIAZID")}, {_ph("pr", "20468")}, hv AS (SELECT patient_id, identifier FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY preferred DESC, date_created DESC, identifier) AS r FROM c_patient_identifier WHERE NOT voided AND identifier_type = 2) WHERE r = 1)
    SELECT {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, {K}(SELECT p.patient_program_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = 1 AND p.patient_id = e.patient_id AND CAST(p.date_enrolled AS DATE) <= CAST(e.encounter_datetime AS DATE) AND (CAST(p.date_completed AS DATE) >= CAST(e.encounter_datetime AS DATE) OR p.date_completed IS NULL)
        ORDER BY CAST(p.date_enrolled AS DATE) DESC, p.patient_program_id DESC LIMIT 1) AS hiv_program_id, emr.identifier AS emr_id, hv.identifier AS hivemr_v1, et.name AS encounter_type, e.date_created AS date_entered, cu.username AS user_entered, {", ".join("oa." + k for k in KEEP)},
      a.rt AS referral_transfer_in, a.ki AS internal_external_in, CASE WHEN a.kic = {{8855}} THEN a.place WHEN a.kic IS NOT NULL THEN a.nam END AS referral_transfer_location_in, b.rt AS referral_transfer_out, b.ko AS internal_external_out, CASE WHEN b.koc = {{8855}} THEN b.place WHEN b.koc IS NOT NULL THEN b.nam END AS referral_transfer_location_out,
      b.pep AS referral_transfer_pepfar_partner_out, pi.line AS inh_line, pi.st AS inh_start_date, pi.en AS inh_end_date, pr.st AS rif_and_inh_start_date, pr.en AS rif_and_inh_end_date, CAST(e.encounter_datetime AS DATE) AS visit_date, vl.name AS visit_location, {FAC} AS facility, {NI} AS index_asc, {NI} AS index_desc, {NI} AS index_program_asc, {NI} AS index_program_desc
    FROM c_encounter e {V} {ET} {EMR} {U} LEFT JOIN hv ON hv.patient_id = e.patient_id LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN g a ON a.obs_group_id = oa.gi LEFT JOIN g b ON b.obs_group_id = oa.go LEFT JOIN pi ON pi.encounter_id = e.encounter_id LEFT JOIN pr ON pr.encounter_id = e.encounter_id
    WHERE NOT e.voided AND e.encounter_type IN (1, 2) AND {TESTP}""",
    M.hiv_visit,
    "patient_program program",
)
HP = Dictionary(
    [*HV_Q, "HIV TEST DATE", "5596", "14990", "5599", "13265", "FIRST NAME", "LAST NAME", "TELEPHONE NUMBER OF CONTACT", "11563"],
    [*HV_A, *SYMPTOMS.values()], [HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, PMTCT_INITIAL, PMTCT_FOLLOWUP], programs=[HIV, "p-2"],
)
SYMPTOM = ", ".join("{" + c + "}" for c in SYMPTOMS.values())
extract(
    "hiv_pmtct_visit",
    "X38 R24b R41 R63",
    HP,
    f""", oa AS (SELECT o.encounter_id, {HV_ANS}, CAST({_last("o.value_datetime", "HIV TEST DATE")} AS DATE) AS hiv_test_date, CAST({_last("o.value_datetime", "5596")} AS DATE) AS expected_delivery_date, {_yn(_last("o.value_coded", "14990"))} AS delivery, {_last("o.value_datetime", "5599")} AS delivery_datetime,
      max(o.obs_datetime) FILTER (o.value_coded IN ({SYMPTOM})) AS son, max(1) FILTER (o.value_coded IN ({SYMPTOM}) AND o.concept_id = {{11563}}) AS pres, max(1) FILTER (o.concept_id IN ({{13265}}, {{FIRST NAME}}, {{LAST NAME}}, {{TELEPHONE NUMBER OF CONTACT}})) AS con {NM} GROUP BY 1),
    {HV_GRP}, {_ph("pi", "ISONIAZID")}, hv AS (SELECT patient_id, identifier FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY preferred DESC, date_created DESC, identifier) AS r FROM c_patient_identifier WHERE NOT voided AND identifier_type = 2) WHERE r = 1)
    SELECT {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, {K}(SELECT p.patient_program_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = 1 AND p.patient_id = e.patient_id AND CAST(p.date_enrolled AS DATE) <= CAST(e.encounter_datetime AS DATE) AND (CAST(p.date_completed AS DATE) >= CAST(e.encounter_datetime AS DATE) OR p.date_completed IS NULL)
        ORDER BY CAST(p.date_enrolled AS DATE) DESC, p.patient_program_id DESC LIMIT 1) AS hiv_program_id, emr.identifier AS emr_id, hv.identifier AS hivemr_v1, et.name AS encounter_type, e.date_created AS date_entered, cu.username AS user_entered, {", ".join("oa." + k for k in KEEP)},
      a.rt AS referral_transfer_in, a.ki AS internal_external_in, CASE WHEN a.kic = {{8855}} THEN a.place WHEN a.kic IS NOT NULL THEN a.nam END AS referral_transfer_location_in, b.rt AS referral_transfer_out, b.ko AS internal_external_out, CASE WHEN b.koc = {{8855}} THEN b.place WHEN b.koc IS NOT NULL THEN b.nam END AS referral_transfer_location_out,
      b.pep AS referral_transfer_pepfar_partner_out, pi.line AS inh_line, pi.st AS inh_start_date, pi.en AS inh_end_date, CAST(e.encounter_datetime AS DATE) AS visit_date, vl.name AS visit_location, {FAC} AS facility, oa.hiv_test_date, oa.expected_delivery_date, CASE WHEN oa.pres = 1 THEN CAST(oa.son AS DATE) END AS tb_screening_date,
      CASE WHEN oa.con = 1 THEN TRUE END AS has_provided_contact, oa.delivery, oa.delivery_datetime, {NI} AS index_asc, {NI} AS index_desc, {NI} AS index_program_asc, {NI} AS index_program_desc
    FROM c_encounter e {V} {ET} {EMR} {U} LEFT JOIN hv ON hv.patient_id = e.patient_id LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN g a ON a.obs_group_id = oa.gi LEFT JOIN g b ON b.obs_group_id = oa.go LEFT JOIN pi ON pi.encounter_id = e.encounter_id
    WHERE NOT e.voided AND e.encounter_type IN (1, 2, 3, 4) AND {TESTP}""",
    M.hiv_pmtct_visit,
    "patient_program program",
)
PG = Dictionary(
    ["Type of HUM visit", "GRAVIDITY", "PARITY", "NUMBER OF ABORTIONS", "CIEL:1825", "DATE OF LAST MENSTRUAL PERIOD", "ESTIMATED DATE OF CONFINEMENT", "13262", "CIEL:159758", M.PREGNANCY_GROUP, "CIEL:163460", "11663", "CIEL:161033"],
    ["ANC VISIT", "a1"], [OBGYN, "t-2"], programs=[MATERNAL, "p-2"],
)
SLOTS = ", ".join(
    f"max(b) FILTER (r = {i}) AS pregnancy_{i}_birth_order, max(d) FILTER (r = {i}) AS pregnancy_{i}_delivery_type, max(u) FILTER (r = {i}) AS pregnancy_{i}_outcome" for i in range(1, 11)
)
extract(
    "mch_pregnancy",
    "X53 R8 F8 F12",
    PG,
    f""", oa AS (SELECT o.encounter_id, {_last("o.value_numeric", "GRAVIDITY")} AS gravidity, {_last("o.value_numeric", "PARITY")} AS parity, {_last("o.value_numeric", "NUMBER OF ABORTIONS")} AS num_abortions, {_last("o.value_numeric", "CIEL:1825")} AS num_living_children, CAST({_last("o.value_datetime", "DATE OF LAST MENSTRUAL PERIOD")} AS DATE) AS last_period_date,
        CAST({_last("o.value_datetime", "ESTIMATED DATE OF CONFINEMENT")} AS DATE) AS expected_delivery_date, {_list("13262")} AS pmtct_club, {_list("CIEL:159758")} AS delivery_location_plan FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    g AS (SELECT obs_group_id, {_last("o.value_numeric", "CIEL:163460")} AS b, {_list("11663")} AS d, {_list("CIEL:161033")} AS u {GRP}),
    w AS (SELECT encounter_id, {SLOTS} FROM (SELECT encounter_id, obs_id, row_number() OVER (PARTITION BY encounter_id ORDER BY date_created DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND concept_id = {{{M.PREGNANCY_GROUP}}}) x LEFT JOIN g ON g.obs_group_id = x.obs_id WHERE r <= 10 GROUP BY 1)
    SELECT o.obs_id AS pregnancy_id, {K}o.encounter_id AS encounter_id, {K}(SELECT p.patient_program_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = 1 AND p.patient_id = e.patient_id AND CAST(p.date_enrolled AS DATE) <= CAST(e.encounter_datetime AS DATE) AND (CAST(p.date_completed AS DATE) >= CAST(e.encounter_datetime AS DATE) OR p.date_completed IS NULL)
        ORDER BY CAST(p.date_enrolled AS DATE) DESC, p.patient_program_id DESC LIMIT 1) AS mch_program_id, emr.identifier AS emr_id, CAST(e.encounter_datetime AS DATE) AS encounter_date, e.date_created AS date_entered, cu.username AS user_entered, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, oa.* EXCLUDE (encounter_id),
      round((CAST(e.encounter_datetime AS DATE) - oa.last_period_date) / 7, 0) + 0 AS calculated_gestational_age, w.* EXCLUDE (encounter_id)
    FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id {V} {EMR} {U} LEFT JOIN oa ON oa.encounter_id = o.encounter_id LEFT JOIN w ON w.encounter_id = o.encounter_id
    WHERE NOT o.voided AND o.concept_id = {{Type of HUM visit}} AND o.value_coded = {{ANC VISIT}} AND o.encounter_id IN (SELECT max(encounter_id) FROM c_encounter WHERE NOT voided AND encounter_type = 1 GROUP BY patient_id)""",
    M.mch_pregnancy,
    "patient_program program",
)
MD = Dictionary(["DIAGNOSIS", NON_CODED, "Visit Diagnoses", "7537", "1379"], [*sorted({c for cs in M.MCH_FLAGS.values() for c in cs}), "ICD-10-WHO:Z1"], [DELIVERY, OBGYN, "t-3"])
MF = ", ".join(f"CAST(CASE WHEN o.value_coded IN ({', '.join('{' + c + '}' for c in cs)}) THEN 1 ELSE 0 END AS INTEGER) AS {n}" for n, cs in M.MCH_FLAGS.items())
extract(
    "mch_diagnoses",
    "X49 R21 R38",
    MD,
    f""", g AS (SELECT obs_group_id, {_last("nm.name", "7537")} AS ord, {_last("nm.name", "1379")} AS cert {GRP})
    SELECT emr.identifier AS emr_id, o.encounter_id, el.location_name AS encounter_location, {FAC} AS facility, o.obs_id, o.obs_datetime, e.visit_id, vl.name AS visit_location, et.name AS encounter_type, cu.person_name AS entered_by, prov.person_name AS provider, o.value_coded AS diagnosis_concept,
      CASE WHEN o.value_coded IS NOT NULL THEN nm.name ELSE o.value_text END AS diagnosis_entered, fr.name AS diagnosis_coded_fr, (SELECT min(code) FROM c_report_mapping m WHERE m.source = 'ICD-10-WHO' AND m.concept_id = o.value_coded) AS icd10_code, g.ord AS dx_order, g.cert AS certainty, CAST(o.value_coded IS NOT NULL AS INTEGER) AS coded,
      CAST(trunc(epoch(o.date_created - o.obs_datetime) / 60) > 30 AS INTEGER) AS retrospective, o.date_created, {MF}
    FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type IN (1, 2) {V} {ET} {EMR} {U} {PR} LEFT JOIN g ON g.obs_group_id = o.obs_group_id LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN nm_fr fr ON fr.concept_id = o.value_coded
    WHERE o.concept_id IN ({{DIAGNOSIS}}, {{{NON_CODED}}}) AND o.obs_group_id IN (SELECT obs_id FROM c_obs WHERE NOT voided AND concept_id = {{Visit Diagnoses}})""",
    M.mch_diagnoses,
    "report_mapping",
    NAMES_FR,
)
CD = Dictionary(["CIEL:165793", "Visit Diagnoses", "DIAGNOSIS", NON_CODED, "CLINICAL IMPRESSION DIAGNOSIS CONFIRMED", "Diagnosis order"], ["a1", "a2"], list(M.COVID), "name")
COVC = f"""emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, et.name AS encounter_type, el.location_name AS location, CAST(e.encounter_datetime AS DATE) AS encounter_date, e.date_created AS date_entered, cu.username AS user_entered, {K}e.visit_id AS visit_id, vl.name AS visit_location, {FAC} AS facility"""
extract(
    "covid_diagnoses",
    "X18 R21 R58",
    CD,
    f""", oa AS (SELECT o.encounter_id, {_list("CIEL:165793")} AS cov FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1), g AS (SELECT obs_group_id, {_last("nm.name", "CLINICAL IMPRESSION DIAGNOSIS CONFIRMED")} AS conf, {_last("nm.name", "Diagnosis order")} AS ord {GRP}),
    d AS (SELECT o.encounter_id, coalesce(nm.name, o.value_text) AS dx, g.conf, g.ord FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN g ON g.obs_group_id = o.obs_group_id WHERE NOT o.voided AND o.concept_id IN ({{DIAGNOSIS}}, {{{NON_CODED}}}) AND o.obs_group_id IN (SELECT obs_id FROM c_obs WHERE NOT voided AND concept_id = {{Visit Diagnoses}}))
    SELECT {COVC}, oa.cov AS covid19_diagnosis, d.dx AS diagnosis, d.conf AS diagnosis_confirmation, d.ord AS diagnosis_order FROM c_encounter e {V} {ET} {EMR} {U} LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN d ON d.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type IN (1, 2, 3) AND {TESTP}""",
    M.covid_diagnoses,
)
CL = Dictionary(["12973", "CIEL:159959", "SPUTUM COLLECTION DATE", *M.COVID_TESTS.values(), "Lab test ordered coded"], ["a1", "a2"], [*M.COVID[:2], "Laboratory Results"], "name")
CT = ", ".join(f"{_last('nm.name', k)} AS {n}_results" for n, k in M.COVID_TESTS.items())
CO = ", ".join(f"CASE WHEN count(*) FILTER (o.concept_id = {{Lab test ordered coded}} AND o.value_coded = {{{k}}}) > 0 THEN 'Yes' END AS {n}" for n, k in M.COVID_TESTS.items())
TESTC = ", ".join(f"t.{n}, t.{n}_results" for n in M.COVID_TESTS)
extract(
    "covid_lab_test",
    "X21 R29 R25 R24",
    CL,
    f""", g AS (SELECT obs_group_id, {_list("CIEL:159959")} AS src, CAST({_last("o.value_datetime", "SPUTUM COLLECTION DATE")} AS DATE) AS sd, {CT}, {CO} {GRP}), r AS (SELECT o.encounter_id, {CT} FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND o.concept_id IN ({", ".join("{" + k + "}" for k in M.COVID_TESTS.values())}) GROUP BY 1)
    SELECT {COVC}, h.obs_id, t.sd AS specimen_date, coalesce(t.sd, CAST(e.encounter_datetime AS DATE)) AS date_for_reporting, t.src AS specimen_source, {TESTC} FROM c_obs h JOIN c_encounter e ON e.encounter_id = h.encounter_id {V} {ET} {EMR} {U} LEFT JOIN g t ON t.obs_group_id = h.obs_id WHERE NOT h.voided AND h.concept_id = {{12973}} AND NOT e.voided AND e.encounter_type IN (1, 2) AND {TESTP}
    UNION ALL SELECT {COVC}, NULL, CAST(e.encounter_datetime AS DATE), CAST(e.encounter_datetime AS DATE), NULL, {", ".join(f"NULL, t.{n}_results" for n in M.COVID_TESTS)} FROM c_encounter e {V} {ET} {EMR} {U} JOIN r t ON t.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type = 3 AND {TESTP}""",
    M.covid_lab_test,
)
VA = Dictionary([M.VACCINATIONS, M.SEQUENCE, M.VACCINE_DATE], [c for cs, _ in M.VACCINES.values() for c in cs], list(M.PRIMARY_CARE_NAMES), "name", programs=["MCH", "p-2"])
extract("vaccinations_anc", "X85 R2 R30", VA, T.VACCINES, M.vaccinations_anc, "patient_program program")
OV = Dictionary(["Service or program", "Service or program non-coded", "CIEL:1169", "HIV TEST DATE"], ["a1", "a2"], ["OVC Intake", "OVC Follow-up", "t-3"], "name", programs=[M.OVC, "p-2"])
extract("ovc_program_encounters", "X69 R11 R18 R22", OV, T.OVC, M.ovc_program_encounters, "patient_program program patient_state program_workflow_state")
J9Q = ["11665", "11117", "13242", "13737", "5596", "5599", "8879", "Type of referring service", "CIEL:160535", "13126", "11663", "12899", "10140", "11673", "CIEL:1054", "10154", "mothers group"]
J9A = [*M.MATERNAL_HISTORY.values(), *M.MATERNAL_VISITS.values(), "OTHER"]
J9 = Dictionary(J9Q, J9A, [OBGYN, DELIVERY, "t-3"], programs=[MATERNAL, "p-2"])
extract("mch_j9_data", "X51 R7 R28", J9, T.J9_DATA, lambda c: M.mch_j9_data(c, "flow-1"), "patient_program program patient_state program_workflow_state")
extract("mch_j9_case_registration", "X50 R5 R62 F16", J9, T.J9_CASES, lambda c: M.mch_j9_case_registration(c, "flow-1"), "patient_program program patient_state program_workflow_state relationship")
