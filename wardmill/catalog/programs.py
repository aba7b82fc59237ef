"""Programme, HIV, maternal, chronic disease and pathology extracts on the driver clinic."""

from __future__ import annotations

from wardmill.catalog import twins as T
from wardmill.catalog.clinic_tables import Dictionary
from wardmill.catalog.extracts import AS_OF, attribute, identifier, years
from wardmill.catalog.records import EMR, ET, FAC, HC, PR, U, V, K, _last, extract
from wardmill.plans.extract import programs as X
from wardmill.plans.extract.forms import MENTAL_HEALTH, ONCOLOGY_INTAKE
from wardmill.plans.extract.records import HIV_DISPENSING_TYPE, HIV_FOLLOWUP_TYPE, HIV_INTAKE_TYPE

NI = "CAST(NULL AS INTEGER)"
IDX = f"{NI} AS index_asc, {NI} AS index_desc"
TESTP = f"NOT EXISTS (SELECT 1 FROM {attribute(1)} ta WHERE ta.person_id = e.patient_id AND ta.value = 'true')"
EMRP = EMR.replace("e.patient_id", "o.person_id")


def prog(uuid: str) -> str:
    return f"e.program_id = (SELECT program_id FROM c_program WHERE uuid = '{uuid}')"


H = Dictionary(
    ["5096", "q2"], ["a1", "LOST TO FOLLOWUP", "internal transfer"], [HIV_DISPENSING_TYPE, "t-2"], programs=[X.HIV, "p-2"],
    state_codes=[("LOST TO FOLLOWUP", "s1"), ("internal transfer", "s2"), ("on treatment", "s3"), ("a1", "s4")],
)
extract(
    "hiv_patient_program",
    "X37 F16",
    H,
    f"""SELECT e.patient_program_id AS hiv_program_id, emr.identifier AS emr_id, CAST(e.date_enrolled AS DATE) AS date_enrolled, CAST(e.date_completed AS DATE) AS date_completed, l.name AS location, nm.name AS outcome, {IDX}
    FROM c_patient_program e {EMR} LEFT JOIN c_location l ON l.location_id = e.location_id LEFT JOIN nm ON nm.concept_id = e.outcome_concept_id WHERE NOT e.voided AND {prog(X.HIV)} AND {TESTP}""",
    X.hiv_patient_program,
    "patient_program program",
)
extract(
    "hiv_status",
    "X41 R23b R29 R49",
    H,
    f""", en AS (SELECT * FROM c_patient_program e WHERE NOT e.voided AND {prog(X.HIV)}),
    r AS (
      SELECT patient_id, patient_program_id AS pid, location_id, CAST(date_enrolled AS DATE) AS sd, CAST(NULL AS DATE) AS ed, CAST(NULL AS BIGINT) AS sc, FALSE AS oc, 'e-' || patient_program_id AS status_id FROM en
      UNION ALL SELECT e.patient_id, e.patient_program_id, e.location_id, s.start_date, NULL, w.concept_id, FALSE, 's-' || s.patient_state_id FROM c_patient_state s JOIN c_patient_program e ON e.patient_program_id = s.patient_program_id AND {prog(X.HIV)} JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state WHERE NOT s.voided
      UNION ALL SELECT patient_id, patient_program_id, location_id, CAST(date_completed AS DATE), CAST(date_completed AS DATE), outcome_concept_id, TRUE, 'o-' || patient_program_id FROM en WHERE date_completed IS NOT NULL),
    o AS (SELECT *, row_number() OVER w AS ia, max(CASE WHEN sc = {{LOST TO FOLLOWUP}} THEN 1 ELSE 0 END) OVER (PARTITION BY patient_id ORDER BY sd, pid, status_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lost,
        lag(CASE WHEN sc = {{internal transfer}} THEN location_id END) OVER w AS fr FROM r WINDOW w AS (PARTITION BY patient_id ORDER BY sd, pid, status_id)),
    d AS (SELECT patient_id, encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type = 1) WHERE r = 1),
    du AS (SELECT encounter_id, {_last("o.value_datetime", "5096")} AS due FROM c_obs o WHERE NOT voided GROUP BY 1)
    SELECT e.status_id, emr.identifier AS emr_id, l.name AS patient_location, lf.name AS transfer_in_from, nm.name AS status_outcome, e.sd AS start_date, e.ed AS end_date, CAST(coalesce(lost = 1 AND NOT oc, FALSE) AS INTEGER) AS return_to_care,
      CAST(date_diff('day', coalesce(CAST(du.due AS DATE), DATE '1900-01-01'), DATE '{AS_OF}') >= 29 AS INTEGER) AS currently_late_for_pickup, e.pid AS hiv_program_id,
      CAST(row_number() OVER (PARTITION BY e.pid ORDER BY e.sd, e.status_id) AS INTEGER) AS index_program_ascending, CAST(row_number() OVER (PARTITION BY e.pid ORDER BY e.sd DESC, e.status_id DESC) AS INTEGER) AS index_program_descending,
      CAST(e.ia AS INTEGER) AS index_patient_ascending, CAST(row_number() OVER (PARTITION BY e.patient_id ORDER BY e.sd DESC, e.pid DESC, e.status_id DESC) AS INTEGER) AS index_patient_descending
    FROM o e {EMR} LEFT JOIN c_location l ON l.location_id = e.location_id LEFT JOIN c_location lf ON lf.location_id = e.fr LEFT JOIN nm ON nm.concept_id = e.sc LEFT JOIN d ON d.patient_id = e.patient_id LEFT JOIN du ON du.encounter_id = d.encounter_id""",
    X.hiv_status,
    "patient_program program patient_state program_workflow_state",
)
M = Dictionary(["q1"], ["a1", "a2"], ["t-1"], programs=[X.MATERNAL, "p-2", "p-3"])
extract(
    "mch_status",
    "X54 R58",
    M,
    f""", s AS (SELECT s.*, w.concept_id FROM c_patient_state s LEFT JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state WHERE NOT s.voided)
    SELECT {K}s.patient_state_id AS patient_state_id, {K}e.patient_program_id AS mch_program_id, emr.identifier AS emr_id, l.name AS enrollment_location, e.date_enrolled AS program_date_enrolled, e.date_completed AS program_date_completed, tn.name AS treatment_status,
      s.start_date AS status_start_date, s.end_date AS status_end_date, oc.name AS outcome, {IDX} FROM c_patient_program e LEFT JOIN s ON s.patient_program_id = e.patient_program_id {EMR} LEFT JOIN c_location l ON l.location_id = e.location_id
    LEFT JOIN nm tn ON tn.concept_id = s.concept_id LEFT JOIN nm oc ON oc.concept_id = e.outcome_concept_id WHERE NOT e.voided AND {prog(X.MATERNAL)} AND {TESTP}""",
    X.mch_status,
    "patient_program program patient_state program_workflow_state",
)
ONC_STATES = [(c, f"s{i}") for i, c in enumerate([*X.ONCOLOGY_STATUSES, *X.TREATMENT_STATUSES, "other state"])]
O = Dictionary(
    ["3064", "7537", "10373", "2881", "10578"], ["a1", "a2", "a3"], [ONCOLOGY_INTAKE, X.ONCOLOGY_PLAN, "t-3"], programs=[X.ONCOLOGY, "p-2"], state_codes=ONC_STATES
)
PSET = ", ".join("{" + c + "}" for c in X.ONCOLOGY_STATUSES)
TSET = ", ".join("{" + c + "}" for c in X.TREATMENT_STATUSES)
ST = f"""st AS (SELECT s.*, w.concept_id, w.program_workflow_id, e.patient_id, e.voided AS ev FROM c_patient_state s JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state JOIN c_patient_program e ON e.patient_program_id = s.patient_program_id
  WHERE NOT s.voided AND NOT e.voided AND {prog(X.ONCOLOGY)})"""
extract(
    "oncology_program",
    "X66 R29 R32",
    O,
    f""", {ST}, en AS (SELECT * FROM c_patient_program e WHERE NOT e.voided AND {prog(X.ONCOLOGY)}),
    r AS (SELECT patient_id, CAST(date_enrolled AS DATE) AS status_start_date, CAST(date_completed AS DATE) AS status_end_date, 'enrollment_status' AS status_type, 'enrolled' AS status FROM en
      UNION ALL SELECT patient_id, CAST(date_completed AS DATE), CAST(date_completed AS DATE), 'outcome', nm.name FROM en LEFT JOIN nm ON nm.concept_id = en.outcome_concept_id
      UNION ALL SELECT patient_id, start_date, end_date, 'program_status', nm.name FROM st LEFT JOIN nm ON nm.concept_id = st.concept_id WHERE st.concept_id IN ({PSET})
      UNION ALL SELECT patient_id, start_date, end_date, 'treatment_status', nm.name FROM st LEFT JOIN nm ON nm.concept_id = st.concept_id WHERE st.concept_id IN ({TSET}))
    SELECT DISTINCT emr.identifier AS emr_id, status_start_date, status_end_date, status_type, status FROM r e {EMR}""",
    X.oncology_program,
    "patient_program program patient_state program_workflow_state",
)
LATEST_STATE = "(SELECT nm.name FROM st JOIN nm ON nm.concept_id = st.concept_id WHERE st.patient_id = e.patient_id AND st.concept_id IN ({set}) AND st.patient_program_id = (SELECT max(patient_program_id) FROM c_patient_program p WHERE p.patient_id = e.patient_id AND p.program_id = e.program_id) ORDER BY start_date DESC, patient_state_id DESC LIMIT 1)"
extract(
    "oncology_monthly_summary",
    "X65 R48 R5",
    O,
    f""", {ST}, oa AS (SELECT o.encounter_id, {_last("nm.name", "10373")} AS stage, {_last("o.value_text", "10578")} AS note FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    fe AS (SELECT patient_id, location_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY date_enrolled, coalesce(date_completed, TIMESTAMP '9999-12-31'), patient_program_id) AS r FROM c_patient_program e WHERE NOT voided AND {prog(X.ONCOLOGY)}) WHERE r = 1),
    ei AS (SELECT patient_id, CAST(max(encounter_datetime) AS DATE) AS d, max(encounter_id) AS i FROM c_encounter WHERE encounter_type = 1 GROUP BY 1), ep AS (SELECT patient_id, CAST(max(encounter_datetime) AS DATE) AS d, max(encounter_id) AS i FROM c_encounter WHERE encounter_type = 2 GROUP BY 1)
    SELECT CAST(date_trunc('month', DATE '{AS_OF}') AS DATE) AS report_month, emr.identifier AS emr_id, e.date_enrolled AS enrollment_date, l.name AS enrollment_location, e.date_completed AS program_completion_date, oc.name AS program_outcome, ps.stage AS latest_stage, ei.d AS latest_intake_date,
      ep.d AS latest_treatment_plan_date, CAST(NULL AS DATE) AS latest_chemotherapy_date, ns.note AS latest_consult_note, {LATEST_STATE.replace("{set}", PSET)} AS latest_oncology_program_status, {LATEST_STATE.replace("{set}", TSET)} AS latest_oncology_treatment_status
    FROM c_patient_program e {EMR} LEFT JOIN fe ON fe.patient_id = e.patient_id LEFT JOIN c_location l ON l.location_id = fe.location_id LEFT JOIN nm oc ON oc.concept_id = e.outcome_concept_id LEFT JOIN ei ON ei.patient_id = e.patient_id LEFT JOIN ep ON ep.patient_id = e.patient_id
    LEFT JOIN oa ps ON ps.encounter_id = ep.i LEFT JOIN oa ns ON ns.encounter_id = ei.i WHERE NOT e.voided AND {prog(X.ONCOLOGY)}""",
    X.oncology_monthly_summary,
    "patient_program program patient_state program_workflow_state",
)
extract(
    "oncology_treatment_plan",
    "X67 F16",
    O,
    f""", {ST}, oa AS (SELECT o.encounter_id, {_last("nm.name", "10373")} AS stage, {_last("o.value_text", "2881")} AS note FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    op AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY date_enrolled DESC, patient_program_id DESC) AS r FROM c_patient_program e WHERE NOT voided AND date_completed IS NULL AND {prog(X.ONCOLOGY)}) WHERE r = 1)
    SELECT emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, e.encounter_datetime, el.location_name AS encounter_location, {FAC} AS facility, e.date_created AS date_entered, cu.person_name AS user_entered, prov.person_name AS encounter_provider,
      (SELECT nm.name FROM st JOIN op ON op.patient_program_id = st.patient_program_id JOIN nm ON nm.concept_id = st.concept_id WHERE op.patient_id = e.patient_id AND st.program_workflow_id = 1 AND st.end_date IS NULL ORDER BY st.start_date DESC, st.patient_state_id DESC LIMIT 1) AS treatment_intent,
      oa.stage AS cancer_stage, oa.note AS plan_details FROM c_encounter e {V} {EMR} {U} {PR} LEFT JOIN oa ON oa.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type = 2""",
    lambda c: X.oncology_treatment_plan(c, 1),
    "patient_program program patient_state program_workflow_state",
)
GRP = "FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1"


def _list(code: str, sep: str = " | ") -> str:
    return f"string_agg(DISTINCT nm.name, '{sep}' ORDER BY nm.name) FILTER (o.concept_id = {{{code}}})"


extract(
    "oncology_diagnosis",
    "X63 R41",
    O,
    f""", g AS (SELECT obs_group_id, {_last("nm.name", "7537")} AS ord {GRP})
    SELECT emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, e.encounter_datetime, el.location_name AS encounter_location, {FAC} AS facility, e.date_created AS date_entered, cu.person_name AS user_entered, prov.person_name AS encounter_provider,
      et.name AS encounter_type, g.ord AS diagnosis_order, nm.name AS diagnosis FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type IN (1, 2) {V} {ET} {EMR} {U} {PR} LEFT JOIN g ON g.obs_group_id = o.obs_group_id LEFT JOIN nm ON nm.concept_id = o.value_coded
    WHERE NOT o.voided AND o.concept_id = {{3064}}""",
    X.oncology_diagnosis,
)
MH = Dictionary(["10636", "10647", "10594", "10742", "10634", "10744", "9073"], ["a1", "a2", "a3"], [MENTAL_HEALTH, "t-2"], programs=[X.MENTAL, "p-2"])
LIVE_ADDRESS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC, date_created DESC, person_address_id DESC) AS r FROM c_person_address WHERE NOT voided) WHERE r = 1)"
extract(
    "mh_patients",
    "X59 F8",
    MH,
    f""", d AS (SELECT patient_id, encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type = 1) WHERE r = 1),
    a AS (SELECT o.encounter_id, {_list("10636")} AS i, {_list("10647")} AS rf FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1)
    SELECT {K}e.patient_program_id AS patient_program_id, {K}e.patient_id AS patient_id, emr.identifier AS emr_id, {K}emr.identifier AS emr_id_deprecated, p.birthdate AS dob, p.gender, hc.name AS health_center, CASE WHEN ad.person_id IS NOT NULL THEN coalesce(ad.city_village, '') END AS town, a.rf AS referral,
      e.date_enrolled AS program_enrollment_date, a.i AS interventions, {IDX} FROM c_patient_program e {EMR} LEFT JOIN c_person p ON p.person_id = e.patient_id LEFT JOIN {HC} hc ON hc.person_id = e.patient_id LEFT JOIN {LIVE_ADDRESS} ad ON ad.person_id = e.patient_id
    LEFT JOIN d ON d.patient_id = e.patient_id LEFT JOIN a ON a.encounter_id = d.encounter_id WHERE NOT e.voided AND {prog(X.MENTAL)}""",
    X.mh_patients,
    "patient_program program",
)
MHC = f"""{K}e.encounter_id AS encounter_id, {K}e.patient_id AS patient_id, emr.identifier AS emr_id, e.encounter_datetime, el.location_name AS encounter_location_name, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, cu.person_name AS encounter_creator, prov.person_name AS provider"""
extract(
    "mh_diagnoses",
    "X56 F7",
    MH,
    f"""SELECT {MHC}, {years("p.birthdate", "e.encounter_datetime")} AS age_at_enc, p.gender, nm.name AS diagnosis FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 {V} {EMR} {U} {PR} LEFT JOIN c_person p ON p.person_id = e.patient_id
    LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT o.voided AND o.concept_id = {{10594}}""",
    X.mh_diagnoses,
)
extract(
    "mh_medications",
    "X58 R32 R41",
    MH,
    f""", g AS (SELECT obs_group_id, {_list("10634")} AS m, {_list("10744")} AS u, {_last("o.value_numeric", "9073")} AS d {GRP})
    SELECT {MHC}, g.m AS medication_name, g.d AS dosage, g.u AS dosage_unit FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 {V} {EMR} {U} {PR} LEFT JOIN g ON g.obs_group_id = o.obs_id WHERE NOT o.voided AND o.concept_id = {{10742}}""",
    X.mh_medications,
)
RG = Dictionary(["CIEL:166073"], [*X.REGIMEN_REASONS, "a1"], ["t-1", "t-2"], programs=[X.HIV, "p-2"])
REASONS = ", ".join("{" + k + "}" for k in X.REGIMEN_REASONS)
CASES = " ".join(f"WHEN {{{k}}} THEN '{v}'" for k, v in X.REGIMEN_REASONS.items())
extract(
    "hiv_regimens",
    "X40 R29 R37 R49 F17",
    RG,
    f""", nw AS (SELECT * FROM c_orders WHERE NOT voided AND order_type_id = 2 AND order_action = 'NEW' AND order_reason IN ({REASONS})),
    r0 AS (SELECT order_id, CAST(NULL AS BIGINT) AS previous_order_id, patient_id, order_action, encounter_id, concept_id, date_activated, date_stopped, auto_expire_date, order_reason FROM nw
      UNION ALL SELECT o.order_id, o.previous_order_id, o.patient_id, o.order_action, o.encounter_id, o.concept_id, o.date_activated, o.date_stopped, o.auto_expire_date, nw.order_reason FROM c_orders o JOIN nw ON nw.order_id = o.previous_order_id),
    r AS (SELECT *, CASE order_reason {CASES} END AS cat, coalesce(date_stopped, CASE WHEN order_action = 'NEW' THEN auto_expire_date END) AS ed, date_stopped IS NULL AND order_action = 'NEW' AND auto_expire_date IS NOT NULL AS ex FROM r0),
    oa AS (SELECT o.encounter_id, {_last("nm.name", "CIEL:166073")} AS line FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    hl AS (SELECT e.encounter_id, CASE WHEN e.location_id = (SELECT location_id FROM c_location WHERE uuid = '8d6c993e-c2cc-11de-8d13-0010c6dffd0f') THEN coalesce((SELECT p.location_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = 1 AND p.patient_id = e.patient_id AND p.date_enrolled <= e.encounter_datetime
        AND (p.date_completed >= e.encounter_datetime OR p.date_completed IS NULL) ORDER BY p.date_enrolled DESC LIMIT 1), e.location_id) ELSE e.location_id END AS lid FROM c_encounter e),
    af AS (SELECT previous_order_id AS pid, max('Revised order') FILTER (order_action = 'REVISE') AS rv, arg_max(nm.name, order_id) FILTER (order_action = 'DISCONTINUE') AS dc FROM c_orders o LEFT JOIN nm ON nm.concept_id = o.order_reason WHERE NOT voided AND order_action IN ('REVISE', 'DISCONTINUE') GROUP BY 1),
    art AS (SELECT patient_id, CAST(min(coalesce(scheduled_date, date_activated)) AS DATE) AS d FROM c_orders WHERE NOT voided AND order_reason = {{CIEL:138405}} GROUP BY 1),
    x AS (SELECT r.*, oa.line, first_value(oa.line) OVER (PARTITION BY r.patient_id, r.cat ORDER BY r.order_id) AS l0, row_number() OVER (PARTITION BY r.patient_id, r.cat ORDER BY r.order_id DESC) AS rd FROM r LEFT JOIN oa ON oa.encounter_id = r.encounter_id)
    SELECT x.order_id, x.previous_order_id, emr.identifier AS emr_id, x.order_action, {K}x.encounter_id AS encounter_id, en.encounter_datetime, lo.name AS visit_location, en.date_created AS date_entered, coalesce(u.username, u.system_id) AS user_entered, x.cat AS drug_category, x.line AS art_treatment_line,
      d.drug_inventory_id AS drug_id, sn.name AS drug_short_name, dg.name AS drug_name, d.dose, n1.name AS dose_units, d.quantity AS prescribed_quantity, n2.name AS quantity_units, n3.name AS route, n4.name AS frequency, CAST(d.duration AS DOUBLE) AS duration, n5.name AS duration_units, x.date_activated AS start_date, x.ed AS end_date,
      CASE WHEN x.ed IS NOT NULL THEN coalesce(af.rv, af.dc, CASE WHEN x.ex THEN 'expired' END) END AS end_reasons, CASE WHEN x.cat IN ('PMTCT', 'HIV Prophylaxis') THEN '1' ELSE '0' END AS ptme_or_prophylaxis, CASE WHEN x.cat = 'ART' AND x.rd = 1 THEN x.l0 END AS regimen_line_original, art.d AS art_start_date, CAST(NULL AS TIMESTAMP) AS inh_completion_date
    FROM x LEFT JOIN {identifier("emr")} emr ON emr.patient_id = x.patient_id LEFT JOIN c_encounter en ON en.encounter_id = x.encounter_id LEFT JOIN hl ON hl.encounter_id = x.encounter_id LEFT JOIN c_location lo ON lo.location_id = hl.lid LEFT JOIN c_users u ON u.user_id = en.creator LEFT JOIN c_drug_order d ON d.order_id = x.order_id
    LEFT JOIN c_drug dg ON dg.drug_id = d.drug_inventory_id LEFT JOIN c_order_frequency f ON f.order_frequency_id = d.frequency LEFT JOIN nm sn ON sn.concept_id = x.concept_id LEFT JOIN nm n1 ON n1.concept_id = d.dose_units LEFT JOIN nm n2 ON n2.concept_id = d.quantity_units LEFT JOIN nm n3 ON n3.concept_id = d.route
    LEFT JOIN nm n4 ON n4.concept_id = f.concept_id LEFT JOIN nm n5 ON n5.concept_id = d.duration_units LEFT JOIN af ON af.pid = x.order_id LEFT JOIN art ON art.patient_id = x.patient_id""",
    X.hiv_regimens,
    "orders drug_order drug order_frequency patient_program program",
)
VLD = Dictionary(["10781", "HIV viral load construct", "11781", "Date of test results", "CIEL:162086", "CIEL:1305", "CIEL:856", "11548", "15124"], ["a1", "a2"], ["t-1", "t-2"])
extract(
    "hiv_viral_load",
    "X43 R29 R37",
    VLD,
    f""", sp AS (SELECT value_text AS num, max(encounter_id) AS sid FROM c_obs WHERE NOT voided AND concept_id = {{10781}} GROUP BY 1),
    oa AS (SELECT o.encounter_id, {_list("11781")} AS est, {_last("o.value_datetime", "Date of test results")} AS res, {_last("o.value_text", "CIEL:162086")} AS num, {_list("CIEL:1305")} AS cod, {_last("o.value_numeric", "CIEL:856")} AS vl, {_last("o.value_numeric", "11548")} AS ldl FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    r AS (SELECT 'o-' || order_id AS id, patient_id, encounter_id AS oe, sp.sid AS se, order_number, date_activated, date_stopped, auto_expire_date, fulfiller_status, nm.name AS vt FROM c_orders o LEFT JOIN sp ON sp.num = o.order_number LEFT JOIN nm ON nm.concept_id = o.order_reason WHERE o.concept_id = {{15124}}
      UNION ALL SELECT 's-' || obs_id, person_id, NULL, encounter_id, NULL, NULL, NULL, NULL, NULL, NULL FROM c_obs WHERE NOT voided AND concept_id = {{HIV viral load construct}})
    SELECT {K}r.id AS hiv_vl_id, emr.identifier AS emr_id, {K}r.patient_id AS patient_id, {K}r.oe AS order_encounter_id, {K}r.se AS specimen_encounter_id, {K}r.order_number AS order_number, l.name AS visit_location, en.date_created AS date_entered, pu.person_name AS user_entered,
      CASE WHEN oa.res IS NOT NULL THEN 'Reported' WHEN r.se IS NOT NULL THEN 'Collected' WHEN r.date_stopped IS NOT NULL THEN 'Cancelled' WHEN r.auto_expire_date < DATE '{AS_OF}' THEN 'Expired' WHEN r.fulfiller_status = 'COMPLETED' THEN 'Reported' WHEN r.fulfiller_status = 'IN_PROGRESS' THEN 'Collected' WHEN r.fulfiller_status = 'EXCEPTION' THEN 'Not Performed' ELSE 'Ordered' END AS status,
      r.date_activated AS order_date, CASE WHEN r.se IS NOT NULL THEN CAST(en.encounter_datetime AS DATE) END AS vl_sample_taken_date, oa.est AS vl_sample_taken_date_estimated, CAST(oa.res AS DATE) AS vl_result_date, oa.num AS specimen_number, oa.cod AS vl_coded_results, CAST(trunc(oa.vl) AS INTEGER) AS viral_load, CAST(trunc(oa.ldl) AS INTEGER) AS ldl_value, r.vt AS vl_type,
      CAST(date_diff('day', CAST(CASE WHEN r.se IS NOT NULL THEN en.encounter_datetime ELSE r.date_activated END AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_vl, {NI} AS order_desc, {NI} AS order_asc
    FROM r LEFT JOIN c_encounter en ON en.encounter_id = coalesce(r.se, r.oe) LEFT JOIN c_location l ON l.location_id = en.location_id LEFT JOIN (SELECT u.user_id, pn.person_name FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id) pu ON pu.user_id = en.creator LEFT JOIN oa ON oa.encounter_id = r.se LEFT JOIN {identifier("emr")} emr ON emr.patient_id = r.patient_id""",
    X.hiv_viral_load,
    "orders",
)
HT = Dictionary(["CIEL:163722", "CIEL:1030", "HIV TEST DATE", "10783", "11387", "11522", "1837", "2169"], ["a1", "a2"], ["t-1", "t-2"])
extract(
    "hiv_tests",
    "X42 R22 F12",
    HT,
    f""", oa AS (SELECT encounter_id, {_last("o.value_datetime", "HIV TEST DATE")} AS said, {_last("o.value_datetime", "10783")} AS r1, {_last("o.value_datetime", "11387")} AS r2 FROM c_obs o WHERE NOT voided GROUP BY 1),
    g AS (SELECT obs_group_id, {_last("o.value_datetime", "1837")} AS d, {_list("2169")} AS t {GRP}),
    tt AS (SELECT * FROM c_obs WHERE NOT voided AND concept_id IN ({{CIEL:163722}}, {{CIEL:1030}})),
    r AS (SELECT o.person_id, o.encounter_id, coalesce(o.obs_datetime, oa.said) AS day, coalesce(oa.r1, oa.r2) AS res, a.name AS test_type, b.name AS test_result, o.date_created FROM tt o LEFT JOIN oa ON oa.encounter_id = o.encounter_id LEFT JOIN nm a ON a.concept_id = o.concept_id LEFT JOIN nm b ON b.concept_id = o.value_coded
      UNION ALL SELECT o.person_id, o.encounter_id, g.d, NULL, 'HIV test', g.t, o.date_created FROM c_obs o LEFT JOIN g ON g.obs_group_id = o.obs_id WHERE NOT o.voided AND o.concept_id = {{11522}} AND NOT EXISTS (SELECT 1 FROM tt WHERE tt.obs_group_id = o.obs_id))
    SELECT emr.identifier AS emr_id, hv.identifier AS hivemr_v1_id, {K}r.encounter_id AS encounter_id, et.name AS encounter_type, CAST(r.day AS DATE) AS specimen_collection_date, CAST(r.res AS DATE) AS result_date, r.test_type, r.test_result, r.date_created, {IDX}
    FROM r LEFT JOIN {identifier("emr")} emr ON emr.patient_id = r.person_id LEFT JOIN {identifier("hiv")} hv ON hv.patient_id = r.person_id LEFT JOIN c_encounter e ON e.encounter_id = r.encounter_id {ET}""",
    X.hiv_tests,
)
HD = Dictionary(
    ["12071", "13276", "CIEL:166073", "CIEL:5096", "3102", "3277", "CIEL:1282", "CIEL:1443", "13786", "1535"], [*X.ARV_SLOTS.values(), "656", "a1"], [HIV_DISPENSING_TYPE, "t-2"]
)
MEDS = ", ".join(f"{_last(v, k)} AS {n}" for n, v, k in (("med", "dg.name", "CIEL:1282"), ("sn", "nm.name", "CIEL:1282"), ("qt", "o.value_numeric", "CIEL:1443"), ("sq", "nm.name", "13786")))
SLOT_SQL = " ".join(f"WHEN {{{v}}} THEN '{k}'" for k, v in X.ARV_SLOTS.items())


def _wide(slot: str, kinds) -> str:
    src = {"med": "med", "med_short_name": "sn", "quantity": "CAST(trunc(qt) AS INTEGER)", "sequence": "sq"}
    return ", ".join(f"max({src[k]}) FILTER (slot = '{slot}') AS {slot}_{k}" for k in kinds)


WIDE = ", ".join(
    [_wide(s, ("med", "med_short_name", "quantity")) for s in X.ARV_SLOTS] + [_wide(s, ("med", "med_short_name", "sequence", "quantity")) for s in ("inh_1", "inh_2")]
)
extract(
    "hiv_dispensing",
    "X35 R8 R10 R12 R41 R49",
    HD,
    f""", g AS (SELECT o.obs_group_id, {MEDS} FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN c_drug dg ON dg.drug_id = o.value_drug WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1),
    an AS (SELECT encounter_id, slot, obs_group_id FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id, slot ORDER BY date_created DESC, obs_id DESC) AS r FROM (SELECT *, CASE value_coded {SLOT_SQL} END AS slot FROM c_obs WHERE NOT voided AND obs_group_id IS NOT NULL) WHERE slot IS NOT NULL) WHERE r = 1
      UNION ALL SELECT encounter_id, 'inh_' || r, obs_group_id FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY obs_datetime, obs_id) AS r FROM c_obs WHERE NOT voided AND concept_id = {{1535}} AND value_coded = {{656}}) WHERE r <= 2),
    w AS (SELECT an.encounter_id, {WIDE} FROM an LEFT JOIN g ON g.obs_group_id = an.obs_group_id GROUP BY 1),
    oa AS (SELECT o.encounter_id, {_last("nm.name", "12071")} AS dto, {_last("o.value_text", "13276")} AS acc, {_last("nm.name", "CIEL:166073")} AS line, {_last("o.value_datetime", "CIEL:5096")} AS due, {_last("o.value_numeric", "3102")} AS mo, {_last("o.value_coded", "3277")} AS mt FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    e0 AS (SELECT e.*, oa.*EXCLUDE (encounter_id), w.* EXCLUDE (encounter_id), row_number() OVER wa AS ia, row_number() OVER (PARTITION BY e.patient_id ORDER BY e.encounter_datetime DESC, e.encounter_id DESC) AS idd, lag(oa.line) OVER wa AS pl, lag(oa.due) OVER wa AS pd, first_value(w.arv_1_med_short_name) OVER wa AS fm
      FROM c_encounter e LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN w ON w.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type = 1 WINDOW wa AS (PARTITION BY e.patient_id ORDER BY e.encounter_datetime, e.encounter_id)),
    e1 AS (SELECT *, sum(CASE WHEN ia = 1 OR line IS NULL OR pl IS NULL OR pl <> line THEN 1 ELSE 0 END) OVER (PARTITION BY patient_id ORDER BY encounter_datetime, encounter_id) AS run FROM e0),
    e2 AS (SELECT *, min(encounter_datetime) OVER (PARTITION BY patient_id, run) AS ls FROM e1)
    SELECT emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, e.encounter_datetime AS dispense_date, el.location_name AS dispense_site, {FAC} AS facility, e.date_created AS date_entered, cu.username AS user_entered, {years("p.birthdate", "e.encounter_datetime")} AS age_at_dispense_date,
      e.dto AS dispensed_to, e.acc AS dispensed_accompagnateur, e.line AS current_art_treatment_line, e.ls AS current_art_line_start_date, CAST(trunc(e.mo) AS INTEGER) AS months_dispensed, CASE WHEN e.mo >= 3 THEN 'Y' ELSE 'N' END AS is_current_mmd, e.due AS next_dispense_date,
      {", ".join(f"e.{s}_{k}" for s in X.ARV_SLOTS for k in ("med", "med_short_name", "quantity"))}, {", ".join(f"e.{s}_{k}" for s in ("inh_1", "inh_2") for k in ("med", "med_short_name", "sequence", "quantity"))},
      CASE WHEN idd = 1 THEN CASE WHEN fm = arv_1_med_short_name THEN '0' ELSE '1' END END AS regimen_change, CASE WHEN idd = 1 THEN CAST(CASE WHEN e.encounter_datetime > e.pd THEN date_diff('day', CAST(e.pd AS DATE), CAST(e.encounter_datetime AS DATE)) ELSE 0 END AS INTEGER) END AS days_late_to_pickup,
      CASE WHEN e.mt IS NOT NULL THEN CASE WHEN e.mt = {{1065}} THEN '1' ELSE '0' END END AS regimen_match, CAST(ia AS INTEGER) AS dispense_date_ascending, CAST(idd AS INTEGER) AS dispense_date_descending
    FROM e2 e {V} {EMR} {U} LEFT JOIN c_person p ON p.person_id = e.patient_id""",
    X.hiv_dispensing,
    "drug",
)
TOP = """tp AS (SELECT a.location_id, CASE WHEN a.parent_location IS NULL THEN a.name WHEN b.parent_location IS NULL THEN b.name ELSE c.name END AS top FROM c_location a LEFT JOIN c_location b ON b.location_id = a.parent_location LEFT JOIN c_location c ON c.location_id = b.parent_location)"""
TS = Dictionary([X.PRESENT, X.ABSENT, "CIEL:160108"], [*X.SYMPTOMS.values(), "703", "664"], [HIV_INTAKE_TYPE, HIV_FOLLOWUP_TYPE, X.PEDS_INTAKE, X.PEDS_FOLLOWUP, "t-5"])
SYM = ", ".join(f"last(CASE WHEN concept_id = {{11563}} THEN '1' ELSE '0' END ORDER BY date_created, obs_id) FILTER (value_coded = {{{c}}}) AS {n}" for n, c in X.SYMPTOMS.items())
extract(
    "tb_screening",
    "X81 R63 R21 R24",
    TS,
    f""", {TOP}, s AS (SELECT encounter_id, {SYM} FROM c_obs WHERE NOT voided AND concept_id IN ({{11563}}, {{11564}}) GROUP BY 1), oa AS (SELECT encounter_id, {_last("o.value_coded", "CIEL:160108")} AS said FROM c_obs o WHERE NOT voided GROUP BY 1)
    SELECT emr.identifier AS emr_id, ds.identifier AS dossier_id, {K}e.encounter_id AS encounter_id, tp.top AS screening_location, {", ".join(f"s.{n} AS {n}_result" for n in X.SYMPTOMS)},
      coalesce(CASE oa.said WHEN {{703}} THEN '1' WHEN {{664}} THEN '0' END, CASE WHEN {" OR ".join(f"coalesce(s.{n}, '0') = '1'" for n in X.SYMPTOMS)} THEN '1' ELSE '0' END) AS tb_screening_result, e.encounter_datetime AS tb_screening_date,
      CAST(row_number() OVER (PARTITION BY e.patient_id ORDER BY e.encounter_datetime, e.encounter_id) AS INTEGER) AS index_ascending, CAST(row_number() OVER (PARTITION BY e.patient_id ORDER BY e.encounter_datetime DESC, e.encounter_id DESC) AS INTEGER) AS index_descending, e.date_created AS date_entered, cu.username AS user_entered
    FROM c_encounter e JOIN s ON s.encounter_id = e.encounter_id {EMR} {U} LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = e.patient_id LEFT JOIN tp ON tp.location_id = e.location_id LEFT JOIN oa ON oa.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type IN (1, 2, 3, 4)""",
    X.tb_screening,
)
TB = Dictionary([*X.TB_TESTS.values(), "11781", "DATE OF LABORATORY TEST", "Date of test results", "PPD qualitative", "CIEL:165182"], ["a1", "a2", "a3"], ["t-1", "t-2"])
KIND = " ".join(f"WHEN {{{c}}} THEN '{k}'" for k, c in X.TB_TESTS.items())
extract(
    "tb_lab_results",
    "X80 R29 R4",
    TB,
    f""", {TOP}, oa AS (SELECT o.encounter_id, {_last("nm.name", "11781")} AS est, {_last("o.value_datetime", "DATE OF LABORATORY TEST")} AS d1, {_last("o.value_datetime", "Date of test results")} AS d2, {_last("nm.name", "PPD qualitative")} AS ppd FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    b AS (SELECT o.*, CASE o.concept_id {KIND} END AS kind, 'performed' AS st FROM c_obs o WHERE NOT o.voided AND o.concept_id IN ({", ".join("{" + c + "}" for c in X.TB_TESTS.values())})
      UNION ALL SELECT o.*, CASE d.concept_id {KIND} END, 'not performed' FROM c_obs o JOIN c_orders d ON d.order_id = o.order_id AND NOT d.voided AND d.fulfiller_status LIKE '%EXCEPTION%' AND d.concept_id IN ({", ".join("{" + c + "}" for c in list(X.TB_TESTS.values())[:3])}) WHERE NOT o.voided AND o.concept_id = {{CIEL:165182}}),
    r AS (SELECT b.*, e.location_id, nm.name AS nam, oa.*EXCLUDE (encounter_id), CAST(CASE WHEN kind = 'genxpert' THEN coalesce(e.encounter_datetime, b.obs_datetime) ELSE b.obs_datetime END AS DATE) AS sd FROM b LEFT JOIN c_encounter e ON e.encounter_id = b.encounter_id AND NOT e.voided LEFT JOIN nm ON nm.concept_id = b.value_coded LEFT JOIN oa ON oa.encounter_id = b.encounter_id)
    SELECT {K}r.obs_id AS tb_lab_results_id, emr.identifier AS emr_id, ds.identifier AS dossier_id, {K}r.encounter_id AS encounter_id, tp.top AS test_location, r.sd AS specimen_collection_date, CASE WHEN st = 'performed' THEN r.est END AS sample_taken_date_estimated,
      CAST(CASE WHEN st = 'performed' THEN coalesce(r.d2, r.d1) ELSE r.d2 END AS DATE) AS test_result_date, 'tb' AS test_related_to, r.kind AS test_type, r.st AS test_status, CASE WHEN st <> 'performed' THEN r.nam END AS reason_test_not_perform,
      CASE WHEN st = 'performed' THEN CASE WHEN kind = 'skin test' THEN r.ppd ELSE r.nam END END AS test_result_text, CASE WHEN st = 'performed' AND kind = 'skin test' THEN r.value_numeric END AS test_result_numeric,
      CAST(row_number() OVER (PARTITION BY r.person_id ORDER BY r.encounter_id, r.sd, r.date_created, r.kind, r.obs_id) AS INTEGER) AS index_asc, CAST(row_number() OVER (PARTITION BY r.person_id ORDER BY r.encounter_id DESC, r.sd DESC, r.date_created DESC, r.kind DESC, r.obs_id DESC) AS INTEGER) AS index_desc,
      r.date_created AS date_entered, coalesce(u.username, u.system_id) AS user_entered FROM r LEFT JOIN {identifier("emr")} emr ON emr.patient_id = r.person_id LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = r.person_id LEFT JOIN tp ON tp.location_id = r.location_id LEFT JOIN c_users u ON u.user_id = r.creator""",
    X.tb_lab_results,
    "orders",
)
PM = Dictionary(
    ["5596", "HIV TEST DATE", "5096", "13642", "6889", "14990", "5599", X.PRESENT, X.ABSENT, "13265", "FIRST NAME", "LAST NAME", "TELEPHONE NUMBER OF CONTACT"],
    [*X.SYMPTOMS.values()], [X.PMTCT_INITIAL, X.PMTCT_FOLLOWUP], programs=[X.HIV, "p-2"],
)
SYMS = ", ".join("{" + c + "}" for c in X.SYMPTOMS.values())
extract(
    "pmtct_visits",
    "X77 R63 F16 R18",
    PM,
    f""", oa AS (SELECT o.encounter_id, {_last("o.value_datetime", "5596")} AS edd, {_last("o.value_datetime", "HIV TEST DATE")} AS td, {_last("o.value_datetime", "5096")} AS nv, {_last("nm.name", "13642")} AS bf, {_last("o.value_datetime", "6889")} AS lb, {_last("o.value_coded", "14990")} AS dl, {_last("o.value_datetime", "5599")} AS dd,
        max(o.obs_datetime) FILTER (o.value_coded IN ({SYMS})) AS son, max(1) FILTER (o.value_coded IN ({SYMS}) AND o.concept_id = {{11563}}) AS pres, max(1) FILTER (o.concept_id IN ({{13265}}, {{FIRST NAME}}, {{LAST NAME}}, {{TELEPHONE NUMBER OF CONTACT}})) AS con FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1)
    SELECT e.visit_id, vl.name AS visit_location, {K}e.encounter_id AS encounter_id, {K}(SELECT p.patient_program_id FROM c_patient_program p WHERE NOT p.voided AND p.program_id = 1 AND p.patient_id = e.patient_id AND CAST(p.date_enrolled AS DATE) <= CAST(e.encounter_datetime AS DATE)
        AND (CAST(p.date_completed AS DATE) >= CAST(e.encounter_datetime AS DATE) OR p.date_completed IS NULL) ORDER BY CAST(p.date_enrolled AS DATE) DESC, p.patient_program_id DESC LIMIT 1) AS hiv_program_id,
      emr.identifier AS emr_id, CAST(vv.date_started AS DATE) AS visit_date, el.location_name AS health_facility, e.date_created AS date_entered, cu.username AS user_entered, CAST(oa.td AS DATE) AS hiv_test_date, CAST(oa.edd AS DATE) AS expected_delivery_date, CASE WHEN oa.pres = 1 THEN CAST(oa.son AS DATE) END AS tb_screening_date,
      CASE WHEN oa.con = 1 THEN TRUE END AS has_provided_contact, oa.bf AS breastfeeding_status, oa.lb AS last_breastfeeding_date, oa.nv AS next_visit_date, CASE oa.dl WHEN {{1065}} THEN TRUE WHEN {{1066}} THEN FALSE END AS delivery, oa.dd AS delivery_datetime, {IDX}, {NI} AS index_program_asc, {NI} AS index_program_desc
    FROM c_encounter e {V} {EMR} {U} LEFT JOIN c_visit vv ON vv.visit_id = e.visit_id AND NOT vv.voided LEFT JOIN oa ON oa.encounter_id = e.encounter_id WHERE NOT e.voided AND e.encounter_type IN (1, 2)""",
    X.pmtct_visits,
    "patient_program program",
)
STATES = [("PATIENT PREGNANT", X.PREGNANT_STATE), ("other state", "s2"), ("a1", "s3")]
PC = Dictionary(["13182", "13265", "2845", "3467"], ["11197", "a1", "a2"], ["t-1"], programs=[X.HIV, "p-2"], state_codes=STATES)
extract(
    "pmtct_contacts",
    "X73 R10 F12 F16 F17",
    PC,
    f""", g AS (SELECT obs_group_id, {_list("13265")} AS ct, {_list("2845")} AS cg, {_last("o.value_numeric", "3467")} AS ca {GRP}),
    en AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY date_enrolled DESC, patient_program_id DESC) AS r FROM c_patient_program e WHERE NOT voided AND {prog(X.HIV)}) WHERE r = 1),
    art AS (SELECT patient_id, min(coalesce(scheduled_date, date_activated)) AS d FROM c_orders WHERE NOT voided AND order_reason = {{11197}} GROUP BY 1)
    SELECT emr.identifier AS emr_id, {years("p.birthdate", f"DATE '{AS_OF}'")} AS age, en.date_enrolled AS hiv_enrollment_date, (SELECT s.start_date FROM c_patient_state s WHERE NOT s.voided AND s.state = 1 AND s.patient_program_id = en.patient_program_id ORDER BY s.start_date DESC LIMIT 1) AS pmtct_initiation_date, art.d AS art_start_date,
      o.obs_datetime AS reference_date, CAST(row_number() OVER (PARTITION BY o.person_id ORDER BY o.obs_datetime, o.obs_id) AS INTEGER) AS contact_index, g.ct AS contact_type, g.cg AS contact_gender, g.ca AS contact_age, o.date_created AS date_entered, coalesce(u.username, u.system_id) AS user_entered
    FROM c_obs o {EMRP} LEFT JOIN c_person p ON p.person_id = o.person_id LEFT JOIN en ON en.patient_id = o.person_id LEFT JOIN art ON art.patient_id = o.person_id LEFT JOIN g ON g.obs_group_id = o.obs_id LEFT JOIN c_users u ON u.user_id = o.creator WHERE NOT o.voided AND o.concept_id = {{13182}}""",
    X.pmtct_contacts,
    "patient_program program patient_state orders",
)
PL = Dictionary(["3267", "lq1", "lq2", "lq3"], ["a1", "a2"], ["4d77916a-0620-11e5-a6c0-1697f925ec7b", "39C09928-0CAB-4DBA-8E48-39C631FA4286"], programs=[X.HIV, "p-2"], state_codes=STATES)
extract(
    "pmtct_labs",
    "X75 R18 R10",
    PL,
    f""", le AS (SELECT encounter_id FROM c_encounter n WHERE NOT n.voided AND n.encounter_type IN (1, 2) AND EXISTS (SELECT 1 FROM c_patient_program e JOIN c_patient_state s ON s.patient_program_id = e.patient_program_id WHERE NOT s.voided AND s.state = 1 AND {prog(X.HIV)} AND e.patient_id = n.patient_id
        AND s.start_date <= n.encounter_datetime AND (n.encounter_datetime <= s.end_date OR s.end_date IS NULL))),
    oa AS (SELECT encounter_id, {_last("o.value_datetime", "3267")} AS d FROM c_obs o WHERE NOT voided GROUP BY 1)
    SELECT emr.identifier AS emr_id, o.obs_datetime AS test_date, oa.d AS test_result_date, a.name AS test_type, coalesce(b.name, CAST(o.value_numeric AS VARCHAR), o.value_text) AS test_result, o.date_created AS date_entered, coalesce(u.username, u.system_id) AS user_entered,
      CAST(row_number() OVER (PARTITION BY o.person_id ORDER BY o.obs_datetime, o.obs_id) AS INTEGER) AS index_asc, CAST(row_number() OVER (PARTITION BY o.person_id ORDER BY o.obs_datetime DESC, o.obs_id DESC) AS INTEGER) AS index_desc
    FROM c_obs o JOIN le ON le.encounter_id = o.encounter_id {EMRP} LEFT JOIN oa ON oa.encounter_id = o.encounter_id LEFT JOIN nm a ON a.concept_id = o.concept_id LEFT JOIN nm b ON b.concept_id = o.value_coded LEFT JOIN c_users u ON u.user_id = o.creator
    WHERE NOT o.voided AND o.concept_id IN (SELECT concept_id FROM c_concept WHERE class = 'Test')""",
    X.pmtct_labs,
    "patient_program program patient_state concept",
)
PP = Dictionary(
    ["CIEL:159599", "CIEL:159758", "REFERRAL OR TRANSFER", "11525", "13955", "CIEL:5497"], ["11197", "TRANSFER", "CIEL:1065"], [X.PMTCT_INITIAL, X.PMTCT_FOLLOWUP], programs=[X.HIV, "p-2"], state_codes=STATES
)
extract("pmtct_pregnancy", "X76 R35 R59", PP, T.PMTCT_PREGNANCY, X.pmtct_pregnancy, "patient_program program patient_state program_workflow_state orders")
PI = Dictionary(["13135", "1040", "1030", "13964", "CIEL:164851", "CIEL:163529", "CIEL:1151", "5096"], ["11197", "a1"], [HIV_DISPENSING_TYPE], programs=[X.INFANTS, "p-2"])
extract("pmtct_infant_delivery", "X74 R59 R61 F14", PI, T.INFANT, X.pmtct_infant_delivery, "patient_program program orders")
EI = Dictionary(["1040", "1030", "1042"], ["CIEL:138405", "a1"], ["t-1"], programs=[X.INFANTS, "p-2"], state_codes=STATES)
extract("eid_patient", "X33 R62 F16", EI, T.EID, lambda c: X.eid_patient(c, "flow-1"), "patient_program program patient_state program_workflow_state orders relationship")
BQ = ["5599", "13555", "CIEL:161033", "CIEL:5916", "CIEL:1504", "CIEL:162131", "CIEL:135437", "11663", "13571", "13572", "13573"]
MB = Dictionary(BQ, ["5622", "a1", "a2"], [X.DELIVERY, "t-2"])


def _com(code: str) -> str:
    return f"last(o.comments ORDER BY o.date_created, o.obs_id) FILTER (o.concept_id = {{{code}}} AND o.value_coded = {{5622}})"


extract(
    "mch_birth",
    "X47 R15 F11 F12",
    MB,
    f""", g AS (SELECT obs_group_id, {_list("CIEL:161033")} AS a, {_last("o.value_numeric", "CIEL:5916")} AS b, {_last("o.value_numeric", "CIEL:1504")} AS c, {_list("CIEL:162131")} AS d, {_list("CIEL:135437")} AS f, {_list("11663")} AS h, {_list("13571")} AS i, {_com("13571")} AS j, {_list("13572")} AS k, {_com("13572")} AS l, {_list("13573")} AS m, {_com("13573")} AS n {GRP}),
    oa AS (SELECT encounter_id, {_last("o.value_datetime", "5599")} AS dt FROM c_obs o WHERE NOT voided GROUP BY 1), lo AS (SELECT o.encounter_id, {_list("11663", "|")} AS t FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NULL GROUP BY 1)
    SELECT emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, CAST(e.encounter_datetime AS DATE) AS encounter_date, e.date_created AS date_entered, cu.username AS user_entered, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, oa.dt AS delivery_datetime,
      CAST(row_number() OVER (PARTITION BY o.encounter_id ORDER BY o.obs_id) AS INTEGER) AS birth_number, CAST(count(*) OVER (PARTITION BY o.encounter_id) AS INTEGER) AS multiples, g.c AS birth_apgar, g.a AS birth_outcome, g.b AS birth_weight, g.d AS birth_neonatal_resuscitation, g.f AS birth_macerated_fetus,
      coalesce(g.h, lo.t) AS type_of_delivery, g.i AS c_section_maternal_reasons, g.j AS other_c_section_maternal_reasons, g.k AS c_section_fetal_reasons, g.l AS other_c_section_fetal_reason, g.m AS c_section_obstetrical_reasons, g.n AS other_c_section_obstetrical_reason
    FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 {V} {EMR} {U} LEFT JOIN g ON g.obs_group_id = o.obs_id LEFT JOIN oa ON oa.encounter_id = e.encounter_id LEFT JOIN lo ON lo.encounter_id = e.encounter_id WHERE NOT o.voided AND o.concept_id = {{13555}}""",
    X.mch_birth,
)
MP = Dictionary(["Type of HUM visit", "ESTIMATED DATE OF CONFINEMENT", "CIVIL STATUS"], ["ANC VISIT", "a1"], [X.OBGYN, X.DELIVERY, "t-3"], programs=[X.MATERNAL, "p-2"])
extract("mch_patient", "X52 R22 R29 R59", MP, T.MCH_PATIENT, X.mch_patient, "patient patient_program program")
NQ = ["10529", "3064", "3139", "11926"]
NA = sorted({*X.NCD_CATEGORIES.values(), *[c for r in (X.DM_TYPES, X.HEART_CATEGORIES, X.NYHA, X.CARDIOMYOPATHIES) for cs, _ in r for c in cs]})
ND = Dictionary(NQ, [*NA, "11501", "11499"], [X.NCD_INITIAL, X.NCD_FOLLOWUP], programs=[X.NCD, "p-2"], sets=[("11501", c) for cs, _ in X.DM_TYPES for c in cs] + [("11499", c) for cs, _ in X.HEART_CATEGORIES for c in cs])
extract("ncd_patient_table_staging", "X61 R24 R26", ND, T.NCD, X.ncd_patient_table_staging, "patient_program program patient_state program_workflow_state concept_set")
NH = Dictionary(["q1", "q2"], [*X.HF_FLAGS.values(), "a1", "a2", "a3", "a4"], ["NCD Initial Consult", "NCD Followup Consult"], "name", programs=["NCD", "p-2"])
HFC = ", ".join(f"bool_or(o.value_coded = {{{c}}}) AS {n}" for n, c in X.HF_FLAGS.items())
extract(
    "ncd_heart_failure_patient_staging",
    "X60 R26 R48",
    NH,
    f""", b AS (SELECT o.person_id, CAST(min(o.obs_datetime) AS DATE) AS hf_diagnosis_date, bool_or(coalesce(e.encounter_type IN (1, 2), FALSE)) AS hf_ncd, {HFC} FROM c_obs o LEFT JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided
        WHERE NOT o.voided AND o.value_coded IN ({", ".join("{" + c + "}" for c in X.HF_FLAGS.values())}) GROUP BY 1)
    SELECT emr.identifier AS emr_id, p.gender AS sex, p.birthdate, o.hf_diagnosis_date, EXISTS (SELECT 1 FROM c_patient_program e WHERE NOT e.voided AND e.date_completed IS NULL AND {prog("NCD")} AND e.patient_id = o.person_id) AS ncd_enrolled, o.hf_ncd, {", ".join("o." + n for n in X.HF_FLAGS)},
      (SELECT CAST(max(encounter_datetime) AS DATE) FROM c_encounter e WHERE NOT voided AND e.patient_id = o.person_id) AS last_visit_date, p.dead AS deceased, hc.name AS health_center FROM b o {EMRP} LEFT JOIN c_person p ON p.person_id = o.person_id LEFT JOIN {HC} hc ON hc.person_id = o.person_id""",
    X.ncd_heart_failure_patient_staging,
    "patient_program program",
)
PQ = [
    "10142", *[str(i) for i in range(10775, 10780)], "14317", "14318", "14319", "14320", "6589", "10840", "7907", "7813", "14111", "14209", "7818",
    "14313", "14239", "10485", "10783", "10785", "10782", "14315", "14314", "3064", "7817", "6110", "10770", "10772",
]
PA = Dictionary(PQ, ["a1", "a2"], ["t-1", "t-2"], order_types=(X.PATHOLOGY_ORDER, "other"))
extract("pathology_encounters", "X70 R5 F7 F9 F12", PA, T.PATHOLOGY, X.pathology_encounters, "orders encounter_role")
extract(
    "pathology_procedures",
    "X71 R56",
    PA,
    f"""SELECT emr.identifier AS emr_id, {K}d.order_id AS order_id, {K}d.order_number AS order_number, {K}o.encounter_id AS encounter_id, CASE WHEN o.concept_id = {{10770}} THEN nm.name END AS coded_procedure, CASE WHEN o.concept_id = {{10772}} THEN o.value_text END AS noncoded_procedure, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location
    FROM c_obs o JOIN c_orders d ON d.encounter_id = o.encounter_id AND NOT d.voided AND d.order_type_id = 1 LEFT JOIN c_encounter e ON e.encounter_id = o.encounter_id {V} {EMRP} LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT o.voided AND o.concept_id IN ({{10770}}, {{10772}})""",
    X.pathology_procedures,
    "orders",
)
NM = Dictionary(["q1"], ["a1", "a2"], ["t-1"])
extract(
    "new_medication_dispensing",
    "X62 R58",
    NM,
    f"""SELECT emr.identifier AS emr_id, CAST(NULL AS INTEGER) AS encounter_id, CAST(NULL AS TIMESTAMP) AS encounter_datetime, CAST(NULL AS VARCHAR) AS encounter_location, CAST(NULL AS VARCHAR) AS encounter_provider, CAST(NULL AS INTEGER) AS duration, CAST(NULL AS VARCHAR) AS duration_unit,
      e.date_created AS date_entered, u.username AS user_entered, d.name AS drug_name, dc.code AS drug_product_code, e.dose AS quantity_per_dose, dn.name AS dose_unit, fn.name AS frequency, e.quantity AS quantity_dispensed, e.dosing_instructions AS prescription
    FROM c_medication_dispense e {EMR} LEFT JOIN c_users u ON u.user_id = e.creator LEFT JOIN c_drug d ON d.drug_id = e.drug_id LEFT JOIN (SELECT drug_id, min(code) AS code FROM c_drug_code GROUP BY 1) dc ON dc.drug_id = e.drug_id LEFT JOIN nm dn ON dn.concept_id = e.dose_units
    LEFT JOIN c_order_frequency f ON f.order_frequency_id = e.frequency LEFT JOIN nm fn ON fn.concept_id = f.concept_id""",
    X.new_medication_dispensing,
    "medication_dispense order_frequency drug drug_code",
)
