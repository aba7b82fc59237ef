"""SQL twins of the extracts whose jobs chain many lookups, written from what each column means."""

from __future__ import annotations

from wardmill.catalog.extracts import ADDRESS, AS_OF, attribute, identifier, registered, years
from wardmill.catalog.records import EMR, ET, FAC, HC, PR, U, V, K, _last
from wardmill.plans.extract import maternal as M, programs as X
from wardmill.plans.extract.clinic import REGISTRATION

NI = "CAST(NULL AS INTEGER)"
IDX = f"{NI} AS index_asc, {NI} AS index_desc"
TESTP = f"NOT EXISTS (SELECT 1 FROM {attribute(1)} ta WHERE ta.person_id = e.patient_id AND ta.value = 'true')"
GRP = "FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1"
EMRE = EMR.replace("e.patient_id", "x.patient_id")
LIVE_ADDRESS = ADDRESS.replace("FROM c_person_address)", "FROM c_person_address WHERE NOT voided)")
NOW = f"TIMESTAMP '{AS_OF} 00:00:00'"
SHORT = """sn AS (SELECT concept_id, name FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY CASE WHEN locale = 'en' THEN 0 ELSE 1 END,
    CASE concept_name_type WHEN 'FULLY_SPECIFIED' THEN 1 WHEN 'SHORT' THEN 2 ELSE 0 END DESC, CASE WHEN locale_preferred THEN 0 ELSE 1 END, CASE WHEN concept_name_type IS NULL THEN 2 ELSE 0 END, name) AS r
  FROM c_concept_name WHERE NOT voided) WHERE r = 1)"""


def listed(code: str, sep: str = " | ") -> str:
    return f"string_agg(DISTINCT nm.name, '{sep}' ORDER BY nm.name) FILTER (o.concept_id = {{{code}}})"


def yes_no(expr: str) -> str:
    return f"CASE {expr} WHEN {{1065}} THEN TRUE WHEN {{1066}} THEN FALSE END"


def newest(*codes: str, order: str = "obs_datetime DESC, obs_id DESC", where: str = "") -> str:
    """Newest live observation of the questions per person."""
    ids = ", ".join("{" + c + "}" for c in codes)
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY {order}) AS r FROM c_obs WHERE NOT voided AND concept_id IN ({ids}){where}) WHERE r = 1)"


def enrolment(program: str, order: str, live: bool = True) -> str:
    """First or last enrolment per patient with its place."""
    return f"""(SELECT pp.*, l.name AS place FROM (SELECT e.*, row_number() OVER (PARTITION BY patient_id ORDER BY {order}) AS r FROM c_patient_program e WHERE NOT e.voided AND e.program_id = (SELECT program_id FROM c_program WHERE uuid = '{program}')) pp
      LEFT JOIN c_location l ON l.location_id = pp.location_id WHERE r = 1)"""


FIRST = "date_enrolled, coalesce(date_completed, TIMESTAMP '9999-12-31'), patient_program_id"
LAST = "date_enrolled DESC, coalesce(date_completed, TIMESTAMP '9999-12-31') DESC, patient_program_id DESC"


def program(uuid: str) -> str:
    return f"(SELECT program_id FROM c_program WHERE uuid = '{uuid}')"


GROUPS = " ".join(f"WHEN x.age BETWEEN {lo} AND {lo + 4} THEN 'Group {i}'" for i, lo in enumerate(range(15, 50, 5), 1))
PMTCT_PREGNANCY = f""", st AS (SELECT e.patient_id, s.patient_state_id, s.start_date FROM c_patient_state s JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state AND w.concept_id = {{PATIENT PREGNANT}}
      JOIN c_patient_program e ON e.patient_program_id = s.patient_program_id AND NOT e.voided AND e.date_completed IS NULL AND e.program_id = {program(X.HIV)} WHERE NOT s.voided),
    x AS (SELECT st.*, p.birthdate, {years("p.birthdate", "st.start_date")} AS age FROM st LEFT JOIN c_person p ON p.person_id = st.patient_id AND NOT p.voided),
    a1 AS (SELECT patient_id, min(coalesce(scheduled_date, date_activated)) AS d FROM c_orders WHERE NOT voided AND order_reason = {{11197}} GROUP BY 1),
    a2 AS (SELECT o.person_id, last(o.value_datetime ORDER BY o.obs_id) AS d FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 2 WHERE NOT o.voided AND o.concept_id = {{CIEL:159599}} GROUP BY 1),
    si AS (SELECT st.patient_state_id, max(CASE WHEN o.concept_id = {{CIEL:159758}} AND o.value_coded = {{CIEL:1065}} THEN 1 END) = 1 AS birthplan, max(CASE WHEN o.concept_id = {{REFERRAL OR TRANSFER}} AND o.value_coded = {{TRANSFER}} THEN 1 END) = 1 AS transfer,
      last(o.value_datetime ORDER BY o.obs_datetime, o.obs_id) FILTER (o.concept_id = {{11525}}) AS counsel, last(o.value_coded ORDER BY o.obs_datetime, o.obs_id) FILTER (o.concept_id = {{13955}}) AS known
      FROM st JOIN c_obs o ON o.person_id = st.patient_id AND NOT o.voided AND o.concept_id IN ({{CIEL:159758}}, {{REFERRAL OR TRANSFER}}, {{11525}}, {{13955}}) AND o.obs_datetime >= st.start_date GROUP BY 1),
    ao AS (SELECT DISTINCT patient_id FROM c_orders WHERE NOT voided AND order_reason = {{11197}} AND auto_expire_date IS NULL AND date_stopped IS NULL),
    hf AS (SELECT e.patient_id, l.name FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type IN (1, 2)) e LEFT JOIN c_location l ON l.location_id = e.location_id WHERE r = 1)
    SELECT emr.identifier AS emr_id, x.start_date, x.start_date AS pmtct_enrollment_date, hf.name AS health_facility, CAST(CASE WHEN a1.d IS NOT NULL AND a2.d IS NOT NULL THEN least(a1.d, a2.d) ELSE coalesce(a1.d, a2.d) END AS DATE) AS art_start_date, x.birthdate, x.age AS age_at_pregnancy,
      CASE {GROUPS} WHEN x.age > 50 THEN 'Group 7' WHEN x.age IS NULL THEN 'Group 10' END AS age_at_pregnancy_cat, si.birthplan AS has_birthplan, CASE WHEN ao.patient_id IS NOT NULL THEN TRUE END AS is_active_on_art, si.transfer AS transfer_status, cd.value_numeric AS cd4_count_assessed,
      CAST(si.counsel AS DATE) AS post_test_counseling_date, {yes_no("si.known")} AS hiv_known_before_current_pregnancy, {IDX}
    FROM x {EMRE} LEFT JOIN a1 ON a1.patient_id = x.patient_id LEFT JOIN a2 ON a2.person_id = x.patient_id LEFT JOIN si ON si.patient_state_id = x.patient_state_id LEFT JOIN ao ON ao.patient_id = x.patient_id LEFT JOIN {newest("CIEL:5497")} cd ON cd.person_id = x.patient_id LEFT JOIN hf ON hf.patient_id = x.patient_id"""

INFANT = f""", x AS (SELECT e.patient_id, e.date_enrolled, e.date_completed, CAST(date_sub('month', p.birthdate, DATE '{AS_OF}') AS DOUBLE) AS months FROM c_patient_program e LEFT JOIN c_person p ON p.person_id = e.patient_id AND NOT p.voided WHERE NOT e.voided AND e.program_id = {program(X.INFANTS)}),
    g AS (SELECT obs_group_id, {listed("1040")} AS res {GRP}),
    od AS (SELECT patient_id, min(b) AS art, max(CASE WHEN b <= {NOW} AND (s IS NULL OR s > {NOW}) THEN 1 END) = 1 AS active FROM (SELECT patient_id, coalesce(scheduled_date, date_activated) AS b, coalesce(date_stopped, auto_expire_date) AS s FROM c_orders WHERE order_reason = {{11197}}) GROUP BY 1),
    oa AS (SELECT encounter_id, CAST({_last("o.value_datetime", "5096")} AS DATE) AS due FROM c_obs o WHERE NOT voided GROUP BY 1),
    di AS (SELECT e.patient_id, oa.due FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type = 1) e LEFT JOIN oa ON oa.encounter_id = e.encounter_id WHERE r = 1)
    SELECT emr.identifier AS emr_id, x.months AS infant_age_in_months, CASE WHEN x.months < 2 THEN '<2 mo' WHEN x.months BETWEEN 2 AND 12 THEN '2-12 mo' ELSE '> 2 mo' END AS age_cat_infant, x.date_enrolled AS eid_date_enrolled, x.date_completed AS eid_date_completed, {yes_no("pt.value_coded")} AS delivery_with_partograph,
      mn.name AS maternity_clinic_type, bn.name AS breastfeeding_status, rt.obs_datetime AS hiv_rapid_test_date, g.res AS hiv_test_result, pc.obs_datetime AS pcr_test_date, pn2.name AS pcr_result, od.art AS art_start_date, od.active AS is_active_on_art, di.due AS next_dispensing_date,
      CASE WHEN di.due + 28 > DATE '{AS_OF}' THEN '0' ELSE '1' END AS "is_LTFU", 1 AS is_exposed, lo.name AS health_facility
    FROM x {EMRE} LEFT JOIN {newest("13135")} rt ON rt.person_id = x.patient_id LEFT JOIN g ON g.obs_group_id = rt.obs_id LEFT JOIN {newest("1030")} pc ON pc.person_id = x.patient_id LEFT JOIN nm pn2 ON pn2.concept_id = pc.value_coded LEFT JOIN {newest("13964")} pt ON pt.person_id = x.patient_id
      LEFT JOIN {newest("CIEL:164851")} mc ON mc.person_id = x.patient_id LEFT JOIN nm mn ON mn.concept_id = mc.value_coded LEFT JOIN {newest("CIEL:163529")} pl ON pl.person_id = x.patient_id LEFT JOIN c_location lo ON CAST(lo.location_id AS VARCHAR) = pl.value_text
      LEFT JOIN {newest("CIEL:1151")} bf ON bf.person_id = x.patient_id LEFT JOIN nm bn ON bn.concept_id = bf.value_coded LEFT JOIN od ON od.patient_id = x.patient_id LEFT JOIN di ON di.patient_id = x.patient_id"""

EID = f""", {SHORT}, x AS (SELECT DISTINCT e.patient_id FROM c_patient_program e WHERE NOT e.voided AND e.program_id = {program(X.INFANTS)} AND {TESTP}),
    la AS {enrolment(X.INFANTS, LAST)}, cs AS (SELECT patient_program_id, nm.name FROM (SELECT s.*, w.concept_id, row_number() OVER (PARTITION BY s.patient_program_id ORDER BY s.start_date DESC, s.patient_state_id DESC) AS r FROM c_patient_state s
      JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state AND w.program_workflow_id = 1 JOIN la ON la.patient_program_id = s.patient_program_id WHERE NOT s.voided AND (s.end_date IS NULL OR CAST(s.end_date AS TIMESTAMP) = la.date_completed)) t LEFT JOIN nm ON nm.concept_id = t.concept_id WHERE r = 1),
    ao AS (SELECT patient_id, CAST(min(coalesce(scheduled_date, date_activated)) AS DATE) AS d FROM c_orders WHERE NOT voided AND order_reason = {{CIEL:138405}} GROUP BY 1),
    mo AS (SELECT person_b, person_a FROM (SELECT r.*, row_number() OVER (PARTITION BY person_b ORDER BY r.date_created DESC, relationship_id DESC) AS n FROM c_relationship r JOIN c_person p ON p.person_id = r.person_a AND p.gender = 'F' WHERE NOT r.voided AND r.relationship = 1) WHERE n = 1)
    SELECT emr.identifier AS emr_id, hv.identifier AS hivemr_v1_id, ds.identifier AS hiv_dossier_id, pn.given_name, pn.family_name, p.gender, p.birthdate, tel.value AS telephone_number, hc.name AS health_center, round((DATE '{AS_OF}' - p.birthdate) / 365.25, 1) AS current_age, CAST(fi.date_enrolled AS DATE) AS initial_enrollment_date,
      fi.place AS initial_enrollment_location, la.place AS latest_enrollment_location, cs.name AS current_treatment_status, CAST(la.date_completed AS DATE) AS completion_date, oc.name AS outcome, t.obs_datetime AS latest_hiv_test_date, tk.name AS latest_hiv_test_type, tr.name AS latest_hiv_test_result, ao.d AS art_start_date, me.identifier AS mother_emr_id
    FROM x {EMRE} LEFT JOIN {identifier("hiv")} hv ON hv.patient_id = x.patient_id LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = x.patient_id LEFT JOIN pn ON pn.person_id = x.patient_id LEFT JOIN c_person p ON p.person_id = x.patient_id AND NOT p.voided LEFT JOIN {attribute(3)} tel ON tel.person_id = x.patient_id
      LEFT JOIN {HC} hc ON hc.person_id = x.patient_id LEFT JOIN {enrolment(X.INFANTS, FIRST)} fi ON fi.patient_id = x.patient_id LEFT JOIN la ON la.patient_id = x.patient_id LEFT JOIN cs ON cs.patient_program_id = la.patient_program_id LEFT JOIN nm oc ON oc.concept_id = la.outcome_concept_id
      LEFT JOIN {newest("1040", "1030", "1042")} t ON t.person_id = x.patient_id LEFT JOIN sn tk ON tk.concept_id = t.concept_id LEFT JOIN nm tr ON tr.concept_id = t.value_coded LEFT JOIN ao ON ao.patient_id = x.patient_id LEFT JOIN mo ON mo.person_b = x.patient_id LEFT JOIN {identifier("emr")} me ON me.patient_id = mo.person_a"""

REG = f"(SELECT min(encounter_type_id) FROM c_encounter_type WHERE uuid = '{REGISTRATION}')"
BANDS = " ".join(f"WHEN age < {e} THEN 'Group {i}'" for i, e in enumerate((10, 15, 20, 25, 30, 35, 40, 45, 50), 1))
MCH_PATIENT = f""", en AS (SELECT e.*, et.name AS type_name, l.name AS place, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS d, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime, encounter_id) AS a
      FROM c_encounter e {ET} LEFT JOIN c_location l ON l.location_id = e.location_id WHERE NOT e.voided AND e.encounter_type IN (1, 2)),
    oa AS (SELECT encounter_id, max(CASE WHEN o.concept_id = {{Type of HUM visit}} AND o.value_coded = {{ANC VISIT}} THEN 1 END) = 1 AS anc, CAST({_last("o.value_datetime", "ESTIMATED DATE OF CONFINEMENT")} AS DATE) AS edd FROM c_obs o WHERE NOT voided GROUP BY 1),
    e AS (SELECT l.patient_id, f.type_name AS ft, l.type_name AS lt, f.encounter_datetime AS fd, l.encounter_datetime AS ld, f.place AS fp, l.place AS lp, oa.anc, oa.edd FROM en l JOIN en f ON f.patient_id = l.patient_id AND f.a = 1 LEFT JOIN oa ON oa.encounter_id = l.encounter_id WHERE l.d = 1
      UNION ALL SELECT DISTINCT pp.patient_id, NULL, NULL, NULL, NULL, l.name, NULL, NULL, NULL FROM c_patient_program pp JOIN c_patient p ON p.patient_id = pp.patient_id AND NOT p.voided LEFT JOIN c_location l ON l.location_id = pp.location_id
      WHERE NOT pp.voided AND pp.program_id = {program(X.MATERNAL)} AND pp.date_completed IS NULL AND pp.patient_id NOT IN (SELECT patient_id FROM en)),
    rg AS (SELECT encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter WHERE NOT voided AND encounter_type = {REG}) WHERE r = 1),
    y AS (SELECT e.*, p.gender, p.birthdate, {years("p.birthdate", f"DATE '{AS_OF}'")} AS age FROM e LEFT JOIN c_person p ON p.person_id = e.patient_id AND NOT p.voided WHERE {TESTP})
    SELECT emr.identifier AS emr_id, ds.identifier AS dossier_id, hc.name AS health_center, e.ft AS first_encounter_type, e.lt AS latest_encounter_type, e.fd AS first_encounter_date, e.ld AS latest_encounter_date, e.fp AS initial_health_center, e.lp AS current_reporting_health_center,
      pn.given_name AS first_name, pn.family_name AS last_name, pn.middle_name AS nickname, mn.name AS marital_status, e.gender, e.birthdate AS dob, CASE WHEN e.birthdate IS NULL THEN '1' END AS age_unknown, CAST(age AS DOUBLE) AS age, CASE {BANDS} ELSE 'Group 10' END AS age_cat_1, ad.address1 AS locality,
      CASE WHEN e.anc THEN TRUE END AS antenatal_visit, e.edd AS estimated_delivery_date, CASE WHEN e.anc THEN TRUE END AS pregnant
    FROM y e {EMR} LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = e.patient_id LEFT JOIN {HC} hc ON hc.person_id = e.patient_id LEFT JOIN pn ON pn.person_id = e.patient_id LEFT JOIN {ADDRESS} ad ON ad.person_id = e.patient_id
      LEFT JOIN {newest("CIVIL STATUS", order="date_created DESC, obs_id DESC", where=" AND encounter_id IN (SELECT encounter_id FROM rg)")} ms ON ms.person_id = e.patient_id LEFT JOIN nm mn ON mn.concept_id = ms.value_coded"""


def _kinds(rules, otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN value_coded IN ({', '.join('{' + c + '}' for c in codes)}) THEN '{name}'" for codes, name in rules) + f" ELSE {otherwise} END"


def _in_set(code: str) -> str:
    return f"(SELECT a.concept_id FROM c_concept_set a WHERE a.concept_set = {{{code}}} UNION SELECT b.concept_id FROM c_concept_set a JOIN c_concept_set b ON b.concept_set = a.concept_id WHERE a.concept_set = {{{code}}})"


MINE = " AND encounter_id IN (SELECT encounter_id FROM en)"
CATEGORIES = ", ".join(f"bool_or(value_coded = {{{c}}}) AS {n}" for n, c in X.NCD_CATEGORIES.items())
HEART = ", ".join("{" + c + "}" for cs, _ in X.CARDIOMYOPATHIES for c in cs)
NCD = f""", en AS (SELECT encounter_id, patient_id, encounter_datetime FROM c_encounter WHERE NOT voided AND encounter_type IN (1, 2)),
    fl AS (SELECT patient_id, CAST(min(encounter_datetime) AS DATE) AS fd, CAST(max(encounter_datetime) AS DATE) AS ld FROM en GROUP BY 1), ca AS (SELECT person_id, {CATEGORIES} FROM c_obs WHERE NOT voided AND concept_id = {{10529}}{MINE} GROUP BY 1),
    dm AS (SELECT person_id, {_kinds(X.DM_TYPES)} AS v FROM {newest("3064", where=MINE + " AND value_coded IN " + _in_set("11501"))}), hc2 AS (SELECT person_id, {_kinds(X.HEART_CATEGORIES, "'other'")} AS v FROM {newest("3064", where=MINE + " AND value_coded IN " + _in_set("11499"))}),
    ny AS (SELECT person_id, {_kinds(X.NYHA)} AS v FROM {newest("3139", where=MINE)}), un AS (SELECT DISTINCT person_id FROM c_obs WHERE NOT voided AND concept_id = {{11926}}{MINE}),
    cm AS (SELECT person_id, {_kinds(X.CARDIOMYOPATHIES)} AS v FROM {newest("3064", order="encounter_id DESC, obs_id DESC", where=f" AND value_coded IN ({HEART})")}),
    st AS (SELECT * FROM (SELECT pp.patient_id, nm.name, s.start_date, row_number() OVER (PARTITION BY pp.patient_id ORDER BY s.start_date DESC, nm.name, s.patient_state_id) AS r FROM c_patient_state s JOIN c_patient_program pp ON pp.patient_program_id = s.patient_program_id AND pp.program_id = {program(X.NCD)}
      JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state AND w.concept_id IS NOT NULL LEFT JOIN nm ON nm.concept_id = w.concept_id) WHERE r = 1)
    SELECT emr.identifier AS emr_id, p.birthdate, p.gender AS sex, ad.state_province AS department, ad.city_village AS commune, coalesce(CAST(fi.date_enrolled AS DATE), x.fd) AS ncd_enrollment_date, x.fd AS ncd_first_encounter_date, x.ld AS ncd_latest_encounter_date, fi.place AS ncd_enrollment_location,
      la.place AS ncd_current_location, ca.* EXCLUDE (person_id), dm.v AS dm_type, hc2.v AS heart_failure_category, cm.v AS cardiomyopathy, ny.v AS nyha_class, ca.heart_failure AND un.person_id IS NOT NULL AS heart_failure_improbable, st.name AS ncd_status, st.start_date AS ncd_status_date, p.dead AS deceased,
      CAST(p.death_date AS DATE) AS date_of_death, hc.name AS health_center
    FROM fl x JOIN ca ON ca.person_id = x.patient_id {EMRE} LEFT JOIN dm ON dm.person_id = x.patient_id LEFT JOIN hc2 ON hc2.person_id = x.patient_id LEFT JOIN ny ON ny.person_id = x.patient_id LEFT JOIN un ON un.person_id = x.patient_id LEFT JOIN cm ON cm.person_id = x.patient_id LEFT JOIN st ON st.patient_id = x.patient_id
      LEFT JOIN {enrolment(X.NCD, FIRST)} fi ON fi.patient_id = x.patient_id LEFT JOIN {enrolment(X.NCD, LAST)} la ON la.patient_id = x.patient_id LEFT JOIN c_person p ON p.person_id = x.patient_id AND NOT p.voided LEFT JOIN {LIVE_ADDRESS} ad ON ad.person_id = x.patient_id LEFT JOIN {HC} hc ON hc.person_id = x.patient_id"""

TEXTS = {
    "clinical_history": "10142", "specimen_details_1": "10775", "specimen_details_2": "10776", "specimen_details_3": "10777", "specimen_details_4": "10778", "specimen_details_5": "14317", "specimen_details_6": "14318",
    "specimen_details_7": "14319", "specimen_details_8": "14320", "md_to_notify": "10779", "clinician_telephone": "6589", "specimen_accession_number": "10840", "results_note": "7907",
}
BOOLS = {"urgent_review": "7813", "suspected_cancer": "14111", "immunohistochemistry_needed": "14209", "immunohistochemistry_sent": "7818", "cancer_confirmed": "14313"}
PATH = ", ".join(
    [f"{_last('o.value_text', k)} AS {n}" for n, k in TEXTS.items()] + [f"{yes_no(_last('o.value_coded', k))} AS {n}" for n, k in BOOLS.items()]
    + [f"{_last('o.value_datetime', k)} AS {n}" for n, k in (("immunohistochemistry_sent_date", "14239"), ("process_date", "10485"), ("results_date", "10783"))]
    + [f"{_last('o.obs_id', k)} AS {n}" for n, k in (("fi", "10785"), ("g1", "10782"), ("g2", "14315"), ("g3", "14314"))]
)


def _entry(name: str, codes: tuple[str, ...]) -> str:
    ids = ", ".join("{" + c + "}" for c in codes)
    return f"{name} AS (SELECT x.encounter_id, x.date_created AS at, pn.person_name AS who FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY date_created DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND concept_id IN ({ids})) x LEFT JOIN c_users u ON u.user_id = x.creator LEFT JOIN pn ON pn.person_id = u.person_id WHERE x.r = 1)"


ROLE = ", ".join(f"max(person_name) FILTER (role = '{u}') AS {n}" for n, u in X.ROLES.items())
PATHOLOGY = f""", oa AS (SELECT encounter_id, {PATH} FROM c_obs o WHERE NOT voided GROUP BY 1), lo AS (SELECT encounter_id, {_last("o.value_datetime", "14239")} AS boston FROM c_obs o WHERE NOT voided AND obs_group_id IS NULL GROUP BY 1),
    g AS (SELECT obs_group_id, {listed("3064")} AS dx, {yes_no(_last("o.value_coded", "7817"))} AS pap, {_last("o.value_datetime", "14239")} AS papd, {_last("o.value_datetime", "6110")} AS ret {GRP}), {_entry("pe", X.PROCESSING)}, {_entry("re", X.RESULTS)},
    wh AS (SELECT encounter_id, {ROLE} FROM (SELECT ep.encounter_id, r.uuid AS role, pn.person_name, row_number() OVER (PARTITION BY ep.encounter_id, r.uuid ORDER BY ep.date_created DESC, ep.encounter_provider_id DESC) AS n FROM c_encounter_provider ep JOIN c_encounter_role r ON r.encounter_role_id = ep.encounter_role_id
      LEFT JOIN c_provider pr ON pr.provider_id = ep.provider_id LEFT JOIN pn ON pn.person_id = pr.person_id WHERE NOT ep.voided) WHERE n = 1 GROUP BY 1)
    SELECT emr.identifier AS emr_id, {years("p.birthdate", "e.encounter_datetime")} AS age_at_enc, p.gender, {K}d.order_id AS order_id, {K}d.order_number AS order_number, {K}d.encounter_id AS encounter_id, el.location_name AS encounter_location, {FAC} AS facility, e.encounter_datetime AS order_datetime, e.date_created AS order_entered_datetime,
      cu.person_name AS order_user_entered, wh.* EXCLUDE (encounter_id), px.name AS prepath_dx, {", ".join(f"oa.{n}" for n in (*TEXTS, *BOOLS, "immunohistochemistry_sent_date", "process_date", "results_date"))}, g1.dx AS post_op_diagnosis, pe.at AS process_date_entered, pe.who AS process_user_entered, oa.immunohistochemistry_sent AS specimen_to_boston,
      lo.boston AS specimen_to_boston_date, g2.pap AS specimen_to_pap, g2.papd AS specimen_to_pap_date, g2.ret AS specimen_returned_pap_date, re.at AS result_date_entered, re.who AS result_user_entered, CAST(oa.fi IS NOT NULL AS INTEGER) AS file_uploaded, g3.dx AS post_result_diagnosis
    FROM c_orders d LEFT JOIN c_encounter e ON e.encounter_id = d.encounter_id {V} LEFT JOIN {identifier("emr")} emr ON emr.patient_id = d.patient_id {U} LEFT JOIN c_person p ON p.person_id = d.patient_id AND NOT p.voided LEFT JOIN nm px ON px.concept_id = d.order_reason LEFT JOIN wh ON wh.encounter_id = d.encounter_id
      LEFT JOIN oa ON oa.encounter_id = d.encounter_id LEFT JOIN lo ON lo.encounter_id = d.encounter_id LEFT JOIN g g1 ON g1.obs_group_id = oa.g1 LEFT JOIN g g2 ON g2.obs_group_id = oa.g2 LEFT JOIN g g3 ON g3.obs_group_id = oa.g3 LEFT JOIN pe ON pe.encounter_id = d.encounter_id LEFT JOIN re ON re.encounter_id = d.encounter_id
    WHERE d.order_type_id = 1"""

DOSE = ", ".join(f"max(given) FILTER (vaccine = {{{codes[0]}}} AND dose = {d}) AS {M.dose_column(v, d)}" for v, (codes, nums) in M.VACCINES.items() for d in nums)
VACCINES = f""", vg AS (SELECT obs_group_id, max(encounter_id) FILTER (concept_id = {{{M.VACCINATIONS}}}) AS encounter_id, max(value_coded) FILTER (concept_id = {{{M.VACCINATIONS}}}) AS vaccine, max(value_numeric) FILTER (concept_id = {{{M.SEQUENCE}}}) AS dose,
      max(value_datetime) FILTER (concept_id = {{{M.VACCINE_DATE}}}) AS given FROM c_obs WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1), vd AS (SELECT encounter_id, {DOSE} FROM vg WHERE encounter_id IS NOT NULL GROUP BY 1)
    SELECT ds.identifier AS dossier_id, emr.identifier AS emr_id, reg.name AS loc_registered, {K}e.encounter_id AS encounter_id, e.encounter_datetime, el.location_name AS encounter_location, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, et.name AS encounter_type, prov.person_name AS provider,
      e.date_created AS date_entered, cu.username AS user_entered, vd.* EXCLUDE (encounter_id)
    FROM c_encounter e JOIN vd ON vd.encounter_id = e.encounter_id {V} {ET} {EMR} {U} {PR} LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = e.patient_id LEFT JOIN {registered(None)} reg ON reg.patient_id = e.patient_id
    WHERE NOT e.voided AND e.encounter_type <= 6 AND prov.person_name IS NOT NULL AND EXISTS (SELECT 1 FROM c_patient_program pp WHERE NOT pp.voided AND pp.program_id = 1 AND pp.patient_id = e.patient_id) AND {TESTP}"""

ENROLLED = f"""SELECT e.patient_program_id, e.patient_id, e.location_id, CAST(e.date_enrolled AS DATE) AS d0, CAST(e.date_completed AS DATE) AS d1, oc.name AS outcome, row_number() OVER (PARTITION BY e.patient_id ORDER BY CAST(e.date_enrolled AS DATE), e.patient_program_id) AS ia,
      row_number() OVER (PARTITION BY e.patient_id ORDER BY CAST(e.date_enrolled AS DATE) DESC, e.patient_program_id DESC) AS idd FROM c_patient_program e LEFT JOIN nm oc ON oc.concept_id = e.outcome_concept_id WHERE NOT e.voided AND e.program_id = {program(M.OVC)} AND {TESTP}"""


def _holding(closed: bool) -> str:
    return f"(SELECT pp.patient_program_id FROM pp WHERE pp.patient_id = e.patient_id AND pp.d0 <= CAST(e.encounter_datetime AS DATE) AND {'pp.d1 >= CAST(e.encounter_datetime AS DATE)' if closed else 'pp.d1 IS NULL'} ORDER BY pp.d0 DESC, pp.patient_program_id DESC LIMIT 1)"


def _runs(name: str, source: str, key: str, order: str, value: str, row: str) -> str:
    """Run numbers of a value from both ends."""
    return f"""{name}_c AS (SELECT *, CASE WHEN lag({value}) OVER (PARTITION BY {key} ORDER BY {order}) IS DISTINCT FROM {value} OR row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1 THEN 1 ELSE 0 END AS c FROM {source}),
    {name}_n AS (SELECT *, sum(c) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS up FROM {name}_c), {name} AS (SELECT {row}, up, max(up) OVER (PARTITION BY {key}) - up + 1 AS down FROM {name}_n)"""


OVC = f""", pp AS ({ENROLLED}), oa AS (SELECT o.encounter_id, {listed("Service or program", ",")} AS services, {_last("o.value_text", "Service or program non-coded")} AS other_services, {_last("nm.name", "CIEL:1169")} AS hiv_status, CAST({_last("o.value_datetime", "HIV TEST DATE")} AS DATE) AS tested
      FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    v AS (SELECT e.*, coalesce({_holding(True)}, {_holding(False)}) AS ppid FROM c_encounter e WHERE NOT e.voided AND e.encounter_type IN (1, 2) AND EXISTS (SELECT 1 FROM c_obs h WHERE NOT h.voided AND h.encounter_id = e.encounter_id)),
    kn AS (SELECT v.encounter_id, v.ppid, CAST(v.encounter_datetime AS DATE) AS day, oa.hiv_status FROM v JOIN oa ON oa.encounter_id = v.encounter_id WHERE oa.hiv_status IS NOT NULL AND v.ppid IS NOT NULL), {_runs("hr", "kn", "ppid", "day, encounter_id", "hiv_status", "encounter_id")},
    s AS (SELECT pp.patient_id, s.patient_program_id, s.patient_state_id, s.state, w.concept_id AS sc, s.start_date, s.end_date FROM c_patient_state s JOIN pp ON pp.patient_program_id = s.patient_program_id LEFT JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state WHERE NOT s.voided),
    {_runs("sr", "s", "patient_program_id", "start_date, patient_state_id", "state", "patient_state_id")},
    u AS (SELECT v.patient_id, v.ppid, pp.location_id, v.encounter_id, CAST(v.encounter_datetime AS DATE) AS day, v.date_created, v.creator, pp.d0, pp.d1, CAST(NULL AS DATE) AS s0, CAST(NULL AS DATE) AS s1, CAST(NULL AS VARCHAR) AS status, pp.outcome, oa.tested, oa.hiv_status, oa.services, oa.other_services, hr.up AS ha, hr.down AS hd, NULL AS sa, NULL AS sd, pp.ia, pp.idd
        FROM v LEFT JOIN pp ON pp.patient_program_id = v.ppid LEFT JOIN oa ON oa.encounter_id = v.encounter_id LEFT JOIN hr ON hr.encounter_id = v.encounter_id
      UNION ALL SELECT s.patient_id, s.patient_program_id, pp.location_id, NULL, NULL, NULL, NULL, pp.d0, pp.d1, s.start_date, s.end_date, nm.name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, sr.up, sr.down, pp.ia, pp.idd FROM s JOIN pp ON pp.patient_program_id = s.patient_program_id JOIN sr ON sr.patient_state_id = s.patient_state_id LEFT JOIN nm ON nm.concept_id = s.sc
      UNION ALL SELECT pp.patient_id, pp.patient_program_id, pp.location_id, NULL, NULL, NULL, NULL, pp.d0, pp.d1, NULL, NULL, NULL, pp.outcome, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, pp.ia, pp.idd FROM pp WHERE pp.patient_program_id NOT IN (SELECT patient_program_id FROM s) AND pp.patient_program_id NOT IN (SELECT ppid FROM v WHERE ppid IS NOT NULL))
    SELECT emr.identifier AS emr_id, x.ppid AS patient_program_id, l.name AS location, {K}x.encounter_id AS encounter_id, x.day AS encounter_date, x.date_created AS date_entered, coalesce(us.username, us.system_id) AS user_entered, x.d0 AS ovc_program_enrollment_date, x.d1 AS ovc_program_completion_date, x.s0 AS program_status_start_date,
      x.s1 AS program_status_end_date, x.status AS program_status, x.outcome AS program_outcome, x.tested AS hiv_test_date, x.hiv_status, x.services, x.other_services, CAST(x.ha AS INTEGER) AS index_asc_hiv_status, CAST(x.hd AS INTEGER) AS index_desc_hiv_status, CAST(x.sa AS INTEGER) AS index_asc_program_status,
      CAST(x.sd AS INTEGER) AS index_desc_program_status, CAST(x.ia AS INTEGER) AS index_asc_enrollment, CAST(x.idd AS INTEGER) AS index_desc_enrollment
    FROM u x {EMRE} LEFT JOIN c_location l ON l.location_id = x.location_id LEFT JOIN c_users us ON us.user_id = x.creator"""

STATE = """cs AS (SELECT patient_program_id, nm.name FROM (SELECT s.*, w.concept_id, row_number() OVER (PARTITION BY s.patient_program_id ORDER BY s.start_date DESC, s.patient_state_id DESC) AS r FROM c_patient_state s JOIN c_program_workflow_state w ON w.program_workflow_state_id = s.state AND w.program_workflow_id = 1
      JOIN pp ON pp.patient_program_id = s.patient_program_id WHERE NOT s.voided AND (s.end_date IS NULL OR CAST(s.end_date AS TIMESTAMP) = pp.date_completed)) t LEFT JOIN nm ON nm.concept_id = t.concept_id WHERE r = 1)"""


def _inside(code: str, value: str) -> str:
    """Newest value of a question inside the enrolment, an open one lasting until now."""
    return f"(SELECT {value} FROM ob o WHERE o.person_id = pp.patient_id AND o.concept_id = {{{code}}} AND o.obs_datetime >= pp.date_enrolled AND o.obs_datetime <= coalesce(pp.date_completed, {NOW}) ORDER BY o.obs_datetime DESC, o.obs_id DESC LIMIT 1)"


def _visits(code: str) -> str:
    return f"(SELECT count(*) FROM ob o WHERE o.person_id = pp.patient_id AND o.concept_id = {{8879}} AND o.value_coded = {{{code}}} AND o.obs_datetime >= pp.date_enrolled AND o.obs_datetime <= coalesce(pp.date_completed, {NOW}))"


EVER = ", ".join(f"max(CASE WHEN concept_id = {{10140}} AND value_coded = {{{k}}} THEN 1 END) = 1 AS {n}" for n, k in M.MATERNAL_HISTORY.items())
J9_DATA = f""", pp AS (SELECT e.patient_id, e.patient_program_id, e.date_enrolled, e.date_completed FROM c_patient_program e WHERE NOT e.voided AND e.program_id = {program(X.MATERNAL)}), {STATE},
    ob AS (SELECT o.*, nm.name, l.name AS place FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN c_location l ON CAST(l.location_id AS VARCHAR) = o.value_text WHERE NOT o.voided),
    rf AS (SELECT pp.patient_program_id, string_agg(DISTINCT o.name, ' | ' ORDER BY o.name) FILTER (o.concept_id = {{Type of referring service}}) AS a, string_agg(DISTINCT o.comments, ' | ' ORDER BY o.comments) FILTER (o.concept_id = {{Type of referring service}} AND o.value_coded = {{OTHER}}) AS b,
      string_agg(DISTINCT o.place, ' | ' ORDER BY o.place) FILTER (o.concept_id = {{CIEL:160535}}) AS c FROM pp JOIN ob o ON o.person_id = pp.patient_id AND o.concept_id IN ({{Type of referring service}}, {{CIEL:160535}}) AND o.obs_datetime >= pp.date_enrolled AND o.obs_datetime <= coalesce(pp.date_completed, {NOW}) GROUP BY 1),
    bg AS (SELECT patient_program_id, obs_group_id FROM (SELECT pp.patient_program_id, o.obs_group_id, row_number() OVER (PARTITION BY pp.patient_program_id ORDER BY o.value_numeric DESC, o.obs_datetime DESC, o.obs_id DESC) AS r FROM pp JOIN ob o ON o.person_id = pp.patient_id AND o.concept_id = {{13126}} AND o.value_numeric IS NOT NULL
      AND o.obs_datetime <= coalesce(pp.date_completed, {NOW})) WHERE r = 1), g AS (SELECT obs_group_id, {_last("nm.name", "11663")} AS dt, {listed("12899")} AS ns {GRP}),
    ev AS (SELECT person_id, {EVER}, max(obs_datetime) FILTER (concept_id = {{11673}} AND value_coded = {{903}}) AS risk FROM ob GROUP BY 1),
    rg AS (SELECT o.person_id, {_last("nm.name", "CIEL:1054")} AS ms, {_last("nm.name", "10154")} AS re FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT o.voided AND o.encounter_id IN (SELECT encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r
      FROM c_encounter WHERE NOT voided AND encounter_type = {REG}) WHERE r = 1) GROUP BY 1)
    SELECT {K}pp.patient_program_id AS mch_program_id, emr.identifier AS emr_id, {years("p.birthdate", f"DATE '{AS_OF}'")} AS patient_age, pp.date_enrolled, pp.date_completed, cs.name AS program_state, {_inside("11665", "o.value_text")} AS mothers_group, CAST({_inside("5596", "o.value_datetime")} AS DATE) AS expected_delivery_date,
      g.dt AS prior_birth_delivery_type, g.ns AS prior_birth_neonatal_status, {", ".join(f"ev.{n}" for n in M.MATERNAL_HISTORY)}, CASE WHEN ev.risk >= pp.date_enrolled THEN TRUE END AS current_hypertension_risk, {", ".join(f"{_visits(k)} AS {n}" for n, k in M.MATERNAL_VISITS.items())}, rg.ms AS marital_status, rg.re AS religion,
      {_inside("11117", "o.value_numeric")} AS number_living_children, ad.state_province AS address_department, ad.city_village AS address_commune, ad.address3 AS address_section_communale, ad.address1 AS address_locality, ad.address2 AS address_street_landmark, {_inside("13242", "o.name")} AS traditional_healer,
      {_inside("13737", "o.name")} AS prenatal_teas, rf.a AS referral_type, rf.b AS referral_type_other, rf.c AS referred_from_facility
    FROM pp LEFT JOIN {identifier("emr")} emr ON emr.patient_id = pp.patient_id LEFT JOIN c_person p ON p.person_id = pp.patient_id AND NOT p.voided LEFT JOIN cs ON cs.patient_program_id = pp.patient_program_id LEFT JOIN rf ON rf.patient_program_id = pp.patient_program_id LEFT JOIN bg ON bg.patient_program_id = pp.patient_program_id
      LEFT JOIN g ON g.obs_group_id = bg.obs_group_id LEFT JOIN ev ON ev.person_id = pp.patient_id LEFT JOIN rg ON rg.person_id = pp.patient_id LEFT JOIN {LIVE_ADDRESS} ad ON ad.person_id = pp.patient_id"""


def _seen(code: str) -> str:
    return newest(code, where=" AND encounter_id IN (SELECT encounter_id FROM c_encounter WHERE NOT voided AND encounter_type IN (1, 2))")


J9_CASES = f""", pp AS (SELECT * FROM (SELECT e.*, row_number() OVER (PARTITION BY patient_id ORDER BY date_enrolled DESC, patient_program_id DESC) AS r FROM c_patient_program e WHERE NOT e.voided AND e.date_completed IS NULL AND e.program_id = {program(X.MATERNAL)}) WHERE r = 1), {STATE},
    mo AS (SELECT person_b, person_a FROM (SELECT r.*, row_number() OVER (PARTITION BY person_b ORDER BY r.date_created DESC, relationship_id DESC) AS n FROM c_relationship r JOIN c_person p ON p.person_id = r.person_a AND p.gender = 'F' WHERE NOT r.voided AND r.relationship = 1) WHERE n = 1)
    SELECT {K}x.patient_id AS patient_id, p.uuid AS patient_uuid, pn.given_name, pn.family_name, emr.identifier AS emr_id, ds.identifier AS dossier_id, mg.value_text AS j9_group, cs.name AS j9_program, tel.value AS telephone, p.birthdate, {years("p.birthdate", f"DATE '{AS_OF}'")} AS age,
      CAST(ed.value_datetime AS DATE) AS estimated_delivery_date, CAST(dd.value_datetime AS DATE) AS actual_delivery_date, CASE WHEN {years("p.birthdate", f"DATE '{AS_OF}'")} < 1 THEN md.identifier END AS mama_dossier, ad.state_province AS department, ad.city_village AS commune, ad.address3 AS section_communal, ad.address1 AS locality,
      ad.address2 AS street_landmark, CAST(x.date_enrolled AS DATE) AS j9_enrollment_date
    FROM pp x JOIN c_person p ON p.person_id = x.patient_id AND NOT coalesce(p.dead, FALSE) {EMRE} LEFT JOIN {identifier("dossier")} ds ON ds.patient_id = x.patient_id LEFT JOIN pn ON pn.person_id = x.patient_id LEFT JOIN cs ON cs.patient_program_id = x.patient_program_id LEFT JOIN {_seen("mothers group")} mg ON mg.person_id = x.patient_id
      LEFT JOIN {_seen("5596")} ed ON ed.person_id = x.patient_id LEFT JOIN {_seen("5599")} dd ON dd.person_id = x.patient_id LEFT JOIN {attribute(3)} tel ON tel.person_id = x.patient_id LEFT JOIN {LIVE_ADDRESS} ad ON ad.person_id = x.patient_id LEFT JOIN mo ON mo.person_b = x.patient_id
      LEFT JOIN {identifier("dossier")} md ON md.patient_id = mo.person_a"""
