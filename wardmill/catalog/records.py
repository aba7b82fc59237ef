"""Record-grain extracts on the clinic laid over the driver tables, with SQL twins."""

from __future__ import annotations

from wardmill.catalog.base import query
from wardmill.catalog.clinic_tables import Dictionary
from wardmill.catalog.extracts import (
    ADDRESS,
    AS_OF,
    NAMES_FR,
    PARTITION,
    PROVIDERS,
    UNKNOWN,
    attribute,
    clinic,
    concept_ids,
    identifier,
    prelude,
    registered,
    years,
)
from wardmill.plans.extract import forms, records as R
from wardmill.plans.extract.clinic import HEALTH_CENTER_ATTRIBUTE, REGISTRATION  # noqa: F401

K = f"'{PARTITION}-' || "


def extract(name: str, covers: str, d: Dictionary, sql: str | None, build, tables: str = "", extra: str = ""):
    text = None
    if sql is not None:
        ids = concept_ids(d)
        for c, i in ids.items():
            sql = sql.replace("{" + c + "}", str(i))
        text = prelude(d, tables.split(), extra) + "\n" + sql
    query(f"extract_{name}", covers, text)(lambda t: build(clinic(t, d)))


FAC = f"coalesce(vl.name, el.facility, {UNKNOWN})"
V = "LEFT JOIN c_visit v ON v.visit_id = e.visit_id LEFT JOIN c_location vl ON vl.location_id = v.location_id LEFT JOIN places el ON el.location_id = e.location_id"
ET = "LEFT JOIN c_encounter_type et ON et.encounter_type_id = e.encounter_type"
EMR = f"LEFT JOIN {identifier('emr')} emr ON emr.patient_id = e.patient_id"
U = "LEFT JOIN (SELECT u.user_id, coalesce(u.username, u.system_id) AS username, pn.person_name FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id) cu ON cu.user_id = e.creator"
PR = f"LEFT JOIN {PROVIDERS} prov ON prov.encounter_id = e.encounter_id"
HC = f"(SELECT a.person_id, l.name FROM {attribute(5)} a LEFT JOIN c_location l ON CAST(l.location_id AS VARCHAR) = a.value)"

D1 = Dictionary(["5096", "8620"], ["3799", "8623"], ["t-1", "t-2", "t-3"])
NEXT = """nx AS (SELECT encounter_id, CAST(max(value_datetime) FILTER (o.concept_id = {5096}) AS DATE) AS next_appt_date,
  max(nm.name) FILTER (o.concept_id = {8620}) AS disposition FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1)"""
ENC_COLS = f"""emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, {K}e.patient_id AS patient_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, et.name AS encounter_type_name,
  el.location_name AS encounter_location, {FAC} AS facility, e.encounter_datetime, e.date_created AS entered_datetime, cu.person_name AS user_entered, nx.next_appt_date"""

MODS = """md AS (SELECT o.encounter_id, string_agg(DISTINCT coalesce(u.username, u.system_id), ', ' ORDER BY coalesce(u.username, u.system_id)) AS users_modified,
  string_agg(DISTINCT CAST(CAST(o.date_created AS DATE) AS VARCHAR), ', ' ORDER BY CAST(CAST(o.date_created AS DATE) AS VARCHAR)) AS dates_modified
  FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided JOIN c_users u ON u.user_id = o.creator WHERE o.creator <> e.creator GROUP BY 1)"""
ALL_ENC = f""", {NEXT}, {MODS}
SELECT {ENC_COLS}, nx.disposition, md.users_modified, md.dates_modified, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
FROM c_encounter e {V} {ET} {EMR} {U} LEFT JOIN nx ON nx.encounter_id = e.encounter_id LEFT JOIN md ON md.encounter_id = e.encounter_id WHERE NOT e.voided"""
extract("all_encounters", "X4 S7d R51 R24", D1, ALL_ENC, R.all_encounters)

WINDOWED = "e.patient_id IN (SELECT patient_id FROM c_dbevent_patient WHERE last_updated BETWEEN TIMESTAMP '2001-06-01' AND TIMESTAMP '2001-07-15')"


def _delta(c):
    c.previous_watermark, c.new_watermark = "2001-06-01 00:00:00", "2001-07-15 00:00:00"
    return R.all_encounters(c)


extract("all_encounters_delta", "X4 S7d", D1, ALL_ENC + f" AND {WINDOWED}", _delta, "dbevent_patient")
extract(
    "all_encounters_past_year",
    "X5 R56",
    D1,
    f""", {NEXT} SELECT {ENC_COLS}, e.voided FROM c_encounter e {V} {ET} {EMR} {U} LEFT JOIN nx ON nx.encounter_id = e.encounter_id
    WHERE NOT e.voided AND e.encounter_datetime >= TIMESTAMP '2000-08-01' AND CAST(e.encounter_datetime AS DATE) <= DATE '{AS_OF}'""",
    R.all_encounters_past_year,
)
extract(
    "all_visits",
    "X12 R23",
    D1,
    f"""SELECT emr.identifier AS emr_id, {K}e.visit_id AS visit_id, {K}e.patient_id AS patient_id, e.date_started AS visit_date_started, e.date_stopped AS visit_date_stopped, e.date_created AS visit_date_entered,
      cu.person_name AS visit_user_entered, vt.name AS visit_type, CAST(NULL AS BOOLEAN) AS visit_checkin, CAST(NULL AS VARCHAR) AS visit_reason, l.name AS visit_location, coalesce(l.name, {UNKNOWN}) AS facility,
      CASE WHEN e.date_started = min(e.date_started) OVER (PARTITION BY e.patient_id, year(e.date_started)) THEN TRUE END AS first_visit_this_year, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
    FROM c_visit e {EMR} {U} LEFT JOIN c_visit_type vt ON vt.visit_type_id = e.visit_type_id LEFT JOIN c_location l ON l.location_id = e.location_id WHERE NOT e.voided""",
    R.all_visits,
    "visit_type",
)

DP = Dictionary(["1054", "1304"], ["a1", "a2"], ["t-1"])
ANY_NAME = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC, date_created DESC, person_name_id DESC) AS r FROM c_person_name) WHERE r = 1)"
extract(
    "all_patients",
    "X10 R35 R48 F4 F5",
    DP,
    f""", reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r FROM c_encounter
        WHERE NOT voided AND encounter_type = (SELECT encounter_type_id FROM c_encounter_type WHERE uuid = '{REGISTRATION}')) WHERE r = 1),
    ro AS (SELECT o.encounter_id, max(nm.name) FILTER (o.concept_id = {{1054}}) AS civil_status, max(nm.name) FILTER (o.concept_id = {{1304}}) AS occupation, max(o.date_created) AS m
      FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT o.voided GROUP BY 1),
    atr AS (SELECT person_id, max(coalesce(date_changed, date_created)) AS m FROM c_person_attribute WHERE NOT voided AND person_attribute_type_id IN (3, 4) GROUP BY 1),
    en AS (SELECT patient_id, CAST(min(encounter_datetime) AS DATE) AS f, CAST(max(encounter_datetime) AS DATE) AS l FROM c_encounter GROUP BY 1)
    SELECT emr.identifier AS emr_id, hiv.identifier AS hiv_emr_id, dos.identifier AS dossier_id, {K}e.patient_id AS patient_id, mo.value AS mothers_first_name, ad.country, ad.state_province AS department, ad.city_village AS commune,
      ad.address3 AS section_communale, ad.address1 AS locality, te.value AS telephone_number, ro.civil_status, ro.occupation, rl.name AS reg_location, CAST(reg.encounter_datetime AS DATE) AS registration_date, reg.date_created AS date_registration_entered,
      ru.person_name AS user_entered, en.f AS first_encounter_date, en.l AS last_encounter_date, n.given_name AS name, n.family_name, p.birthdate AS dob, p.birthdate_estimated AS dob_estimated, p.gender, p.dead,
      CAST(p.death_date AS DATE) AS death_date, cd.name AS cause_of_death,
      greatest(coalesce(p.date_changed, p.date_created), coalesce(n.date_changed, n.date_created), coalesce(ad.date_changed, ad.date_created), atr.m, ro.m, reg.date_changed, coalesce(e.date_changed, e.date_created)) AS last_modified_datetime,
      p.uuid AS patient_uuid, CAST(NULL AS VARCHAR) AS patient_url, hc.name AS health_center
    FROM c_patient e LEFT JOIN c_person p ON p.person_id = e.patient_id {EMR} LEFT JOIN {identifier("hiv")} hiv ON hiv.patient_id = e.patient_id LEFT JOIN {identifier("dossier")} dos ON dos.patient_id = e.patient_id
    LEFT JOIN {attribute(4)} mo ON mo.person_id = e.patient_id LEFT JOIN {attribute(3)} te ON te.person_id = e.patient_id LEFT JOIN {ADDRESS} ad ON ad.person_id = e.patient_id LEFT JOIN {ANY_NAME} n ON n.person_id = e.patient_id
    LEFT JOIN reg ON reg.patient_id = e.patient_id LEFT JOIN ro ON ro.encounter_id = reg.encounter_id LEFT JOIN c_location rl ON rl.location_id = reg.location_id
    LEFT JOIN (SELECT u.user_id, pn.person_name FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id) ru ON ru.user_id = reg.creator
    LEFT JOIN atr ON atr.person_id = e.patient_id LEFT JOIN en ON en.patient_id = e.patient_id LEFT JOIN nm cd ON cd.concept_id = p.cause_of_death LEFT JOIN {HC} hc ON hc.person_id = e.patient_id
    WHERE NOT e.voided""",
    R.all_patients,
    "patient",
)

SETS = list(R.DIAGNOSIS_SETS.values())
DXA = [f"dx {i}" for i in range(30)]
DD = Dictionary(
    ["3064", R.NON_CODED, "7537", "1379"],
    DXA + SETS + ["group set"] + [f"ICD-10-WHO:J{i}" for i in range(3)],
    ["t-1", "t-2"],
    sets=[(s, DXA[(i * 3 + k) % 30]) for i, s in enumerate(SETS) for k in range(4)]
    + [(SETS[0], "group set"), ("group set", "dx 29"), ("group set", "dx 28")],
)


def _set_sql(name: str, code: str) -> str:
    i = "{" + code + "}"
    return f"""CASE WHEN x.value_coded IS NOT NULL THEN x.value_coded IN (SELECT concept_id FROM c_concept_set WHERE concept_set = {i}
      UNION SELECT b.concept_id FROM c_concept_set a JOIN c_concept_set b ON b.concept_set = a.concept_id WHERE a.concept_set = {i}) END AS {name}"""


SECTION = """(SELECT a.person_id, s4.user_generated_id AS code FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC, date_created DESC, person_address_id DESC) AS r FROM c_person_address) a
      JOIN c_address_hierarchy_entry s1 ON s1.name = a.country JOIN c_address_hierarchy_entry s2 ON s2.parent_id = s1.address_hierarchy_entry_id AND s2.name = a.state_province
      JOIN c_address_hierarchy_entry s3 ON s3.parent_id = s2.address_hierarchy_entry_id AND s3.name = a.city_village JOIN c_address_hierarchy_entry s4 ON s4.parent_id = s3.address_hierarchy_entry_id AND s4.name = a.address3 WHERE a.r = 1)"""


def _dx_sql(where: str) -> str:
    flags = ", ".join(_set_sql(n, c) for n, c in R.DIAGNOSIS_SETS.items())
    return f""", x AS (SELECT obs_id, person_id, encounter_id, obs_datetime, concept_id = {{3064}} AS coded, CASE WHEN concept_id = {{3064}} THEN obs_group_id END AS grp, CASE WHEN concept_id = {{3064}} THEN value_coded END AS value_coded,
        CASE WHEN concept_id <> {{3064}} THEN value_text END AS txt FROM c_obs o WHERE NOT voided AND concept_id IN ({{3064}}, {{{R.NON_CODED}}}) {where}),
    g AS (SELECT obs_group_id, last(nm.name ORDER BY date_created, obs_id) FILTER (o.concept_id = {{7537}} AND nm.name IS NOT NULL) AS dx_order, last(nm.name ORDER BY date_created, obs_id) FILTER (o.concept_id = {{1379}} AND nm.name IS NOT NULL) AS certainty
      FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1)
    SELECT {K}x.person_id AS patient_id, dos.identifier AS dossierid, emr.identifier AS patient_primary_id, reg.name AS loc_registered, CAST(unk.person_id AS VARCHAR) AS unknown_patient, p.gender,
      {years("p.birthdate", "e.encounter_datetime")} AS age_at_encounter, ad.state_province AS department, ad.city_village AS commune, ad.address3 AS section, ad.address1 AS locality, ad.address2 AS street_landmark,
      {K}x.encounter_id AS encounter_id, el.location_name AS encounter_location, {FAC} AS facility, {K}x.obs_id AS obs_id, x.obs_datetime, cu.person_name AS entered_by, prov.person_name AS provider,
      coalesce(fr.name, x.txt) AS diagnosis_entered, g.dx_order, g.certainty, x.coded, x.value_coded AS diagnosis_concept, fr.name AS diagnosis_coded_fr, en.name AS diagnosis_coded_en,
      (SELECT min(code) FROM c_report_mapping m WHERE m.source = 'ICD-10-WHO' AND m.concept_id = x.value_coded) AS icd10_code, {flags}, e.date_created,
      (hour(e.date_created) * 3600 + minute(e.date_created) * 60 + second(e.date_created)) - (hour(x.obs_datetime) * 3600 + minute(x.obs_datetime) * 60 + second(x.obs_datetime)) > 1800 AS retrospective,
      {K}e.visit_id AS visit_id, vl.name AS visit_location, p.birthdate, p.birthdate_estimated, et.name AS encounter_type, sc.code AS section_communale_cdc_id,
      CASE WHEN x.coded THEN x.value_coded IS NULL OR CAST(x.obs_datetime AS DATE) = min(CAST(x.obs_datetime AS DATE)) OVER (PARTITION BY x.person_id, x.value_coded, x.coded) END AS first_diagnosis
    FROM x LEFT JOIN c_encounter e ON e.encounter_id = x.encounter_id {V} {ET} {U} {PR} LEFT JOIN {identifier("emr")} emr ON emr.patient_id = x.person_id LEFT JOIN {identifier("dossier")} dos ON dos.patient_id = x.person_id
    LEFT JOIN {registered(DD)} reg ON reg.patient_id = x.person_id LEFT JOIN {attribute(2)} unk ON unk.person_id = x.person_id LEFT JOIN c_person p ON p.person_id = x.person_id AND NOT p.voided
    LEFT JOIN {ADDRESS} ad ON ad.person_id = x.person_id LEFT JOIN g ON g.obs_group_id = x.grp LEFT JOIN nm en ON en.concept_id = x.value_coded LEFT JOIN nm_fr fr ON fr.concept_id = x.value_coded
    LEFT JOIN {SECTION} sc ON sc.person_id = x.person_id"""


extract("all_diagnosis", "X2 R23 R38 R41 F3", DD, _dx_sql(""), R.all_diagnosis, "concept_set report_mapping address_hierarchy_entry", NAMES_FR)
extract(
    "all_diagnosis_past_year",
    "X3 R56",
    DD,
    _dx_sql(f"AND obs_datetime >= TIMESTAMP '2000-08-01' AND CAST(obs_datetime AS DATE) <= DATE '{AS_OF}'"),
    R.all_diagnosis_past_year,
    "concept_set report_mapping address_hierarchy_entry",
    NAMES_FR,
)
DPL = Dictionary(
    ["3064", R.NON_CODED, "7537", "1379"],
    DXA + list(R.PLAIN_SETS.values()) + ["group set"] + [f"ICD-10-WHO:J{i}" for i in range(3)],
    ["t-1", "t-2"],
    sets=[(s, DXA[(i * 3 + k) % 30]) for i, s in enumerate(R.PLAIN_SETS.values()) for k in range(4)] + [(R.NOTIFIABLE_SET, "group set"), ("group set", "dx 29")],
)
PLAIN_FLAGS = ", ".join(f"CAST({_set_sql(n, c).rsplit(' AS ', 1)[0]} AS INTEGER) AS {n}" for n, c in R.PLAIN_SETS.items())
extract(
    "diagnoses",
    "X29 R38 R41 R56 F3",
    DPL,
    f""", x AS (SELECT obs_id, person_id, encounter_id, obs_datetime, concept_id = {{3064}} AS coded, CASE WHEN concept_id = {{3064}} THEN obs_group_id END AS grp, CASE WHEN concept_id = {{3064}} THEN value_coded END AS value_coded,
        CASE WHEN concept_id <> {{3064}} THEN value_text END AS txt FROM c_obs o WHERE NOT voided AND concept_id IN ({{3064}}, {{{R.NON_CODED}}}) AND CAST(obs_datetime AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'),
    g AS (SELECT obs_group_id, last(nm.name ORDER BY date_created, obs_id) FILTER (o.concept_id = {{7537}} AND nm.name IS NOT NULL) AS dx_order, last(nm.name ORDER BY date_created, obs_id) FILTER (o.concept_id = {{1379}} AND nm.name IS NOT NULL) AS certainty
      FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1)
    SELECT x.person_id AS patient_id, dos.identifier AS dossier_id, emr.identifier AS patient_primary_id, reg.name AS loc_registered, CAST(unk.person_id AS VARCHAR) AS unknown_patient, p.gender, {years("p.birthdate", "e.encounter_datetime")} AS age_at_encounter,
      ad.state_province AS department, ad.city_village AS commune, ad.address3 AS section, ad.address1 AS locality, ad.address2 AS street_landmark, x.encounter_id, el.location_name AS encounter_location, {FAC} AS facility, x.obs_id, x.obs_datetime,
      cu.person_name AS entered_by, prov.person_name AS provider, coalesce(en.name, x.txt) AS diagnosis_entered, g.dx_order, g.certainty, CASE WHEN x.coded THEN '1' ELSE '0' END AS coded, x.value_coded AS diagnosis_concept, fr.name AS diagnosis_coded_fr,
      (SELECT min(code) FROM c_report_mapping m WHERE m.source = 'ICD-10-WHO' AND m.concept_id = x.value_coded) AS icd10_code, {PLAIN_FLAGS}, e.date_created,
      CAST(coalesce((hour(e.date_created) * 3600 + minute(e.date_created) * 60 + second(e.date_created)) - (hour(x.obs_datetime) * 3600 + minute(x.obs_datetime) * 60 + second(x.obs_datetime)) > 1800, FALSE) AS INTEGER) AS retrospective,
      e.visit_id, vl.name AS visit_location, p.birthdate, p.birthdate_estimated, et.name AS encounter_type, sc.code AS section_communale_cdc_id
    FROM x LEFT JOIN c_encounter e ON e.encounter_id = x.encounter_id {V} {ET} {U} {PR} LEFT JOIN {identifier("emr")} emr ON emr.patient_id = x.person_id LEFT JOIN {identifier("dossier")} dos ON dos.patient_id = x.person_id
    LEFT JOIN {registered(DPL)} reg ON reg.patient_id = x.person_id LEFT JOIN {attribute(2)} unk ON unk.person_id = x.person_id LEFT JOIN c_person p ON p.person_id = x.person_id AND NOT p.voided LEFT JOIN {ADDRESS} ad ON ad.person_id = x.person_id
    LEFT JOIN g ON g.obs_group_id = x.grp LEFT JOIN nm en ON en.concept_id = x.value_coded LEFT JOIN nm_fr fr ON fr.concept_id = x.value_coded LEFT JOIN {SECTION} sc ON sc.person_id = x.person_id""",
    lambda c: R.diagnoses(c, "1996-01-01", "1999-12-31"),
    "concept_set report_mapping address_hierarchy_entry",
    NAMES_FR,
)

DL = Dictionary(["10781", "11791", "Date of test results", "11781"], ["a1", "a2", "a3"], [R.SPECIMEN_COLLECTION, "t-2"])


def _last(value: str, code: str) -> str:
    return f"last({value} ORDER BY o.date_created, o.obs_id) FILTER (o.concept_id = {{{code}}} AND {value} IS NOT NULL)"


extract(
    "all_lab_orders",
    "X6 R2 R37",
    DL,
    f""", sp AS (SELECT value_text AS num, max(o.encounter_id) AS sid FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 WHERE NOT o.voided AND o.concept_id = {{10781}} GROUP BY 1),
    so AS (SELECT encounter_id, {_last("nm.name", "11791")} AS test_location, {_last("value_datetime", "Date of test results")} AS result_date, {_last("nm.name", "11781")} AS est
      FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided GROUP BY 1),
    pv AS (SELECT x.encounter_id, pn.person_name, r.name AS role FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY encounter_provider_id) AS r FROM c_encounter_provider WHERE NOT voided) x
      JOIN c_provider p ON p.provider_id = x.provider_id LEFT JOIN pn ON pn.person_id = p.person_id LEFT JOIN c_provider_role r ON r.provider_role_id = p.provider_role_id WHERE x.r = 1)
    SELECT {K}o.patient_id AS patient_id, emr.identifier AS emr_id, reg.name AS loc_registered, CASE WHEN unk.person_id IS NOT NULL THEN '1' END AS unknown_patient, p.gender, {years("p.birthdate", "e.encounter_datetime")} AS age_at_encounter,
      {K}o.order_number AS order_number, rn.name AS order_reason, o.accession_number AS lab_id, cn.name AS orderable,
      CASE WHEN o.date_stopped IS NOT NULL AND sp.sid IS NULL THEN 'Cancelled' WHEN o.auto_expire_date < DATE '{AS_OF}' AND sp.sid IS NULL THEN 'Expired' WHEN o.fulfiller_status = 'COMPLETED' THEN 'Reported'
        WHEN o.fulfiller_status = 'IN_PROGRESS' THEN 'Collected' WHEN o.fulfiller_status = 'EXCEPTION' THEN 'Not Performed' ELSE 'Ordered' END AS status,
      pv.person_name AS user_entered, pv.role AS orderer_provider_type, o.date_activated AS order_datetime, el.location_name AS ordering_location, {K}e.visit_id AS visit_id, vl.name AS visit_location, {FAC} AS facility, o.urgency,
      se.encounter_datetime AS specimen_collection_datetime, so.est AS collection_date_estimated, so.test_location, so.result_date
    FROM c_orders o LEFT JOIN sp ON sp.num = o.order_number LEFT JOIN c_encounter e ON e.encounter_id = o.encounter_id {V} LEFT JOIN {identifier("emr")} emr ON emr.patient_id = o.patient_id LEFT JOIN {registered(DL)} reg ON reg.patient_id = o.patient_id
    LEFT JOIN {attribute(2)} unk ON unk.person_id = o.patient_id LEFT JOIN c_person p ON p.person_id = o.patient_id LEFT JOIN nm cn ON cn.concept_id = o.concept_id LEFT JOIN nm rn ON rn.concept_id = o.order_reason
    LEFT JOIN pv ON pv.encounter_id = o.encounter_id LEFT JOIN c_encounter se ON se.encounter_id = sp.sid LEFT JOIN so ON so.encounter_id = sp.sid
    WHERE o.order_type_id = 1 AND o.order_action = 'NEW' AND NOT EXISTS (SELECT 1 FROM {attribute(1)} ta WHERE ta.person_id = o.patient_id AND ta.value = 'true')""",
    R.all_lab_orders,
    "orders provider_role",
)

LABQ = [f"lab q{i}" for i in range(8)]
DR = Dictionary(
    LABQ + ["10783", "not performed reason"],
    ["a1", "a2", "lab tests", "panel", "LOINC:x1", "LOINC:x2"],
    ["t-1", "t-2"],
    sets=[("lab tests", LABQ[0]), ("lab tests", LABQ[1]), ("lab tests", "panel"), ("panel", LABQ[2]), ("panel", LABQ[3])],
)
extract(
    "all_lab_results",
    "X7 R39",
    DR,
    f""", tests AS (SELECT concept_id FROM c_concept_set WHERE concept_set = {{lab tests}} UNION SELECT b.concept_id FROM c_concept_set a JOIN c_concept_set b ON b.concept_set = a.concept_id WHERE a.concept_set = {{lab tests}}),
    x AS (SELECT obs_id, person_id, encounter_id, order_id, concept_id AS tst, value_coded, value_numeric, value_text, CAST(NULL AS BIGINT) AS why FROM c_obs WHERE NOT voided AND concept_id IN (SELECT * FROM tests) AND coalesce(CAST(value_coded AS VARCHAR), CAST(value_numeric AS VARCHAR), value_text) IS NOT NULL
      UNION ALL SELECT obs_id, person_id, encounter_id, order_id, NULL, NULL, NULL, NULL, value_coded FROM c_obs WHERE NOT voided AND concept_id = {{not performed reason}}),
    rd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY date_created DESC, obs_id DESC) AS r FROM c_obs WHERE NOT voided AND concept_id = {{10783}}) WHERE r = 1)
    SELECT {K}x.obs_id AS obs_id, {K}x.person_id AS patient_id, emr.identifier AS emr_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, {K}x.encounter_id AS encounter_id, et.name AS encounter_type, el.location_name AS encounter_location, {FAC} AS facility,
      reg.name AS loc_registered, CAST(unk.person_id AS VARCHAR) AS unknown_patient, p.gender, {years("p.birthdate", "e.encounter_datetime")} AS age_at_encounter, {K}od.order_number AS order_number, oc.name AS orderable, tn.name AS test, od.accession_number AS lab_id,
      (SELECT string_agg(DISTINCT code, ' | ' ORDER BY code) FROM c_report_mapping m WHERE m.source = 'LOINC' AND m.concept_id = x.tst) AS "LOINC", CAST(e.encounter_datetime AS DATE) AS specimen_collection_date, e.date_created AS specimen_collection_entry_date,
      cu.person_name AS user_entered, CAST(rd.value_datetime AS DATE) AS results_date, rd.date_created AS results_entry_date, CASE WHEN x.value_coded IS NOT NULL THEN vc.name ELSE coalesce(CAST(x.value_numeric AS VARCHAR), x.value_text) END AS result,
      CASE WHEN x.tst % 2 = 0 THEN 'mg' END AS units, wn.name AS reason_not_performed, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
    FROM x LEFT JOIN c_encounter e ON e.encounter_id = x.encounter_id {V} {ET} {U} LEFT JOIN {identifier("emr")} emr ON emr.patient_id = x.person_id LEFT JOIN {registered(DR)} reg ON reg.patient_id = x.person_id LEFT JOIN {attribute(2)} unk ON unk.person_id = x.person_id
    LEFT JOIN c_person p ON p.person_id = x.person_id LEFT JOIN c_orders od ON od.order_id = x.order_id LEFT JOIN nm oc ON oc.concept_id = od.concept_id LEFT JOIN nm tn ON tn.concept_id = x.tst LEFT JOIN nm vc ON vc.concept_id = x.value_coded LEFT JOIN nm wn ON wn.concept_id = x.why
    LEFT JOIN rd ON rd.encounter_id = x.encounter_id""",
    R.all_lab_results,
    "orders concept_set report_mapping",
)

ALL_PROC = sorted({c for cs in R.PROCEDURE_FLAGS.values() for c in cs})
DPR = Dictionary([*R.CODED_PROCEDURES, R.FREE_PROCEDURE], ALL_PROC, ["t-1", "t-2"])
PF = ", ".join(
    f"CAST(CASE WHEN o.value_coded IN ({', '.join('{' + c + '}' for c in cs)}) THEN 1 ELSE 0 END AS INTEGER) AS {n}"
    for n, cs in R.PROCEDURE_FLAGS.items()
)
extract(
    "all_procedures",
    "X11 R38",
    DPR,
    f"""SELECT emr.identifier AS emr_id, o.encounter_id, o.obs_id, e.visit_id, vl.name AS visit_location, o.creator, e.encounter_datetime, o.obs_datetime, el.location_name AS encounter_location, {FAC} AS facility, et.name AS encounter_type,
      ou.person_name AS entered_by, prov.person_name AS provider, CASE WHEN o.concept_id <> {{{R.FREE_PROCEDURE}}} THEN nm.name ELSE o.value_text END AS procedures, CAST(CASE WHEN o.concept_id <> {{{R.FREE_PROCEDURE}}} THEN 1 ELSE 0 END AS INTEGER) AS procedure_coded,
      o.date_created, CAST(CASE WHEN trunc(epoch(o.date_created - e.encounter_datetime) / 60) > 30 THEN 1 ELSE 0 END AS INTEGER) AS retrospective, {PF}
    FROM c_obs o LEFT JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided {V} {ET} LEFT JOIN {PROVIDERS} prov ON prov.encounter_id = o.encounter_id LEFT JOIN {identifier("emr")} emr ON emr.patient_id = o.person_id
    LEFT JOIN (SELECT u.user_id, pn.person_name FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id) ou ON ou.user_id = o.creator LEFT JOIN nm ON nm.concept_id = o.value_coded
    WHERE NOT o.voided AND o.concept_id IN ({{10751}}, {{10484}}, {{{R.FREE_PROCEDURE}}})""",
    R.all_procedures,
)

DM = Dictionary(["9070", "9071", "9072", "9073", "9074", "9075", "6412", "9363", "1282"], ["a1", "a2", "a3", "1267"], ["t-1", "t-2"])


def _max(value: str, code: str, name: str) -> str:
    return f"max({value}) FILTER (o.concept_id = {{{code}}}) AS {name}"


GROUPED = "FROM c_obs o LEFT JOIN nm ON nm.concept_id = o.value_coded WHERE NOT voided AND obs_group_id IS NOT NULL GROUP BY 1"
DRUG_CODE = "(SELECT drug_id, min(code) AS code FROM c_drug_code GROUP BY 1)"
extract(
    "all_medication_dispensing",
    "X8 R41 R29 S4",
    DM,
    f""", g AS (SELECT obs_group_id, {_max("value_numeric", "9073", "dose")}, {_max("value_text", "9074", "du")}, {_max("value_numeric", "9075", "dur")}, {_max("nm.name", "6412", "duu")}, {_max("nm.name", "9363", "freq")},
        {_max("value_numeric", "9071", "qty")}, {_max("value_text", "9072", "ins")}, {_max("value_drug", "1282", "drug")} {GROUPED}),
    x AS (
      SELECT 'Old' AS form, h.obs_id AS did, h.person_id AS patient_id, h.encounter_id, e.encounter_datetime, e.date_created AS ent, e.creator, e.location_id, e.visit_id, prov.person_name AS prov, g.drug, g.dur, g.duu, g.dose, g.du, g.freq, g.qty, g.du AS qu, CAST(NULL AS BIGINT) AS oid, g.ins
      FROM c_obs h LEFT JOIN g ON g.obs_group_id = h.obs_id LEFT JOIN c_encounter e ON e.encounter_id = h.encounter_id {PR} WHERE NOT h.voided AND h.concept_id = {{9070}}
      UNION ALL
      SELECT 'New', m.medication_dispense_id, m.patient_id, m.encounter_id, m.date_handed_over, m.date_created, m.creator, m.location_id, e.visit_id, w.person_name, m.drug_id, NULL, NULL, m.dose, dn.name, fn.name, m.quantity, qn.name, m.drug_order_id, m.dosing_instructions
      FROM c_medication_dispense m LEFT JOIN c_encounter e ON e.encounter_id = m.encounter_id LEFT JOIN c_order_frequency f ON f.order_frequency_id = m.frequency LEFT JOIN nm fn ON fn.concept_id = f.concept_id LEFT JOIN nm dn ON dn.concept_id = m.dose_units LEFT JOIN nm qn ON qn.concept_id = m.quantity_units
      LEFT JOIN (SELECT p.provider_id, pn.person_name FROM c_provider p LEFT JOIN pn ON pn.person_id = p.person_id) w ON w.provider_id = m.dispenser WHERE m.status = {{1267}})
    SELECT {K}did AS dispensing_id, form, {K}e.patient_id AS patient_id, emr.identifier AS emr_id, {K}e.encounter_id AS encounter_id, e.encounter_datetime, el.location_name AS encounter_location, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, ent AS datetime_entered,
      cu.person_name AS user_entered, e.prov AS encounter_provider, d.name AS drug_name, dc.code AS drug_product_code, CAST(trunc(dur) AS INTEGER) AS duration, duu AS duration_unit, dose AS quantity_per_dose, du AS dose_unit, freq AS frequency, CAST(trunc(qty) AS INTEGER) AS quantity_dispensed, qu AS quantity_unit,
      {K}oid AS order_id, ins AS instructions, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
    FROM x e {V} {EMR} {U} LEFT JOIN c_drug d ON d.drug_id = e.drug LEFT JOIN {DRUG_CODE} dc ON dc.drug_id = e.drug""",
    R.all_medication_dispensing,
    "medication_dispense order_frequency drug drug_code",
)
DMP = Dictionary(["10742", "9071", "9072", "9073", "10744", "9075", "6412", "9363", "1282", "10634", "Medication comments (text)"], ["a1", "a2", "a3"], ["t-1", "t-2"])
extract(
    "all_medication_prescribed",
    "X9 R24 R29 F17",
    DMP,
    f""", g AS (SELECT obs_group_id, {_max("value_numeric", "9073", "dose")}, {_max("nm.name", "10744", "du")}, {_max("value_numeric", "9075", "dur")}, {_max("nm.name", "6412", "duu")}, {_max("nm.name", "9363", "freq")}, {_max("value_numeric", "9071", "qty")}, {_max("value_text", "9072", "ins")},
        max(value_drug) FILTER (o.concept_id IN ({{1282}}, {{10634}})) AS drug, max(value_coded) FILTER (o.concept_id IN ({{1282}}, {{10634}})) AS dcon {GROUPED}),
    oc AS (SELECT encounter_id, {_last("value_text", "Medication comments (text)")} AS t FROM c_obs o WHERE NOT voided GROUP BY 1),
    x AS (
      SELECT h.encounter_id, h.person_id AS patient_id, e.encounter_type, e.visit_id, e.location_id, e.creator, CAST(NULL AS BIGINT) AS oid, CAST(e.date_created AS DATE) AS cd, CAST(e.encounter_datetime AS DATE) AS ad, g.dcon, g.drug, g.dose, g.du, g.ins, CAST(NULL AS VARCHAR) AS route, g.freq, g.qty,
        CAST(NULL AS VARCHAR) AS qu, g.dur, g.duu, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS com, CAST(NULL AS VARCHAR) AS non, CAST(NULL AS INTEGER) AS refills
      FROM c_obs h JOIN c_encounter e ON e.encounter_id = h.encounter_id AND NOT e.voided LEFT JOIN g ON g.obs_group_id = h.obs_id WHERE NOT h.voided AND h.concept_id = {{10742}}
      UNION ALL
      SELECT o.encounter_id, o.patient_id, e.encounter_type, e.visit_id, e.location_id, e.creator, o.order_id, CAST(o.date_created AS DATE), CAST(o.date_activated AS DATE), o.concept_id, d.drug_inventory_id, d.dose, n1.name, d.dosing_instructions, n2.name, n3.name, d.quantity, n4.name, d.duration, n5.name, n6.name, oc.t, d.drug_non_coded, d.num_refills
      FROM c_orders o JOIN c_drug_order d ON d.order_id = o.order_id LEFT JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided LEFT JOIN c_order_frequency f ON f.order_frequency_id = d.frequency LEFT JOIN nm n1 ON n1.concept_id = d.dose_units LEFT JOIN nm n2 ON n2.concept_id = d.route
      LEFT JOIN nm n3 ON n3.concept_id = f.concept_id LEFT JOIN nm n4 ON n4.concept_id = d.quantity_units LEFT JOIN nm n5 ON n5.concept_id = d.duration_units LEFT JOIN nm n6 ON n6.concept_id = o.order_reason LEFT JOIN oc ON oc.encounter_id = o.encounter_id WHERE NOT o.voided)
    SELECT emr.identifier AS emr_id, et.name AS encounter_type, {K}e.encounter_id AS encounter_id, {K}e.visit_id AS visit_id, vl.name AS visit_location, {K}oid AS order_id, el.location_name AS order_location, {FAC} AS facility, cd AS order_created_date, ad AS order_date_activated, cu.person_name AS user_entered,
      prov.person_name AS prescriber, dn.name AS order_drug, d.name AS order_formulation, dc.code AS product_code, CAST(trunc(qty) AS INTEGER) AS order_quantity, qu AS order_quantity_units, CAST(trunc(dose) AS INTEGER) AS order_dose, du AS order_dose_unit, ins AS order_dosing_instructions, route AS order_route,
      freq AS order_frequency, CAST(trunc(dur) AS INTEGER) AS order_duration, duu AS order_duration_units, reason AS order_reason, com AS order_comments, non AS order_formulation_non_coded, refills AS order_quantity_num_refills
    FROM x e {V} {ET} {EMR} {U} {PR} LEFT JOIN nm dn ON dn.concept_id = e.dcon LEFT JOIN c_drug d ON d.drug_id = e.drug LEFT JOIN {DRUG_CODE} dc ON dc.drug_id = e.drug""",
    R.all_medication_prescribed,
    "orders drug_order order_frequency drug drug_code",
)
DC = Dictionary(["10506"], ["5622", "a1", "a2"], [forms.CHEMO, "t-2"])
extract(
    "chemo_session_regimens",
    "X15",
    DC,
    f"""SELECT emr.identifier AS emr_id, {K}o.obs_id AS obs_id, {K}o.encounter_id AS encounter_id, e.encounter_datetime, nm.name AS chemo_regimen_name, CASE WHEN nm.name = 'Other' THEN (SELECT last(x.comments ORDER BY x.date_created, x.obs_id) FROM c_obs x WHERE NOT x.voided AND x.encounter_id = o.encounter_id AND x.concept_id = {{10506}} AND x.value_coded = {{5622}}) END AS other_regimen
    FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id AND NOT e.voided AND e.encounter_type = 1 LEFT JOIN nm ON nm.concept_id = o.value_coded LEFT JOIN {identifier("emr")} emr ON emr.patient_id = o.person_id WHERE NOT o.voided AND o.concept_id = {{10506}}""",
    R.chemo_session_regimens,
)
extract(
    "datakind_encounter",
    "X26 R27 R58",
    D1,
    f"""SELECT {K}e.patient_id AS patient_id, {K}e.encounter_id AS encounter_id, e.encounter_datetime, et.name AS encounter_type, el.location_name AS encounter_location, {FAC} AS facility, {K}e.visit_id AS visit_id, vl.name AS visit_location, prov.person_name AS provider, e.date_created AS date_entered,
      cu.username AS user_entered, e.date_changed, n.n AS obs_count, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc FROM c_encounter e {V} {ET} {U} {PR} LEFT JOIN (SELECT encounter_id, count(*) AS n FROM c_obs WHERE NOT voided GROUP BY 1) n ON n.encounter_id = e.encounter_id WHERE NOT e.voided""",
    R.datakind_encounter,
)
extract(
    "datakind_patient_program",
    "X27",
    D1,
    """SELECT e.patient_id, p.name AS program_name, e.date_enrolled, e.date_completed, nm.name AS outcome, e.date_created, e.date_changed FROM c_patient_program e JOIN c_program p ON p.program_id = e.program_id LEFT JOIN nm ON nm.concept_id = e.outcome_concept_id WHERE NOT e.voided""",
    R.datakind_patient_program,
    "patient_program program",
)
extract(
    "datakind_registration",
    "X28 R58",
    D1,
    f"""SELECT p.patient_id, e.encounter_datetime AS registration_date, d.death_date, p.date_created AS patient_date_created, p.date_changed AS patient_date_changed, e.date_created AS encounter_date_created, e.date_changed AS encounter_date_changed, hc.name AS health_center
    FROM c_patient p LEFT JOIN c_encounter e ON e.patient_id = p.patient_id AND NOT e.voided AND NOT p.voided AND e.encounter_type = (SELECT encounter_type_id FROM c_encounter_type WHERE uuid = '{REGISTRATION}')
    LEFT JOIN c_person d ON d.person_id = p.patient_id LEFT JOIN {HC} hc ON hc.person_id = p.patient_id""",
    R.datakind_registration,
    "patient",
)

HIVP, EIDP = "b1cb1fc1-5190-4f7a-af08-48870975dafc", "7e06bf82-9f1a-4218-b68f-823082ef519b"
DQ = Dictionary(
    ["q1"], ["a1"], [R.HIV_DISPENSING_TYPE, R.HIV_INTAKE_TYPE, R.HIV_FOLLOWUP_TYPE, R.INFANT_FOLLOWUP_TYPE], programs=[HIVP, EIDP, "p-3", "p-4", "p-5", "p-6"]
)
OVER = """ov AS (SELECT a.patient_id, pr.name, a.patient_program_id, b.patient_program_id AS other_id FROM c_patient_program a JOIN c_program pr ON pr.program_id = a.program_id JOIN c_patient_program b ON NOT b.voided AND b.patient_id = a.patient_id AND b.program_id = a.program_id
  AND b.patient_program_id <> a.patient_program_id AND a.date_enrolled < b.date_enrolled AND coalesce(a.date_completed, TIMESTAMP '9999-12-31') > b.date_enrolled WHERE NOT a.voided)"""
JUDGED = f""", {OVER}, pt AS (SELECT p.patient_id, emr.identifier AS emr_id, unk.person_id AS unk FROM c_patient p LEFT JOIN {identifier("emr")} emr ON emr.patient_id = p.patient_id LEFT JOIN {attribute(2)} unk ON unk.person_id = p.patient_id WHERE NOT p.voided),
j AS (SELECT 1 AS rule, patient_id, emr_id IS NULL AS bad FROM pt UNION ALL SELECT 2, patient_id, birthdate IS NULL AND unk IS NOT NULL FROM pt JOIN c_person ON person_id = patient_id UNION ALL SELECT 3, patient_id, gender IS NULL AND unk IS NOT NULL FROM pt JOIN c_person ON person_id = patient_id
  UNION ALL SELECT 4, patient_id, (given_name IS NULL OR family_name IS NULL) AND unk IS NOT NULL FROM pt JOIN c_person_name ON person_id = patient_id UNION ALL SELECT 6, p.patient_id, coalesce(d.death_date < d.birthdate, FALSE) FROM c_patient p JOIN c_person d ON d.person_id = p.patient_id AND NOT d.voided),
ru AS (SELECT * FROM (VALUES (1, 'Completness', 'patient', 'emr_id', 'emr id is null'), (2, 'Completness', 'patient, person', 'birthdate', 'birthdate is null'), (3, 'Completness', 'patient, person', 'gender', 'gender is null'),
  (4, 'Completness', 'patient, person_name', 'given_name, family_name', 'given_name is null or family_name is null'), (5, 'Consistency', 'patient_program, program', 'date_enrolled, date_completed', 'overlapping program enrollments'),
  (6, 'Validity', 'patient, person', 'death_date, birthdate', 'death date before birthdate')) t(rule, issue_category, table_names, column_names, quality_issue_desc))
"""
extract(
    "data_quality_log_summary",
    "X24 R46 R19",
    DQ,
    JUDGED
    + f""", s AS (SELECT rule, count(*) FILTER (bad) AS n, count(*) AS t FROM j GROUP BY 1 UNION ALL SELECT 5, (SELECT count(*) FROM ov), (SELECT count(*) FROM c_patient_program a JOIN c_patient_program b ON NOT b.voided AND b.patient_id = a.patient_id AND b.program_id = a.program_id AND b.patient_program_id <> a.patient_program_id WHERE NOT a.voided))
    SELECT s.rule AS quality_rule_id, 'mysql' AS source, issue_category, table_names, column_names, quality_issue_desc, DATE '{AS_OF}' AS issue_log_date, n AS number_of_cases, t AS total_count, n / t * 100 AS percentage FROM s JOIN ru ON ru.rule = s.rule WHERE n > 0""",
    R.data_quality_log_summary,
    "patient patient_program program",
)
extract(
    "data_quality_log_details",
    "X23 R46",
    DQ,
    JUDGED
    + f""", b AS (SELECT patient_id, rule FROM j WHERE bad UNION ALL SELECT patient_id, 5 FROM ov)
    SELECT b.rule AS quality_rule_id, 'mysql' AS source, issue_category, b.patient_id, emr.identifier AS emr_id, table_names, column_names, quality_issue_desc, DATE '{AS_OF}' AS issue_log_date FROM b JOIN ru ON ru.rule = b.rule LEFT JOIN {identifier("emr")} emr ON emr.patient_id = b.patient_id""",
    R.data_quality_log_details,
    "patient patient_program program",
)
NOPROG = f"NOT EXISTS (SELECT 1 FROM c_patient_program pp JOIN c_program pr ON pr.program_id = pp.program_id WHERE NOT pp.voided AND pr.uuid IN ('{HIVP}', '{EIDP}') AND pp.patient_id = e.patient_id)"


def _no_program(i: int, kind: str, label: str) -> str:
    return f"SELECT patient_id, '{kind} without any HIV or exposed infant enrollment', '{label}: ' || strftime(min(encounter_datetime), '%Y-%m-%d %H:%M:%S') FROM c_encounter e WHERE NOT voided AND encounter_type = {i} AND {NOPROG} GROUP BY patient_id"


extract(
    "data_warnings",
    "X25 R46 R22 R19",
    DQ,
    JUDGED
    + f""", w AS (
      SELECT patient_id, 'blank emr_id' AS warning_type, 'patient_id: ' || patient_id || ' on site: site' AS warning_details FROM pt WHERE emr_id IS NULL
      UNION ALL SELECT patient_id, 'overlapping program enrollments', 'program name: ' || name || ' | patient_program_ids: ' || patient_program_id || ',' || other_id FROM ov
      UNION ALL SELECT patient_id, 'blank gender', NULL FROM j WHERE rule = 3 AND bad UNION ALL SELECT patient_id, 'blank birthdate', NULL FROM j WHERE rule = 2 AND bad
      UNION ALL SELECT patient_id, 'blank given or family name', 'given name: ' || given_name || ' | family name: ' || family_name FROM pt JOIN c_person_name ON person_id = patient_id WHERE unk IS NOT NULL AND (given_name IS NULL OR family_name IS NULL)
      UNION ALL SELECT j.patient_id, 'death date before birth date', 'death date: ' || strftime(d.death_date, '%Y-%m-%d %H:%M:%S') || ' | birth date: ' || d.birthdate || ' | unknown patient: ' || coalesce(CAST(unk.person_id AS VARCHAR), '0') FROM j JOIN c_person d ON d.person_id = j.patient_id LEFT JOIN {attribute(2)} unk ON unk.person_id = j.patient_id WHERE rule = 6 AND bad
      UNION ALL SELECT patient_id, 'HIV dispensing without any prescriptions', 'first HIV dispensing: ' || strftime(min(encounter_datetime), '%Y-%m-%d %H:%M:%S') FROM c_encounter e WHERE encounter_type = 1 AND NOT EXISTS (SELECT 1 FROM c_orders o WHERE o.order_type_id = 2 AND o.patient_id = e.patient_id) GROUP BY patient_id
      UNION ALL {_no_program(2, "HIV initial encounter", "first HIV intake")} UNION ALL {_no_program(3, "HIV followup encounter", "first HIV followup")}
      UNION ALL {_no_program(4, "HIV exposed infant followup", "first HIV exposed infant followup")} UNION ALL {_no_program(1, "HIV dispensing encounter", "first HIV dispensing")})
    SELECT emr.identifier AS emr_id, {K}w.patient_id AS patient_id, warning_type, warning_details FROM w LEFT JOIN {identifier("emr")} emr ON emr.patient_id = w.patient_id""",
    R.data_warnings,
    "patient patient_program program orders",
)
MIG = "migration_data_warnings"
extract("migration_warnings", "X46", D1, f"SELECT * FROM c_{MIG}", R.migration_warnings, MIG)
extract(
    "migration_warning_counts",
    "X45 R27",
    D1,
    f"SELECT warning_type, count(*) AS count, max(flag_for_review) AS flag_for_review, TIMESTAMP '{AS_OF}' AS timestamp FROM c_{MIG} GROUP BY 1",
    R.migration_warning_counts,
    MIG,
)
extract("patient_last_update_date", "X72 S8", D1, f"SELECT {K}patient_id AS patient_id, last_updated, deleted FROM c_dbevent_patient", R.patient_last_update_date, "dbevent_patient")
extract(
    "summary_db_restore",
    "X79 R57",
    D1,
    """SELECT (SELECT max(date_created) FROM c_patient WHERE NOT voided) AS last_sourced_patient_datapoint_created_on, (SELECT max(date_created) FROM c_encounter WHERE NOT voided) AS last_sourced_encounter_datapoint_created_on,
      (SELECT max(date_created) FROM c_obs WHERE NOT voided) AS last_sourced_obs_datapoint_created_on, CAST(NULL AS TIMESTAMP) AS backup_datetime, CAST(NULL AS TIMESTAMP) AS restore_datetime""",
    R.summary_db_restore,
    "patient",
)
ACC = """, lg AS (SELECT user_id, max(event_datetime) AS last, count(*) AS n FROM c_authentication_event_log WHERE event_type = 'LOGIN_SUCCEEDED' GROUP BY 1),
acc AS (SELECT u.user_id, u.person_id, coalesce(u.username, u.system_id) AS username, pn.given_name AS first_name, pn.family_name AS last_name, NOT u.retired AS account_enabled, u.date_created AS created_date, coalesce(k.username, k.system_id) AS created_by, lg.last AS last_login_date,
  CAST(coalesce(lg.n, 0) AS INTEGER) AS num_logins_recorded FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id LEFT JOIN c_users k ON k.user_id = u.creator LEFT JOIN lg ON lg.user_id = u.user_id)"""
extract(
    "users",
    "X84 F18",
    D1,
    ACC
    + """ SELECT acc.* EXCLUDE (user_id, person_id), ux.email, r.name AS provider_type, CASE coalesce(nullif(up.property_value, ''), 'disabled') WHEN 'secret' THEN 'question' WHEN 'totp' THEN 'authenticator' ELSE coalesce(nullif(up.property_value, ''), 'disabled') END AS mfa_status
    FROM acc LEFT JOIN c_users ux ON ux.user_id = acc.user_id LEFT JOIN c_provider p ON p.person_id = acc.person_id LEFT JOIN c_provider_role r ON r.provider_role_id = p.provider_role_id LEFT JOIN c_user_property up ON up.user_id = acc.user_id AND up.property = 'authentication.secondaryType'""",
    R.users,
    "authentication_event_log provider_role user_property",
)
extract(
    "user_roles",
    "X83 R29 F18",
    D1,
    ACC
    + """, r AS (SELECT user_id, CASE WHEN role LIKE 'Application Role: %' THEN 'Application Role' ELSE 'Privilege Level' END AS role_type, replace(replace(role, 'Application Role: ', ''), 'Privilege Level: ', '') AS role_value FROM c_user_role
      UNION ALL SELECT u.user_id, 'Provider Type', x.name FROM c_provider p JOIN c_users u ON u.person_id = p.person_id LEFT JOIN c_provider_role x ON x.provider_role_id = p.provider_role_id)
    SELECT r.role_type, r.role_value, acc.* EXCLUDE (user_id, person_id) FROM r LEFT JOIN acc ON acc.user_id = r.user_id""",
    R.user_roles,
    "authentication_event_log provider_role user_role",
)
extract(
    "user_logins",
    "X82 R47",
    D1,
    """, e AS (SELECT login_id, max(event_datetime) FILTER (event_type = 'LOGIN_EXPIRED') AS x, max(event_datetime) FILTER (event_type = 'LOGOUT_SUCCEEDED') AS o FROM c_authentication_event_log GROUP BY 1),
    m AS (SELECT l.*, e.x, e.o, CAST(trunc(epoch(o - event_datetime) / 60) AS INTEGER) AS a, CAST(trunc(epoch(x - event_datetime) / 60) AS INTEGER) AS b FROM c_authentication_event_log l JOIN e ON e.login_id = l.login_id WHERE event_type = 'LOGIN_SUCCEEDED')
    SELECT login_id, username, event_datetime AS date_logged_in, o AS date_logged_out, x AS date_expired, CASE WHEN coalesce(a, b - 30) < 0 THEN b ELSE coalesce(a, b - 30) END AS active_duration_minutes, ip_address, CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc FROM m""",
    R.user_logins,
    "authentication_event_log",
)
