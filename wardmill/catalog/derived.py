"""Derived-table jobs on warehouse extracts laid over the driver tables, with SQL twins."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from wardmill.catalog.base import Tables, query, read_table
from wardmill.plans.derive import hiv, stays, tables
from wardmill.sources.warehouse import tag_site, union_sites

AS_OF = "2001-08-15"

P = "'P' || o_custkey"
TYPES_ADT = "CASE o_orderkey % 3 WHEN 0 THEN 'Admission' WHEN 1 THEN 'Transfer' ELSE 'Exit from Inpatient Care' END"
SITE = "CASE o_custkey % 3 WHEN 0 THEN 'hiv' WHEN 1 THEN 'north' ELSE 'south' END"

W: dict[str, str] = {
    "adt_encounters": f"""
        SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, CASE WHEN o_orderkey % 7 <> 0 THEN 'V' || o_orderkey END AS visit_id, {TYPES_ADT} AS encounter_type,
          o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS encounter_datetime, 'user' || o_orderkey % 5 AS user_entered,
          o_orderdate + INTERVAL '1' DAY AS datetime_created, 'ward' || o_orderkey % 6 AS encounter_location, 'place' || o_orderkey % 4 AS visit_location,
          'facility' || o_orderkey % 4 AS facility, 'provider' || o_orderkey % 9 AS provider, {SITE} AS site, CAST(1 + o_custkey % 3 AS INTEGER) AS partition_num
        FROM {{orders}}""",
    "all_visits": """
        SELECT 'V' || o_orderkey AS visit_id, o_custkey AS patient_id, o_orderdate AS visit_date_started, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + (o_orderkey % 40) * INTERVAL '1' DAY END AS visit_date_stopped FROM {orders}""",
    "all_encounters": f"""
        SELECT {P} AS emr_id, o_custkey AS patient_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 30) * INTERVAL '1' HOUR AS encounter_datetime,
          CASE o_orderkey % 6 WHEN 0 THEN 'Death' WHEN 1 THEN 'Discharged' WHEN 2 THEN 'Transfer out of hospital' WHEN 3 THEN 'Admit to hospital' END AS disposition
        FROM {{orders}}""",
    "ed_triage": f"""
        SELECT {P} AS emr_id, 'T' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 10) * INTERVAL '1' HOUR AS triage_datetime, CAST(o_orderdate AS DATE) AS date_entered,
          'user' || o_orderkey % 5 AS user_entered, 'V' || o_custkey AS visit_id, 'D' || o_custkey AS dossier_id, 'reg' || o_custkey % 4 AS loc_registered,
          CAST(NULL AS STRING) AS unknown_patient, o_orderdate AS ed_visit_start_datetime, 'ward' || o_orderkey % 6 AS encounter_location, 'provider' || o_orderkey % 9 AS provider,
          'queue' || o_orderkey % 3 AS triage_queue_status, 'color' || o_orderkey % 5 AS triage_color, CAST(o_orderkey % 8 AS INTEGER) AS triage_score,
          CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
        FROM {{orders}}""",
    "consult_encounters": """
        SELECT 'P' || o_custkey AS emr_id, 'C' || o_orderkey AS encounter_id, 'V' || o_custkey AS visit_id, o_orderdate + (o_orderkey % 15) * INTERVAL '1' HOUR AS encounter_datetime,
          CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS trauma,
          CASE o_orderkey % 7 WHEN 0 THEN 'Death' WHEN 1 THEN 'Discharged' WHEN 2 THEN 'Left without seeing a clinician' WHEN 3 THEN 'Admit to hospital' WHEN 4 THEN 'Transfer out of hospital' END AS disposition
        FROM {orders}""",
    "all_diagnosis": f"""
        SELECT CASE q % 2 WHEN 0 THEN 'C' ELSE 'O' END || o_orderkey AS encounter_id, 'B' || (o_orderkey * 8 + q) AS obs_id, (o_orderkey + q) % 5 <> 0 AS coded,
          CASE WHEN (o_orderkey * 5 + q) % 11 <> 0 THEN 'maladie ' || (o_orderkey + CAST(floor(q / 2) AS BIGINT)) % 4 END AS diagnosis_coded_fr, CASE (o_orderkey + q) % 6 WHEN 0 THEN 'ARTERIAL HYPERTENSION' ELSE 'text ' || q END AS diagnosis_entered,
          CASE (o_orderkey + q) % 3 WHEN 0 THEN 'Primaire' WHEN 1 THEN 'Secondaire' END AS dx_order, (o_orderkey + q) % 4 <> 1 AS oncology, {P} AS patient_primary_id,
          o_orderdate + q * INTERVAL '5' HOUR AS obs_datetime, o_orderdate + q * INTERVAL '1' DAY AS date_created
        FROM (SELECT o_orderkey, o_custkey, o_orderdate, {{EXPAND 6}} AS q FROM {{orders}})""",
    "hiv_patient_program": f"""
        SELECT {P} AS emr_id, CAST(o_orderkey AS INTEGER) AS hiv_program_id, CAST(o_orderdate AS DATE) AS date_enrolled,
          CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate + (o_orderkey % 500) * INTERVAL '1' DAY AS DATE) END AS date_completed,
          CASE WHEN o_orderkey % 4 <> 0 THEN 'outcome ' || o_orderkey % 3 END AS outcome, 'place' || o_orderkey % 4 AS location
        FROM {{orders}}""",
    "hiv_patient": """
        SELECT 'P' || c_custkey AS emr_id, 'H' || c_custkey AS hivemr_v1_id, 'given' || c_custkey AS given_name, 'family' || c_custkey AS family_name,
          CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, CAST(DATE '1950-01-01' + CAST(c_custkey * 13 % 18000 AS INTEGER) AS DATE) AS birthdate, CAST(c_custkey % 80 AS INTEGER) AS age,
          'addr' || c_custkey AS address, 'dept' || c_nationkey AS department, CASE WHEN c_custkey % 5 <> 0 THEN 'com' || c_custkey % 9 END AS commune, 'sec' || c_custkey % 3 AS section_communal,
          'loc' || c_custkey % 6 AS locality, 'tel' || c_custkey AS telephone_number, 'user' || c_custkey % 4 AS user_entered, 'place' || c_custkey % 4 AS latest_enrollment_location,
          c_custkey % 3 = 0 AS biometrics_collected, TIMESTAMP_NTZ '2000-01-01 00:00:00' + (c_custkey % 90) * INTERVAL '1' DAY AS latest_biometrics_collection_date, 'col' || c_custkey % 2 AS biometrics_collector
        FROM {customer}""",
    "hiv_visit": f"""
        SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, 'M' || o_orderkey % 3 AS encounter_type, CAST(o_orderdate AS DATE) AS visit_date,
          CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate + (20 + o_orderkey % 60) * INTERVAL '1' DAY AS DATE) END AS next_visit_date, 'place' || o_orderkey % 4 AS visit_location,
          o_orderdate + INTERVAL '2' DAY AS date_entered, CASE WHEN o_orderkey % 9 = 0 THEN 'Transfer' ELSE 'Referral' END AS referral_transfer_in, 'from' || o_orderkey % 6 AS referral_transfer_location_in,
          CASE WHEN o_orderkey % 6 = 0 THEN 'reason ' || o_orderkey % 4 END AS reason_not_on_arv, CASE WHEN o_orderkey % 8 = 1 THEN 'status ' || o_orderkey % 3 END AS breastfeeding_status,
          CASE WHEN o_orderkey % 8 = 1 THEN o_orderdate - INTERVAL '3' DAY END AS last_breastfeeding_date, CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) END AS inh_start_date,
          CASE WHEN o_orderkey % 14 = 0 THEN CAST(o_orderdate + INTERVAL '90' DAY AS DATE) END AS inh_end_date, CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate AS DATE) END AS rif_and_inh_start_date,
          CASE WHEN o_orderkey % 22 = 0 THEN CAST(o_orderdate + INTERVAL '60' DAY AS DATE) END AS rif_and_inh_end_date, CASE WHEN o_orderkey % 3 = 0 THEN 'chw' || o_orderkey % 5 END AS chw,
          CAST(o_custkey AS INTEGER) AS hiv_program_id, {SITE} AS site
        FROM {{orders}}""",
    "hiv_dispensing": f"""
        SELECT {P} AS emr_id, 'S' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 20) * INTERVAL '1' HOUR AS dispense_date,
          CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate + (30 + o_orderkey % 50) * INTERVAL '1' DAY END AS next_dispense_date, CAST(1 + o_orderkey % 6 AS INTEGER) AS months_dispensed,
          CAST(o_orderkey % 12 AS INTEGER) AS days_late_to_pickup, 'line ' || o_orderkey % 3 AS current_art_treatment_line, CASE WHEN o_orderkey % 4 <> 0 THEN 'A' || o_orderkey % 5 END AS arv_1_med,
          CASE WHEN o_orderkey % 5 = 0 THEN 'B' || o_orderkey % 3 END AS arv_2_med, CASE WHEN o_orderkey % 7 = 0 THEN 'C' || o_orderkey % 2 END AS arv_3_med,
          CASE WHEN o_orderkey % 3 = 1 THEN 'acc' || o_orderkey % 8 END AS dispensed_accompagnateur
        FROM {{orders}}""",
    "hiv_regimens": f"""
        SELECT {P} AS emr_id, CAST(o_orderkey AS INTEGER) AS order_id, CASE WHEN o_orderkey % 5 = 0 THEN 'REVISE' ELSE 'NEW' END AS order_action, CASE o_orderkey % 4 WHEN 0 THEN 'TB' WHEN 1 THEN 'PMTCT' ELSE 'ART' END AS drug_category,
          o_orderdate + (o_orderkey % 13) * INTERVAL '1' HOUR AS encounter_datetime, 'line ' || o_orderkey % 4 AS art_treatment_line, CASE o_orderkey % 9 WHEN 0 THEN 'Isoniazid' WHEN 1 THEN 'Rifapentine + Isoniazid' ELSE 'drug ' || o_orderkey % 6 END AS drug_short_name,
          o_orderdate AS start_date, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + (o_orderkey % 70) * INTERVAL '1' DAY END AS end_date
        FROM {{orders}}""",
    "hiv_viral_load": f"""
        SELECT {P} AS emr_id, 'L' || o_orderkey AS hiv_vl_id, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS vl_sample_taken_date, o_orderdate + INTERVAL '1' DAY AS date_entered,
          CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate + INTERVAL '9' DAY AS DATE) END AS vl_result_date, o_orderdate - INTERVAL '1' DAY AS order_date, 'status ' || o_orderkey % 4 AS status,
          CASE o_orderkey % 9 WHEN 0 THEN 'Detected' WHEN 3 THEN 'Not detected' END AS vl_coded_results, CAST(o_orderkey % 5000 AS INTEGER) AS viral_load
        FROM {{orders}}""",
    "tb_screening": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 9) * INTERVAL '1' HOUR AS tb_screening_date, CAST(o_orderkey % 2 AS STRING) AS tb_screening_result FROM {{orders}}",
    "tb_lab_results": f"""
        SELECT {P} AS emr_id, 'R' || o_orderkey AS tb_lab_results_id, CAST(o_orderdate AS DATE) AS specimen_collection_date, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate + INTERVAL '4' DAY AS DATE) END AS test_result_date,
          CASE o_orderkey % 4 WHEN 0 THEN 'genxpert' WHEN 1 THEN 'smear' WHEN 2 THEN 'culture' ELSE 'skin test' END AS test_type,
          CASE o_orderkey % 5 WHEN 0 THEN 'Detected' WHEN 1 THEN '++' WHEN 2 THEN 'Scanty' WHEN 3 THEN 'Positive' ELSE '1+' END AS test_result_text
        FROM {{orders}}""",
    "pmtct_visits": f"""
        SELECT {P} AS emr_id, 'M' || o_orderkey AS encounter_id, 'V' || o_orderkey AS visit_id, CAST(o_custkey AS INTEGER) AS hiv_program_id, CAST(o_orderdate AS DATE) AS visit_date, o_orderdate + INTERVAL '25' DAY AS next_visit_date, 'place' || o_orderkey % 4 AS health_facility, o_orderdate AS date_entered,
          CASE WHEN o_orderkey % 3 = 0 THEN 'pm status ' || o_orderkey % 3 END AS breastfeeding_status, o_orderdate - INTERVAL '1' DAY AS last_breastfeeding_date, {SITE} AS site
        FROM {{orders}}""",
    "eid_visit": f"SELECT {P} AS emr_id, 'D' || o_orderkey AS encounter_id, CAST(o_orderdate AS DATE) AS visit_date, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate + INTERVAL '40' DAY AS DATE) END AS next_visit_date FROM {{orders}}",
    "hiv_status": f"""
        SELECT {P} AS emr_id, CAST(o_custkey AS INTEGER) AS hiv_program_id, CAST(o_orderkey AS INTEGER) AS status_id, CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate + (o_orderkey % 200) * INTERVAL '1' DAY AS DATE) END AS end_date,
          CASE o_orderkey % 5 WHEN 0 THEN 'Patient pregnant' WHEN 1 THEN 'Not pregnant' WHEN 2 THEN 'Lost to followup' WHEN 3 THEN 'On treatment' END AS status_outcome
        FROM {{orders}}""",
    "all_vitals": f"""
        SELECT {P} AS emr_id, CAST(o_orderkey AS INTEGER) AS all_vitals_id, o_orderdate + (o_orderkey % 11) * INTERVAL '1' HOUR AS encounter_datetime, o_orderdate + INTERVAL '1' DAY AS date_entered,
          CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 90 + 30 AS DOUBLE) END AS weight, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 60 + 120 AS DOUBLE) END AS height,
          CASE WHEN o_orderkey % 3 <> 1 THEN CAST(o_orderkey % 40 + 60 AS DOUBLE) END AS bp_diastolic, CASE WHEN o_orderkey % 5 <> 1 THEN CAST(o_orderkey % 60 + 90 AS DOUBLE) END AS bp_systolic,
          'ward' || o_orderkey % 6 AS encounter_location, {SITE} AS site
        FROM {{orders}}""",
    "all_patients": """
        SELECT 'P' || c_custkey AS emr_id, CASE WHEN c_custkey % 9 <> 0 THEN CAST(DATE '1950-06-30' + CAST(c_custkey * 17 % 18000 AS INTEGER) AS DATE) END AS dob, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
        FROM {customer}""",
    "chemo_session_encounter": f"""
        SELECT {P} AS emr_id, 'O' || o_orderkey AS encounter_id, 'V' || o_orderkey AS visit_id, o_orderdate AS encounter_datetime, 'prov' || o_orderkey % 4 AS provider_name, 'user' || o_orderkey % 5 AS user_entered, o_orderdate AS date_created,
          'ward' || o_orderkey % 6 AS encounter_location, CAST(o_orderkey % 8 AS INTEGER) AS cycle_number, CAST(8 AS INTEGER) AS planned_chemo_sessions, 'plan' || o_orderkey % 3 AS treatment_plan, 'c' || o_orderkey % 4 AS visit_information_comments,
          CAST(NULL AS INTEGER) AS index_asc, CAST(NULL AS INTEGER) AS index_desc
        FROM {{orders}}""",
    "chemo_session_regimens": "SELECT 'B' || (o_orderkey * 4 + q) AS obs_id, 'O' || o_orderkey AS encounter_id, 'regimen ' || (o_orderkey + q) % 5 AS chemo_regimen_name FROM (SELECT o_orderkey, {EXPAND 2} AS q FROM {orders})",
    "oncology_treatment_plan": f"""
        SELECT {P} AS emr_id, 'O' || o_orderkey AS encounter_id, 'V' || o_orderkey AS visit_id, o_orderdate AS encounter_datetime, 'prov' || o_orderkey % 4 AS encounter_provider, 'user' || o_orderkey % 5 AS user_entered, CAST(o_orderdate AS DATE) AS date_entered,
          'stage ' || o_orderkey % 4 AS cancer_stage, 'intent ' || o_orderkey % 2 AS treatment_intent FROM {{orders}}""",
    "all_medication_dispensing": f"""
        SELECT 'S' || o_orderkey AS dispensing_id, {P} AS emr_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS encounter_datetime, 'prov' || o_orderkey % 4 AS encounter_provider, 'ward' || o_orderkey % 6 AS encounter_location,
          'facility' || o_orderkey % 4 AS facility, CASE o_orderkey % 5 WHEN 0 THEN 'Tamoxifen, 10mg, tablet' WHEN 1 THEN 'Tamoxifen, 20mg tablet' ELSE 'drug ' || o_orderkey % 7 END AS drug_name, CAST(o_orderkey % 7 AS INTEGER) AS drug_product_code,
          CAST(o_orderkey % 60 AS INTEGER) AS quantity_dispensed, {SITE} AS site FROM {{orders}}""",
    "ncd_patient_table_staging": f"""
        SELECT {P} AS emr_id, max(CAST(DATE '1940-01-01' + CAST(o_custkey AS INTEGER) AS DATE)) AS birthdate, max(CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END) AS sex, 'dept' || max(o_custkey % 9) AS department, 'com' || max(o_custkey % 8) AS commune,
          CAST(min(o_orderdate) AS DATE) AS ncd_enrollment_date, CAST(min(o_orderdate) AS DATE) AS ncd_first_encounter_date, CAST(max(o_orderdate) AS DATE) AS ncd_latest_encounter_date, 'e' || max(o_orderkey % 4) AS ncd_enrollment_location, 'c' || max(o_orderkey % 5) AS ncd_current_location,
          max(o_orderkey) % 2 = 0 AS htn, CASE WHEN max(o_orderkey) % 3 = 0 THEN TRUE END AS diabetes, max(o_orderkey) % 5 = 0 AS respiratory, FALSE AS epilepsy, max(o_orderkey) % 7 = 0 AS heart_failure, FALSE AS cerebrovascular_accident, max(o_orderkey) % 11 = 0 AS renal_failure,
          FALSE AS liver_failure, FALSE AS rehabilitation, max(o_orderkey) % 13 = 0 AS sickle_cell, TRUE AS other_ncd, 't' || max(o_orderkey % 3) AS dm_type, 'h' || max(o_orderkey % 3) AS heart_failure_category, 'k' || max(o_orderkey % 3) AS cardiomyopathy, 'n' || max(o_orderkey % 4) AS nyha_class,
          FALSE AS heart_failure_improbable, 's' || max(o_orderkey % 4) AS ncd_status, CAST(max(o_orderdate) AS DATE) AS ncd_status_date, FALSE AS deceased, CAST(NULL AS DATE) AS date_of_death, {SITE} AS site, CAST(1 + o_custkey % 3 AS INTEGER) AS partition_num
        FROM {{orders}} GROUP BY {P}, {SITE}, CAST(1 + o_custkey % 3 AS INTEGER)""",
    "ncd_heart_failure_patient_staging": f"""
        SELECT {P} AS emr_id, max(CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END) AS sex, max(CAST(DATE '1940-01-01' + CAST(o_custkey AS INTEGER) AS DATE)) AS birthdate, CAST(min(o_orderdate) AS DATE) AS hf_diagnosis_date, max(o_orderkey) % 2 = 0 AS ncd_enrolled, max(o_orderkey) % 3 = 0 AS hf_ncd,
          TRUE AS hf_broad, CASE WHEN max(o_orderkey) % 5 = 0 THEN TRUE END AS hf_left, FALSE AS hf_isolated_right, FALSE AS hf_congestive, max(o_orderkey) % 7 = 0 AS hf_rheumatic, CAST(max(o_orderdate) AS DATE) AS last_visit_date, FALSE AS deceased, {SITE} AS site, CAST(1 + o_custkey % 3 AS INTEGER) AS partition_num
        FROM {{orders}} GROUP BY {P}, {SITE}, CAST(1 + o_custkey % 3 AS INTEGER)""",
    "mch_patient": f"SELECT {P} AS emr_id, {SITE} AS site, CASE WHEN max(o_orderkey) % 9 <> 0 THEN date_trunc('MONTH', max(o_orderdate)) END AS latest_encounter_date FROM {{orders}} GROUP BY {P}, {SITE}",
    "mch_visit": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, CAST(o_orderdate AS DATE) AS visit_date, 'kind ' || o_orderkey % 3 AS consultation_type, {SITE} AS site, 'place' || o_orderkey % 5 AS encounter_location, o_orderdate + INTERVAL '1' DAY AS date_entered FROM {{orders}}",
    "covid_visit": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, {SITE} AS site, CASE WHEN o_orderkey % 7 <> 0 THEN 'place' || o_orderkey % 3 END AS location, o_orderdate AS date_entered FROM {{orders}}",
    "mh_patients": "SELECT o_custkey AS patient_id, CAST(o_orderkey AS INTEGER) AS patient_program_id, CAST(o_orderdate AS DATE) AS program_enrollment_date FROM {orders}",
    "mh_encounters": "SELECT o_custkey AS patient_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 7) * INTERVAL '1' HOUR AS encounter_datetime FROM {orders}",
    "covid_disposition": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, CASE o_orderkey % 3 WHEN 0 THEN 'Discharged' WHEN 1 THEN 'Death' END AS disposition FROM {{orders}}",
    "hiv_tests": f"""
        SELECT {P} AS emr_id, 'T' || o_orderkey AS hiv_test_id, 'E' || CAST(floor(o_orderkey / 4) AS BIGINT) AS encounter_id, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS specimen_collection_date,
          o_orderdate + INTERVAL '1' DAY AS date_created, 'kind ' || o_orderkey AS test_type FROM {{orders}}""",
    "mch_status": f"""
        SELECT {P} AS emr_id, CAST(o_orderkey AS INTEGER) AS patient_state_id, date_trunc('MONTH', o_orderdate) AS program_date_enrolled, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS status_start_date
        FROM {{orders}}""",
    "pmtct_pregnancy": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END AS pmtct_enrollment_date FROM {{orders}}",
    "outpatient_encounters": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 9) * INTERVAL '1' HOUR AS encounter_datetime FROM {{orders}}",
    "hiv_psychosocial_encounter": f"SELECT {P} AS emr_id, 'E' || o_orderkey AS encounter_id, o_orderdate + (o_orderkey % 5) * INTERVAL '1' HOUR AS encounter_datetime FROM {{orders}}",
    "hiv_pmtct_visit": "SELECT CAST(o_custkey AS INTEGER) AS hiv_program_id, 'E' || o_orderkey AS encounter_id, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS visit_date FROM {orders}",
    "pathology_encounters": f"SELECT {SITE} AS site, 'place' || o_orderkey % 6 AS encounter_location, o_orderdate AS order_datetime FROM {{orders}}",
    "all_lab_results": f"SELECT {SITE} AS site, 'place' || o_orderkey % 4 AS encounter_location, o_orderdate + INTERVAL '3' DAY AS results_entry_date FROM {{orders}}",
}


def _text(table: str, spark: bool) -> str:
    s = W[table]
    if spark:
        return re.sub(r"\{EXPAND (\d+)\}", lambda m: f"explode(sequence(0L, {int(m[1]) - 1}L))", s)
    s = re.sub(r"\{EXPAND (\d+)\}", lambda m: f"unnest(range({m[1]}))", s)
    s = s.replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("AS STRING)", "AS VARCHAR)")
    return re.sub(r"\{(\w+)\}", r"\1", s)


class Warehouse:
    """Extract tables derived from the driver tables of one folder."""

    def __init__(self, t: Tables):
        self._t = t

    def __getattr__(self, name: str):
        text = _text(name, True)
        used = set(re.findall(r"\{(\w+)\}", text))
        return self._t.spark.sql(text, **{u: read_table(self._t.spark, self._t.folder, u) for u in used})


def ctes(*names: str, extra: str = "") -> str:
    return "WITH " + ",\n".join(f"w_{n} AS ({_text(n, False)})" for n in names) + (f",\n{extra}" if extra else "") + "\n"


def derived(name: str, covers: str, needs: str, sql: str | None):
    text = None if sql is None else ctes(*needs.split()) + sql
    if sql is not None and sql.lstrip().startswith(","):
        text = ctes(*needs.split()).rstrip() + sql
    return lambda fn: query(name, covers, text)(lambda t: fn(Warehouse(t)))


ADMISSIONS = """, ev AS (
  SELECT *, lead(encounter_datetime) OVER (PARTITION BY emr_id ORDER BY encounter_datetime, encounter_id) AS e0 FROM w_adt_encounters),
s1 AS (
  SELECT ev.*, v.visit_date_stopped AS stop, CASE WHEN v.visit_date_stopped < e0 THEN v.visit_date_stopped ELSE e0 END AS e1
  FROM ev LEFT JOIN w_all_visits v ON v.visit_id = ev.visit_id WHERE encounter_type <> 'Exit from Inpatient Care'),
adm AS (
  SELECT s1.emr_id, s1.encounter_id, s1.visit_id, s1.encounter_type, s1.encounter_datetime AS start_datetime, coalesce(s1.e1, s1.stop) AS end_datetime, s1.user_entered,
    CAST(s1.datetime_created AS DATE) AS date_entered, s1.encounter_location, s1.visit_location, s1.facility, s1.provider,
    p.encounter_id AS previous_disposition_encounter_id, p.encounter_datetime AS previous_disposition_datetime, p.disposition AS previous_disposition,
    n.encounter_id AS ending_disposition_encounter_id, n.encounter_datetime AS ending_disposition_datetime, n.disposition AS ending_disposition, s1.site, s1.partition_num
  FROM s1
  LEFT JOIN LATERAL (SELECT * FROM w_all_encounters e WHERE e.emr_id = s1.emr_id AND e.disposition IS NOT NULL AND e.encounter_datetime <= s1.encounter_datetime
    ORDER BY e.encounter_datetime DESC, e.encounter_id DESC LIMIT 1) p ON TRUE
  LEFT JOIN LATERAL (SELECT * FROM w_all_encounters e WHERE e.emr_id = s1.emr_id AND e.disposition IS NOT NULL AND e.encounter_datetime <= s1.e1
    ORDER BY e.encounter_datetime DESC, e.encounter_id DESC LIMIT 1) n ON TRUE)
"""


def _admissions(w):
    return stays.all_admissions(w.adt_encounters, w.all_visits, w.all_encounters)


@derived("derive_all_admissions", "D11 R13 R6 R4", "adt_encounters all_visits all_encounters", ADMISSIONS + "SELECT * FROM adm")
def derive_all_admissions(w):
    return _admissions(w)


WARDS = [
    (s, f"ward{i}", c)
    for s in ("hiv", "north", "south")
    for i, c in enumerate(["pediatric", "internal_medicine", "surgery", "maternity", "other"])
]
WARDS_SQL = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in WARDS)


@derived(
    "derive_inpatient_census",
    "D16 R16 R19 R20 R42",
    "adt_encounters all_visits all_encounters",
    ADMISSIONS
    + f""", wards AS (SELECT * FROM (VALUES {WARDS_SQL}) t(site, location, clinical_category)),
    months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2000-08-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m),
    slots AS (
      SELECT w.site, w.clinical_category, m, a.end_datetime, a.ending_disposition,
        CASE WHEN a.start_datetime < m THEN CAST(m AS TIMESTAMP) ELSE a.start_datetime END AS es,
        CASE WHEN a.end_datetime IS NULL OR a.end_datetime > last_day(m) THEN CAST(least(last_day(m), DATE '{AS_OF}') AS TIMESTAMP) + INTERVAL 1 DAY ELSE a.end_datetime END AS ee
      FROM adm a JOIN wards w ON w.site = a.site AND w.location = a.encounter_location
      JOIN months ON CAST(a.start_datetime AS DATE) <= last_day(m) AND (a.end_datetime IS NULL OR CAST(a.end_datetime AS DATE) >= m)),
    d AS (SELECT *, date_diff('day', CAST(es AS DATE), CAST(ee AS DATE)) AS days, date_trunc('month', end_datetime) = m AS here FROM slots),
    t AS (
      SELECT site, clinical_category, m, sum(days) AS patient_days, count(*) AS hospitalizations,
        count(*) FILTER (here AND ending_disposition IN ('Transfer out of hospital', 'Discharged')) AS discharges,
        count(*) FILTER (here AND ending_disposition = 'Death' AND days <= 2) AS deaths_less_than_48_hours,
        count(*) FILTER (here AND ending_disposition = 'Death' AND days > 2) AS deaths_greater_than_48_hours,
        sum(CASE WHEN days = 0 THEN 1 ELSE days END) AS days_hospitalized FROM d GROUP BY 1, 2, 3),
    frame AS (
      SELECT site, clinical_category, m, indicator FROM (SELECT DISTINCT site FROM wards) CROSS JOIN months
      CROSS JOIN (VALUES ('pediatric'), ('internal_medicine'), ('surgery'), ('maternity'), ('mental_health'), ('other')) c(clinical_category)
      CROSS JOIN (VALUES ('patient_days'), ('hospitalizations'), ('discharges'), ('deaths_less_than_48_hours'), ('deaths_greater_than_48_hours'), ('days_hospitalized')) i(indicator))
    SELECT f.site, CAST(year(f.m) AS INTEGER) AS reporting_year, CAST(month(f.m) AS INTEGER) AS reporting_month, f.indicator, f.clinical_category,
      CAST(coalesce(CASE f.indicator WHEN 'patient_days' THEN patient_days WHEN 'hospitalizations' THEN hospitalizations WHEN 'discharges' THEN discharges
        WHEN 'deaths_less_than_48_hours' THEN deaths_less_than_48_hours WHEN 'deaths_greater_than_48_hours' THEN deaths_greater_than_48_hours ELSE days_hospitalized END, 0) AS INTEGER) AS total
    FROM frame f LEFT JOIN t ON t.site = f.site AND t.clinical_category = f.clinical_category AND t.m = f.m
    """,
)
def derive_inpatient_census(w):
    return stays.inpatient_census(_admissions(w), stays.ward_table(w._t.spark, WARDS), AS_OF)


def _note_sql(p: str, trauma: str) -> str:
    dx = f"""(SELECT encounter_id, diagnosis_coded_fr AS d, max(obs_id) AS o, max(max(obs_id)) OVER (PARTITION BY encounter_id) AS top FROM w_all_diagnosis WHERE coded GROUP BY 1, 2)"""
    return f"""{p}n AS (
      SELECT t.encounter_id AS tid, c.* FROM w_ed_triage t LEFT JOIN LATERAL (
        SELECT c.encounter_id AS nid, c.encounter_datetime AS ndt, c.disposition AS nd FROM w_consult_encounters c
        WHERE c.visit_id = t.visit_id AND c.trauma IS {trauma} AND c.encounter_datetime >= t.triage_datetime
        ORDER BY c.encounter_datetime DESC, c.encounter_id DESC LIMIT 1) c ON TRUE),
    {p}d AS (
      SELECT encounter_id, max(d) FILTER (r = 1) AS d1, max(d) FILTER (r = 2) AS d2, max(d) FILTER (r = 3) AS d3 FROM (
        SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY o DESC) AS r FROM {dx} x WHERE d IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM w_all_diagnosis y WHERE y.encounter_id = x.encounter_id AND y.coded AND y.obs_id = x.top AND y.diagnosis_coded_fr IS NULL)) GROUP BY 1),
    {p}f AS (SELECT encounter_id, arg_max(diagnosis_entered, obs_id) AS f FROM w_all_diagnosis WHERE NOT coded GROUP BY 1)"""


@derived(
    "derive_ed_summary",
    "D10 R6c R34 R37",
    "ed_triage consult_encounters all_diagnosis",
    f""", {_note_sql("e", "NOT NULL")}, {_note_sql("c", "NULL")}
    SELECT t.emr_id, t.encounter_id, triage_datetime, date_entered, user_entered, visit_id, dossier_id, loc_registered, unknown_patient, ed_visit_start_datetime, encounter_location, provider,
      triage_queue_status, triage_color, triage_score, index_asc, index_desc,
      en.nid AS ed_note_enc_id, en.ndt AS ednote_datetime, en.nd AS ednote_disposition, ed.d1 AS ed_diagnosis1, ed.d2 AS ed_diagnosis2, ed.d3 AS ed_diagnosis3, ef.f AS ed_diagnosis_noncoded,
      cn.nid AS consult_enc_id, cn.ndt AS consult_datetime, cn.nd AS consult_disposition, cd.d1 AS consult_diagnosis1, cd.d2 AS consult_diagnosis2, cd.d3 AS consult_diagnosis3, cf.f AS consult_diagnosis_noncoded,
      CASE CASE WHEN coalesce(cn.ndt, TIMESTAMP '1900-01-01') > coalesce(en.ndt, TIMESTAMP '1900-01-01') THEN cn.nd ELSE en.nd END
        WHEN 'Death' THEN 'Deceased' WHEN 'Transfer out of hospital' THEN 'Referred' WHEN 'Left without seeing a clinician' THEN 'Left Without Authorization'
        WHEN 'Discharged' THEN 'Discharged' WHEN 'Admit to hospital' THEN 'Unknown' END AS visit_outcome
    FROM w_ed_triage t JOIN en ON en.tid = t.encounter_id JOIN cn ON cn.tid = t.encounter_id
    LEFT JOIN ed ON ed.encounter_id = en.nid LEFT JOIN ef ON ef.encounter_id = en.nid LEFT JOIN cd ON cd.encounter_id = cn.nid LEFT JOIN cf ON cf.encounter_id = cn.nid
    """,
)
def derive_ed_summary(w):
    return stays.ed_summary(w.ed_triage, w.consult_encounters, w.all_diagnosis)


HIV_TABLES = (
    "hiv_patient_program hiv_visit hiv_dispensing hiv_regimens hiv_viral_load tb_screening tb_lab_results pmtct_visits hiv_status all_vitals all_diagnosis"
)
SINCE = "1999-12-15"


def _pick(alias: str, table: str, cond: str, order: str, cols: str, key: str = "emr_id") -> str:
    return f"LEFT JOIN LATERAL (SELECT {cols} FROM w_{table} x WHERE x.{key} = m.emr_id AND {cond} ORDER BY {order} LIMIT 1) {alias} ON TRUE"


COINF = "((test_type = 'genxpert' AND test_result_text = 'Detected') OR (test_type = 'smear' AND test_result_text IN ('1+', '++', '+++')) OR (test_type = 'culture' AND test_result_text IN ('Scanty', '++', '+++')))"
ARV_START = """st AS (
  SELECT emr_id, CAST(CASE WHEN coalesce(d, TIMESTAMP '9999-12-31') < coalesce(r, TIMESTAMP '9999-12-31') THEN d ELSE r END AS DATE) AS arv_start_date,
    coalesce(d, TIMESTAMP '9999-12-31') < coalesce(r, TIMESTAMP '9999-12-31') AS dispensed_first
  FROM (SELECT emr_id, min(dispense_date) AS d FROM w_hiv_dispensing WHERE coalesce(arv_1_med, arv_2_med, arv_3_med) IS NOT NULL GROUP BY 1)
  FULL JOIN (SELECT emr_id, min(start_date) AS r FROM w_hiv_regimens WHERE order_action = 'NEW' AND drug_category = 'ART' GROUP BY 1) USING (emr_id))"""
MONTHLY = f""", pm AS (SELECT *, lead(date_enrolled) OVER (PARTITION BY emr_id ORDER BY date_enrolled, hiv_program_id) AS nx FROM w_hiv_patient_program),
m AS (
  SELECT DISTINCT emr_id, date_enrolled, date_completed, last_day(CAST(k AS DATE)) AS reporting_date FROM (
    SELECT *, unnest(generate_series(date_trunc('month', CAST(date_enrolled AS TIMESTAMP)), CAST(date_trunc('month', coalesce(least(date_completed, DATE '{AS_OF}'), DATE '{AS_OF}')) AS TIMESTAMP), INTERVAL 1 MONTH)) AS k
    FROM pm WHERE nx IS NULL OR date_completed IS NULL OR nx <> date_completed)
  WHERE last_day(CAST(k AS DATE)) <= DATE '{AS_OF}' AND last_day(CAST(k AS DATE)) > DATE '{SINCE}'),
{ARV_START}
SELECT m.emr_id, m.date_enrolled, m.date_completed, m.reporting_date, hs.status_outcome AS latest_program_status_outcome, hs.start_date AS latest_program_status_outcome_date,
  v.visit_date AS latest_hiv_visit_date, v.next_visit_date AS latest_expected_hiv_visit_date,
  CAST(greatest(date_diff('day', coalesce(v.next_visit_date, v.visit_date, m.date_enrolled), m.reporting_date), 0) AS INTEGER) AS hiv_visit_days_late,
  v2.visit_date AS second_to_latest_hiv_visit_date, tr.visit_date AS latest_transfer_in_date, tr.referral_transfer_location_in AS latest_transfer_in_location,
  d.dispense_date AS latest_dispensing_date, d.next_dispense_date AS latest_expected_dispensing_date, dl.n AS dispensing_days_late, d.months_dispensed AS latest_months_dispensed,
  vl.order_date AS latest_hiv_viral_load_order_date, vl.status AS latest_hiv_viral_load_status, vl.vl_sample_taken_date AS latest_hiv_viral_load_collection_date, vl.vl_result_date AS latest_hiv_viral_load_results_date,
  rg.encounter_datetime AS latest_arv_regimen_date, rg.art_treatment_line AS latest_arv_regimen_line, da.dispense_date AS latest_arv_dispensed_date, da.current_art_treatment_line AS latest_arv_dispensed_line,
  d.days_late_to_pickup AS days_late_at_latest_pickup, rn.visit_date AS "latest_reason_not_on_ARV_date", rn.reason_not_on_arv AS "latest_reason_not_on_ARV",
  CAST(ts.tb_screening_date AS DATE) AS latest_tb_screening_date, ts.tb_screening_result AS latest_tb_screening_result, tl.specimen_collection_date AS latest_tb_test_date, tl.test_type AS latest_tb_test_type, tl.test_result_text AS latest_tb_test_result,
  tc.specimen_collection_date AS latest_tb_coinfection_date,
  CASE WHEN b2.visit_date < b1.visit_date OR b1.visit_date IS NULL THEN b2.visit_date ELSE b1.visit_date END AS date_of_last_breastfeeding_status,
  CASE WHEN b2.visit_date < b1.visit_date OR b1.visit_date IS NULL THEN b2.breastfeeding_status ELSE b1.breastfeeding_status END AS latest_breastfeeding_status,
  CASE WHEN b2.visit_date < b1.visit_date OR b1.visit_date IS NULL THEN b2.last_breastfeeding_date ELSE b1.last_breastfeeding_date END AS latest_breastfeeding_date,
  st.arv_start_date, CASE WHEN date_trunc('month', st.arv_start_date) = date_trunc('month', m.reporting_date) THEN 'new' WHEN st.arv_start_date < m.reporting_date THEN 'existing' ELSE 'not on ART' END AS monthly_arv_status,
  CASE WHEN m.date_completed < m.reporting_date THEN hs.status_outcome WHEN dl.n <= 28 THEN 'active - on arvs'
    WHEN hs.status_outcome IS NOT NULL AND hs.status_outcome NOT LIKE '%pregnant%' THEN hs.status_outcome ELSE 'Lost to followup' END AS latest_status,
  bd.bp_diastolic AS latest_bp_diastolic, CAST(bd.encounter_datetime AS DATE) AS latest_bp_diastolic_date, bs.bp_systolic AS latest_bp_systolic, CAST(bs.encounter_datetime AS DATE) AS latest_bp_systolic_date,
  h.obs_datetime IS NOT NULL AS htn_diagnosis, CAST(h.obs_datetime AS DATE) AS latest_htn_diagnosis_date
FROM m LEFT JOIN st ON st.emr_id = m.emr_id
{_pick("v", "hiv_visit", "x.visit_date <= m.reporting_date", "x.visit_date DESC, x.encounter_id DESC", "x.visit_date, x.next_visit_date")}
{_pick("v2", "hiv_visit", "x.visit_date < v.visit_date", "x.visit_date DESC", "x.visit_date")}
{_pick("tr", "hiv_visit", "x.visit_date <= m.reporting_date AND x.referral_transfer_in = 'Transfer'", "x.visit_date DESC, x.encounter_id DESC", "x.visit_date, x.referral_transfer_location_in")}
{_pick("rn", "hiv_visit", "x.visit_date <= m.reporting_date AND x.reason_not_on_arv IS NOT NULL", "x.visit_date DESC, x.encounter_id DESC", "x.visit_date, x.reason_not_on_arv")}
{_pick("d", "hiv_dispensing", "CAST(x.dispense_date AS DATE) <= m.reporting_date", "x.dispense_date DESC, x.encounter_id DESC", "x.*")}
LEFT JOIN LATERAL (SELECT CAST(greatest(date_diff('day', CAST(coalesce(d.next_dispense_date, d.dispense_date, m.date_enrolled) AS DATE), m.reporting_date), 0) AS INTEGER) AS n) dl ON TRUE
{_pick("vl", "hiv_viral_load", "coalesce(x.vl_sample_taken_date, x.date_entered) <= m.reporting_date", "x.vl_sample_taken_date DESC NULLS LAST, x.date_entered DESC, x.hiv_vl_id DESC", "x.*")}
{_pick("rg", "hiv_regimens", "CAST(x.encounter_datetime AS DATE) <= m.reporting_date AND x.order_action = 'NEW' AND x.drug_category = 'ART'", "x.encounter_datetime DESC, x.order_id DESC", "x.*")}
{_pick("da", "hiv_dispensing", "CAST(x.dispense_date AS DATE) <= m.reporting_date AND coalesce(x.arv_1_med, x.arv_2_med, x.arv_3_med) IS NOT NULL", "x.dispense_date DESC, x.encounter_id DESC", "x.*")}
{_pick("ts", "tb_screening", "x.tb_screening_date <= m.reporting_date", "x.tb_screening_date DESC, x.encounter_id DESC", "x.*")}
{_pick("tl", "tb_lab_results", "x.specimen_collection_date <= m.reporting_date", "x.specimen_collection_date DESC, x.tb_lab_results_id DESC", "x.*")}
{_pick("tc", "tb_lab_results", "x.specimen_collection_date <= m.reporting_date AND " + COINF, "x.specimen_collection_date DESC", "x.*")}
{_pick("b1", "hiv_visit", "x.visit_date <= m.reporting_date AND x.breastfeeding_status IS NOT NULL", "x.visit_date DESC, x.encounter_id DESC", "x.*")}
{_pick("b2", "pmtct_visits", "x.visit_date <= m.reporting_date AND x.breastfeeding_status IS NOT NULL", "x.visit_date DESC, x.encounter_id DESC", "x.*")}
{_pick("hs", "hiv_status", "x.start_date <= m.reporting_date", "x.start_date DESC, coalesce(x.end_date, DATE '9999-12-31') DESC, x.status_id DESC", "x.*")}
{_pick("bd", "all_vitals", "x.encounter_datetime <= m.reporting_date AND x.bp_diastolic IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_pick("bs", "all_vitals", "x.encounter_datetime <= m.reporting_date AND x.bp_systolic IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_pick("h", "all_diagnosis", "x.obs_datetime <= m.reporting_date AND x.diagnosis_entered LIKE '%HYPERTENSION'", "x.obs_datetime DESC, x.date_created DESC, x.obs_id DESC", "x.*", "patient_primary_id")}
"""


@derived("derive_hiv_monthly_reporting", "D7 R17 R6 R6b R6d R53 R54 R37", HIV_TABLES, MONTHLY)
def derive_hiv_monthly_reporting(w):
    return hiv.hiv_monthly_reporting(
        w.hiv_patient_program, w.hiv_visit, w.hiv_dispensing, w.hiv_regimens, w.hiv_viral_load, w.tb_screening,
        w.tb_lab_results, w.pmtct_visits, w.hiv_status, w.all_vitals, w.all_diagnosis, AS_OF, SINCE,
    )


def _one(alias: str, table: str, cond: str, order: str, cols: str, key: str = "emr_id") -> str:
    return _pick(alias, table, cond, order, cols, key).replace("m.emr_id", "b.emr_id")


TBDX = "((test_type = 'genxpert' AND test_result_text = 'Detected') OR (test_type = 'skin test' AND test_result_text = 'Positive') OR (test_type IN ('smear', 'culture') AND test_result_text IN ('1+', '++', '+++')))"
RECENT = "((test_type = 'genxpert' AND test_result_text = 'Detected') OR (test_type = 'smear' AND test_result_text IN ('1+', '++', '+++')))"
SUMMARY = f""", {ARV_START},
b AS (SELECT emr_id, min(date_enrolled) AS initial_enrollment_date FROM w_hiv_patient_program GROUP BY 1),
pr AS (
  SELECT emr_id, string_agg(DISTINCT drug_short_name, ',' ORDER BY drug_short_name) AS drugs FROM w_hiv_regimens r JOIN st USING (emr_id)
  WHERE order_action = 'NEW' AND drug_category = 'ART' AND CAST(start_date AS DATE) = arv_start_date GROUP BY 1),
iv AS (SELECT *, row_number() OVER (PARTITION BY emr_id ORDER BY visit_date DESC, encounter_id DESC) AS rd FROM w_hiv_visit),
ph AS (
  SELECT emr_id, 'Isoniazid' AS r, CAST(inh_start_date AS TIMESTAMP) AS s, CAST(inh_end_date AS TIMESTAMP) AS e, 1 AS k, 0 AS o FROM (
    SELECT *, row_number() OVER (PARTITION BY emr_id ORDER BY visit_date DESC, rd) AS z FROM iv WHERE inh_start_date IS NOT NULL) WHERE z = 1
  UNION ALL SELECT emr_id, 'Rifapentine + Isoniazid', CAST(rif_and_inh_start_date AS TIMESTAMP), CAST(rif_and_inh_end_date AS TIMESTAMP), 2, 0 FROM (
    SELECT *, row_number() OVER (PARTITION BY emr_id ORDER BY visit_date DESC, rd) AS z FROM iv WHERE rif_and_inh_start_date IS NOT NULL) WHERE z = 1
  UNION ALL SELECT emr_id, drug_short_name, start_date, end_date, 3, order_id FROM w_hiv_regimens WHERE drug_short_name IN ('Isoniazid', 'Rifapentine + Isoniazid')),
tb AS (SELECT emr_id, coalesce(test_result_date, specimen_collection_date) AS dt, test_type, tb_lab_results_id FROM w_tb_lab_results WHERE {TBDX}),
q AS (
SELECT b.emr_id, hp.hivemr_v1_id AS legacy_emr_id, hp.given_name AS first_name, hp.family_name AS last_name, hp.gender, hp.birthdate, hp.age,
  ac.dispensed_accompagnateur AS last_pickup_accompagnateur, cw.chw AS hiv_note_accompagnateur,
  CASE WHEN hp.emr_id IS NOT NULL THEN coalesce(hp.address, '') || ' ' || coalesce(hp.department, '') || ' ' || coalesce(hp.commune, '') || ' ' || coalesce(hp.section_communal, '') END AS address,
  hp.locality, hp.telephone_number AS phone_number, hp.user_entered, b.initial_enrollment_date, st.arv_start_date,
  CASE WHEN coalesce(st.dispensed_first, FALSE) THEN concat_ws(',', fd.arv_1_med, fd.arv_2_med, fd.arv_3_med) ELSE pr.drugs END AS initial_arv_regimen,
  CASE WHEN la.emr_id IS NOT NULL THEN coalesce(la.arv_1_med, '') || coalesce(',' || la.arv_2_med, '') || coalesce(',' || la.arv_3_med, '') END AS latest_arv_dispensed,
  CAST((year(DATE '{AS_OF}') - year(st.arv_start_date)) * 12 + month(DATE '{AS_OF}') - month(st.arv_start_date) AS INTEGER) AS months_on_art,
  px.r AS prophylactic_regimen, CAST(px.s AS DATE) AS prophylactic_start_date, CAST(px.e AS DATE) AS prophylactic_end_date, hp.latest_enrollment_location AS site,
  greatest(hv.visit_date, pv.visit_date, ev.visit_date) AS last_visit_date, sv.visit_date AS second_to_latest_hiv_visit_date,
  CAST(ld.dispense_date AS DATE) AS last_med_pickup_date, ld.months_dispensed AS last_med_pickup_months_dispensed, ld.current_art_treatment_line AS last_med_pickup_treatment_line,
  least(hv.next_visit_date, CAST(pv.next_visit_date AS DATE), ev.next_visit_date) AS next_visit_date, CAST(ld.next_dispense_date AS DATE) AS next_med_pickup_date,
  CAST(vl.order_date AS DATE) AS last_viral_load_order_date, vl.status AS last_viral_load_status, vl.vl_sample_taken_date AS last_viral_load_collection_date, vl.vl_result_date AS last_viral_load_results_date,
  vl.viral_load AS last_viral_load_numeric, CASE WHEN vl.vl_coded_results <> 'Detected' THEN 't' END AS last_viral_load_undetected,
  CAST((year(DATE '{AS_OF}') - year(vl.vl_sample_taken_date)) * 12 + month(DATE '{AS_OF}') - month(vl.vl_sample_taken_date) AS INTEGER) AS months_since_last_viral_load,
  (SELECT max(specimen_collection_date) FROM w_tb_lab_results x WHERE x.emr_id = b.emr_id AND {RECENT}) AS last_tb_coinfection_date,
  w.weight AS last_weight, CAST(w.encounter_datetime AS DATE) AS last_weight_date, hg.height AS last_height, CAST(hg.encounter_datetime AS DATE) AS last_height_date, td.dt AS tb_diag_date, td.test_type AS tb_diag_test,
  (SELECT CAST(min(start_date) AS DATE) FROM w_hiv_regimens x WHERE x.emr_id = b.emr_id AND lower(drug_category) = 'tb') AS tb_tx_start_date,
  (SELECT CAST(max(end_date) AS DATE) FROM w_hiv_regimens x WHERE x.emr_id = b.emr_id AND lower(drug_category) = 'tb') AS tb_tx_end_date,
  en.date_enrolled AS enr, CASE WHEN en.date_completed IS NOT NULL THEN en.outcome END AS oc, en.date_completed AS ocd, tx.status_outcome AS tr, tx.start_date AS trd,
  bd.bp_diastolic AS last_bp_diastolic, CAST(bd.encounter_datetime AS DATE) AS last_bp_diastolic_date, bs.bp_systolic AS last_bp_systolic, CAST(bs.encounter_datetime AS DATE) AS last_bp_systolic_date,
  ht.diagnosis_entered AS last_htn_diag, CAST(ht.obs_datetime AS DATE) AS last_htn_diag_date, hp.biometrics_collected, hp.latest_biometrics_collection_date, hp.biometrics_collector
FROM b LEFT JOIN w_hiv_patient hp ON hp.emr_id = b.emr_id LEFT JOIN st ON st.emr_id = b.emr_id LEFT JOIN pr ON pr.emr_id = b.emr_id
{_one("fd", "hiv_dispensing", "coalesce(x.arv_1_med, x.arv_2_med, x.arv_3_med) IS NOT NULL", "x.dispense_date, x.encounter_id DESC", "x.*")}
{_one("la", "hiv_dispensing", "coalesce(x.arv_1_med, x.arv_2_med, x.arv_3_med) IS NOT NULL", "x.dispense_date DESC, x.encounter_id DESC", "x.*")}
LEFT JOIN LATERAL (SELECT * FROM ph WHERE ph.emr_id = b.emr_id ORDER BY coalesce(e, TIMESTAMP '1900-01-01') DESC, s DESC, k DESC, o DESC LIMIT 1) px ON TRUE
{_one("hv", "hiv_visit", "TRUE", "x.visit_date DESC, x.encounter_id DESC", "x.*")}
{_one("pv", "pmtct_visits", "TRUE", "x.visit_date DESC, x.encounter_id DESC", "x.*")}
{_one("ev", "eid_visit", "TRUE", "x.encounter_id DESC", "x.*")}
LEFT JOIN LATERAL (SELECT DISTINCT visit_date FROM w_hiv_visit x WHERE x.emr_id = b.emr_id AND x.visit_date < hv.visit_date ORDER BY visit_date DESC LIMIT 1) sv ON TRUE
{_one("ld", "hiv_dispensing", "TRUE", "x.dispense_date DESC, x.encounter_id DESC", "x.*")}
{_one("vl", "hiv_viral_load", "TRUE", "x.vl_sample_taken_date DESC NULLS LAST, CASE WHEN x.vl_coded_results IS NULL THEN 0 ELSE 1 END DESC, x.vl_result_date DESC NULLS LAST, x.hiv_vl_id DESC", "x.*")}
LEFT JOIN LATERAL (SELECT * FROM tb WHERE tb.emr_id = b.emr_id ORDER BY dt, tb_lab_results_id LIMIT 1) td ON TRUE
{_one("w", "all_vitals", "x.weight IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_one("hg", "all_vitals", "x.height IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_one("bd", "all_vitals", "x.bp_diastolic IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_one("bs", "all_vitals", "x.bp_systolic IS NOT NULL", "x.encounter_datetime DESC, x.date_entered DESC, x.all_vitals_id DESC", "x.*")}
{_one("ht", "all_diagnosis", "x.diagnosis_entered LIKE '%HYPERTENSION'", "x.obs_datetime DESC, x.date_created DESC, x.obs_id DESC", "x.*", "patient_primary_id")}
LEFT JOIN LATERAL (SELECT * FROM (SELECT * FROM w_hiv_status x WHERE x.emr_id = b.emr_id AND status_outcome NOT IN ('Patient pregnant', 'Not pregnant')
  ORDER BY start_date DESC, end_date DESC NULLS LAST, status_id DESC LIMIT 1) WHERE start_date <= DATE '{AS_OF}' AND (end_date >= DATE '{AS_OF}' OR end_date IS NULL)) tx ON TRUE
{_one("en", "hiv_patient_program", f"x.date_enrolled <= DATE '{AS_OF}'", "x.date_enrolled DESC, coalesce(x.date_completed, DATE '9999-12-31') DESC, x.hiv_program_id DESC", "x.*")}
{_one("ac", "hiv_dispensing", "x.dispensed_accompagnateur IS NOT NULL", "x.dispense_date DESC, x.encounter_id DESC", "x.*")}
{_one("cw", "hiv_visit", "x.chw IS NOT NULL", "x.visit_date DESC, x.encounter_id DESC", "x.*")}),
z AS (SELECT *, coalesce(date_diff('day', coalesce(next_med_pickup_date, enr), DATE '{AS_OF}') <= 28, FALSE) AS act FROM q),
y AS (SELECT *, CASE WHEN act THEN coalesce(last_med_pickup_date, enr) WHEN next_med_pickup_date IS NOT NULL THEN next_med_pickup_date + 28 ELSE enr + 28 END AS pdate FROM z)
SELECT * EXCLUDE (enr, oc, ocd, tr, trd, act, pdate),
  CAST(greatest(coalesce(date_diff('day', next_visit_date, DATE '{AS_OF}'), 0), 0) AS INTEGER) AS days_late_for_next_visit,
  CAST(greatest(coalesce(date_diff('day', next_med_pickup_date, DATE '{AS_OF}'), 0), 0) AS INTEGER) AS days_late_for_next_med_pickup,
  CASE WHEN oc IS NOT NULL THEN oc WHEN act THEN 'active - on arvs' WHEN tr IS NOT NULL THEN tr ELSE 'ltfu' END AS status,
  CASE WHEN oc IS NOT NULL THEN ocd WHEN act THEN pdate WHEN tr IS NOT NULL THEN trd ELSE pdate END AS status_date
FROM y
"""


@derived("derive_hiv_patient_summary_status", "D8 R5 R25b R36 R37 R53 R14", HIV_TABLES + " hiv_patient eid_visit", SUMMARY)
def derive_hiv_patient_summary_status(w):
    from wardmill.operators.asof import time_line
    from wardmill.operators.ordered import KeyStats, index_pair

    dated = ((w.hiv_visit, "visit_date"), (w.pmtct_visits, "visit_date"), (w.eid_visit, "visit_date"), (w.hiv_dispensing, "dispense_date"), (w.hiv_viral_load, "order_date"))
    sizes = KeyStats.of([time_line(df, ["emr_id"], ts) for df, ts in dated])
    visits = index_pair(w.hiv_visit, ["emr_id"], ["visit_date", "encounter_id"], sizes=sizes)
    pmtct = index_pair(w.pmtct_visits, ["emr_id"], ["visit_date", "encounter_id"], sizes=sizes)
    eid = tables.update_index_numbers("eid_visit", w.eid_visit)
    disp = index_pair(
        w.hiv_dispensing, ["emr_id"], ["dispense_date", "encounter_id"], ("dispense_date_ascending", "dispense_date_descending"), sizes=sizes
    )
    vl = tables.update_index_numbers("hiv_viral_load", w.hiv_viral_load, sizes)
    return hiv.hiv_patient_summary_status(
        w.hiv_patient_program, w.hiv_patient, visits, disp, w.hiv_regimens, vl, w.tb_lab_results, pmtct, eid,
        w.hiv_status, w.all_vitals, w.all_diagnosis, AS_OF,
    )


@derived(
    "derive_hiv_appointment_summary",
    "D9 R13b R9",
    "hiv_visit",
    """, n AS (
      SELECT *, lead(visit_date) OVER w AS nv, lead(visit_location) OVER w AS nl, lead(encounter_type) OVER w AS nt, lead(encounter_id) OVER w AS ne
      FROM w_hiv_visit WINDOW w AS (PARTITION BY emr_id ORDER BY visit_date, encounter_id))
    SELECT emr_id, encounter_id AS appointment_scheduling_encounter_id, next_visit_date AS appointment_date, nv AS next_actual_visit, nl AS visit_location, nt AS encounter_type, ne AS encounter_id,
      CAST(row_number() OVER (PARTITION BY emr_id ORDER BY next_visit_date, n.encounter_id) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY emr_id ORDER BY next_visit_date DESC, n.encounter_id DESC) AS INTEGER) AS index_desc
    FROM n WHERE next_visit_date IS NOT NULL AND nv IS NOT NULL
    """,
)
def derive_hiv_appointment_summary(w):
    return hiv.hiv_appointment_summary(w.hiv_visit)


def _ordinal_sql(spec: tables.Ordinals, extra: str = "") -> str:
    out = []
    for name, desc in zip(spec.names, ("", " DESC")):
        by = ", ".join(f"{c}{desc} NULLS {'LAST' if desc else 'FIRST'}" for c in spec.order)
        out.append(f"CAST(row_number() OVER (PARTITION BY {', '.join(spec.keys)} ORDER BY {by}) AS INTEGER) AS {name}")
    return ", ".join(out)


def _register_ordinals() -> None:
    available = {
        "hiv_regimens": "order_id", "hiv_viral_load": "hiv_vl_id", "adt_encounters": "encounter_id", "ed_triage": "encounter_id",
        "hiv_visit": "encounter_id", "hiv_patient_program": "hiv_program_id", "all_vitals": "all_vitals_id", "all_visits": "visit_id",
        "all_encounters": "encounter_id", "consult_encounters": "encounter_id", "covid_visit": "encounter_id", "eid_visit": "encounter_id",
        "hiv_status": "status_id", "pmtct_visits": "encounter_id", "mch_visit": "encounter_id", "chemo_session_encounter": "encounter_id",
        "mh_patients": "patient_program_id", "mh_encounters": "encounter_id", "covid_disposition": "encounter_id", "hiv_tests": "hiv_test_id",
        "mch_status": "patient_state_id", "pmtct_pregnancy": "encounter_id", "outpatient_encounters": "encounter_id",
        "hiv_psychosocial_encounter": "encounter_id", "hiv_pmtct_visit": "encounter_id",
    }
    for table, unique in available.items():
        specs = [s for s in tables.ORDINALS if s.table == table]
        cols = ", ".join(_ordinal_sql(s) for s in specs)
        src = f"(SELECT *, {'CAST(date_completed IS NULL AS INTEGER) AS _open_last' if table == 'hiv_patient_program' else 'CAST(vl_coded_results IS NOT NULL AS INTEGER) AS _has_result' if table == 'hiv_viral_load' else '1 AS _u'} FROM w_{table})"
        names = [n for s in specs for n in s.names]

        def build(w, table=table, unique=unique, names=names):
            return tables.update_index_numbers(table, getattr(w, table)).select(unique, *names)

        derived(f"index_numbers_{table}", "D1 R9", table, f"SELECT {unique}, {cols} FROM {src}")(build)


_register_ordinals()


NCD_SQL = ", ".join(f"CAST(max(CASE WHEN {f} THEN 1 ELSE 0 END) AS INTEGER) AS {f}" for f in tables.NCD_FLAGS)
NCD_COLS = ", ".join(f"l.{c}" for c in tables.NCD_COLUMNS)
NCD = f""", f AS (SELECT emr_id, {NCD_SQL} FROM w_ncd_patient_table_staging GROUP BY 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY emr_id ORDER BY ncd_latest_encounter_date DESC, partition_num DESC) AS rn FROM w_ncd_patient_table_staging) WHERE rn = 1),
npt AS (SELECT f.*, {NCD_COLS} FROM f JOIN l ON l.emr_id = f.emr_id)
"""


@derived("derive_ncd_patient_table", "D4 R31b R26", "ncd_patient_table_staging", NCD + "SELECT * FROM npt")
def derive_ncd_patient_table(w):
    return tables.ncd_patient_table(w.ncd_patient_table_staging)


HF_SQL = ", ".join(f"CAST(max(CASE WHEN {f} THEN 1 ELSE 0 END) AS INTEGER) AS {f}" for f in tables.HF_FLAGS)


@derived(
    "derive_ncd_heart_failure_patient",
    "D4 R31c",
    "ncd_patient_table_staging ncd_heart_failure_patient_staging",
    NCD
    + f""", h AS (SELECT emr_id, {HF_SQL} FROM w_ncd_heart_failure_patient_staging GROUP BY 1)
    SELECT h.*, s.sex, s.birthdate, s.hf_diagnosis_date, s.last_visit_date, s.deceased, s.site, s.partition_num FROM h
    LEFT JOIN npt ON npt.emr_id = h.emr_id LEFT JOIN w_ncd_heart_failure_patient_staging s ON s.emr_id = npt.emr_id AND s.site = npt.site
    """,
)
def derive_ncd_heart_failure_patient(w):
    return tables.ncd_heart_failure_patient(
        w.ncd_heart_failure_patient_staging, tables.ncd_patient_table(w.ncd_patient_table_staging)
    )


@derived(
    "derive_mch_patient_latest",
    "D4 R31",
    "mch_patient",
    "SELECT * FROM w_mch_patient m WHERE NOT EXISTS (SELECT 1 FROM w_mch_patient n WHERE n.emr_id = m.emr_id AND m.latest_encounter_date < n.latest_encounter_date)",
)
def derive_mch_patient_latest(w):
    return tables.mch_patient_latest(w.mch_patient)


def _entry_sql() -> str:
    parts = [
        f"SELECT site, CASE WHEN site = 'hiv' THEN {loc} ELSE site END AS visit_location, '{d}' AS d, {ts} AS ts FROM w_{tab}"
        for d, (tab, loc, ts) in tables.ENTRY_SOURCES.items()
    ]
    cols = ", ".join(
        f"max(ts) FILTER (d = '{d}' AND visit_location IS NOT NULL) AS {d}_max_date_entered" for d in tables.ENTRY_SOURCES
    )
    return f", u AS ({' UNION ALL '.join(parts)}) SELECT site, visit_location, {cols} FROM u GROUP BY 1, 2"


@derived(
    "derive_visit_entry_dates",
    "D6 R29 R57",
    "mch_visit hiv_visit pmtct_visits covid_visit pathology_encounters all_vitals all_lab_results",
    _entry_sql(),
)
def derive_visit_entry_dates(w):
    names = [tab for tab, _, _ in tables.ENTRY_SOURCES.values()]
    return tables.visit_entry_dates({n: getattr(w, n) for n in names})


@derived(
    "derive_chemo_session_summary",
    "D12 R9",
    "chemo_session_encounter chemo_session_regimens all_patients",
    """SELECT e.emr_id, r.obs_id, e.encounter_id, e.visit_id, p.dob, CAST(year(e.encounter_datetime) - year(p.dob) AS INTEGER) AS age_at_encounter, p.gender, e.encounter_datetime, e.provider_name, e.user_entered,
      e.date_created, e.encounter_location, e.cycle_number, e.planned_chemo_sessions, e.treatment_plan, e.visit_information_comments, r.chemo_regimen_name,
      CAST(row_number() OVER (PARTITION BY e.emr_id ORDER BY e.encounter_datetime, r.obs_id) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY e.emr_id ORDER BY e.encounter_datetime DESC, r.obs_id DESC) AS INTEGER) AS index_desc
    FROM w_chemo_session_encounter e JOIN w_chemo_session_regimens r ON r.encounter_id = e.encounter_id JOIN w_all_patients p ON p.emr_id = e.emr_id""",
)
def derive_chemo_session_summary(w):
    return tables.chemo_session_summary(w.chemo_session_encounter, w.chemo_session_regimens, w.all_patients)


@derived(
    "derive_oncology_treatment_plan_summary",
    "D13 R34 R9",
    "oncology_treatment_plan all_diagnosis all_patients",
    """, dx AS (SELECT encounter_id, obs_id, diagnosis_coded_fr AS d, CASE WHEN dx_order = 'Primaire' THEN 1 ELSE 0 END AS pr FROM w_all_diagnosis WHERE oncology),
    fst AS (SELECT encounter_id, arg_min(d IS NULL, (1 - pr, obs_id)) AS null_first FROM dx GROUP BY 1),
    b AS (SELECT *, row_number() OVER (PARTITION BY encounter_id, d ORDER BY pr DESC, obs_id) AS k FROM dx WHERE d IS NOT NULL),
    r AS (SELECT b.*, row_number() OVER (PARTITION BY encounter_id ORDER BY pr DESC, obs_id) AS n FROM b JOIN fst USING (encounter_id) WHERE k = 1 AND NOT null_first),
    t AS (SELECT encounter_id, max(d) FILTER (n = 1) AS d1, max(pr) FILTER (n = 1) AS p1, max(d) FILTER (n = 2) AS d2, max(pr) FILTER (n = 2) AS p2, max(d) FILTER (n = 3) AS d3, max(pr) FILTER (n = 3) AS p3 FROM r GROUP BY 1)
    SELECT o.emr_id, o.encounter_id, o.visit_id, p.dob, CAST(year(o.encounter_datetime) - year(p.dob) AS INTEGER) AS age_at_encounter, p.gender, o.encounter_datetime, o.encounter_provider, o.user_entered, o.date_entered, o.cancer_stage, o.treatment_intent,
      d1 AS diagnosis_1, CAST(p1 AS INTEGER) AS diagnosis_1_primary, d2 AS diagnosis_2, CAST(p2 AS INTEGER) AS diagnosis_2_primary, d3 AS diagnosis_3, CAST(p3 AS INTEGER) AS diagnosis_3_primary,
      CAST(row_number() OVER (PARTITION BY o.emr_id ORDER BY o.encounter_datetime, o.encounter_id) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY o.emr_id ORDER BY o.encounter_datetime DESC, o.encounter_id DESC) AS INTEGER) AS index_desc
    FROM w_oncology_treatment_plan o LEFT JOIN w_all_patients p ON p.emr_id = o.emr_id LEFT JOIN t ON t.encounter_id = o.encounter_id""",
)
def derive_oncology_treatment_plan_summary(w):
    return tables.oncology_treatment_plan_summary(w.oncology_treatment_plan, w.all_diagnosis, w.all_patients)


@derived(
    "derive_outpatient_chemo_summary",
    "D14 R9 R52",
    "all_medication_dispensing all_patients",
    """SELECT d.dispensing_id AS outpatient_chemo_id, d.emr_id, d.encounter_id, p.dob, CAST(year(d.encounter_datetime) - year(p.dob) AS INTEGER) AS age_at_encounter, p.gender, d.encounter_datetime, d.encounter_provider, d.encounter_location, d.facility, d.drug_name,
      CAST(row_number() OVER (PARTITION BY d.emr_id ORDER BY d.encounter_datetime, d.dispensing_id) AS INTEGER) AS index_asc,
      CAST(row_number() OVER (PARTITION BY d.emr_id ORDER BY d.encounter_datetime DESC, d.dispensing_id DESC) AS INTEGER) AS index_desc
    FROM w_all_medication_dispensing d JOIN w_all_patients p ON p.emr_id = d.emr_id WHERE d.drug_name IN ('Tamoxifen, 10mg, tablet', 'Tamoxifen, 20mg tablet')""",
)
def derive_outpatient_chemo_summary(w):
    return tables.outpatient_chemo_summary(w.all_medication_dispensing, w.all_patients)


@derived(
    "derive_dispensed_medication_summary",
    "D15 R27",
    "all_medication_dispensing",
    """SELECT site, facility, CAST(encounter_datetime AS DATE) AS date, drug_name, drug_product_code, CAST(sum(quantity_dispensed) AS BIGINT) AS daily_quantity
    FROM w_all_medication_dispensing GROUP BY ALL""",
)
def derive_dispensed_medication_summary(w):
    return tables.dispensed_medication_summary(w.all_medication_dispensing)


@derived(
    "all_sites_one_table",
    "S3",
    "all_visits",
    """SELECT visit_id, patient_id, visit_date_started, visit_date_stopped, 'north' AS site, CAST(1 AS INTEGER) AS partition_num FROM w_all_visits
    UNION ALL SELECT visit_id, patient_id, visit_date_started, visit_date_stopped, 'south', 2 FROM w_all_visits""",
)
def all_sites_one_table(w):
    return union_sites([tag_site(w.all_visits, "north", 1), tag_site(w.all_visits, "south", 2)])




@query(
    "incremental_refresh_orders",
    "S7 S7a S7b S7c S7d S8",
    """
    WITH base AS (SELECT o_orderkey, o_custkey AS patient_id, 'old' AS o_orderstatus FROM orders WHERE o_orderkey % 6 <> 0),
    fresh AS (SELECT o_orderkey, o_custkey AS patient_id, o_orderstatus FROM orders WHERE o_orderkey % 9 <> 0),
    ch AS (SELECT o_custkey AS patient_id, max(o_orderdate) AS last_updated FROM orders GROUP BY 1),
    hit AS (SELECT patient_id FROM ch WHERE last_updated BETWEEN TIMESTAMP '2001-06-01 00:00:00' AND (SELECT max(last_updated) FROM ch))
    SELECT * FROM base WHERE patient_id NOT IN (SELECT patient_id FROM hit) UNION ALL SELECT * FROM fresh WHERE patient_id IN (SELECT patient_id FROM hit)
    """,
)
def incremental_refresh_orders(t: Tables):
    from wardmill.streaming import incremental as inc

    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("patient_id"), "o_orderstatus", "o_orderdate")
    base = o.filter("o_orderkey % 6 <> 0").select("o_orderkey", "patient_id", F.lit("old").alias("o_orderstatus"))
    fresh = o.filter("o_orderkey % 9 <> 0").select("o_orderkey", "patient_id", "o_orderstatus")
    changes = o.groupBy("patient_id").agg(F.max("o_orderdate").alias("last_updated")).withColumn("partition_num", F.lit(1))
    hi = inc.new_watermark(changes, 1)
    return inc.refreshed(base, fresh, changes, "2001-06-01 00:00:00", hi)
