"""A clinical site laid over the driver tables.

Customers are patients, orders are visits and encounters, suppliers are staff
and wards.  Every table is a SELECT over the driver tables written in the SQL
that both engines share, so its size follows theirs; only the dictionary
(codes, names, types) is literal.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wardmill.catalog.base import read_table
from wardmill.plans.extract.clinic import IDENTIFIER_TYPES, REGISTRATION, UNKNOWN_LOCATION
from wardmill.sources.staging import Published

OBS_PER_ENCOUNTER = 14

TABLES: dict[str, str] = {
    "patient": """
        SELECT c_custkey AS patient_id, TIMESTAMP_NTZ '1994-01-01 08:00:00' + (c_custkey % 500) * INTERVAL '1' DAY AS date_created,
          CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP_NTZ '1999-01-01 08:00:00' + (c_custkey % 700) * INTERVAL '1' DAY END AS date_changed,
          c_custkey % 41 = 0 AS voided FROM {customer}""",
    "person": """
        SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
          CASE WHEN c_custkey % 29 <> 0 THEN CAST(DATE '1940-03-31' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS DATE) END AS birthdate,
          c_custkey % 4 = 0 AS birthdate_estimated, c_custkey % 23 = 0 AS dead,
          CASE WHEN c_custkey % 23 = 0 THEN TIMESTAMP_NTZ '2001-02-01 10:00:00' + (c_custkey % 90) * INTERVAL '1' DAY END AS death_date,
          CASE WHEN c_custkey % 23 = 0 THEN 1000 + c_custkey % 5 END AS cause_of_death, 'uuid-' || c_custkey AS uuid,
          TIMESTAMP_NTZ '1994-01-02 08:00:00' AS date_created,
          CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP_NTZ '2000-05-01 08:00:00' + (c_custkey % 300) * INTERVAL '1' DAY END AS date_changed,
          FALSE AS voided FROM {customer}""",
    "person_name": """
        SELECT c_custkey * 4 + q AS person_name_id, c_custkey AS person_id, 'Given' || (c_custkey % 97 + q) AS given_name,
          CASE WHEN q = 1 THEN 'Nick' || c_custkey % 7 END AS middle_name, 'Family' || c_custkey % 53 AS family_name,
          (c_custkey + q) % 3 = 0 AS preferred, TIMESTAMP_NTZ '1995-01-01 08:00:00' + ((c_custkey * 3 + q * 5) % 11) * INTERVAL '1' DAY AS date_created,
          CAST(NULL AS TIMESTAMP_NTZ) AS date_changed, (c_custkey + q) % 13 = 0 AS voided
        FROM (SELECT c_custkey, {EXPAND 3} AS q FROM {customer})
        UNION ALL
        SELECT 90000000 + s_suppkey, 10000000 + s_suppkey, 'Staff' || s_suppkey, CAST(NULL AS STRING), 'Member', TRUE,
          TIMESTAMP_NTZ '1995-01-01 08:00:00', CAST(NULL AS TIMESTAMP_NTZ), FALSE FROM {supplier}""",
    "person_address": """
        SELECT c_custkey * 4 + q AS person_address_id, c_custkey AS person_id, 'Country' AS country, 'Dept' || c_nationkey AS state_province,
          'Commune' || (c_nationkey + q) AS city_village, 'Locality' || c_custkey % 31 AS address1, 'Street' || q AS address2,
          'Section' || c_custkey % 11 AS address3, q = 1 AS preferred, TIMESTAMP_NTZ '1996-01-01 08:00:00' + (c_custkey % 7 + q) * INTERVAL '1' DAY AS date_created,
          CASE WHEN q = 1 AND c_custkey % 6 = 0 THEN TIMESTAMP_NTZ '2000-09-01 08:00:00' + (c_custkey % 50) * INTERVAL '1' DAY END AS date_changed,
          (c_custkey + q) % 17 = 0 AS voided
        FROM (SELECT c_custkey, c_nationkey, {EXPAND 2} AS q FROM {customer})""",
    "address_hierarchy_entry": """
        SELECT CAST(1 AS BIGINT) AS address_hierarchy_entry_id, CAST(NULL AS BIGINT) AS parent_id, 1 AS level_id, 'Country' AS name, CAST(NULL AS STRING) AS user_generated_id
        UNION ALL SELECT CAST(10 + n_nationkey AS BIGINT), CAST(1 AS BIGINT), 2, 'Dept' || n_nationkey, CAST(NULL AS STRING) FROM {nation}
        UNION ALL SELECT CAST(100 + n_nationkey * 2 + q AS BIGINT), CAST(10 + n_nationkey AS BIGINT), 3, 'Commune' || (n_nationkey + q), CAST(NULL AS STRING) FROM (SELECT n_nationkey, {EXPAND 2} AS q FROM {nation})
        UNION ALL SELECT CAST(1000 + (n_nationkey * 2 + floor(q / 11)) * 11 + q % 11 AS BIGINT), CAST(100 + n_nationkey * 2 + floor(q / 11) AS BIGINT), 4, 'Section' || q % 11,
          CASE WHEN (n_nationkey + q) % 7 <> 3 THEN 'C' || n_nationkey || '-' || q END FROM (SELECT n_nationkey, {EXPAND 22} AS q FROM {nation})""",
    "person_attribute_type": """
        SELECT * FROM (VALUES (1, 'Test Patient', 'pat-1'), (2, 'Unknown patient', 'pat-2'), (3, 'Telephone Number', '14d4f066-15f5-102d-96e4-000c29c2a5d7'),
          (4, 'First Name of Mother', 'pat-4'), (5, 'Health Center', '8d87236c-c2cc-11de-8d13-0010c6dffd0f')) AS t(person_attribute_type_id, name, uuid)""",
    "person_attribute": """
        SELECT c_custkey * 8 + q AS person_attribute_id, c_custkey AS person_id, CAST(1 + q % 5 AS INTEGER) AS person_attribute_type_id,
          CASE q % 5 WHEN 0 THEN CASE WHEN c_custkey % 31 = 0 THEN 'true' ELSE 'false' END WHEN 1 THEN 'yes' WHEN 2 THEN '509-' || (c_custkey * 7 + q)
            WHEN 3 THEN 'Mother' || c_custkey % 19 ELSE CAST(51 + c_nationkey AS STRING) END AS value,
          TIMESTAMP_NTZ '1997-01-01 08:00:00' + (c_custkey % 400 + q) * INTERVAL '1' DAY AS date_created,
          CASE WHEN q = 7 THEN TIMESTAMP_NTZ '2001-01-01 08:00:00' + (c_custkey % 33) * INTERVAL '1' DAY END AS date_changed,
          (c_custkey + q) % 7 = 0 AS voided
        FROM (SELECT c_custkey, c_nationkey, {EXPAND 8} AS q FROM {customer}) WHERE q % 5 <> 1 OR c_custkey % 10 = 0""",
    "patient_identifier_type": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{k}', '{u}')" for i, (k, u) in enumerate(IDENTIFIER_TYPES.items(), 1))
    + ") AS t(patient_identifier_type_id, name, uuid)",
    "patient_identifier": """
        SELECT c_custkey AS patient_id, 'ID' || q || '-' || c_custkey AS identifier, CAST(1 + q % 5 AS INTEGER) AS identifier_type,
          (c_custkey + q) % 4 = 0 AS preferred, TIMESTAMP_NTZ '1995-06-01 08:00:00' + ((c_custkey * 7 + q * 3) % 200) * INTERVAL '1' DAY AS date_created,
          CAST(1 + c_custkey % 3 AS BIGINT) AS creator, (c_custkey + q) % 11 = 0 AS voided
        FROM (SELECT c_custkey, {EXPAND 10} AS q FROM {customer})""",
    "location": f"""
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS location_id, r_name AS name, CASE WHEN r_regionkey = 4 THEN '{UNKNOWN_LOCATION}' ELSE 'loc-r' || r_regionkey END AS uuid,
          CAST(NULL AS BIGINT) AS parent_location FROM {{region}}
        UNION ALL SELECT CAST(n_nationkey + 51 AS BIGINT), n_name, 'loc-n' || n_nationkey, CAST(n_regionkey + 1 AS BIGINT) FROM {{nation}}
        UNION ALL SELECT s_suppkey + 101, s_name, 'loc-s' || s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(s_nationkey + 51 AS BIGINT) END FROM {{supplier}}""",
    "location_tag": "SELECT * FROM (VALUES (1, 'Visit Location'), (2, 'Other')) AS t(location_tag_id, name)",
    "location_tag_map": """
        SELECT CAST(n_nationkey + 51 AS BIGINT) AS location_id, CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END AS location_tag_id FROM {nation}
        UNION ALL SELECT CAST(r_regionkey + 1 AS BIGINT), 1 FROM {region} WHERE r_regionkey = 2
        UNION ALL SELECT s_suppkey + 101, 1 FROM {supplier} WHERE s_suppkey % 10 = 3""",
    "users": """
        SELECT s_suppkey AS user_id, 10000000 + s_suppkey AS person_id, CASE WHEN s_suppkey % 5 <> 0 THEN 'user' || s_suppkey END AS username,
          'sys-' || s_suppkey AS system_id, s_suppkey % 8 = 0 AS retired, TIMESTAMP_NTZ '1995-01-01 08:00:00' + s_suppkey * INTERVAL '1' HOUR AS date_created,
          CAST(0 AS BIGINT) AS creator, CASE WHEN s_suppkey % 3 <> 0 THEN 'user' || s_suppkey || '@example.org' END AS email FROM {supplier}""",
    "provider": "SELECT s_suppkey AS provider_id, 10000000 + s_suppkey AS person_id, CAST(1 + s_suppkey % 3 AS INTEGER) AS provider_role_id FROM {supplier}",
    "provider_role": "SELECT * FROM (VALUES (1, 'Nurse'), (2, 'Doctor'), (3, 'Clerk')) AS t(provider_role_id, name)",
    "encounter_provider": """
        SELECT o_orderkey * 2 + q AS encounter_provider_id, o_orderkey + 1 AS encounter_id, CASE WHEN q = 0 THEN CAST(floor(o_orderkey / 150) AS BIGINT) ELSE CAST(floor(o_custkey / 15) AS BIGINT) END AS provider_id,
          CAST(1 + q AS INTEGER) AS encounter_role_id, o_orderdate AS date_created, (o_orderkey + q) % 6 = 0 AS voided
        FROM (SELECT o_orderkey, o_custkey, o_orderdate, {EXPAND 2} AS q FROM {orders})""",
    "visit": """
        SELECT o_orderkey AS visit_id, o_custkey AS patient_id, o_orderdate + (o_orderkey % 8) * INTERVAL '1' HOUR AS date_started,
          CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + (o_orderkey % 9 + 1) * INTERVAL '1' DAY END AS date_stopped,
          o_orderdate + (o_orderkey % 8 + 1) * INTERVAL '1' HOUR AS date_created, CAST(1 + o_orderkey % 2 AS INTEGER) AS visit_type_id,
          CAST(floor(o_orderkey / 150) AS BIGINT) AS creator, CASE WHEN o_orderkey % 13 <> 0 THEN 101 + CAST(floor(o_custkey / 15) AS BIGINT) END AS location_id, o_orderkey % 37 = 0 AS voided FROM {orders}""",
    "visit_type": "SELECT * FROM (VALUES (1, 'Clinic or Hospital Visit'), (2, 'Home Visit')) AS t(visit_type_id, name)",
    "encounter": """
        SELECT o_orderkey + 1 AS encounter_id, o_custkey AS patient_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS visit_id,
          CAST(1 + o_orderkey % {NTYPES} AS INTEGER) AS encounter_type, 101 + CAST(floor(o_orderkey / 150) AS BIGINT) AS location_id, CAST(1 + o_orderkey % 3 AS INTEGER) AS form_id,
          o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS encounter_datetime, o_orderdate + (o_orderkey % 24 + o_orderkey % 4) * INTERVAL '1' HOUR AS date_created,
          CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL '3' DAY END AS date_changed, CAST(floor(o_custkey / 15) AS BIGINT) AS creator, o_orderkey % 43 = 0 AS voided
        FROM {orders}""",
    "obs": """
        SELECT e * 32 + q AS obs_id, o_custkey AS person_id, e AS encounter_id, 1000 + h % {NQ} AS concept_id,
          CASE WHEN q % 4 <> 3 THEN e * 32 + 20 + q % 4 END AS obs_group_id, CASE WHEN q % 2 = 0 THEN e END AS order_id,
          d + q * INTERVAL '7' MINUTE AS obs_datetime, {ANSWER} AS value_coded, CAST(h % 400 AS DOUBLE) / 2 AS value_numeric,
          CASE h % 3 WHEN 0 THEN CAST(101 + h % 12 AS STRING) WHEN 1 THEN 'ORD-' || (e + h % 7) ELSE 'text ' || h % 90 END AS value_text,
          d + (h % 50) * INTERVAL '1' DAY AS value_datetime, CAST(h % 6 AS BIGINT) AS value_drug, CASE WHEN h % 4 = 0 THEN 'note ' || h % 9 END AS comments,
          CAST(floor((e - 1) / 150) AS BIGINT) AS creator, d + (h % 70) * INTERVAL '1' HOUR AS date_created, h % 21 = 0 AS voided
        FROM (SELECT o_orderkey + 1 AS e, o_custkey, o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS d, q,
                (o_orderkey * 7919 + q * 104729 + o_custkey * 31) % 1000003 AS h
              FROM (SELECT o_orderkey, o_custkey, o_orderdate, {EXPAND {NOBS}} AS q FROM {orders}))
        UNION ALL
        SELECT e * 32 + 20 + q, o_custkey, e, 1000 + (e * 7919 + q * 104729 + o_custkey * 31) % 1000003 % {NQ}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), d, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE),
          CAST(NULL AS STRING), CAST(NULL AS TIMESTAMP_NTZ), CAST(NULL AS BIGINT), CAST(NULL AS STRING), CAST(floor((e - 1) / 150) AS BIGINT), d, FALSE
        FROM (SELECT o_orderkey + 1 AS e, o_custkey, o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS d, q
              FROM (SELECT o_orderkey, o_custkey, o_orderdate, {EXPAND 3} AS q FROM {orders}))""",
    "orders": """
        SELECT o_orderkey AS order_id, CASE o_orderkey % 4 WHEN 1 THEN o_orderkey - 2 WHEN 2 THEN o_orderkey - 3 END AS previous_order_id, o_custkey AS patient_id, o_orderkey + 1 AS encounter_id,
          1000 + o_orderkey * 11 % {NC} AS concept_id, CAST(1 + o_orderkey % 2 AS INTEGER) AS order_type_id, 1000 + o_orderkey * 5 % {NC} AS order_reason,
          'ORD-' || o_orderkey AS order_number, 'LAB-' || o_orderkey % 1000 AS accession_number,
          CASE o_orderkey % 4 WHEN 1 THEN 'REVISE' WHEN 2 THEN 'DISCONTINUE' ELSE 'NEW' END AS order_action,
          CASE o_orderkey % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'EXCEPTION' END AS fulfiller_status,
          CASE WHEN o_orderkey % 7 = 0 THEN 'STAT' ELSE 'ROUTINE' END AS urgency, o_orderdate AS date_activated,
          CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL '20' DAY END AS date_stopped,
          CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '30' DAY END AS auto_expire_date,
          CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL '5' DAY END AS scheduled_date, o_orderdate AS date_created,
          CAST(floor(o_orderkey / 150) AS BIGINT) AS creator, CAST(floor(o_custkey / 15) AS BIGINT) AS orderer, o_orderkey % 47 = 0 AS voided FROM {orders}""",
    "order_type": "SELECT * FROM (VALUES (1, '{OT1}', 'Test Order'), (2, '{OT2}', 'Drug Order')) AS t(order_type_id, uuid, name)",
    "drug_order": """
        SELECT o_orderkey AS order_id, o_orderkey % 6 AS drug_inventory_id, CAST(o_orderkey % 5 + 1 AS DOUBLE) AS dose, 1000 + o_orderkey % {NC} AS dose_units,
          CAST(o_orderkey % 90 AS DOUBLE) AS quantity, 1000 + o_orderkey * 3 % {NC} AS quantity_units, 1000 + o_orderkey * 7 % {NC} AS route,
          CAST(o_orderkey % 30 AS INTEGER) AS duration, 1000 + o_orderkey * 9 % {NC} AS duration_units, CAST(1 + o_orderkey % 3 AS BIGINT) AS frequency,
          'take ' || o_orderkey % 4 AS dosing_instructions, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS num_refills,
          CASE WHEN o_orderkey % 11 = 0 THEN 'compound ' || o_orderkey % 9 END AS drug_non_coded FROM {orders}""",
    "order_frequency": "SELECT * FROM (VALUES (1, 1000), (2, 1001), (3, 1002)) AS t(order_frequency_id, concept_id)",
    "drug": "SELECT * FROM (VALUES (0, 'Drug A 10mg', 'drug-0', 1000), (1, 'Drug B 20mg', 'drug-1', 1001), (2, 'Drug C', 'drug-2', 1002), (3, 'Drug D', 'drug-3', 1003), (4, 'Drug E', 'drug-4', 1004), (5, 'Drug F', 'drug-5', 1005)) AS t(drug_id, name, uuid, concept_id)",
    "program": "SELECT * FROM (VALUES {PROGRAMS}) AS t(program_id, name, uuid, retired)",
    "patient_program": """
        SELECT o_orderkey AS patient_program_id, o_custkey AS patient_id, CAST(1 + o_orderkey % {NP} AS INTEGER) AS program_id, 101 + CAST(floor(o_orderkey / 150) AS BIGINT) AS location_id,
          CASE WHEN o_orderkey % 3 = 0 THEN 1000 + o_orderkey % {NC} END AS outcome_concept_id, o_orderdate AS date_enrolled,
          CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate + (o_orderkey % 400) * INTERVAL '1' DAY END AS date_completed,
          o_orderdate + INTERVAL '1' DAY AS date_created, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL '9' DAY END AS date_changed,
          CAST(floor(o_orderkey / 150) AS BIGINT) AS creator, o_orderkey % 29 = 0 AS voided FROM {orders}""",
    "program_workflow": "SELECT * FROM (VALUES {WORKFLOWS}) AS t(program_workflow_id, program_id, uuid, concept_id)",
    "program_workflow_state": "SELECT * FROM (VALUES {STATES}) AS t(program_workflow_state_id, program_workflow_id, concept_id, uuid)",
    "patient_state": """
        SELECT o_orderkey * 4 + q AS patient_state_id, o_orderkey AS patient_program_id, CAST(1 + (o_orderkey + q) % {NS} AS INTEGER) AS state,
          CAST(o_orderdate + (q * 60) * INTERVAL '1' DAY AS DATE) AS start_date,
          CASE WHEN q < 2 THEN CAST(o_orderdate + (q * 60 + 60) * INTERVAL '1' DAY AS DATE) END AS end_date, o_orderdate + INTERVAL '2' DAY AS date_created, (o_orderkey + q) % 14 = 0 AS voided
        FROM (SELECT o_orderkey, o_orderdate, {EXPAND 3} AS q FROM {orders})""",
    "relationship_type": "SELECT * FROM (VALUES (1, 'Parent', FALSE), (2, 'Sibling', FALSE)) AS t(relationship_type_id, a_is_to_b, retired)",
    "relationship": """
        SELECT c_custkey AS relationship_id, CAST(floor(c_custkey / 2) AS BIGINT) AS person_a, c_custkey AS person_b, CAST(1 + c_custkey % 2 AS INTEGER) AS relationship,
          TIMESTAMP_NTZ '1998-01-01 08:00:00' + (c_custkey % 60) * INTERVAL '1' DAY AS date_created, c_custkey % 15 = 0 AS voided FROM {customer}""",
    "dbevent_patient": """
        SELECT o_custkey AS patient_id, max(o_orderdate) AS last_updated, max(o_orderkey) % 50 = 0 AS deleted FROM {orders} GROUP BY o_custkey""",
    "authentication_event_log": """
        SELECT 'S' || (user_id * 40 + day(ts)) AS login_id, CAST(floor(user_id * 2 / 3) AS BIGINT) AS user_id, 'user' || CAST(floor(user_id * 2 / 3) AS BIGINT) AS username,
          CASE event_type WHEN 'signup' THEN 'LOGIN_SUCCEEDED' WHEN 'click' THEN 'LOGOUT_SUCCEEDED' WHEN 'view' THEN 'LOGIN_EXPIRED' ELSE 'LOGIN_FAILED' END AS event_type,
          ts AS event_datetime, '10.0.0.' || user_id AS ip_address FROM {events}""",
    "medication_dispense": """
        SELECT o_orderkey AS medication_dispense_id, o_custkey AS patient_id, o_orderkey + 1 AS encounter_id, o_orderdate + INTERVAL '1' DAY AS date_handed_over, o_orderdate AS date_created, CAST(floor(o_orderkey / 150) AS BIGINT) AS creator,
          CAST(floor(o_custkey / 15) AS BIGINT) AS dispenser, 101 + CAST(floor(o_orderkey / 150) AS BIGINT) AS location_id, o_orderkey % 6 AS drug_id, CAST(o_orderkey % 5 AS DOUBLE) AS dose, 1000 + o_orderkey % {NC} AS dose_units, CAST(1 + o_orderkey % 3 AS INTEGER) AS frequency,
          CAST(o_orderkey % 80 AS DOUBLE) AS quantity, 1000 + o_orderkey * 3 % {NC} AS quantity_units, o_orderkey AS drug_order_id, 'use ' || o_orderkey % 5 AS dosing_instructions, 1000 + o_orderkey * 7 % {NC} AS status FROM {orders}""",
    "drug_code": "SELECT * FROM (VALUES (0, 'K10'), (0, 'K11'), (1, 'K20'), (3, 'K30')) AS t(drug_id, code)",
    "concept": "SELECT DISTINCT concept_id, CASE WHEN concept_id % 2 = 0 THEN 'Test' ELSE 'Misc' END AS class FROM (VALUES {CODES}) AS t(concept_id, source, code)",
    "encounter_role": "SELECT * FROM (VALUES (1, 'c458d78e-8374-4767-ad58-9f8fe276e01c'), (2, '6e630e03-5182-4cb3-9a82-a5b1a85c09a7')) AS t(encounter_role_id, uuid)",
    "concept_numeric": "SELECT concept_id, 'mg' AS units FROM (VALUES {CODES}) AS t(concept_id, source, code) WHERE concept_id % 2 = 0",
    "user_role": "SELECT s_suppkey AS user_id, CASE q WHEN 0 THEN 'Application Role: clerk ' || s_suppkey % 3 WHEN 1 THEN 'Privilege Level: full' ELSE 'System Role' END AS role FROM (SELECT s_suppkey, {EXPAND 3} AS q FROM {supplier})",
    "user_property": "SELECT s_suppkey AS user_id, 'authentication.secondaryType' AS property, CASE WHEN s_suppkey % 5 = 4 THEN NULL WHEN s_suppkey % 4 = 0 THEN 'secret' WHEN s_suppkey % 4 = 1 THEN 'totp' WHEN s_suppkey % 4 = 2 THEN '' ELSE 'sms' END AS property_value FROM {supplier}",
    "migration_data_warnings": "SELECT event_id AS id, user_id AS patient_id, CASE WHEN event_id % 4 <> 0 THEN event_id * 3 END AS encounter_id, CASE WHEN event_id % 6 <> 1 THEN event_id * 7 END AS source_encounter_id, 'P' || user_id AS emr_id, CASE WHEN user_id % 3 = 0 THEN user_id + 5000 END AS hivemr_v1_id, 'D' || user_id % 40 AS hiv_dossier_id, event_type AS warning_type, 'value ' || event_id % 7 AS warning_details, CAST(ts AS DATE) AS encounter_date, CASE event_id % 3 WHEN 0 THEN 'weight' WHEN 1 THEN 'visit date' END AS field_name, CASE WHEN event_id % 3 <> 2 THEN 'given ' || event_id % 13 END AS field_value, event_id % 5 = 0 AS flag_for_review FROM {events}",
    "encounter_type": "SELECT * FROM (VALUES {TYPES}) AS t(encounter_type_id, name, uuid)",
    "report_mapping": "SELECT * FROM (VALUES {CODES}) AS t(concept_id, source, code)",
    "concept_name": "SELECT * FROM (VALUES {NAMES}) AS t(concept_id, name, locale, locale_preferred, concept_name_type, voided)",
    "concept_set": "SELECT * FROM (VALUES {SETS}) AS t(concept_id, concept_set)",
    "concept_answer": "SELECT * FROM (VALUES {OFFERED}) AS t(concept_id, answer_concept)",
}


#: ``{EXPAND n} AS q FROM {table}``: a row for each q below n.
EXPANDED = re.compile(r"\{EXPAND (\d+)\} AS q FROM (\{\w+\})")


def _expanded(m: re.Match) -> str:
    """As a cross join with n rows: Spark's size estimate counts these, while it takes explode for one row to one."""
    return f"q FROM {m[2]} CROSS JOIN (VALUES {', '.join(f'({i}L)' for i in range(int(m[1])))}) AS expanded(q)"


class Dictionary:
    """Codes, types and programs that one job talks about."""

    def __init__(
        self,
        questions: list[str],
        answers: list[str],
        types: list[str],
        by: str = "uuid",
        programs: list[str] | None = None,
        states: int = 6,
        sets: list[tuple[str, str]] | None = None,
        state_codes: list[tuple[str, str]] | None = None,
        order_types: tuple[str, str] | None = None,
        offered: list[tuple[str, str]] | None = None,
    ):
        q = list(dict.fromkeys(questions)) or ["none"]
        self.state_codes = state_codes or []
        self.order_types = order_types or ("52a447d3-a64a-11e3-9aeb-50e549534c5e", "131168f4-15f5-102d-96e4-000c29c2a5d7")
        given = [*answers, *[c for c, _ in self.state_codes], "1065", "1066", "other answer"]
        a = [c for c in dict.fromkeys(given) if c not in q]
        self.codes = q + a
        self.nq, self.nc = len(q), len(q) + len(a)
        self.na = len(a)
        self.types = list(dict.fromkeys(types))
        self.by = by
        self.programs = programs or ["program-1", "program-2"]
        self.states = len(self.state_codes) or states
        self.sets = sets or []
        self.offered = offered or []

    def fill(self) -> dict[str, str]:
        ids = {c: 1000 + i for i, c in enumerate(self.codes)}
        quote = lambda s: "'" + s.replace("'", "''") + "'"
        types = [
            f"({i}, {quote('type ' + str(i) if self.by == 'uuid' else t)}, {quote(t if self.by == 'uuid' else 'type-' + str(i))})"
            for i, t in enumerate(self.types, 1)
        ] + [f"({len(self.types) + 1}, 'registration', '{REGISTRATION}')"] * (REGISTRATION not in self.types)
        n_types = len(types) + 1
        names = []
        for c, i in ids.items():
            word = {"1065": "Yes", "1066": "No", "5622": "Other"}.get(c, f"word {c}")
            names.append(f"({i}, {quote(word)}, 'en', TRUE, 'FULLY_SPECIFIED', FALSE)")
            names.append(f"({i}, {quote('short ' + c)}, 'en', FALSE, 'SHORT', FALSE)")
            if i % 3:
                names.append(f"({i}, {quote('mot ' + c)}, 'fr', TRUE, 'FULLY_SPECIFIED', {'TRUE' if i % 5 == 0 else 'FALSE'})")
        sets = [f"({ids[m]}, {ids[s]})" for s, m in self.sets] or ["(1, 2)"]
        progs = [f"({i}, {quote(p)}, {quote(p)}, FALSE)" for i, p in enumerate(self.programs, 1)]
        flows = [f"({i}, {i}, 'flow-{i}', 1000)" for i, _ in enumerate(self.programs, 1)]
        states = [
            f"({i}, {1 + i % len(self.programs)}, {1000 + i % self.nc}, 'state-{i}')" for i in range(1, self.states + 1)
        ]
        if self.state_codes:
            states = [
                f"({i}, {1 + i % len(self.programs)}, {ids[c]}, '{u}')" for i, (c, u) in enumerate(self.state_codes, 1)
            ]
        return {
            "{NOBS}": str(OBS_PER_ENCOUNTER),
            "{NTYPES}": str(n_types),
            "{NQ}": str(self.nq),
            "{NC}": str(self.nc),
            "{ANSWER}": f"1000 + {self.nq} + CAST(floor(h / 13) AS BIGINT) % {self.na}",
            "{NP}": str(len(progs)),
            "{NS}": str(self.states),
            "{OT1}": self.order_types[0],
            "{OT2}": self.order_types[1],
            "{TYPES}": ", ".join(types),
            "{CODES}": ", ".join(f"({i}, {quote(c.split(':')[0] if ':' in c else 'LOCAL')}, {quote(c.split(':', 1)[-1])})" for c, i in ids.items()),
            "{NAMES}": ", ".join(names),
            "{SETS}": ", ".join(sets),
            "{OFFERED}": ", ".join(f"({ids[q]}, {ids[a]})" for q, a in self.offered) or "(1, 2)",
            "{PROGRAMS}": ", ".join(progs),
            "{WORKFLOWS}": ", ".join(flows),
            "{STATES}": ", ".join(states),
        }

    def text(self, table: str, spark: bool) -> str:
        s = TABLES[table]
        for k, v in self.fill().items():
            s = s.replace(k, v)
        if spark:
            return EXPANDED.sub(_expanded, s)
        s = re.sub(r"\{EXPAND (\d+)\}", lambda m: f"unnest(range({m[1]}))", s)
        s = s.replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("AS STRING)", "AS VARCHAR)")
        return re.sub(r"\{(\w+)\}", r"\1", s)

    def ctes(self, tables: list[str]) -> str:
        """The tables as SQL common table expressions named ``c_<table>``."""
        return "WITH " + ",\n".join(f"c_{t} AS ({self.text(t, False)})" for t in tables)


_SHARED: dict[tuple[str, str], Published] = {}


class DriverSite:
    """Site reader over the driver tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str, dictionary: Dictionary):
        self.spark, self.folder, self.dictionary = spark, folder, dictionary
        self._read: dict[str, DataFrame] = {}

    def exists(self, table: str) -> bool:
        return table in TABLES

    def published(self, name: str, build) -> DataFrame:
        """Shared by all jobs over the folder in a session: the driver's tables never change."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _SHARED:
            _SHARED[key] = Published(self.spark)
        return _SHARED[key].get(name, build)

    def read(self, table: str) -> DataFrame:
        if table not in self._read:
            text = self.dictionary.text(table, True)
            used = set(re.findall(r"\{(\w+)\}", text))
            frames = {t: read_table(self.spark, self.folder, t) for t in used}
            self._read[table] = self.spark.sql(text, **frames)
        return self._read[table]
