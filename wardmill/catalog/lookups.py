"""Lookups of a clinic on their own, source views, and extracts that feed derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.base import REGISTRY, Tables, query
from wardmill.catalog.clinic_tables import Dictionary
from wardmill.catalog.extracts import clinic, concept_ids, prelude
from wardmill.catalog.records import _last
from wardmill.plans.derive import tables
from wardmill.plans.extract.clinic import Q, coded, date, num, text
from wardmill.sources import views

D = Dictionary(["weight", "note", "finding", "day"], ["a1", "a2", "a3"], ["t-1", "t-2"])


def lookup(name: str, covers: str, sql: str, build, more: str = "") -> None:
    for c, i in concept_ids(D).items():
        sql = sql.replace("{" + c + "}", str(i))
    query(name, covers, prelude(D, more.split()) + "\n" + sql)(lambda t: build(clinic(t, D)))


def _nth(value: str, code: str, offset: int) -> str:
    return f"max({value}) FILTER (o.concept_id = {{{code}}} AND o.r = {offset + 1})"


lookup(
    "visit_answers_by_offset",
    "F13 F12",
    f""", o AS (SELECT b.*, e.visit_id, row_number() OVER (PARTITION BY e.visit_id, b.concept_id ORDER BY b.obs_datetime, b.obs_id) AS r FROM c_obs b JOIN c_encounter e ON e.encounter_id = b.encounter_id AND NOT e.voided AND e.visit_id IS NOT NULL WHERE NOT b.voided)
    SELECT o.visit_id, {_nth("o.value_numeric", "weight", 0)} AS first_weight, {_nth("o.value_numeric", "weight", 1)} AS second_weight, {_nth("nm.name", "finding", 0)} AS first_finding, {_nth("nm.name", "finding", 1)} AS second_finding, {_nth("nm.name", "finding", 4)} AS fifth_finding,
      {_nth("o.value_text", "note", 2)} AS third_note, {_nth("o.value_datetime", "day", 0)} AS first_day, CAST(NULL AS DOUBLE) AS never_asked FROM o LEFT JOIN nm ON nm.concept_id = o.value_coded GROUP BY 1""",
    lambda c: c.visit_answers(
        {
            "first_weight": (num("weight"), 0), "second_weight": (num("weight"), 1), "first_finding": (coded("finding"), 0), "second_finding": (coded("finding"), 1),
            "fifth_finding": (coded("finding"), 4), "third_note": (text("note"), 2), "first_day": (date("day"), 0), "never_asked": (num("no such question"), 0),
        }
    ),
)
lookup(
    "observation_values_by_id",
    "F10",
    f""", h AS (SELECT o.encounter_id, {_last("o.obs_id", "finding")} AS finding_id, {_last("o.obs_id", "weight")} AS weight_id FROM c_obs o WHERE NOT voided GROUP BY 1)
    SELECT h.encounter_id, h.finding_id, nm.name AS finding, a.comments AS remark, h.weight_id, b.value_numeric AS weight, b.value_text AS words FROM h LEFT JOIN c_obs a ON a.obs_id = h.finding_id LEFT JOIN nm ON nm.concept_id = a.value_coded LEFT JOIN c_obs b ON b.obs_id = h.weight_id""",
    lambda c: c.obs_values(
        c.obs_values(c.answers(["encounter_id"], {"finding_id": Q("obs", "finding"), "weight_id": Q("obs", "weight")}, c.live("obs")), "finding_id", {"finding": "coded", "remark": "comment"}),
        "weight_id", {"weight": "num", "words": "text"},
    ).select("encounter_id", "finding_id", "finding", "remark", "weight_id", "weight", "words"),
)
lookup(
    "current_name_address",
    "S13 R5 F4",
    """, a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC, date_created DESC, person_address_id DESC) AS r FROM c_person_address WHERE NOT voided) WHERE r = 1)
    SELECT p.person_id, p.gender, p.birthdate, p.birthdate_estimated, pn.given_name, pn.family_name, pn.middle_name AS nick_name, a.person_address_id, a.country, a.state_province AS department, a.city_village AS commune, a.address3 AS section_communal, a.address1 AS locality, a.address2 AS street_landmark
    FROM c_person p LEFT JOIN pn ON pn.person_id = p.person_id LEFT JOIN a ON a.person_id = p.person_id WHERE NOT p.voided""",
    lambda c: views.current_name_address(c.table("person"), c.table("person_name"), c.table("person_address")),
)


@query(
    "mapped_concepts",
    "S13 F3",
    """SELECT p.p_partkey % 60 AS concept_id, r.r_name AS source, 'C' || p.p_size || '-' || p.p_brand AS code FROM part p JOIN region r ON r.r_regionkey = p.p_size % 5
    WHERE p.p_partkey % 4 = 1 AND p.p_partkey % 11 <> 0 AND r.r_regionkey <> 4 AND r.r_name IN ('ASIA', 'EUROPE', 'MIDDLE EAST')""",
)
def mapped_concepts(t: Tables):
    p = t.part
    maps = p.select((F.col("p_partkey") % 60).alias("concept_id"), F.col("p_partkey").alias("concept_reference_term_id"), (F.col("p_partkey") % 4).alias("concept_map_type_id"))
    terms = p.select(
        F.col("p_partkey").alias("concept_reference_term_id"), (F.col("p_size") % 5).alias("concept_source_id"),
        F.concat(F.lit("C"), "p_size", F.lit("-"), "p_brand").alias("code"), (F.col("p_partkey") % 11 == 0).alias("retired"),
    )
    sources = t.region.select(F.col("r_regionkey").alias("concept_source_id"), F.col("r_name").alias("name"), (F.col("r_regionkey") == 4).alias("retired"))
    kinds = t.nation.select(F.col("n_nationkey").cast("bigint").alias("concept_map_type_id"), F.concat(F.lit("kind-"), "n_nationkey").alias("uuid"))
    return views.report_mapping(maps, terms, sources, kinds, "kind-1", ["ASIA", "EUROPE", "MIDDLE EAST"])


def _chain(table: str) -> None:
    """The table's own extract, then its ordinals: what a refresh of the derived tables does."""
    from wardmill.catalog.derived import _ordinal_sql

    extract = REGISTRY[f"extract_{table}"]
    specs = [s for s in tables.ORDINALS if s.table == table]
    names = [n for s in specs for n in s.names]
    own = ", ".join(_ordinal_sql(s) for s in specs)
    gone = ", ".join(names)
    sql = f"SELECT s.* EXCLUDE ({gone}), {own} FROM ({extract.sql}) s"
    query(f"refreshed_{table}", "D1 R9 S6", sql)(lambda t: tables.update_index_numbers(table, extract.build(t.spark, t.folder)))


for _table in ("all_visits", "all_vitals", "hiv_visit", "mh_encounters", "outpatient_encounters", "covid_visit", "hiv_pmtct_visit"):
    _chain(_table)
