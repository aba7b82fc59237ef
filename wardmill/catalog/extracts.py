"""Extraction jobs run on the clinic laid over the driver tables, each with its SQL twin."""

from __future__ import annotations

import re

from wardmill.catalog.base import Tables, query
from wardmill.catalog.clinic_tables import Dictionary, DriverSite
from wardmill.plans.extract.clinic import IDENTIFIER_TYPES, REGISTRATION, UNKNOWN_LOCATION, Clinic, Q
from wardmill.plans.extract.form import FormJob, run, wanted

AS_OF = "2001-08-15"
PARTITION = "3"


def clinic(t: Tables, d: Dictionary, **kw) -> Clinic:
    return Clinic(DriverSite(t.spark, t.folder, d), AS_OF, PARTITION, code_source="LOCAL", **kw)


def tup(x) -> tuple:
    return () if x is None else x if isinstance(x, tuple) else (x,)


def dictionary(job: FormJob, extra_questions=(), extra_answers=()) -> Dictionary:
    qs = [*job.answers.values(), *job.patient_answers.values()]
    refs = [m for s in job.finish_sql.values() for m in re.findall(r"\{([^}]+)\}", s)]
    asked = [q.code for q in qs]
    asked += [m for s in job.finish_sql.values() for m in re.findall(r"concept_id = \{([^}]+)\}", s)]
    given = [a for q in qs for a in tup(q.answer)]
    sets = [q.answer for q in qs if q.kind == "member"]
    given += [c for c in refs if c not in asked]
    spare = [f"member {i}" for i in range(len(sets))]
    members = [(s, m) for i, s in enumerate(sets) for m in (spare[i], spare[(i + 3) % len(spare)])]
    return Dictionary(
        [*asked, *extra_questions], [*given, *spare, *extra_answers], list(job.types), job.by, sets=members
    )


# ---- SQL pieces shared by the twins ---------------------------------------

NAMES = """nm AS (SELECT concept_id, name FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY
    CASE WHEN locale = 'en' THEN 0 ELSE 1 END, CASE WHEN locale_preferred THEN 0 ELSE 1 END,
    CASE WHEN concept_name_type IS NULL THEN 1 ELSE 0 END, CASE concept_name_type WHEN 'FULLY_SPECIFIED' THEN 1 WHEN 'SHORT' THEN 2 ELSE 0 END, name) AS r
  FROM c_concept_name WHERE NOT voided) WHERE r = 1)"""
NAMES_FR = NAMES.replace("nm AS", "nm_fr AS").replace(
    "CASE WHEN locale = 'en' THEN 0 ELSE 1 END", "CASE WHEN locale = 'fr' THEN 0 ELSE 1 END, CASE WHEN locale = 'en' THEN 0 ELSE 1 END"
)
PLACES = """tagged AS (SELECT location_id FROM c_location_tag_map WHERE location_tag_id = 1),
places AS (SELECT a.location_id, a.name AS location_name, CASE WHEN a.location_id IN (SELECT * FROM tagged) THEN a.name
    WHEN b.location_id IN (SELECT * FROM tagged) THEN b.name WHEN c.location_id IN (SELECT * FROM tagged) THEN c.name END AS facility
  FROM c_location a LEFT JOIN c_location b ON b.location_id = a.parent_location LEFT JOIN c_location c ON c.location_id = b.parent_location)"""
PEOPLE = """pn AS (SELECT * FROM (SELECT *, given_name || ' ' || family_name AS person_name, row_number() OVER (PARTITION BY person_id
    ORDER BY preferred DESC, date_created DESC, person_name_id DESC) AS r FROM c_person_name WHERE NOT voided) WHERE r = 1)"""
UNKNOWN = f"(SELECT name FROM c_location WHERE uuid = '{UNKNOWN_LOCATION}')"
ADDRESS = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY preferred DESC, date_created DESC, person_address_id DESC) AS r
  FROM c_person_address) WHERE r = 1)"""


def identifier(kind: str) -> str:
    i = list(IDENTIFIER_TYPES).index(kind) + 1
    date = "date_created" if kind == "dossier" else "date_created DESC"
    return (
        f"(SELECT patient_id, identifier FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY preferred DESC, {date}, identifier) AS r "
        f"FROM c_patient_identifier WHERE NOT voided AND identifier_type = {i}) WHERE r = 1)"
    )


def attribute(type_id: int) -> str:
    return (
        "(SELECT person_id, value FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY date_created DESC, value DESC) AS r "
        f"FROM c_person_attribute WHERE NOT voided AND person_attribute_type_id = {type_id}) WHERE r = 1)"
    )


PROVIDERS = """(SELECT x.encounter_id, pn.person_name FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY encounter_provider_id) AS r
  FROM c_encounter_provider WHERE NOT voided) x JOIN c_provider p ON p.provider_id = x.provider_id LEFT JOIN pn ON pn.person_id = p.person_id WHERE x.r = 1)"""


def registered(d: Dictionary) -> str:
    t = f"(SELECT min(encounter_type_id) FROM c_encounter_type WHERE uuid = '{REGISTRATION}')"
    return (
        "(SELECT r.patient_id, l.name FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY encounter_datetime DESC, encounter_id DESC) AS r "
        f"FROM c_encounter WHERE NOT voided AND encounter_type = {t}) r LEFT JOIN c_location l ON l.location_id = r.location_id WHERE r.r = 1)"
    )


def years(birth: str, at: str) -> str:
    return (
        f"CAST(year({at}) - year({birth}) - CASE WHEN month({at}) * 100 + day({at}) < month({birth}) * 100 + day({birth}) THEN 1 ELSE 0 END AS INTEGER)"
    )


# lookup -> (joins it needs, SQL expression)
def lookups(d: Dictionary) -> dict[str, tuple[tuple[str, ...], str]]:
    return {
        "emr_id": (("emr",), "emr.identifier"),
        "dossier_id": (("dossier",), "dossier.identifier"),
        "hiv_emr_id": (("hiv",), "hiv.identifier"),
        "patient_id": ((), f"'{PARTITION}-' || e.patient_id"),
        "encounter_id": ((), f"'{PARTITION}-' || e.encounter_id"),
        "visit_id": ((), f"'{PARTITION}-' || e.visit_id"),
        "raw_patient_id": ((), "e.patient_id"),
        "raw_encounter_id": ((), "e.encounter_id"),
        "raw_visit_id": ((), "e.visit_id"),
        "visit_location": (("v",), "vl.name"),
        "encounter_location": (("el",), "el.location_name"),
        "facility": (("v", "el"), f"coalesce(vl.name, el.facility, {UNKNOWN})"),
        "encounter_datetime": ((), "e.encounter_datetime"),
        "encounter_date": ((), "CAST(e.encounter_datetime AS DATE)"),
        "encounter_type": (("et",), "et.name"),
        "encounter_type_id": ((), "e.encounter_type"),
        "user_entered": (("cu",), "cu.person_name"),
        "username": (("cu",), "cu.username"),
        "date_entered": ((), "e.date_created"),
        "provider": (("prov",), "prov.person_name"),
        "loc_registered": (("reg",), "reg.name"),
        "unknown_patient": (("unk",), "CAST(unk.person_id AS VARCHAR)"),
        "gender": (("p",), "p.gender"),
        "birthdate": (("p",), "p.birthdate"),
        "age_at_encounter": (("p",), years("p.birthdate", "e.encounter_datetime")),
        "visit_date": (("v2",), "CAST(v2.date_started AS DATE)"),
        "visit_start": (("v2",), "v2.date_started"),
        "department": (("ad",), "ad.state_province"),
        "commune": (("ad",), "ad.city_village"),
        "section": (("ad",), "ad.address3"),
        "locality": (("ad",), "ad.address1"),
        "street_landmark": (("ad",), "ad.address2"),
        "location_id": ((), "e.location_id"),
    }


def joins(d: Dictionary) -> dict[str, str]:
    return {
        "emr": f"LEFT JOIN {identifier('emr')} emr ON emr.patient_id = e.patient_id",
        "dossier": f"LEFT JOIN {identifier('dossier')} dossier ON dossier.patient_id = e.patient_id",
        "hiv": f"LEFT JOIN {identifier('hiv')} hiv ON hiv.patient_id = e.patient_id",
        "v": "LEFT JOIN c_visit v ON v.visit_id = e.visit_id LEFT JOIN c_location vl ON vl.location_id = v.location_id",
        "v2": "LEFT JOIN c_visit v2 ON v2.visit_id = e.visit_id AND NOT v2.voided",
        "el": "LEFT JOIN places el ON el.location_id = e.location_id",
        "et": "LEFT JOIN c_encounter_type et ON et.encounter_type_id = e.encounter_type",
        "cu": "LEFT JOIN (SELECT u.user_id, coalesce(u.username, u.system_id) AS username, pn.person_name FROM c_users u LEFT JOIN pn ON pn.person_id = u.person_id) cu ON cu.user_id = e.creator",
        "prov": f"LEFT JOIN {PROVIDERS} prov ON prov.encounter_id = e.encounter_id",
        "reg": f"LEFT JOIN {registered(d)} reg ON reg.patient_id = e.patient_id",
        "unk": f"LEFT JOIN {attribute(2)} unk ON unk.person_id = e.patient_id",
        "p": "LEFT JOIN c_person p ON p.person_id = e.patient_id AND NOT p.voided",
        "ad": f"LEFT JOIN {ADDRESS} ad ON ad.person_id = e.patient_id",
    }


def answer_sql(name: str, q: Q, ids: dict[str, int], d: Dictionary) -> str:
    where = f"o.concept_id = {ids[q.code]}"
    value = {
        "num": "o.value_numeric", "text": "o.value_text", "date": "o.value_datetime", "coded": "n.name",
        "comment": "o.comments", "place": "pl.name", "obs": "o.obs_id", "code": "o.value_coded",
        "yn": "o.value_coded", "member": "n.name",
    }.get(q.kind)
    if q.kind == "member":
        where += " AND o.value_coded IN (" + ", ".join(str(ids[m]) for s, m in d.sets if s == q.answer) + ")"
    elif q.answer is not None and q.kind != "either":
        where += " AND o.value_coded IN (" + ", ".join(str(ids[a]) for a in tup(q.answer)) + ")"
    if q.kind == "list":
        return f"string_agg(DISTINCT n.name, '{q.sep}' ORDER BY n.name) FILTER (WHERE {where})"
    if q.kind == "has":
        return f"coalesce(bool_or(TRUE) FILTER (WHERE {where}), FALSE)"
    if q.kind == "mark":
        return f"CAST(max(1) FILTER (WHERE {where}) AS INTEGER)"
    if q.kind.startswith("max_"):
        v = {"num": "o.value_numeric", "date": "o.value_datetime", "coded": "n.name", "text": "o.value_text"}[q.kind[4:]]
        return f"max({v}) FILTER (WHERE {where})"
    if q.kind == "either":
        lo, hi = (f"{f}(o.value_coded) FILTER (WHERE {where})" for f in ("min", "max"))
        a, b = (ids[x] for x in q.answer)
        return f"CASE WHEN {lo} = {hi} THEN CASE {lo} WHEN {a} THEN TRUE WHEN {b} THEN FALSE END END"
    known = "" if q.kind == "comment" else f" AND {value} IS NOT NULL"
    pick = f"last({value} ORDER BY o.date_created, o.obs_id) FILTER (WHERE {where}{known})"
    if q.kind == "yn":
        return f"CASE {pick} WHEN {ids['1065']} THEN TRUE WHEN {ids['1066']} THEN FALSE END"
    return pick


ALL_TABLES = (
    "concept_name location location_tag_map person_name person person_address person_attribute patient_identifier users provider "
    "encounter_provider encounter_type visit encounter obs"
).split()


def prelude(d: Dictionary, tables=(), extra: str = "") -> str:
    names = list(dict.fromkeys([*ALL_TABLES, *tables]))
    return d.ctes(names) + ",\n" + ",\n".join([NAMES, PLACES, PEOPLE] + ([extra] if extra else []))


def concept_ids(d: Dictionary) -> dict[str, int]:
    return {c: 1000 + i for i, c in enumerate(d.codes)}


def form_sql(job: FormJob, d: Dictionary) -> str:
    ids, look, js = concept_ids(d), lookups(d), joins(d)
    need = wanted(job)
    refs = " ".join(job.finish_sql.values())
    use = [n for n in look if n in need or re.search(rf"\b{n}\b", refs)]
    used_joins = list(dict.fromkeys(j for n in use for j in look[n][0]))
    types = ", ".join(str(i) for i in range(1, len(job.types) + 1))
    where = ["NOT e.voided"] + ([f"e.encounter_type IN ({types})"] if job.types else [])
    if job.no_test_patients:
        where.append(f"NOT EXISTS (SELECT 1 FROM {attribute(1)} ta WHERE ta.person_id = e.patient_id AND ta.value = 'true')")
    cols = [f"{look[n][1]} AS {n}" for n in use]
    order = job.index_order
    for n, desc in (("index_asc", ""), ("index_desc", " DESC")):
        if n in need:
            by = ", ".join(f"e.{o}{desc}" for o in order)
            cols.append(
                f"CAST(row_number() OVER (PARTITION BY e.patient_id ORDER BY {by}) AS INTEGER) AS {n}" if order else f"CAST(NULL AS INTEGER) AS {n}"
            )
    parts = []
    if job.answers:
        a = ", ".join(f'{answer_sql(n, q, ids, d)} AS "{n}"' for n, q in job.answers.items())
        parts.append(
            f"ans AS (SELECT o.encounter_id AS ans_key, {a} FROM c_obs o LEFT JOIN nm n ON n.concept_id = o.value_coded "
            "LEFT JOIN c_location pl ON CAST(pl.location_id AS VARCHAR) = o.value_text WHERE NOT o.voided GROUP BY o.encounter_id)"
        )
        for n, q in job.answers.items():
            cols.append(f'coalesce(ans."{n}", FALSE) AS "{n}"' if q.kind == "has" else f'ans."{n}"')
    if job.patient_answers:
        a = ", ".join(f'{answer_sql(n, q, ids, d)} AS "{n}"' for n, q in job.patient_answers.items())
        parts.append(
            f"pans AS (SELECT o.person_id AS pans_key, {a} FROM c_obs o JOIN c_encounter e ON e.encounter_id = o.encounter_id "
            f"LEFT JOIN nm n ON n.concept_id = o.value_coded WHERE NOT o.voided AND {' AND '.join(where)} GROUP BY o.person_id)"
        )
        cols += [f'pans."{n}"' for n in job.patient_answers]
    body = (
        f"SELECT {', '.join(cols)} FROM c_encounter e {' '.join(js[j] for j in used_joins)} "
        + ("LEFT JOIN ans ON ans.ans_key = e.encounter_id " if job.answers else "")
        + ("LEFT JOIN pans ON pans.pans_key = e.patient_id " if job.patient_answers else "")
        + f"WHERE {' AND '.join(where)}"
    )
    fin = {n: re.sub(r"\{([^}]+)\}", lambda m: str(ids[m[1]]), s) for n, s in job.finish_sql.items()}
    out = []
    for c in job.columns:
        name, src = c.split("=")[0], c.split("=")[-1]
        out.append(f'({fin[src]}) AS "{name}"' if src in fin else f'x."{src}" AS "{name}"')
    ctes = prelude(d) + "".join(",\n" + p for p in parts)
    return f"{ctes},\nx AS ({body})\nSELECT {', '.join(out)} FROM x"


def register_form(job: FormJob, covers: str) -> None:
    d = dictionary(job)
    query(f"extract_{job.name}", covers, form_sql(job, d))(lambda t: run(clinic(t, d), job))


def _forms() -> None:
    from wardmill.plans.extract import forms

    ids = {
        "adt_encounters": "X1", "all_vitals": "X13", "chemo_session_encounter": "X14", "consult_encounters": "X16",
        "covid_admission": "X17", "covid_discharge": "X19", "covid_disposition": "X20", "covid_visit": "X22",
        "echocardiogram_encounters": "X31", "ed_triage": "X32", "eid_visit": "X34", "hiv_psychosocial_encounter": "X39",
        "mh_encounters": "X57", "oncology_intake": "X64", "outpatient_encounters": "X68", "socioeconomic_encounter": "X78",
    }
    for name, job in forms.JOBS.items():
        register_form(job, f"{ids.get(name, '')} R24 R45 F9 F11 F15")


_forms()
