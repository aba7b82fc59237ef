"""What every extraction job needs from one site's source tables.

A ``Clinic`` wraps a site reader with the report's moment, locale and lineage.
Its methods return plain DataFrames; the per-row lookups of the source database
(names, identifiers, providers, facilities, answers) are each one join or one
aggregate over a whole table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions import dates as D
from wardmill.operators import eav, enrich
from wardmill.operators.eav import Answer
from wardmill.operators.latest import top1, top_n
from wardmill.sources.site import adapted

# Well-known ids of the source system's metadata.
UNKNOWN_LOCATION = "8d6c993e-c2cc-11de-8d13-0010c6dffd0f"
IDENTIFIER_TYPES = {
    "emr": "a541af1e-105c-40bf-b345-ba1fd6a59b85",
    "hiv": "139766e8-15f5-102d-96e4-000c29c2a5d7",
    "dossier": "e66645eb-03a8-4991-b4ce-e87318e37566",
    "hiv_dossier": "3B954DB1-0D41-498E-A3F9-1E20CCC47323",
    "biometrics": "e26ca279-8f57-44a5-9ed8-8cc16e90e559",
}
REGISTRATION = "873f968a-73a8-4f9c-ac78-9f4778b751b6"
HEALTH_CENTER_ATTRIBUTE = "8d87236c-c2cc-11de-8d13-0010c6dffd0f"
VISIT_LOCATION_TAG = "Visit Location"

YES, NO = "1065", "1066"
"""Codes of the plain yes and no answers."""


@dataclass(frozen=True)
class Q:
    """One output column taken from the observations of a form.

    kind
      ``num`` ``text`` ``date`` ``coded`` ``comment``: value of the latest answer
      ``list``: distinct coded answers joined by `` | ``
      ``yn``: latest answer as true / false
      ``has``: true if the question was given this answer, else false
      ``mark``: 1 if the question was given this answer, else null
      ``either``: true / false if the only answer given is the first / second of ``answer``
      ``member``: latest answer that belongs to the concept set ``answer``
      ``max_num`` ``max_date`` ``max_coded`` ``max_text``: largest value given
      ``max_either``: true if the first of ``answer`` was given, else false if the second was
      ``max_comment``: largest comment on the answer
      ``place``: location whose id is the text of the answer
      ``obs``: id of the latest answer; ``code``: its coded value
    """

    kind: str
    code: str
    answer: str | tuple[str, ...] | None = None
    sep: str = " | "


def num(code: str) -> Q:
    return Q("num", code)


def text(code: str) -> Q:
    return Q("text", code)


def date(code: str) -> Q:
    return Q("date", code)


def coded(code: str, answer=None) -> Q:
    return Q("coded", code, answer)


def listed(code: str, answer=None, sep: str = " | ") -> Q:
    return Q("list", code, answer, sep)


def yn(code: str) -> Q:
    return Q("yn", code)


def has(code: str, answer) -> Q:
    return Q("has", code, answer)


def mark(code: str, answer) -> Q:
    return Q("mark", code, answer)


def comment(code: str, answer=None) -> Q:
    return Q("comment", code, answer)


def either(code: str, first: str = "1065", second: str = "1066") -> Q:
    return Q("either", code, (first, second))


def max_either(code: str, first: str = "1065", second: str = "1066") -> Q:
    return Q("max_either", code, (first, second))


def member(code: str, concept_set: str) -> Q:
    return Q("member", code, concept_set)


@dataclass
class Clinic:
    site: object
    """Reader with ``read(table)`` and ``exists(table)``."""
    as_of: str
    partition: str = "1"
    locale: str = "en"
    start: str | None = None
    end: str | None = None
    code_source: str | None = None
    """Name of the code system that plain codes belong to; None if codes are unique over all systems."""
    previous_watermark: str | None = None
    new_watermark: str | None = None
    _ids: dict = field(default_factory=dict, repr=False)

    # ---- metadata -------------------------------------------------------

    def table(self, name: str, optional: dict[str, str] | None = None) -> DataFrame:
        """A source table; ``optional`` columns (name to type) that the site does not have are null."""
        df = self.site.read(name)
        return adapted(df, optional) if optional else df

    def live(self, name: str) -> DataFrame:
        return enrich.active(self.table(name))

    def codes(self, codes: Iterable[str]) -> dict[str, int | None]:
        """Concept ids of dictionary codes, read once; the result is as long as the list asked for.

        ``"SYSTEM:code"`` names the code system; a plain code uses ``code_source``.
        """
        new = [c for c in dict.fromkeys(codes) if c not in self._ids]
        if new:
            m = self.table("report_mapping")
            plain = [c.split(":", 1)[-1] for c in new]
            rows = m.filter(F.col("code").isin(plain)).select("source", "code", "concept_id").collect()
            for c in new:
                system, code = c.split(":", 1) if ":" in c else (self.code_source, c)
                hit = [r.concept_id for r in rows if r.code == code and (system is None or r.source == system)]
                self._ids[c] = min(hit) if hit else None
        return {c: self._ids[c] for c in codes}

    def code(self, code: str) -> Column:
        v = self.codes([code])[code]
        return F.lit(v).cast("bigint")

    def is_code(self, column: str | Column, *codes: str) -> Column:
        ids = [v for v in self.codes(codes).values() if v is not None]
        col = F.col(column) if isinstance(column, str) else column
        return col.isin(ids) if ids else F.lit(False)

    def metadata_ids(self, table: str, id_column: str, column: str, values: Iterable[str]) -> list:
        key = (table, column, tuple(values))
        if key not in self._ids:
            rows = self.table(table).filter(F.col(column).isin(list(values))).select(id_column).collect()
            self._ids[key] = sorted(r[0] for r in rows)
        return self._ids[key]

    def concept_names(self, locale: str | None = None, short: bool = False) -> DataFrame:
        """One name per concept: asked locale first, then English, then preferred, then by name type."""
        loc = locale or self.locale
        n = self.live("concept_name")
        rank = F.when(F.col("concept_name_type").isNull(), 2).otherwise(0)
        kind = D.list_rank(F.col("concept_name_type"), ["FULLY_SPECIFIED", "SHORT"])
        n = n.select(
            "concept_id",
            "name",
            F.when(F.col("locale") == loc, 0).otherwise(1).alias("_l"),
            F.when(F.col("locale") == "en", 0).otherwise(1).alias("_e"),
            F.when(F.col("locale_preferred"), 0).otherwise(1).alias("_p"),
            rank.alias("_t"),
            kind.alias("_k"),
        )
        order = ["_l", "_e", "-_k", "_p", "_t", "name"] if short else ["_l", "_e", "_p", "_t", "_k", "name"]
        return top1(n, ["concept_id"], order).select("concept_id", "name")

    def with_concept_name(
        self, df: DataFrame, column: str, name: str, locale: str | None = None, short: bool = False
    ) -> DataFrame:
        return enrich.decode(df, self.concept_names(locale, short), column, "concept_id", {name: "name"})

    def set_members(self, code: str) -> DataFrame:
        """concept_id of the direct members of a concept set."""
        return self.table("concept_set").filter(F.col("concept_set") == self.code(code)).select("concept_id").distinct()

    def locations(self) -> DataFrame:
        """location_id, location_name and the name of the nearest ancestor where visits take place, built once per site."""
        from wardmill.sources.views import locations

        def build() -> DataFrame:
            tables = (self.table(n) for n in ("location", "location_tag_map", "location_tag"))
            return locations(*tables, VISIT_LOCATION_TAG)

        return self.site.published("locations", build)

    def unknown_location(self) -> str:
        row = self.table("location").filter(F.col("uuid") == UNKNOWN_LOCATION).select("name").first()
        return row[0] if row else "Unknown Location"

    # ---- people ---------------------------------------------------------

    def identifiers(self, kind: str = "emr") -> DataFrame:
        """One identifier of a type per patient: preferred, then newest (oldest for dossiers)."""
        ids = self.live("patient_identifier").join(
            self.table("patient_identifier_type")
            .filter(F.col("uuid") == IDENTIFIER_TYPES[kind])
            .select("patient_identifier_type_id"),
            F.col("identifier_type") == F.col("patient_identifier_type_id"),
            "left_semi",
        )
        date = "date_created" if kind == "dossier" else "-date_created"
        return top1(ids, ["patient_id"], ["-preferred", date, "identifier"])

    def with_identifiers(self, df: DataFrame, columns: dict[str, str], key: str = "patient_id") -> DataFrame:
        """``df`` with an identifier of each type (column name to kind): one read and one aggregate for all of them."""
        kinds = {IDENTIFIER_TYPES[k] for k in columns.values()}
        types = self.table("patient_identifier_type").filter(F.col("uuid").isin(sorted(kinds))).select("patient_identifier_type_id", F.col("uuid").alias("_type"))
        ids = self.live("patient_identifier").join(types, F.col("identifier_type") == F.col("patient_identifier_type_id"))
        preferred = F.coalesce((~F.col("preferred")).cast("int"), F.lit(2))
        old, new = (F.lit(t).cast("timestamp_ntz") for t in ("0001-01-01 00:00:00", "9999-12-31 00:00:00"))
        since = F.coalesce(F.timestamp_diff("MICROSECOND", old, F.col("date_created")), F.lit(-1))
        until = F.coalesce(F.timestamp_diff("MICROSECOND", F.col("date_created"), new), F.lit(1 << 62))
        # the least of (not preferred, age, identifier): newest first, for dossiers oldest first
        rank = {n: F.struct(preferred, since if k == "dossier" else until, F.col("identifier").alias("id")) for n, k in columns.items()}
        best = [F.min(F.when(F.col("_type") == IDENTIFIER_TYPES[k], rank[n]))["id"].alias(f"_wm_{n}") for n, k in columns.items()]
        return enrich.decode(df, ids.groupBy("patient_id").agg(*best), key, "patient_id", {n: f"_wm_{n}" for n in columns})

    def attribute_values(self, columns: dict[str, tuple[str, str]], **more: Column) -> DataFrame:
        """person_id and the newest value of each attribute (column name to (column of the type table, value)): one read.

        ``more``: aggregates over all attributes read.
        """
        wanted = F.lit(False)
        for column, value in columns.values():
            wanted = wanted | (F.col(column) == value)
        types = self.table("person_attribute_type").filter(wanted).select("person_attribute_type_id", "name", "uuid")
        a = self.live("person_attribute").join(types, "person_attribute_type_id")
        newest = [F.max(F.when(F.col(c) == v, F.struct("date_created", "value")))["value"].alias(n) for n, (c, v) in columns.items()]
        return a.groupBy("person_id").agg(*newest, *[c.alias(n) for n, c in more.items()])

    def identifier_list(self, kind: str, sep: str = ",") -> DataFrame:
        """patient_id and all live identifiers of a type, joined."""
        kinds = self.table("patient_identifier_type").filter(F.col("uuid") == IDENTIFIER_TYPES[kind]).select("patient_identifier_type_id")
        ids = self.live("patient_identifier").join(kinds, F.col("identifier_type") == F.col("patient_identifier_type_id"), "left_semi")
        return ids.groupBy("patient_id").agg(eav.text_list(F.col("identifier"), sep).alias("identifiers"))

    def with_identifier(self, df: DataFrame, name: str = "emr_id", kind: str = "emr", key: str = "patient_id") -> DataFrame:
        return enrich.decode(df, self.identifiers(kind).select("patient_id", "identifier"), key, "patient_id", {name: "identifier"})

    def names(self, voided_too: bool = False) -> DataFrame:
        n = self.table("person_name") if voided_too else self.live("person_name")
        return top1(n, ["person_id"], ["-preferred", "-date_created", "-person_name_id"])

    def section_codes(self) -> DataFrame:
        """person_id and the code of the section of their address, found through country, department and commune."""
        a = top1(self.table("person_address"), ["person_id"], ["-preferred", "-date_created", "-person_address_id"])
        a = a.select("person_id", "country", "state_province", "city_village", "address3")
        h = self.table("address_hierarchy_entry")
        found = a.join(h.select(F.col("name").alias("country"), F.col("address_hierarchy_entry_id").alias("_at"), F.col("level_id").alias("_level")), "country")
        for part in ("state_province", "city_village", "address3"):
            below = h.select(
                F.col("name").alias(part), F.col("parent_id").alias("_at"), (F.col("level_id") - 1).alias("_level"),
                F.col("address_hierarchy_entry_id").alias("_next"), "user_generated_id",
            )
            found = found.join(below, [part, "_at", "_level"]).withColumns({"_at": F.col("_next"), "_level": F.col("_level") + 1}).drop("_next")
            found = found if part == "address3" else found.drop("user_generated_id")
        return found.groupBy("person_id").agg(F.min("user_generated_id").alias("code"))

    def person_names(self) -> DataFrame:
        return self.names().select(
            "person_id", F.concat("given_name", F.lit(" "), "family_name").alias("person_name")
        )

    def user_names(self) -> DataFrame:
        u = self.table("users").select("user_id", "person_id", F.coalesce("username", "system_id").alias("username"))
        return enrich.decode(u, self.person_names(), "person_id", "person_id", {"person_name": "person_name"}).select(
            "user_id", "username", "person_name"
        )

    def with_user(
        self, df: DataFrame, key: str = "creator", name: str = "user_entered", login: bool = False, users: DataFrame | None = None
    ) -> DataFrame:
        """``users``: the table ``user_names``, if it was staged."""
        return enrich.decode(df, self.user_names() if users is None else users, key, "user_id", {name: "username" if login else "person_name"})

    def attributes(self, name: str, column: str = "name") -> DataFrame:
        """Newest value of one person attribute."""
        a = self.live("person_attribute").join(
            self.table("person_attribute_type").filter(F.col(column) == name).select("person_attribute_type_id"),
            "person_attribute_type_id",
            "left_semi",
        )
        return top1(a, ["person_id"], ["-date_created", "-value"]).select("person_id", "value")

    def with_attribute(self, df: DataFrame, name: str, attribute: str, column: str = "name", key: str = "patient_id") -> DataFrame:
        return enrich.decode(df, self.attributes(attribute, column), key, "person_id", {name: "value"})

    def with_unknown_flag(self, df: DataFrame, name: str = "unknown_patient", key: str = "patient_id") -> DataFrame:
        """The person's id if they are registered as unknown, else null."""
        a = self.attributes("Unknown patient").select("person_id", F.col("person_id").cast("string").alias("_id"))
        return enrich.decode(df, a, key, "person_id", {name: "_id"})

    def with_health_center(self, df: DataFrame, name: str = "health_center", key: str = "patient_id") -> DataFrame:
        """Name of the location whose id is the person's health center attribute."""
        a = self.attributes(HEALTH_CENTER_ATTRIBUTE, "uuid")
        places = self.table("location").select(F.col("location_id").cast("string").alias("_lid"), "name")
        return enrich.decode(df, enrich.decode(a, places, "value", "_lid", {"_hc": "name"}), key, "person_id", {name: "_hc"})

    def test_patients(self) -> DataFrame:
        return self.attributes("Test Patient").filter("value = 'true'")

    def without_test_patients(self, df: DataFrame, key: str = "patient_id") -> DataFrame:
        return enrich.exclude_flagged(df, self.test_patients(), key, "person_id")

    def with_person(self, df: DataFrame, columns: dict[str, str], key: str = "patient_id") -> DataFrame:
        return enrich.decode(df, self.live("person"), key, "person_id", columns)

    def addresses(self, voided_too: bool = True) -> DataFrame:
        """Preferred, else newest address.  The extracts do not leave voided addresses out."""
        a = self.table("person_address") if voided_too else self.live("person_address")
        return top1(a, ["person_id"], ["-preferred", "-date_created", "-person_address_id"])

    def with_address(self, df: DataFrame, columns: dict[str, str], key: str = "patient_id") -> DataFrame:
        return enrich.decode(df, self.addresses(), key, "person_id", columns)

    def registrations_all(self) -> DataFrame:
        return self.encounters([REGISTRATION])

    def registrations(self) -> DataFrame:
        """Newest registration encounter per patient."""
        return top1(self.registrations_all(), ["patient_id"], ["-encounter_datetime", "-encounter_id"])

    def with_registration_place(self, df: DataFrame, name: str = "loc_registered", key: str = "patient_id") -> DataFrame:
        reg = enrich.decode(
            self.registrations(), self.table("location"), "location_id", "location_id", {"_place": "name"}
        )
        return enrich.decode(df, reg, key, "patient_id", {name: "_place"})

    # ---- encounters -----------------------------------------------------

    def encounters(self, types: list[str] | None = None, by: str = "uuid") -> DataFrame:
        e = self.live("encounter")
        if types is None:
            return e
        ids = self.metadata_ids("encounter_type", "encounter_type_id", by, types)
        return e.filter(F.col("encounter_type").isin(ids) if ids else F.lit(False))

    def window(self, df: DataFrame, column: str) -> DataFrame:
        """The optional start and end day of the run."""
        from wardmill.sources.site import date_window

        return date_window(df, column, self.start, self.end)

    def with_type_name(self, df: DataFrame, name: str = "encounter_type_name") -> DataFrame:
        return enrich.decode(df, self.table("encounter_type"), "encounter_type", "encounter_type_id", {name: "name"})

    def with_facility(self, df: DataFrame, location: str = "location_id", visit: str = "visit_id") -> DataFrame:
        names = self.table("location").select("location_id", F.col("name").alias("location_name"))
        return enrich.resolve_facility(
            df, self.table("visit"), names, self.locations(), visit, location, self.unknown_location(), row_ids(df)
        )

    def with_place(self, df: DataFrame, name: str = "encounter_location", key: str = "location_id") -> DataFrame:
        return enrich.decode(df, self.table("location"), key, "location_id", {name: "name"})

    def providers(self) -> DataFrame:
        """One provider name per encounter."""
        ep = self.live("encounter_provider").select("encounter_id", "encounter_provider_id", "provider_id")
        one = top1(ep, ["encounter_id"], ["encounter_provider_id"])
        one = enrich.decode(one, self.table("provider"), "provider_id", "provider_id", {"_person": "person_id", "_role": "provider_role_id"})
        return enrich.decode(one, self.person_names(), "_person", "person_id", {"provider_name": "person_name"}).select(
            "encounter_id", "provider_name", F.col("_role").alias("provider_role_id")
        )

    def with_provider(self, df: DataFrame, name: str = "provider", key: str = "encounter_id") -> DataFrame:
        return enrich.decode(df, self.providers(), key, "encounter_id", {name: "provider_name"})

    def with_age(self, df: DataFrame, name: str, at: str = "encounter_datetime", key: str = "patient_id") -> DataFrame:
        df = self.with_person(df, {"_birth": "birthdate"}, key)
        return df.withColumn(name, D.complete_years(F.col("_birth"), F.col(at))).drop("_birth")

    def key(self, column: str, guard: bool = False) -> Column:
        return enrich.surrogate_key(self.partition, F.col(column), guard).alias(column)

    # ---- programs and orders --------------------------------------------

    def program_ids(self, uuid: str, by: str = "uuid") -> Column:
        ids = self.metadata_ids("program", "program_id", by, [uuid])
        return F.col("program_id").isin(ids) if ids else F.lit(False)

    def enrolments(self, program: str, by: str = "uuid") -> DataFrame:
        return self.live("patient_program").filter(self.program_ids(program, by))

    def first_enrolment(self, program: str, by: str = "uuid") -> DataFrame:
        e = self.enrolments(program, by).withColumn("_end", F.coalesce("date_completed", F.lit("9999-12-31").cast("timestamp_ntz")))
        return top1(e, ["patient_id"], ["date_enrolled", "_end", "patient_program_id"])

    def last_enrolment(self, program: str, by: str = "uuid") -> DataFrame:
        e = self.enrolments(program, by).withColumn("_end", F.coalesce("date_completed", F.lit("9999-12-31").cast("timestamp_ntz")))
        return top1(e, ["patient_id"], ["-date_enrolled", "-_end", "-patient_program_id"])

    def states(self) -> DataFrame:
        """Live program states with the concept they stand for and their workflow."""
        s = self.live("patient_state")
        return enrich.decode(
            s,
            self.table("program_workflow_state"),
            "state",
            "program_workflow_state_id",
            {"state_concept_id": "concept_id", "program_workflow_id": "program_workflow_id", "state_uuid": "uuid"},
        )

    def enrolment_at(
        self, df: DataFrame, program: str, ids: list[str], name: str, at: str = "encounter_datetime", events: DataFrame | None = None
    ) -> DataFrame:
        """Enrolment of the program whose days contain the row's day; the latest one if several.

        ``events`` is a short plan with the same ``ids``, patient and time, used for
        the lookup when ``df`` is the end of a long one.
        """
        from wardmill.operators.intervals import join_containing

        span = self.enrolments(program).select(
            "patient_id",
            F.to_date("date_enrolled").alias("_from"),
            F.to_date("date_completed").alias("_to"),
            "patient_program_id",
        )
        day = (df if events is None else events).select(*ids, "patient_id", F.to_date(at).alias("_day"))
        hit = join_containing(
            day, span, ["patient_id"], "_day", "_from", "_to", {name: "patient_program_id"}, ids, True,
            ["patient_program_id"], days=180,
        )
        return df.join(hit.select(*ids, name), ids, "left")

    def order_start(self, *reasons: str) -> DataFrame:
        """Earliest scheduled, else activated, date of the patient's orders for a reason."""
        o = self.live("orders").filter(self.is_code("order_reason", *reasons))
        return o.groupBy("patient_id").agg(F.min(F.coalesce("scheduled_date", "date_activated")).alias("order_start"))

    def latest_obs(self, *codes: str) -> DataFrame:
        """Newest live observation of the questions per person."""
        return top1(self.obs(*codes), ["person_id"], ["-obs_datetime", "-obs_id"])

    # ---- answers --------------------------------------------------------

    def obs(self, *codes: str) -> DataFrame:
        """Live observations, of the given questions if any."""
        o = self.live("obs")
        return o.filter(self.is_code("concept_id", *codes)) if codes else o

    def _telling(self, o: DataFrame, spec: dict[str, Q]) -> DataFrame:
        """The observations that give a column of the spec a value, with only the values that their questions are asked for.

        What is left out here does not pass through the shuffles of joins and aggregates. A key may lose all its rows.
        """
        self.codes([YES, NO] + [c for q in spec.values() for c in _codes_of(q)])
        telling, uses = F.lit(False), {}
        limits: dict[tuple[str | None, bool], list[Q]] = {}
        for q in spec.values():
            value = VALUE_OF[q.kind]
            if value is not None:
                uses.setdefault(value, []).append(q.code)
            limited = q.answer is not None and q.kind not in ("either", "max_either", "member")
            if limited:
                uses.setdefault("value_coded", []).append(q.code)
            # the newest comment may be none, and a mark without an answer stands for any
            bare = q.kind in ("comment", "obs") or value is None or (q.kind in ("has", "mark") and not limited)
            limits.setdefault((None if bare else value, limited), []).append(q)
        for (value, limited), qs in limits.items():
            rows = self.is_code("concept_id", *dict.fromkeys(q.code for q in qs))
            if value is not None:
                rows = rows & F.col(value).isNotNull()
            if limited:
                rows = rows & self.is_code("value_coded", *dict.fromkeys(a for q in qs for a in _tuple(q.answer)))
            telling = telling | rows
        values = [v for v in ("value_coded", "value_numeric", "value_text", "value_datetime", "comments") if v in o.columns]
        asked = {v: F.when(self.is_code("concept_id", *dict.fromkeys(uses[v])), F.col(v)) for v in values if v in uses}
        return o.filter(telling).withColumns(asked)

    def _asked(self, o: DataFrame, spec: dict[str, Q], filtered: bool = False) -> DataFrame:
        """The observations of the spec's questions with the names and places that its kinds look at."""
        if not filtered:
            self.codes([YES, NO] + [c for q in spec.values() for c in _codes_of(q)])
            o = o.filter(self.is_code("concept_id", *[q.code for q in spec.values()]))
        kinds = {q.kind for q in spec.values()}
        if kinds & {"coded", "list", "max_coded", "member"}:
            o = self.with_concept_name(o, "value_coded", "_name")
        for s in sorted({q.answer for q in spec.values() if q.kind == "member"}):
            members = self.set_members(s).select(F.col("concept_id").alias("_wm_m"), F.lit(True).alias("_wm_is"))
            o = enrich.decode(o, members, "value_coded", "_wm_m", {_member(s): "_wm_is"})
        if "place" in kinds:
            places = self.table("location").select(F.col("location_id").cast("string").alias("_lid"), "name")
            o = enrich.decode(o, places, "value_text", "_lid", {"_place": "name"})
        return o

    def _told(self, out: DataFrame, spec: dict[str, Q]) -> DataFrame:
        """The picked values in the form that each kind promises."""
        for n, q in spec.items():
            if q.kind == "comment":
                out = out.withColumn(n, F.col(n)["c"])
            elif q.kind == "yn":
                out = out.withColumn(n, self.yes_no(n))
            elif q.kind == "either":
                yes, no = (self.is_code(n, a) for a in q.answer)
                out = out.withColumn(n, F.when(yes, True).when(no, False))
        return out

    def answers(self, key: list[str], spec: dict[str, Q], obs: DataFrame | None = None) -> DataFrame:
        """One row per key with a column per entry of ``spec``: one scan, one aggregate."""
        o = self._asked(self.live("obs") if obs is None else obs, spec)
        return self._told(eav.pivot(o, key, {n: self._answer(q) for n, q in spec.items()}), spec)

    def with_numbered_groups(
        self, df: DataFrame, head: str, spec: dict[str, Q], slots: int, name: str, order: tuple[str, ...] = ("-date_created", "-obs_id"),
        key: str = "encounter_id", within: DataFrame | None = None,
    ) -> DataFrame:
        """``df`` with the answers of the first ``slots`` groups of each key, side by side.

        A group's head is an observation of the question ``head``; ``order`` ranks the heads of a key. ``name`` makes a
        column's name of the group's number ``{i}`` and the answer ``{n}``. The members of all groups meet in one aggregate; a key
        with fewer groups has nulls, further groups are left out.
        """
        heads = self.obs(head)
        if within is not None:
            heads = heads.join(within.select(F.col(key).alias("_wm_within")), F.col(key) == F.col("_wm_within"), "left_semi")
        heads = top_n(heads, [key], list(order), slots).select(F.col(key).alias("_wm_key"), F.col("obs_id").alias("_wm_group"), "position")
        grouped = self._telling(self.live("obs").filter("obs_group_id IS NOT NULL"), spec)
        o = self._asked(grouped.join(heads, F.col("obs_group_id") == F.col("_wm_group")), spec, True)
        wide, told = {}, {}
        for i in range(1, slots + 1):
            for n, q in spec.items():
                a = self._answer(q)
                column = name.format(i=i, n=n)
                wide[column] = replace(a, where=(F.col("position") == i) & a.where)
                told[column] = q
        out = df.join(self._told(eav.pivot(o, ["_wm_key"], wide, dealt=True), told), F.col(key) == F.col("_wm_key"), "left").drop("_wm_key")
        for n, q in told.items():
            if q.kind == "has":
                out = out.withColumn(n, F.coalesce(F.col(n), F.lit(False)))
        return out

    def visit_answers(self, spec: dict[str, tuple[Q, int]], within: DataFrame | None = None) -> DataFrame:
        """visit_id with a column per entry of ``spec``: the answer to a question at an offset, counted from 0 by time.

        All encounters of a visit count together; ties go by the observation's id, and a visit with fewer answers has null. Kinds are
        ``num``, ``text``, ``date`` and ``coded``. One ranking over the questions asked and one aggregate per visit, whatever
        the number of entries. ``within`` has the visits that count.
        """
        questions = {n: q for n, (q, _) in spec.items()}
        e = self.live("encounter").filter("visit_id IS NOT NULL").select("encounter_id", "visit_id")
        if within is not None:
            e = e.join(within.select("visit_id"), "visit_id", "left_semi")
        o = self.obs(*dict.fromkeys(q.code for q in questions.values())).join(e, "encounter_id")
        far = max(offset for _, offset in spec.values()) + 1
        o = self._asked(top_n(o, ["visit_id", "concept_id"], ["obs_datetime", "obs_id"], far), questions)
        value = {"num": "value_numeric", "text": "value_text", "date": "value_datetime", "coded": "_name"}
        found = {
            n: Answer(self.is_code("concept_id", q.code) & (F.col("position") == offset + 1), F.col(value[q.kind]), "max")
            for n, (q, offset) in spec.items()
        }
        return eav.pivot(o, ["visit_id"], found)

    def obs_values(self, df: DataFrame, key: str, spec: dict[str, str]) -> DataFrame:
        """``df`` with values of the observation whose id is in ``key``: column name to ``num``, ``text``, ``date``, ``coded`` or ``comment``."""
        o = self.live("obs").join(df.select(F.col(key).alias("_wm_id")), F.col("obs_id") == F.col("_wm_id"), "left_semi")
        if "coded" in spec.values():
            o = self.with_concept_name(o, "value_coded", "_name")
        value = {"num": "value_numeric", "text": "value_text", "date": "value_datetime", "coded": "_name", "comment": "comments"}
        return enrich.decode(df, o, key, "obs_id", {n: value[kind] for n, kind in spec.items()}, row_ids(df, key))

    def yes_no(self, column: str) -> Column:
        """Coded yes / no as a boolean; any other answer is null."""
        return F.when(self.is_code(column, YES), True).when(self.is_code(column, NO), False)

    def with_answers(
        self, df: DataFrame, spec: dict[str, Q], key: str = "encounter_id", obs: DataFrame | None = None,
        obs_key: str | None = None, within: DataFrame | None = None, sparse: bool = False, within_key: str | None = None,
    ) -> DataFrame:
        """``df`` with the spec's columns; unanswered questions are null (false for ``has``).

        ``sparse``: the key is a group that many rows do not have.
        ``within``: a short plan with the keys of ``df`` (and maybe more); only their observations are aggregated.
        ``within_key``: the column that ``within`` and the observations have in common, if not the key.
        """
        own = obs_key or key
        # a row without answers and a row whose answers say nothing look the same in the left join
        o = self._telling(self.live("obs") if obs is None else obs, spec).filter(F.col(own).isNotNull())
        if within is not None:
            mine = within.select(F.col(within_key or key).alias("_wm_within"))
            o = o.join(mine, F.col(within_key or own) == F.col("_wm_within"), "left_semi")
        picked = {n: self._answer(q) for n, q in spec.items()}
        a = self._told(eav.pivot(self._asked(o, spec, True), [own], picked, dealt=True), spec).withColumnRenamed(own, "_wm_key")
        if sparse:
            out = enrich.sparse_left(df, a, key, "_wm_key", row_ids(df, key)).drop("_wm_key")
        else:
            out = df.join(a, F.col(key) == F.col("_wm_key"), "left").drop("_wm_key")
        for n, q in spec.items():
            if q.kind == "has":
                out = out.withColumn(n, F.coalesce(F.col(n), F.lit(False)))
        return out

    def _answer(self, q: Q) -> Answer:
        asked = self.is_code("concept_id", q.code)
        given = asked
        if q.kind == "member":
            given = asked & F.col(_member(q.answer)).isNotNull()
        elif q.answer is not None and q.kind not in ("either", "max_either"):
            given = asked & self.is_code("value_coded", *_tuple(q.answer))
        v = F.col
        match q.kind:
            case "num":
                return _latest(given, v("value_numeric"))
            case "text":
                return _latest(given, v("value_text"))
            case "date":
                return _latest(given, v("value_datetime"))
            case "coded":
                return _latest(given, v("_name"))
            case "comment":
                # the newest answer's comment, also when it has none
                return _latest(given, F.struct(v("comments").alias("c")))
            case "place":
                return _latest(given, v("_place"))
            case "obs":
                return _latest(given, v("obs_id"))
            case "code":
                return _latest(given, v("value_coded"))
            case "yn":
                return _latest(asked, v("value_coded"))
            case "member":
                return _latest(given, v("_name"))
            case "either":
                return Answer(asked, v("value_coded"), "only")
            case "list":
                return Answer(given, v("_name"), "list", q.sep)
            case "has":
                return Answer(given, given, "max")
            case "mark":
                return Answer(given, F.lit(1), "max")
            case "max_either":
                first, second = (self.is_code("value_coded", a) for a in q.answer)
                return Answer(asked, F.when(first, True).when(second, False), "max")
            case "max_comment":
                return Answer(given, v("comments"), "max")
            case "max_num":
                return Answer(given, v("value_numeric"), "max")
            case "max_date":
                return Answer(given, v("value_datetime"), "max")
            case "max_coded":
                return Answer(given, v("_name"), "max")
            case "max_text":
                return Answer(given, v("value_text"), "max")
        raise ValueError(q.kind)


#: The column of an observation that a kind takes its value from.
VALUE_OF = dict.fromkeys(("coded", "list", "yn", "has", "mark", "either", "member", "max_coded", "max_either", "code"), "value_coded") | {
    "num": "value_numeric", "max_num": "value_numeric", "text": "value_text", "max_text": "value_text", "place": "value_text",
    "date": "value_datetime", "max_date": "value_datetime", "comment": "comments", "max_comment": "comments", "obs": None,
}

#: Ids that tell the rows of an extract apart and are seldom null.
ROW_IDS = ("encounter_id", "obs_id", "order_id", "patient_id")


def row_ids(df: DataFrame, key: str | None = None) -> list[str]:
    """The row ids, other than ``key``, among the columns of ``df``."""
    return [i for i in ROW_IDS if i in df.columns and i != key]


def _latest(where: Column, value: Column) -> Answer:
    return Answer(where, value, "latest")


def _member(concept_set: str) -> str:
    return f"_in {concept_set}"


def _tuple(x) -> tuple:
    return x if isinstance(x, tuple) else (x,)


def _codes_of(q: Q) -> list[str]:
    return [q.code, *(_tuple(q.answer) if q.answer is not None else ())]
