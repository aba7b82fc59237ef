"""Source views shared by the extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.operators.enrich import active, decode
from wardmill.operators.latest import top1
from wardmill.operators.tree import tagged_ancestor


def report_mapping(
    maps: DataFrame, terms: DataFrame, sources: DataFrame, map_types: DataFrame, same_as_uuid: str, names: list[str]
) -> DataFrame:
    """concept_id, source, code for same-as mappings of the named code systems."""
    t = terms.filter(~F.col("retired")).select("concept_reference_term_id", "concept_source_id", "code")
    s = sources.filter(~F.col("retired") & F.col("name").isin(names)).select(
        "concept_source_id", F.col("name").alias("source")
    )
    same = map_types.filter(F.col("uuid") == same_as_uuid).select("concept_map_type_id")
    return (
        maps.join(same, "concept_map_type_id", "left_semi")
        .join(t, "concept_reference_term_id")
        .join(s, "concept_source_id")
        .select("concept_id", "source", "code")
    )


def current_name_address(person: DataFrame, names: DataFrame, addresses: DataFrame) -> DataFrame:
    """One row per live person with the preferred, else newest, name and address."""
    n = top1(active(names), ["person_id"], ["-preferred", "-date_created", "-person_name_id"])
    a = top1(active(addresses), ["person_id"], ["-preferred", "-date_created", "-person_address_id"])
    out = active(person).select("person_id", "gender", "birthdate", "birthdate_estimated")
    out = decode(
        out,
        n,
        "person_id",
        "person_id",
        {"given_name": "given_name", "family_name": "family_name", "nick_name": "middle_name"},
    )
    return decode(
        out,
        a,
        "person_id",
        "person_id",
        {
            "person_address_id": "person_address_id",
            "country": "country",
            "department": "state_province",
            "commune": "city_village",
            "section_communal": "address3",
            "locality": "address1",
            "street_landmark": "address2",
        },
    )


def locations(location: DataFrame, tag_map: DataFrame, tags: DataFrame, tag: str) -> DataFrame:
    """location_id, location_name, facility: the name of the nearest tagged ancestor, itself included."""
    tagged = tag_map.join(tags.filter(F.col("name") == tag).select("location_tag_id"), "location_tag_id", "left_semi")
    anc = tagged_ancestor(location, tagged, "location_id", "parent_location")
    out = location.select("location_id", F.col("name").alias("location_name"))
    out = decode(out, anc, "location_id", "location_id", {"_anc": "ancestor_id"})
    return decode(out, location, "_anc", "location_id", {"facility": "name"}).drop("_anc")
