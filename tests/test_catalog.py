"""Every registered query against its SQL twin on the smallest driver tables.

WARDMILL_TEST_QUERIES=all runs the form extracts too, which share one code path.
"""

import os
import re

import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry_point
from tests.oracle import compare, connect
from wardmill.catalog import registry
from wardmill.sources.contracts import Contracts, drifts, fitted

FOLDER = os.environ.get("WARDMILL_TEST_DIR", "/root/testdata/sf0.001")
REG = registry()
FULL = os.environ.get("WARDMILL_TEST_QUERIES") == "all"
NAMES = [n for n in REG if FULL or not n.startswith("extract_") or n in (
    "extract_all_vitals", "extract_consult_encounters", "extract_all_visits", "extract_hiv_status", "extract_user_logins",
    "extract_mch_delivery", "extract_mch_visit", "extract_hiv_patient", "extract_covid_visit", "extract_echo_summary_table",
    "extract_all_patients", "extract_pathology_encounters", "extract_ovc_program_encounters", "extract_mch_j9_data",
)]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


SQL_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def contract(con, sql):
    """The table's contract as the other engine declares it."""
    rows = con.execute(f"DESCRIBE {sql}").fetchall()
    declared = Contracts()
    declared.declare("t", T.StructType([T.StructField(r[0], T.StructType.fromDDL(f"c {SQL_TYPES.get(r[1], r[1])}").fields[0].dataType) for r in rows]))
    return declared.schemas["t"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    e = REG[name]
    df = e.build(spark, FOLDER)
    if e.sql is None:
        assert df.columns and df.limit(5).collect() is not None
    else:
        assert compare(df, con, e.sql) == []
        if name.startswith(("extract_", "derive_", "refreshed_")):
            declared = contract(con, e.sql)
            assert drifts(df, declared) == [] and fitted(df, declared, name).schema.simpleString() == declared.simpleString()


def test_entry_contract(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).columns


def test_no_row_functions_and_no_unkeyed_windows():
    import pathlib

    for p in pathlib.Path("wardmill").rglob("*.py"):
        if "llm" in p.parts:  # has tests of its own
            continue
        src = p.read_text()
        assert not re.search(r"\b(pandas_udf|mapInPandas|applyInPandas|\.rdd\b|crossJoin|localCheckpoint)", src), p
        assert not re.search(r"Window\.orderBy", src), p
