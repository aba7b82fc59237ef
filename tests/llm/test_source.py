"""What the operators must not use."""

import pathlib
import re

import pytest

import wardmill.llm

MODULES = sorted(pathlib.Path(wardmill.llm.__file__).parent.glob("*.py"))


@pytest.mark.parametrize("path", MODULES, ids=lambda p: p.stem)
def test_no_row_functions_cross_joins_or_local_copies(path):
    src = path.read_text()
    assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|pandas_udf|F\.udf\b|@udf", src)
    assert not re.search(r"except (ImportError|ModuleNotFoundError)", src)


@pytest.mark.parametrize("name", ["quality_rules", "line_templates"])
def test_native_operators_run_no_python(name):
    src = next(p for p in MODULES if p.stem == name).read_text()
    assert not re.search(r"mapIn|applyIn|import (numpy|pandas|pyarrow)", src)


def test_unkeyed_windows_run_over_parts_only():
    """The only window without a key sums parts of RUN rows each."""
    found = [(p.stem, line.strip()) for p in MODULES for line in p.read_text().splitlines() if "Window.orderBy" in line or "Window.partitionBy()" in line]
    assert [m for m, _ in found] == ["mixing"] and "_part" in found[0][1]


def test_nothing_else_imports_the_subpackage():
    top = pathlib.Path(wardmill.llm.__file__).parent.parent
    for p in top.rglob("*.py"):
        if "llm" not in p.parts:
            assert "wardmill.llm" not in p.read_text(), p
