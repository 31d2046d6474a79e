"""The coverage table names only queries and tests that exist."""

import glob
import os
import re

import __spark_entry__ as entry
from conftest import ROOT


def test_table_is_true():
    text = open(f"{ROOT}/COVERAGE.md").read()
    tests = "".join(open(f).read() for f in glob.glob(os.path.join(ROOT, "tests", "*.py")))
    column = " ".join(line.split("|")[2] for line in text.splitlines() if line.startswith("| ") and "---" not in line)
    for name in re.findall(r"`([a-z_0-9]+)`", column):
        assert name in entry.queries() or f"def {name}(" in tests, name


def test_every_query_has_an_oracle():
    own = {q for q in entry.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}  # corpus queries have tests of their own
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())
