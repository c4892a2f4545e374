"""Every registered query against its SQL check, on whole tables of the smallest scale."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from check import compare, connect

import __spark_entry__ as entry
from acadmetric.catalog import load

QUERIES, CHECKS = load().QUERIES, load().CHECKS


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, small, db, name):
    assert name in CHECKS
    assert compare(QUERIES[name](spark, small), db, CHECKS[name], allow_empty=True) == ""


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["co_seq_programa", "nm_programa", "qt_producoes"]
    assert df.count() > 0


def test_queries_load_without_a_session():
    root = Path(__file__).resolve().parents[1]
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
