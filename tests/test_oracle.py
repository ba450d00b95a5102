"""Every query that has an SQL twin, compared with DuckDB on the small tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import verify

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="test tables not here")


@pytest.fixture(scope="module")
def con():
    return verify.connect(ROOT)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    ok, message, _, _ = verify.compare(spark, con, ROOT, name)
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
