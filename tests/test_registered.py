"""Every registered query against its SQL, over whole tables of the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
# Fits run for minutes on the smallest machine; the model tests cover them.
QUERIES = [q for q in entry.queries() if q not in ("fit_predict_tfidf_lr", "train_output", "cross_validate")]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ok, note = check.compare(spark, duck, name, SF_DIR, SQL.get(name))
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["verdict_clean", "n", "weight"] and out.count() == 3
