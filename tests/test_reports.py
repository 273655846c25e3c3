"""Every registered report against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences
from tidemark.plans.registry import load_all

QUERIES, ORACLES = load_all()


def test_every_report_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report(spark, folder, name):
    assert differences(spark, folder, name, QUERIES, ORACLES) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
