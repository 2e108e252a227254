"""Every registered query against its SQL in another engine."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

from proofline.plans.queries import registered  # noqa: E402

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_every_query_has_an_oracle():
    """All of the library's own; queries that are added to them may have no SQL."""
    assert set(registered()) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    problem = compare.difference(QUERIES[name](spark, sf), con, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "merchant_id", "legal_name", "capture_date", "txn_count", "gross_amount", "total_fees", "net_amount",
    ]
