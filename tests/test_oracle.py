"""Every query that has an SQL twin gives the twin's rows."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from orderloom.plans.catalog import all_queries
from orderloom.plans.oracles import all_oracles
from tests.compare import duck, mismatch

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert all_queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_oracle(spark, connection, name):
    result = all_queries()[name](spark, FOLDER)
    assert mismatch(result, connection, all_oracles()[name]) is None


def test_flagship_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
