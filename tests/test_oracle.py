"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.oracles import ORACLES
from checks.queries import registered
from tests.compare import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


def test_every_query_has_an_oracle():
    assert set(registered()) == set(ORACLES)


@pytest.mark.parametrize("name", registered())
def test_query_matches_its_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
