"""Registered queries of the subpackage against their SQL."""

import oracle
import pytest
from conftest import DATA

from tierhouse.llm import queries  # noqa: F401
from tierhouse.llm.registry import ORACLES, QUERIES

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    assert oracle.differences(QUERIES[name](spark, SF), ORACLES[name], db) == []
