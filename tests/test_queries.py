"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as contract
from conftest import DATA
from tierhouse.operators import lookups, merging, numbering, star, versions
from tierhouse.workload import ORACLES as SQL
from tierhouse.workload import QUERIES

SF = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert oracle.differences(QUERIES[name](spark, SF), SQL[name], db) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 20
    assert result.columns[:4] == ["country", "category", "year", "month"]


SPLIT = ["fact_sales", "facts_without_orphans", "orphan_facts", "scd1_upsert", "scd2_apply_changes", "scd2_merge",
         "scd2_overlaps", "scd2_ranges", "star_sales", "star_sales_views"]


@pytest.mark.parametrize("name", SPLIT)
def test_query_matches_sql_without_broadcast_and_with_split_keys(spark, db, name, monkeypatch):
    """The paths for large inputs give the same rows: nothing is broadcast by size, keys are split."""
    for function in (lookups.frequent, lookups.hot_keys, numbering.next_value, numbering.neighbours, versions.version_ranges,
                     versions.range_conflicts, star.with_dimension_keys, star.sales_summary, merging.paired,
                     merging.scd1_upsert, merging.scd2_merge, merging.scd2_apply_changes):
        small = tuple(20 if d == lookups.HOT_ROWS else d for d in function.__defaults__)
        assert 20 in small
        monkeypatch.setattr(function, "__defaults__", small)
    for function in (lookups.lookup, lookups.lookup_all):
        small = tuple(20 if d is None else d for d in function.__defaults__)
        monkeypatch.setattr(function, "__defaults__", small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert oracle.differences(QUERIES[name](spark, SF), SQL[name], db) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
