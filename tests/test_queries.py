"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest
from workload.check import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


def test_status_and_trend_branches_all_occur(spark):
    from workload.gold import comparison_frame, evolution_frame

    statuses = {r[0] for r in comparison_frame(spark, FOLDER, "left").select("status_meta").distinct().collect()}
    assert statuses == {"Meta atingida", "Abaixo da meta", "Sem resultado", "Sem meta"}
    trends = {r[0] for r in evolution_frame(spark, FOLDER).select("tendencia").distinct().collect()}
    assert {"Evolução positiva", "Queda", "Sem comparação"} <= trends
