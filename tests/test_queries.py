from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
from medallion import session
from medallion.plans.oracles import ORACLES
from medallion.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.duck(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_contract_has_all_of_them():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = check.rows_of(df.columns, df.collect())
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == check.rows_of(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["rule", "analyzed_column", "client_id", "offender", "rule_params"]
    assert df.count() > 0


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.work_folder(spark, "x") != session.work_folder(spark, "x")
