"""Every registered query against its SQL counterpart, and free of cross joins and Python."""

import re

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from seriesframe.plans.oracle import ORACLE
from seriesframe.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_names_agree():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert differences(df, duck, entry_point.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|CartesianProduct|ArrowEval|BatchEvalPython|MapInPandas|ExistingRDD", plan)
