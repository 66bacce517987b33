"""The registered queries against their SQL, and the plans of the native ones."""

from __future__ import annotations

import re

import pytest

import __spark_entry__
from riskpanel.catalog.compare import differences
from riskpanel.llm.queries import oracle_sql, queries
from tests.llm.frames import SMALL

QUERIES, SQL = queries(), oracle_sql()
PYTHON = re.compile(r"EvalPython|InPandas|InArrow|PythonUDF")


def test_they_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql()) and "pipeline" not in __spark_entry__.oracle_sql()


@pytest.mark.parametrize("key", list(SQL))
def test_query_equals_sql(spark, key):
    assert differences(QUERIES[key](spark, SMALL).toArrow(), SMALL, SQL[key]) is None


@pytest.mark.parametrize("key", ["op6_source_mixing", "op9_jump_sharding", "op10_quality_rules"])
def test_native_queries_run_no_python(spark, key):
    plan = QUERIES[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not PYTHON.search(plan) and "CartesianProduct" not in plan
