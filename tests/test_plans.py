"""Plan checks over every registered batch query (static plans, AQE off so every exchange shows).

* no cross product of two unbounded sides (``CartesianProduct``);
* no Python UDF evaluation (``BatchEvalPython`` / ``ArrowEvalPython``): all work stays in the JVM;
* scans read only the columns they need (``ReadSchema`` narrower than the table for wide tables).
"""

from __future__ import annotations

import re

import pytest

from strata.plans.registry import queries
from tests.conftest import SF_SMALL

BATCH = sorted(n for n in queries() if not n.startswith("strm"))


@pytest.fixture(scope="module")
def static_spark(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", BATCH)
def test_plan_shape(static_spark, name):
    df = queries()[name](static_spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # lineitem has 11 columns; no query needs all of them
    for schema in re.findall(r"ReadSchema: struct<([^>\n]*)", plan):
        if "l_orderkey" in schema:
            assert schema.count(":") < 11, schema
