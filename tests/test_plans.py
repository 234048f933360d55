"""Plan lint over every registered query: no cross products or nested-loop joins
of our own, and Python UDFs only where the Arrow vectoriser is the point."""

import pytest

import __spark_entry__ as entry
from mixtape.plans import registry

# compares the bounded top-k with the engine's own product of all factors
FULL_PRODUCT = {"check_top_k"}
# queries that build sparse vectors with the Arrow pandas UDF
ARROW_UDF = {"user_vectors"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - FULL_PRODUCT))
def test_no_cross_products(spark, sf_smoke, name):
    plan = _plan(entry.queries()[name](spark, sf_smoke))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in ARROW_UDF:
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
