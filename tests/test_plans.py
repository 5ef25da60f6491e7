"""Plan-level scale properties of every registered query (regression guard).

* no nested-loop or cartesian join;
* sort-based aggregates only where accepted on purpose: the baseline month on
  the monthly table (decomposition), and a global text ``min`` (no keys).
"""

import pytest

from boreflow.plans import registry_files, registry_ingest  # noqa: F401  (register their queries)
from boreflow.plans.registry import QUERIES
from tests.conftest import SF_SMALL

SORT_AGG_OK = {
    "revenue_decomposition", "decomposition_check", "gov_mask", "dq_uncastable", "dq_uncastable_monthly",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name][0](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    if name not in SORT_AGG_OK:
        assert "SortAggregate" not in plan, f"{name} plans a sort-based aggregate"


def test_plans_behind_the_stored_layers(spark):
    """The plans from the raw tables on, without any stored layer in between."""
    from boreflow.operators import measures, quality
    from boreflow.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMALL, store_silver=False)
    # as measured; broadcasts of date series come on top
    shuffles = {"fact": 11, "downtime": 7, "unusual": 25, "deferred": 35, "scd1": 6, "decomposition": 26}
    frames = {
        "fact": p.fact, "downtime": p.downtime, "unusual": quality.unusual(p.well_day),
        "deferred": measures.deferred_volume(p.well_day), "scd1": p.scd1, "decomposition": p.decomposition,
    }
    seen = {}
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        hashed = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
        seen[name] = hashed
        # a window never gathers an entity whole: it is cut by month
        assert "Exchange SinglePartition" not in plan or name in ("fact", "downtime", "decomposition"), name
    assert {n: x for n, x in seen.items() if x > shuffles[n]} == {}
