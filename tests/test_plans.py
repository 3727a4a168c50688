"""Plan regression guard: shuffle counts of the key tables over written inputs (see PLANS.md)."""

import re

import pytest

from productlens.plans.catalog import marts_for
from productlens.plans.marts import Marts
from tests.conftest import SF_SMALL

# table -> most full shuffles (hash/single-partition exchanges) its own job may plan
MAX_SHUFFLES = {
    "fct_sessions": 2,
    "fct_feature_adoption": 2,
    "mart_cohort_retention_weekly": 4,
    "mart_user_week_retention": 3,
    "mart_user_baseline_engagement": 3,
    "mart_feature_impact_summary": 1,
}
INPUTS = ("fct_events", "fct_sessions", "dim_user_cohorts", "fct_feature_adoption", "monthly_revenue",
          "mart_user_revenue_monthly", "mart_user_baseline_engagement", "mart_user_engagement_tiers")


@pytest.fixture(scope="module")
def written(spark):
    m = marts_for(spark, SF_SMALL)
    return m, {name: getattr(m, name) for name in INPUTS}


@pytest.mark.parametrize("name", sorted(MAX_SHUFFLES))
def test_shuffle_budget(spark, written, name):
    m, inputs = written
    lazy = Marts(m.base, rollout_days=m.rollout_days, derived={k: v for k, v in inputs.items() if k != name})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = getattr(lazy, name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = len(re.findall(r"(?<!Reused)Exchange (?:hashpartitioning|SinglePartition)", plan))
    assert shuffles <= MAX_SHUFFLES[name], plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
