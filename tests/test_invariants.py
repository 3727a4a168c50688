"""Cross-table invariants of the pipeline on the driver data (sf0.001)."""

from pyspark.sql import functions as F

from productlens.operators import reports as N
from productlens.plans.catalog import marts_for
from tests.conftest import SF_SMALL


def test_pipeline_invariants(spark):
    m = marts_for(spark, SF_SMALL)
    # every clean event lands in exactly one session
    assert m.fct_sessions.agg(F.sum("event_count")).collect()[0][0] == m.fct_events.count()
    # retention never exceeds the cohort
    assert m.mart_cohort_retention_weekly.filter(F.col("active_users") > F.col("cohort_size")).count() == 0
    # one adoption row per cohort user, and the dense spine is users x 9 weeks
    n_cohort = m.dim_user_cohorts.count()
    assert m.fct_feature_adoption.count() == n_cohort
    assert m.mart_user_week_retention.count() == n_cohort * 9
    # the revenue mart holds every billable invoice amount of cohort users, nothing else
    billable = (m.invoices.filter(F.col("status").isin("paid", "open"))
                .join(m.dim_user_cohorts.select("user_id"), "user_id", "left_semi")
                .agg(F.sum("amount_usd")).collect()[0][0])
    assert m.mart_user_revenue_monthly.agg(F.sum("revenue_usd")).collect()[0][0] == billable
    assert m.mart_feature_impact_summary.agg(F.sum("total_revenue_usd")).collect()[0][0] == billable
    # adoption shares per company size sum to one
    for r in N.adoption_share_by_size(m.fct_feature_adoption).collect():
        assert abs((r["share_adopters"] or 0.0) + (r["share_non_adopters"] or 0.0) - 1.0) < 1e-12
    # the baseline covers every user (internal included) and tiers cover the baseline
    assert m.mart_user_baseline_engagement.count() == m.dim_users.count() == m.mart_user_engagement_tiers.count()
    # dq flags are consistent: time came from exactly one source
    ev = m.fct_events
    assert ev.filter(F.col("dq_used_client_time") & F.col("dq_used_ingested_time")).count() == 0
    assert ev.filter(F.col("dq_missing_event_time")
                     != (F.col("dq_used_client_time") | F.col("dq_used_ingested_time"))).count() == 0
