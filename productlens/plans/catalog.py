"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the base tables from the driver's parquet tables
(``sources.driver``), runs the jobs it needs over the whole tables and
returns a comparison-friendly projection (``checks.for_check``). Derived
tables are written once per session and shared by later queries
(``marts_for``).
"""

from __future__ import annotations

import os
import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from productlens.operators import adoption as A
from productlens.operators import clean as C
from productlens.operators import distinct_users as D
from productlens.operators import models as M
from productlens.operators import quality as Q
from productlens.operators import reports as N
from productlens.operators import retention as R
from productlens.operators import sessions as W
from productlens.plans.checks import for_check, rounded
from productlens.plans.marts import Marts
from productlens.session import ensure_utc, input_version, scratch_folder
from productlens.sources.csv import read_table, write_table
from productlens.sources.driver import OTHER_FEATURE, DriverSource
from productlens.sources.warehouse import Warehouse

_MARTS: dict[tuple[int, str, str], tuple[SparkSession, Marts]] = {}
_LOCK = threading.Lock()


def marts_for(spark: SparkSession, sf_dir: str) -> Marts:
    """The pipeline over one driver directory, shared by every query of a session.

    Like the analysed pipeline's CTAS tables, each derived table is computed
    over the whole input the first time a query needs it, written to the
    session's shared checkpoint folder (``spark.checkpoint.dir``) and read
    back by every later consumer; reports then run over the written marts.
    Changed input files start a new set; the folders go when the driver ends.
    ``PRODUCTLENS_MATERIALIZE=0`` keeps every table a lazy plan instead, so
    each query recomputes its branch from the parquet files.
    """
    ensure_utc(spark)
    key = (id(spark), sf_dir.rstrip("/"), input_version(spark, sf_dir, ("customer", "events", "orders")))
    with _LOCK:
        hit = _MARTS.get(key)
        if hit is not None and hit[0] is spark:
            return hit[1]
        return _new_marts(spark, sf_dir, key)


def _new_marts(spark: SparkSession, sf_dir: str, key) -> Marts:
    src = DriverSource(spark, sf_dir)
    store = None
    if os.environ.get("PRODUCTLENS_MATERIALIZE", "1") != "0":
        tag = re.sub(r"[^A-Za-z0-9.]+", "_", sf_dir.strip("/"))
        store = Warehouse(spark, scratch_folder(spark, f"productlens-marts-{tag}"))
    # one-step projections of cheap inputs are recomputed rather than written
    light = frozenset({"dim_user_cohorts", "mart_user_engagement_tiers"})
    m = Marts(src.tables(), rollout_days=src.rollout_days, store=store, store_skip=light)
    _MARTS[key] = (spark, m)
    return m


def _q(build: Callable[[Marts], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_check(build(marts_for(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _csv(table: str, omit: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    """A base table exported as CSV without the ``omit`` columns, loaded from the files into the raw layer, read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        root = scratch_folder(spark, "productlens-csv")
        write_table(DriverSource(spark, sf_dir).tables()[table].drop(*omit), f"{root}/{table}")
        loaded = Warehouse(spark, f"{root}/warehouse").write(read_table(spark, f"{root}/{table}", table), "raw", table)
        return for_check(loaded)
    return run


#: account weeks begin a day and a half after the signup, in the middle of a day
ACCOUNT_WEEK_SHIFT_US = 36 * 3_600_000_000


def _retention_curve(m: Marts) -> DataFrame:
    return N.retention_curve(m.mart_cohort_retention_weekly, 1, m.weeks)


def _retention_by_tier(m: Marts) -> DataFrame:
    return N.retention_by_tier(m.mart_user_week_retention, 1, 4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources (driver tables relabelled) and checks
    "raw_events": _q(lambda m: m.raw_events),
    "dim_users": _q(lambda m: m.dim_users),
    "billing_invoices": _q(lambda m: m.invoices),
    "subscriptions": _q(lambda m: m.base["fct_subscriptions"]),
    "pk_violations": _q(lambda m: Q.pk_violations(m.base)),
    "null_violations": _q(lambda m: Q.null_violations(m.base)),
    "orphan_keys": _q(lambda m: Q.orphan_keys(m.base)),
    # cleaning
    "duplicate_ids": _q(lambda m: C.duplicate_ids(m.raw_events)),
    "clean_events": _q(lambda m: m.fct_events),
    "dq_flag_counts": _q(lambda m: C.dq_flag_counts(m.fct_events)),
    # sessions
    "sessions": _q(lambda m: m.fct_sessions),
    "sessions_session_window": _q(lambda m: W.session_windows(m.fct_events)),
    # cohorts, adoption
    "user_cohorts": _q(lambda m: m.dim_user_cohorts),
    "rollout_bucket": _q(lambda m: A.rollout_buckets(m.dim_users)),
    "feature_adoption": _q(lambda m: m.fct_feature_adoption),
    "feature_adoption_no_rollout": _q(lambda m: A.feature_adoption(
        m.dim_user_cohorts, m.dim_features, m.fct_events, OTHER_FEATURE, m.rollout_days, m.initial_share)),
    # retention
    "cohort_retention_weekly": _q(lambda m: m.mart_cohort_retention_weekly),
    "cohort_retention_ordered": _q(lambda m: N.in_report_order(
        m.mart_cohort_retention_weekly, "signup_week", "adopted_feature", "week_number")),
    "sessions_by_account_week": _q(lambda m: R.sessions_by_account_week(
        m.fct_sessions, m.dim_users, m.weeks, ACCOUNT_WEEK_SHIFT_US)),
    "baseline_engagement": _q(lambda m: m.mart_user_baseline_engagement),
    "engagement_tiers": _q(lambda m: m.mart_user_engagement_tiers),
    "user_week_retention": _q(lambda m: m.mart_user_week_retention),
    # revenue
    "user_revenue_monthly": _q(lambda m: m.mart_user_revenue_monthly),
    "impact_summary": _q(lambda m: m.mart_feature_impact_summary),
    "impact_by_segment": _q(lambda m: D.rolled_up(m.mart_feature_impact_bitmaps, "industry", "adopted_feature")),
    "impact_by_month_size": _q(lambda m: D.rolled_up(m.mart_feature_impact_bitmaps, "revenue_month", "company_size")),
    "impact_total": _q(lambda m: D.rolled_up(m.mart_feature_impact_bitmaps)),
    "revenue_relative_to_adoption": _q(lambda m: m.mart_revenue_relative_to_adoption),
    # grain of every derived table (after the marts it checks)
    "grain_violations": _q(lambda m: Q.grain_violations({t: getattr(m, t) for t in Q.DERIVED_GRAINS})),
    # reports
    "adoption_funnel": _q(lambda m: N.adoption_funnel(m.fct_feature_adoption)),
    "adoption_funnel_long": _q(lambda m: N.funnel_long(N.adoption_funnel(m.fct_feature_adoption))),
    "time_to_adoption_hist": _q(lambda m: N.time_to_adoption_hist(m.fct_feature_adoption)),
    "retention_curve": _q(_retention_curve),
    "retention_by_tier": _q(_retention_by_tier),
    "revenue_around_adoption": _q(lambda m: N.revenue_around_adoption(m.mart_revenue_relative_to_adoption)),
    "adoption_rate_by_size": _q(lambda m: N.adoption_rate_by_size(m.fct_feature_adoption)),
    "retention_heatmap": _q(lambda m: N.retention_heatmap_grid(m.mart_cohort_retention_weekly)),
    "retention_heatmap_cells": _q(lambda m: N.retention_heatmap_long(m.mart_cohort_retention_weekly)),
    "activity_curve": _q(lambda m: N.activity_curve(m.mart_user_week_retention)),
    "adoption_share_by_size": _q(lambda m: N.adoption_share_by_size(m.fct_feature_adoption)),
    "adoption_rate": _q(lambda m: N.adoption_rate(m.fct_feature_adoption)),
    "retention_lift": _q(lambda m: N.retention_lift(N.retention_means(m.mart_cohort_retention_weekly, 1, m.weeks))),
    "retention_lift_by_tier": _q(lambda m: N.retention_lift_by_tier(N.tier_means(m.mart_user_week_retention, 1, 4))),
    "adoption_by_tier": _q(lambda m: N.adoption_by_tier(m.mart_user_engagement_tiers, m.fct_feature_adoption)),
    # statistical models: iterated floating point, compared to some digits
    "time_to_adoption_kde": _q(lambda m: rounded(M.time_to_adoption_kde(m.fct_feature_adoption), 9)),
    "adoption_logit": _q(lambda m: rounded(
        M.adoption_logit(m.mart_user_baseline_engagement, m.fct_feature_adoption), 6)),
    "adoption_logit_ci": _q(lambda m: rounded(
        M.adoption_logit_ci(m.mart_user_baseline_engagement, m.fct_feature_adoption), 6)),
    # base tables through CSV files and the raw layer
    "csv_raw_events": _csv("raw_events"),
    "csv_dim_users": _csv("dim_users"),
    "csv_subscriptions": _csv("fct_subscriptions"),
    "csv_billing_invoices": _csv("fct_billing_invoices"),
    "csv_dim_users_defaults": _csv("dim_users", omit=("is_internal",)),
}
