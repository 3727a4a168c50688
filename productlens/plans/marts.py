"""The pipeline DAG as lazily built DataFrames.

``Marts`` wires the jobs in the order of the analysed pipeline:

    raw_events, dim_users -> fct_events -> fct_sessions
    dim_users -> dim_user_cohorts -> fct_feature_adoption (+ dim_features, fct_events)
    sessions, cohorts, adoption -> mart_cohort_retention_weekly
    sessions, dim_users -> baseline engagement -> engagement tiers
    cohorts, adoption, tiers, sessions -> mart_user_week_retention
    invoices -> monthly revenue -> user revenue -> impact summary
                                -> revenue relative to adoption

Each attribute is built once per ``Marts`` object. Given a ``store``
(``sources.warehouse.Warehouse``), every derived table is written there on
first use and its consumers read the written copy, as the analysed pipeline
does with its CTAS tables: a layer shared by many reports is computed once,
lineage is cut at every table, and a lost executor reruns only the current
table's stage. Without a store the attributes stay lazy plans (each consumer
then prunes and recomputes its own branch).
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame

from productlens import config
from productlens.operators import adoption as A
from productlens.operators import clean as C
from productlens.operators import cohorts as K
from productlens.operators import distinct_users as D
from productlens.operators import retention as R
from productlens.operators import revenue as V
from productlens.operators import sessions as W


class Marts:
    def __init__(self, base: dict[str, DataFrame], *, feature: str = config.FEATURE,
                 gap_minutes: int = config.SESSION_GAP_MINUTES, rollout_days: int = config.ROLLOUT_DAYS,
                 initial_share: float = config.ROLLOUT_INITIAL_SHARE, weeks: int = config.RETENTION_WEEKS,
                 baseline_days: int = config.BASELINE_DAYS, derived: dict[str, DataFrame] | None = None,
                 store=None, store_skip: frozenset[str] = frozenset()):
        self.base = base
        self.store = store
        self.store_skip = store_skip  # tables cheaper to recompute than to write and read back
        self._lock = threading.RLock()  # one writer per table, even if queries run in threads
        self._written: dict[str, DataFrame] = {}
        self.feature, self.gap_minutes, self.rollout_days = feature, gap_minutes, rollout_days
        self.initial_share, self.weeks, self.baseline_days = initial_share, weeks, baseline_days
        for name, df in (derived or {}).items():
            self.__dict__[name] = df  # pre-materialised layer overrides the lazy build

    # base tables
    @property
    def raw_events(self) -> DataFrame:
        return self.base["raw_events"]

    @property
    def dim_users(self) -> DataFrame:
        return self.base["dim_users"]

    @property
    def dim_features(self) -> DataFrame:
        return self.base["dim_features"]

    @property
    def invoices(self) -> DataFrame:
        return self.base["fct_billing_invoices"]

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if self.store is None or name in self.store_skip:
            return df
        with self._lock:
            if name not in self._written:
                self._written[name] = self.store.write(df, LAYER_OF.get(name, "marts"), name)
            return self._written[name]

    # core
    @cached_property
    def fct_events(self) -> DataFrame:
        return self._keep("fct_events", C.clean_events(self.raw_events, self.dim_users))

    @cached_property
    def fct_sessions(self) -> DataFrame:
        return self._keep("fct_sessions", W.sessionize(self.fct_events, self.gap_minutes, self.feature))

    # marts
    @cached_property
    def dim_user_cohorts(self) -> DataFrame:
        return self._keep("dim_user_cohorts", K.user_cohorts(self.dim_users))

    @cached_property
    def fct_feature_adoption(self) -> DataFrame:
        df = A.feature_adoption(self.dim_user_cohorts, self.dim_features, self.fct_events,
                                self.feature, self.rollout_days, self.initial_share)
        return self._keep("fct_feature_adoption", df)

    @cached_property
    def mart_cohort_retention_weekly(self) -> DataFrame:
        df = R.cohort_retention_weekly(self.fct_sessions, self.fct_feature_adoption)
        return self._keep("mart_cohort_retention_weekly", df)

    @cached_property
    def mart_user_baseline_engagement(self) -> DataFrame:
        df = R.baseline_engagement(self.fct_sessions, self.dim_users, self.baseline_days)
        return self._keep("mart_user_baseline_engagement", df)

    @cached_property
    def mart_user_engagement_tiers(self) -> DataFrame:
        return self._keep("mart_user_engagement_tiers", R.engagement_tiers(self.mart_user_baseline_engagement))

    @cached_property
    def mart_user_week_retention(self) -> DataFrame:
        df = R.user_week_retention(self.fct_feature_adoption, self.mart_user_engagement_tiers,
                                   self.fct_sessions, self.weeks)
        return self._keep("mart_user_week_retention", df)

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return self._keep("monthly_revenue", V.monthly_revenue(self.invoices))

    @cached_property
    def mart_user_revenue_monthly(self) -> DataFrame:
        df = V.user_revenue_monthly(self.dim_user_cohorts, self.monthly_revenue, self.fct_feature_adoption)
        return self._keep("mart_user_revenue_monthly", df)

    @cached_property
    def mart_feature_impact_summary(self) -> DataFrame:
        return self._keep("mart_feature_impact_summary", V.impact_summary(self.mart_user_revenue_monthly))

    @cached_property
    def mart_feature_impact_bitmaps(self) -> DataFrame:
        return self._keep("mart_feature_impact_bitmaps", D.impact_bitmaps(self.mart_user_revenue_monthly))

    @cached_property
    def mart_revenue_relative_to_adoption(self) -> DataFrame:
        df = V.revenue_relative_to_adoption(self.fct_feature_adoption, self.monthly_revenue)
        return self._keep("mart_revenue_relative_to_adoption", df)


# Materialisation order (file order of the analysed pipeline) and layer of each table.
TABLE_LAYERS = (
    ("fct_events", "core"),
    ("fct_sessions", "core"),
    ("dim_user_cohorts", "marts"),
    ("fct_feature_adoption", "marts"),
    ("mart_cohort_retention_weekly", "marts"),
    ("mart_user_revenue_monthly", "marts"),
    ("mart_feature_impact_summary", "marts"),
    ("mart_revenue_relative_to_adoption", "marts"),
    ("mart_user_baseline_engagement", "marts"),
    ("mart_user_engagement_tiers", "marts"),
    ("mart_user_week_retention", "marts"),
)
LAYER_OF = dict(TABLE_LAYERS)
