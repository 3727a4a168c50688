"""Feature eligibility and adoption (A2-A10) -> ``fct_feature_adoption``.

Eligibility follows a staggered rollout: a user first active at or after the
end of the rollout window is eligible; a user first active inside the window
is eligible when a stable per-user bucket in [0, 1) falls below the share
rolled out at that moment, ``initial + (1 - initial) * elapsed / window``;
a user never active since the rollout start is not eligible.

Scale notes
-----------
The five per-user event scans of the SQL formulation (first activity after
rollout start, first exposure, first view, first use, use count) are one
conditional ``groupBy(user_id)`` over ``fct_events``; all its aggregates are
partially aggregated map-side, so a heavy user costs one combined row per
map task. The feature row is bounded to one row by its primary key; its
rollout bounds enter as scalar subqueries (computed once, no join).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import MICROS_PER_DAY, days_between, rollout_bucket
from productlens.operators.cohorts import SEGMENTS


def feature_window(features: DataFrame, feature: str = config.FEATURE,
                   rollout_days: int = config.ROLLOUT_DAYS) -> DataFrame:
    """A2: the feature's row with ``rollout_end_at = rollout_start_at + rollout_days``."""
    end = F.timestamp_micros(F.unix_micros("rollout_start_at") + F.lit(int(rollout_days) * MICROS_PER_DAY))
    return (features.filter(F.col("feature_name") == feature)
            .select(F.col("feature_name").alias("_feature"), "launched_at", "rollout_start_at",
                    end.alias("rollout_end_at")))


def user_feature_activity(events: DataFrame, rollout_start: Column, feature: str = config.FEATURE) -> DataFrame:
    """A3, A6, A7 in one pass: per-user first activity after rollout start,
    first exposure / view / use of the feature, and number of use events."""
    ts = F.col("event_time_final")
    is_feature = F.col("feature_name") == feature

    def first(name: str):
        return F.min(F.when(is_feature & (F.col("event_name") == name), ts))

    return events.groupBy("user_id").agg(
        F.min(F.when(ts >= rollout_start, ts)).alias("first_activity_after_launch"),
        first(config.EXPOSED).alias("first_exposure_at"),
        first(config.VIEWED).alias("first_view_at"),
        first(config.USED).alias("first_used_at"),
        F.count_if(is_feature & (F.col("event_name") == config.USED)).alias("total_feature_use_events"),
    )


def eligibility_rule(first_activity: str, start: str, end: str, bucket: str,
                     initial_share: float = config.ROLLOUT_INITIAL_SHARE,
                     resolution: int = config.BUCKET_RESOLUTION):
    """A4 as exact integer arithmetic.

    ``bucket / R < s0 + (1 - s0) * e / W`` with e, W in microseconds is
    ``bucket * W < s0*R * W + (1 - s0)*R * e`` after multiplying by R*W > 0,
    so no rounding is involved (all terms fit a bigint for windows < 2.9 years).
    """
    s0 = Decimal(str(initial_share)) * resolution
    if s0 != s0.to_integral_value():
        raise ValueError("initial_share must be a multiple of 1/resolution")
    s0 = int(s0)
    e = F.unix_micros(first_activity) - F.unix_micros(start)
    w = F.unix_micros(end) - F.unix_micros(start)
    inside = F.col(bucket).cast("bigint") * w < F.lit(s0) * w + F.lit(resolution - s0) * e
    return (F.when(F.col(first_activity).isNull(), F.lit(False))
            .when(F.col(first_activity) >= F.col(end), F.lit(True))
            .otherwise(inside))


ADOPTION_COLUMNS = (
    "user_id", "signup_at", "signup_week", "signup_month", *SEGMENTS,
    "first_activity_after_launch", "feature_rollout_eligible",
    "first_exposure_at", "first_view_at", "first_used_at", "adopted_feature",
    "days_from_signup_to_adoption", "days_from_exposure_to_adoption", "total_feature_use_events",
)


def feature_adoption(cohorts: DataFrame, features: DataFrame, events: DataFrame,
                     feature: str = config.FEATURE, rollout_days: int = config.ROLLOUT_DAYS,
                     initial_share: float = config.ROLLOUT_INITIAL_SHARE,
                     resolution: int = config.BUCKET_RESOLUTION) -> DataFrame:
    """Composite A: one row per non-internal user (empty when the feature has no row)."""
    # The feature row is unique (primary key): its rollout bounds are scalar
    # subqueries, evaluated once and inlined as constants (no join). With a NULL
    # rollout start nobody is eligible; without a feature row the mart is empty.
    window = feature_window(features, feature, rollout_days)
    start = window.select("rollout_start_at").scalar()
    end = window.select("rollout_end_at").scalar()
    known = window.select(F.lit(True).alias("known")).scalar()
    activity = user_feature_activity(events, start, feature)
    base = (cohorts.select("user_id", "signup_at", "signup_week", "signup_month", *SEGMENTS,
                           start.alias("rollout_start_at"), end.alias("rollout_end_at"), known.alias("_known"))
            .filter("_known")
            .withColumn("_bucket", rollout_bucket("user_id", resolution)))
    a = base.join(activity, "user_id", "left")
    used = F.col("first_used_at")
    return a.select(
        "user_id", "signup_at", "signup_week", "signup_month", *SEGMENTS,
        "first_activity_after_launch",
        eligibility_rule("first_activity_after_launch", "rollout_start_at", "rollout_end_at", "_bucket",
                         initial_share, resolution).alias("feature_rollout_eligible"),
        "first_exposure_at", "first_view_at", "first_used_at",
        used.isNotNull().alias("adopted_feature"),
        F.when(used.isNotNull(), days_between(used, "signup_at")).alias("days_from_signup_to_adoption"),
        F.when(used.isNotNull() & F.col("first_exposure_at").isNotNull(),
               days_between(used, "first_exposure_at")).alias("days_from_exposure_to_adoption"),
        F.coalesce(F.col("total_feature_use_events"), F.lit(0)).alias("total_feature_use_events"),
    )


def rollout_buckets(users: DataFrame, resolution: int = config.BUCKET_RESOLUTION) -> DataFrame:
    """A5 on its own: the stable rollout bucket of every user."""
    return users.select("user_id", rollout_bucket("user_id", resolution).alias("rollout_bucket"))
