"""Reusable column expressions."""

from productlens.functions.columns import (  # noqa: F401
    MICROS_PER_DAY,
    MICROS_PER_SECOND,
    days_between,
    engagement_tier,
    epoch_seconds_rounded,
    micros_between,
    month_diff,
    month_start,
    out_of_domain,
    pct,
    ratio,
    rollout_bucket,
    standardise,
    week_start,
)
