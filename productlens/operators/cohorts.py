"""User cohorts (A1): signup week (Monday) and month, segments, internal users excluded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens.functions.columns import month_start, week_start
from productlens.operators.clean import external_users

SEGMENTS = ("industry", "company_size", "country", "acquisition_channel")


def user_cohorts(users: DataFrame) -> DataFrame:
    return external_users(users).select(
        "user_id", "signup_at",
        week_start("signup_at").alias("signup_week"),
        month_start("signup_at").alias("signup_month"),
        *SEGMENTS,
        F.col("is_internal"),
    )
