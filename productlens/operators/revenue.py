"""Revenue marts (V1-V8).

* ``user_revenue_monthly``: cohort users x billable monthly revenue, users
  never invoiced keep one row with NULL month and 0 revenue.
* ``impact_summary``: revenue, users and ARPU by month, adoption, eligibility
  and three segments.
* ``revenue_relative_to_adoption``: revenue months aligned to the adoption
  month (signed calendar-month difference).

Scale notes
-----------
Invoices are pre-aggregated to one row per (user, month) with map-side
partial sums before any join; the joins that follow are one-row-per-user
dimension joins. ``monthly_revenue`` is built once and shared by both marts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import month_diff, month_start


def monthly_revenue(invoices: DataFrame, statuses=config.BILLABLE_STATUSES) -> DataFrame:
    """V1, V2: billable revenue per (user, revenue_month)."""
    return (invoices.filter(F.col("status").isin(*statuses))
            .groupBy("user_id", month_start("invoice_period_start").alias("revenue_month"))
            .agg(F.sum("amount_usd").alias("revenue_usd")))


def user_revenue_monthly(cohorts: DataFrame, revenue: DataFrame, adoption: DataFrame) -> DataFrame:
    """V3 (composite V-60a)."""
    a = adoption.select("user_id", "adopted_feature", "feature_rollout_eligible", "first_used_at")
    return (cohorts.select("user_id", "signup_month", "industry", "company_size", "country",
                           "acquisition_channel")
            .join(revenue, "user_id", "left")
            .join(a, "user_id", "left")
            .select("user_id", "signup_month", "revenue_month",
                    F.coalesce(F.col("revenue_usd"), F.lit(0)).cast("decimal(12,2)").alias("revenue_usd"),
                    "adopted_feature", "feature_rollout_eligible", "first_used_at",
                    "industry", "company_size", "country", "acquisition_channel"))


SUMMARY_KEYS = ("revenue_month", "adopted_feature", "feature_rollout_eligible", "industry",
                "company_size", "acquisition_channel")


def impact_summary(user_revenue: DataFrame, keys=SUMMARY_KEYS) -> DataFrame:
    """V4, V5 (composite V-60b): revenue, distinct users and ARPU per segment cell.

    ``user_revenue`` is unique per (user_id, revenue_month) and revenue_month
    is a grouping key, so counting rows counts distinct users.
    """
    g = user_revenue.groupBy(*keys).agg(
        F.sum("revenue_usd").alias("total_revenue_usd"),
        F.count(F.lit(1)).alias("users"))
    return g.withColumn("arpu_usd", arpu("total_revenue_usd", "users"))


def arpu(revenue: str, users: str) -> Column:
    """V5: revenue per user in exact decimal, rounded to cents; NULL without users."""
    per_user = F.col(revenue).cast("decimal(38,10)") / F.col(users).cast("decimal(20,0)")
    return F.when(F.col(users) == 0, F.lit(None)).otherwise(F.round(per_user, 2))


def revenue_relative_to_adoption(adoption: DataFrame, revenue: DataFrame) -> DataFrame:
    """V6-V8 (composite V-62): users with invoices, months relative to adoption."""
    a = adoption.select("user_id", "adopted_feature", "feature_rollout_eligible",
                        month_start("first_used_at").alias("adoption_month"))
    j = a.join(revenue.filter(F.col("revenue_month").isNotNull()), "user_id")
    return j.select(
        "user_id", "adopted_feature", "feature_rollout_eligible", "adoption_month", "revenue_month",
        F.coalesce(F.col("revenue_usd"), F.lit(0)).cast("decimal(12,2)").alias("revenue_usd"),
        F.when(F.col("adoption_month").isNull(), F.lit(None).cast("int"))
        .otherwise(month_diff("revenue_month", "adoption_month")).alias("months_from_adoption"),
    )
