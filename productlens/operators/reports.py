"""Report queries over the marts.

Each returns a small aggregated DataFrame (the data behind a chart); only
that small result ever leaves Spark. Reports the notebook sorted (retention
curve, retention by tier, revenue around adoption, activity curve) are
sorted the same way; their size is bounded by weeks/months x groups. Reshaping that the notebook did in
pandas (unpivot, pivot, cross-tab normalisation) runs in Spark here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import ratio


def adoption_funnel(adoption: DataFrame) -> DataFrame:
    """Total, eligible and adopting users (one row).

    ``fct_feature_adoption`` is one row per user, so conditional counts equal
    the COUNT(DISTINCT CASE ...) of the SQL formulation without its Expand.
    """
    return adoption.agg(
        F.count("user_id").alias("total_users"),
        F.count_if(F.col("feature_rollout_eligible")).alias("eligible_users"),
        F.count_if(F.col("adopted_feature")).alias("adopters"))


def funnel_long(funnel: DataFrame, stages=config.FUNNEL_STAGES) -> DataFrame:
    """Wide funnel -> (stage_order, stage, users)."""
    cols = ("total_users", "eligible_users", "adopters")
    renamed = funnel.select(*[F.col(c).alias(s) for c, s in zip(cols, stages)])
    long = renamed.unpivot([], list(stages), "stage", "users")
    order = F.when(F.col("stage") == stages[0], 1).when(F.col("stage") == stages[1], 2).otherwise(3)
    return long.select(order.alias("stage_order"), "stage", "users")


def time_to_adoption_hist(adoption: DataFrame, bins: int = config.HIST_BINS) -> DataFrame:
    """Equal-width histogram of days from signup to adoption over adopters.

    Bins span [min, max] (max falls in the last bin); when all values are
    equal the range is widened by 0.5 on both sides. All ``bins`` bins are
    returned, empty ones with 0. The bounds are scalar subqueries over one
    global aggregate (computed once, inlined as constants).
    """
    x = adoption.filter(F.col("adopted_feature")).select(
        F.col("days_from_signup_to_adoption").cast("double").alias("x"))
    rng = x.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    same = F.col("lo0") == F.col("hi0")
    lo = rng.select(F.when(same, F.col("lo0") - 0.5).otherwise(F.col("lo0"))).scalar()
    hi = rng.select(F.when(same, F.col("hi0") + 0.5).otherwise(F.col("hi0"))).scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int") + 1
    counts = (x.filter(F.col("x").isNotNull())
              .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("users")))
    spine = (rng.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
             .filter(lo.isNotNull()))
    return (spine.join(counts, "bin", "left")
            .select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"),
                    (lo + F.col("bin") * width).alias("bin_end"),
                    F.coalesce(F.col("users"), F.lit(0)).alias("users")))


def retention_means(cohort_retention: DataFrame, first_week: int = 1,
                    last_week: int = config.RETENTION_WEEKS) -> DataFrame:
    """Unweighted mean of cohort retention rates by (week, adopted)."""
    return (cohort_retention.filter(F.col("week_number").between(first_week, last_week))
            .groupBy("week_number", "adopted_feature")
            .agg(F.avg("retention_rate_pct").alias("retention")))


def retention_curve(cohort_retention: DataFrame, first_week: int = 1,
                    last_week: int = config.RETENTION_WEEKS) -> DataFrame:
    """The means in the report's order."""
    return retention_means(cohort_retention, first_week, last_week).orderBy("week_number", "adopted_feature")


def tier_means(user_weeks: DataFrame, first_week: int = 1, last_week: int = 4) -> DataFrame:
    """Retention % by engagement tier, adoption and week."""
    return (user_weeks.filter(F.col("week_number").between(first_week, last_week))
            .groupBy("engagement_tier", "adopted_feature", "week_number")
            .agg(F.round(F.avg(F.col("retained").cast("decimal(10,0)")) * 100, 2).alias("retention_rate_pct")))


def retention_by_tier(user_weeks: DataFrame, first_week: int = 1, last_week: int = 4) -> DataFrame:
    """The tier means in the report's order (bias control)."""
    return tier_means(user_weeks, first_week, last_week).orderBy("engagement_tier", "adopted_feature", "week_number")


def revenue_around_adoption(rel: DataFrame, before: int = 3, after: int = 3) -> DataFrame:
    """Mean monthly revenue of adopters by month relative to adoption."""
    return (rel.filter(F.col("adopted_feature") & F.col("months_from_adoption").between(-before, after))
            .groupBy("months_from_adoption").agg(F.avg("revenue_usd").alias("revenue"))
            .orderBy("months_from_adoption"))


def adoption_rate_by_size(adoption: DataFrame) -> DataFrame:
    """Share of adopters per company size (NULL sizes dropped, as a pandas groupby does)."""
    return (adoption.filter(F.col("company_size").isNotNull())
            .groupBy("company_size").agg(F.avg(F.col("adopted_feature").cast("int")).alias("adoption_rate")))


def retention_heatmap_long(cohort_retention: DataFrame) -> DataFrame:
    """N9 cells: mean retention of adopters per (signup_week, week_number)."""
    return (cohort_retention.filter(F.col("adopted_feature"))
            .groupBy("signup_week", "week_number").agg(F.avg("retention_rate_pct").alias("retention_rate_pct")))


def retention_heatmap(cohort_retention: DataFrame, weeks=None) -> DataFrame:
    """signup_week x week_number pivot of adopters' retention.

    Give ``weeks`` to pivot on known values (saves the job that discovers
    them); columns are named ``w<week>``.
    """
    cells = cohort_retention.filter(F.col("adopted_feature"))
    if weeks is None:
        weeks = sorted(r[0] for r in cells.select("week_number").distinct().collect())
    weeks = list(weeks)
    p = cells.groupBy("signup_week").pivot("week_number", weeks).agg(F.avg("retention_rate_pct"))
    return p.select("signup_week", *[F.col(str(w)).alias(f"w{w}") for w in weeks])


def retention_heatmap_grid(cohort_retention: DataFrame) -> DataFrame:
    """N9 with every week of the data, one row for each cell; cells without data are NULL."""
    cells = retention_heatmap_long(cohort_retention)
    weeks = cells.agg(F.array_sort(F.collect_set("week_number"))).scalar()  # the calendar's weeks
    grid = cells.select("signup_week").distinct().select("signup_week", F.explode(weeks).alias("week_number"))
    found = cells.withColumnRenamed("signup_week", "_cohort").withColumnRenamed("week_number", "_week")
    here = F.col("signup_week").eqNullSafe(F.col("_cohort")) & (F.col("week_number") == F.col("_week"))
    return grid.join(found, here, "left").select("signup_week", "week_number", "retention_rate_pct")


def in_report_order(df: DataFrame, *order: str) -> DataFrame:
    """A report of calendar size with the place of each row in its presentation order."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def activity_curve(user_weeks: DataFrame) -> DataFrame:
    """Share of users active per (week, adopted) over the dense user-week rows."""
    return (user_weeks.groupBy("week_number", "adopted_feature").agg(F.avg("retained").alias("retention"))
            .orderBy("week_number", "adopted_feature"))


def adoption_share_by_size(adoption: DataFrame) -> DataFrame:
    """Row-normalised cross-tab of company size x adopted (absent cell -> NULL)."""
    ct = (adoption.filter(F.col("company_size").isNotNull())
          .groupBy("company_size").pivot("adopted_feature", [False, True]).count())
    ct = ct.select("company_size", F.col("false").alias("non_adopters"), F.col("true").alias("adopters"))
    total = F.coalesce(F.col("non_adopters"), F.lit(0)) + F.coalesce(F.col("adopters"), F.lit(0))
    return ct.select("company_size", "non_adopters", "adopters",
                     ratio("non_adopters", total).alias("share_non_adopters"),
                     ratio("adopters", total).alias("share_adopters"))


def adoption_rate(adoption: DataFrame) -> DataFrame:
    """Adoption among eligible users, gated and ungated (the docs do not say which)."""
    a = adoption.agg(
        F.count_if(F.col("feature_rollout_eligible")).alias("eligible_users"),
        F.count_if(F.col("adopted_feature")).alias("adopters"),
        F.count_if(F.col("adopted_feature") & F.col("feature_rollout_eligible")).alias("eligible_adopters"))
    return a.select("eligible_users", "adopters", "eligible_adopters",
                    ratio("eligible_adopters", "eligible_users").alias("adoption_rate_eligible"),
                    ratio("adopters", "eligible_users").alias("adopters_per_eligible"))


def retention_lift(curve: DataFrame) -> DataFrame:
    """Adopters minus non-adopters, in percentage points, by week (from the means of N5)."""
    p = curve.groupBy("week_number").pivot("adopted_feature", [True, False]).agg(F.max("retention"))
    p = p.select("week_number", F.col("true").alias("retention_adopters"),
                 F.col("false").alias("retention_non_adopters"))
    return p.withColumn("lift_pp", F.col("retention_adopters") - F.col("retention_non_adopters"))


def retention_lift_by_tier(by_tier: DataFrame) -> DataFrame:
    """N15 by engagement tier (from N6)."""
    p = (by_tier.groupBy("engagement_tier", "week_number")
         .pivot("adopted_feature", [True, False]).agg(F.max("retention_rate_pct")))
    p = p.select("engagement_tier", "week_number", F.col("true").alias("retention_adopters"),
                 F.col("false").alias("retention_non_adopters"))
    return p.withColumn("lift_pp", F.col("retention_adopters") - F.col("retention_non_adopters"))


def adoption_by_tier(tiers: DataFrame, adoption: DataFrame) -> DataFrame:
    """Adoption rate by engagement tier."""
    j = tiers.select("user_id", "engagement_tier").join(adoption.select("user_id", "adopted_feature"), "user_id")
    return j.groupBy("engagement_tier").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("adopted_feature")).alias("adopters"),
        F.avg(F.col("adopted_feature").cast("int")).alias("adoption_rate"))
