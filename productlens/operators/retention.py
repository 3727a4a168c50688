"""Retention marts.

* ``cohort_retention_weekly``: sparse weekly cohort retention by
  (signup_week, adopted_feature, week_number), week_number unbounded.
* ``baseline_engagement`` / ``engagement_tiers``: sessions in the first 7 days
  after signup for *all* users, and their tier.
* ``user_week_retention``: dense 0/1 retained flag per user for weeks 0..8.

Scale notes
-----------
Sessions are reduced per user to a bitmap of active weeks (or days): longs of
64 calendar bits each, merged by ``bit_or`` in a hash aggregate with fixed
buffers, so a heavy user contributes one small row per map task and no set of
values is ever built. The number of longs follows from the first and last day
of the data, not from its rows (beyond ``MOST_WORDS``, sets do).
That is the only shuffle of sessions, and it is already on ``user_id``, so
the joins with the one-row-per-user adoption and tier tables that follow
are co-partitioned. The interval join of the SQL formulation
(session start in [week_start, week_end)) becomes a week index computed
from the day, and the dense user x week spine is an
``explode(sequence(0, weeks))`` checked with ``array_contains`` (no cross
join, no second join). Cohort sizes come from the same aggregation as the
cells, and a window over the cells (calendar weeks only) hands them on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import MICROS_PER_DAY, engagement_tier, pct, week_start
from productlens.operators.intervals import range_join


#: longs of a bitmap: 11 years of days, 78 of weeks
MOST_WORDS = 64


def active_dates(sessions: DataFrame, day: Column, days: int, name: str) -> DataFrame:
    """(user_id, ``name``): the distinct values of ``day`` of each user's sessions, which lie ``days`` apart, as an array."""
    lo, hi = sessions.agg(F.min(day), F.max(day)).first()
    lo = lo or date(1970, 1, 1)
    count = (hi - lo).days // days + 1 if hi else 1
    place = F.floor(F.datediff(day, F.lit(lo)) / F.lit(days)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)
    words = [f"_word{i}" for i in range(-(-count // 64))]
    if len(words) > MOST_WORDS:  # some time far off: the same dates by sets, as a buffer of all the days would be too wide
        return sessions.groupBy("user_id").agg(F.array_sort(F.collect_set(day)).alias(name))
    merged = sessions.groupBy("user_id").agg(
        *[F.bit_or(F.when(F.floor(place / F.lit(64)) == i, bit)).alias(w) for i, w in enumerate(words)])
    longs = F.array(*[F.coalesce(w, F.lit(0).cast("long")) for w in words])

    def is_set(i: Column) -> Column:
        word = F.element_at(longs, F.floor(i / F.lit(64)).cast("int") + 1)
        return F.call_function("shiftright", word, i % 64).bitwiseAND(F.lit(1)) == 1

    places = F.filter(F.sequence(F.lit(0), F.lit(count - 1)), is_set)
    return merged.select("user_id", F.transform(places, lambda i: F.date_add(F.lit(lo), i * days)).alias(name))


def user_activity_weeks(sessions: DataFrame) -> DataFrame:
    """Per user, the distinct activity weeks (Mondays)."""
    return active_dates(sessions, week_start("session_start_at"), 7, "activity_weeks")


def cohort_retention_weekly(sessions: DataFrame, adoption: DataFrame) -> DataFrame:
    """Composite R-50, from the adoption mart, which holds each cohort user's signup week (R2).

    A user becomes one row for each active week number and one for the cohort
    (NULL week number), so one aggregation gives the active users and, in its
    NULL rows, the cohort sizes, which a window over those few rows hands on.
    Distinct weeks give distinct week numbers, so a count is COUNT(DISTINCT
    user_id).
    """
    weeks = F.transform("activity_weeks", lambda d: F.floor(F.datediff(d, F.col("signup_week")) / F.lit(7)).cast("int"))
    active = F.filter(F.coalesce(weeks, F.array().cast("array<int>")), lambda w: w >= 0)
    rows = (adoption.select("user_id", "signup_week", "adopted_feature")
            .join(user_activity_weeks(sessions), "user_id", "left")
            .select("signup_week", "adopted_feature",
                    F.explode(F.array_append(active, F.lit(None).cast("int"))).alias("week_number")))
    cells = rows.groupBy("signup_week", "adopted_feature", "week_number").agg(F.count(F.lit(1)).alias("active_users"))
    cohort = Window.partitionBy("signup_week", "adopted_feature")
    size = F.max(F.when(F.col("week_number").isNull(), F.col("active_users"))).over(cohort)
    return (cells.withColumn("cohort_size", size).where("week_number is not null")
            .select("signup_week", "adopted_feature", "week_number", "active_users", "cohort_size",
                    pct("active_users", "cohort_size").alias("retention_rate_pct")))


def baseline_engagement(sessions: DataFrame, users: DataFrame, days: int = config.BASELINE_DAYS) -> DataFrame:
    """Sessions starting in [signup_at, signup_at + days) per user; all users, zero-filled.

    A user's sessions start more than the gap apart, so a user has at most
    about 48 a day: the join needs no salt.
    """
    base = users.select("user_id", "signup_at")
    s = sessions.select("user_id", "session_start_at").join(base, "user_id")
    start_us, signup_us = F.unix_micros("session_start_at"), F.unix_micros("signup_at")
    s = s.filter((start_us >= signup_us) & (start_us < signup_us + F.lit(int(days) * MICROS_PER_DAY)))
    counts = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return base.join(counts, "user_id", "left").select(
        "user_id", F.coalesce(F.col("_n"), F.lit(0)).alias("sessions_first_7d"))


def sessions_by_account_week(sessions: DataFrame, users: DataFrame, weeks: int = config.RETENTION_WEEKS,
                             shift_us: int = 0) -> DataFrame:
    """Sessions and active seconds of each user in 7-day windows from ``shift_us`` after the signup, which no calendar
    week aligns with; windows without a session are left out."""
    week_us = 7 * MICROS_PER_DAY
    opens = F.unix_micros("signup_at") + F.lit(shift_us) + F.col("account_week") * F.lit(week_us)
    windows = users.select("user_id", "signup_at", F.explode(F.sequence(F.lit(0), F.lit(int(weeks)))).alias("account_week"))
    windows = windows.select("user_id", "account_week", opens.alias("_from"), (opens + F.lit(week_us)).alias("_to"))
    points = sessions.select("user_id", F.unix_micros("session_start_at").alias("_at"), "session_duration_seconds")
    return (range_join(points, windows, "_at", "_from", "_to", keys=("user_id",))
            .groupBy("user_id", "account_week")
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum("session_duration_seconds").alias("active_seconds")))


def engagement_tiers(baseline: DataFrame, tiers=config.ENGAGEMENT_TIERS) -> DataFrame:
    """R9."""
    return baseline.select("user_id", "sessions_first_7d",
                           engagement_tier("sessions_first_7d", tiers).alias("engagement_tier"))


def user_week_retention(adoption: DataFrame, tiers: DataFrame, sessions: DataFrame,
                        weeks: int = config.RETENTION_WEEKS) -> DataFrame:
    """Composite R-65: one row per (user, week_number in 0..weeks) with retained 0/1.

    Week boundaries are UTC midnights, so "session start in [signup_week + 7n,
    signup_week + 7(n+1))" is "(start date - signup_week) // 7 == n" (floor
    division: days before the signup week give negative weeks, never week 0).
    """
    days = active_dates(sessions, F.to_date("session_start_at"), 1, "_days")
    base = (adoption.select("user_id", "signup_week", "adopted_feature")
            .join(tiers.select("user_id", "engagement_tier"), "user_id")
            .join(days, "user_id", "left"))
    week_of = F.transform("_days", lambda d: F.floor(F.datediff(d, F.col("signup_week")) / F.lit(7)).cast("int"))
    active = F.filter(week_of, lambda w: (w >= 0) & (w <= int(weeks)))
    spine = base.select("user_id", "signup_week", "adopted_feature", "engagement_tier",
                        F.coalesce(active, F.array().cast("array<int>")).alias("_active"),
                        F.explode(F.sequence(F.lit(0), F.lit(int(weeks)))).alias("week_number"))
    return spine.select("user_id", "signup_week", "adopted_feature", "engagement_tier", "week_number",
                        F.array_contains("_active", F.col("week_number")).cast("int").alias("retained"))
