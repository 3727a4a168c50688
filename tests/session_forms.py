"""Another form of the sessionisation, for cross-checks: whole-user window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from productlens import config
from productlens.operators.sessions import _gap_us


def number_events_by_user(events, gap_minutes=config.SESSION_GAP_MINUTES):
    """lag + running sum over all events of a user, events without time last."""
    w = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("event_time_final"), "event_id")
    us = F.unix_micros("event_time_final")
    prev = F.lag(us).over(w)
    new = F.when(prev.isNull() | (us - prev > _gap_us(gap_minutes)), 1).otherwise(0)
    return events.withColumn("_new", new).withColumn(
        "session_number", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))


def sessions_by_user(events):
    return number_events_by_user(events).groupBy("user_id", "session_number").agg(
        F.min("event_time_final").alias("session_start_at"), F.max("event_time_final").alias("session_end_at"),
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("session_id").alias("raw_session_id_count"),
        F.sum(((F.col("event_name") == "feature_used") & (F.col("feature_name") == "team_collab")).cast("int"))
        .alias("team_collab_used"))
