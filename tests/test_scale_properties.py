"""Properties behind the scale design: exactness of the skew-safe paths and how they spread work."""

from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from productlens.operators import clean as C
from productlens.operators import sessions as W
from tests import session_forms
from tests.conftest import raw_row, user_row

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_time_final", T.TimestampType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("session_id", T.StringType()),
])
T0 = datetime(2024, 3, 1, 22, 0, tzinfo=timezone.utc)
GAPS = st.sampled_from([0, 1, 29 * 60, 30 * 60, 30 * 60 + 1, 45 * 60, 5 * 3600, 26 * 3600])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), GAPS), min_size=1, max_size=60))
def test_range_sessionisation_equals_whole_user_window(spark, steps):
    clock, rows = {}, []
    for i, (user, gap) in enumerate(steps):
        clock[user] = clock.get(user, T0) + timedelta(seconds=gap)
        rows.append((f"e{i:03d}", user, "page_view", clock[user], None, f"s{i % 2}"))
    events = spark.createDataFrame(rows, EVENTS)
    cols = ["user_id", "session_number", "session_start_at", "session_end_at", "event_count",
            "raw_session_id_count"]
    want = sorted(map(tuple, session_forms.sessions_by_user(events).select(cols).collect()))
    assert sorted(map(tuple, W.sessionize(events).select(cols).collect())) == want


def test_one_user_hour_is_spread_over_ranges(spark):
    # one user's single hour holds half of all events; it is one session
    hot = spark.range(30_000).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"), F.lit("hot").alias("user_id"),
        F.lit("page_view").alias("event_name"),
        F.timestamp_micros(F.lit(1_709_251_200_000_000) + F.col("id") * F.lit(3_600_000_000 // 30_000))
        .alias("event_time_final"),
        F.lit(None).cast("string").alias("feature_name"), F.concat(F.lit("s"), F.col("id") % 7).alias("session_id"))
    rest = spark.range(30_000).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("event_id"),
        F.concat(F.lit("u"), (F.col("id") % 600).cast("string")).alias("user_id"),
        F.lit("page_view").alias("event_name"),
        F.timestamp_micros(F.lit(1_709_251_200_000_000) + F.col("id") * F.lit(43_200_000)).alias("event_time_final"),
        F.lit(None).cast("string").alias("feature_name"), F.lit("s").alias("session_id"))
    events = hot.unionByName(rest)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be one task
    try:
        per_range = [r["n"] for r in W.session_pieces(events).where("user_id = 'hot'").groupBy("part")
                     .agg(F.sum("event_count").alias("n")).collect()]
        got = W.sessionize(events)
        hot_row = got.where("user_id = 'hot'").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_range) >= 4 and sum(per_range) == 30_000 and max(per_range) < 30_000 / 3
    assert [(r["session_number"], r["event_count"], r["raw_session_id_count"]) for r in hot_row] == [(1, 30_000, 7)]
    a = got.agg(F.sum("event_count"), F.max("session_number"), F.count("*")).collect()[0]
    b = session_forms.sessions_by_user(events).agg(F.sum("event_count"), F.max("session_number"), F.count("*")).collect()[0]
    assert tuple(a) == tuple(b)


def test_hot_event_id_is_combined_before_the_shuffle(spark, make_raw, make_users):
    # 5,000 copies of one id: the dedup aggregate combines them map-side
    raw = make_raw([raw_row("hot", "u1", session_id=f"s{i:05d}") for i in range(5000)] + [raw_row("x", "u1")])
    cleaned = C.clean_events(raw, make_users([user_row("u1")]))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan
    rows = {r["event_id"]: r for r in cleaned.collect()}
    assert rows["hot"]["session_id"] == "s00000" and rows["hot"]["dq_duplicate_event_id"]


def test_baseline_counts_a_hot_user(spark, make_users):
    from productlens.operators import retention as R
    base_us = 1_704_067_200_000_000  # 2024-01-01
    sessions = spark.range(6000).select(
        F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string")))
        .alias("user_id"),
        F.timestamp_micros(F.lit(base_us) + F.col("id") * F.lit(60_000_000)).alias("session_start_at"))
    users = make_users([user_row("hot", "2024-01-01 00:00:00"), user_row("none", "2024-01-01 00:00:00")]
                       + [user_row(f"u{i}", "2024-01-03 00:00:00") for i in range(50)])
    got = {r["user_id"]: r["sessions_first_7d"] for r in R.baseline_engagement(sessions, users).collect()}
    assert got["hot"] == 3000 and got["none"] == 0 and got["u1"] == 60
