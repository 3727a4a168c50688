import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from productlens.operators import sessions as W
from tests import session_forms

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_time_final", T.TimestampType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("session_id", T.StringType()),
])
T0 = datetime(2024, 1, 1, 23, 0, 0, tzinfo=timezone.utc)


def ev(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def row(i, user, t, name="page_view", feature=None, sid="s"):
    return (f"e{i:04d}", user, name, t, feature, sid)


def sessions_by_user(df):
    return {(r["user_id"], r["session_number"]): r for r in df.collect()}


def test_gap_boundaries_durations_and_counts(spark):
    rows = [
        row(1, "a", T0),
        row(2, "a", T0 + timedelta(minutes=29, seconds=59)),          # continues
        row(3, "a", T0 + timedelta(minutes=59, seconds=59)),          # gap exactly 30:00 continues
        row(4, "a", T0 + timedelta(minutes=90, seconds=0, microseconds=1)),  # gap 30:00.000001 -> new
        row(5, "a", T0 + timedelta(minutes=90, seconds=0, microseconds=1), "feature_used", "team_collab", "s2"),
        row(6, "b", T0),                                              # single event
        row(7, "c", T0), row(8, "c", T0 + timedelta(microseconds=500_000)),  # 0.5 s rounds up to 1
        row(9, "d", T0), row(10, "d", T0 + timedelta(microseconds=499_999)),  # rounds down to 0
    ]
    s = sessions_by_user(W.sessionize(ev(spark, rows)))
    assert s[("a", 1)]["event_count"] == 3
    assert s[("a", 1)]["session_duration_seconds"] == 3599
    assert s[("a", 2)]["event_count"] == 2
    assert s[("a", 2)]["team_collab_used"] == 1 and s[("a", 2)]["used_team_collab_in_session"]
    assert s[("a", 2)]["raw_session_id_count"] == 2
    assert s[("a", 2)]["session_key"] == "a_s000002"
    assert s[("b", 1)]["event_count"] == 1 and s[("b", 1)]["session_duration_seconds"] == 0
    assert s[("c", 1)]["session_duration_seconds"] == 1
    assert s[("d", 1)]["session_duration_seconds"] == 0
    assert s[("a", 1)]["page_views"] == 3 and s[("a", 1)]["login_events"] == 0
    assert len(s) == 5


def small_ranges(spark):
    """Sorted ranges of a few events each: no coalescing, many partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")


@pytest.fixture(params=["few", "many"])
def ranges(spark, request):
    """With AQE's few ranges, and with many that cut through sessions; Arrow batches of a few rows."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    if request.param == "many":
        small_ranges(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield request.param
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_session_spanning_hours_and_ranges(spark, ranges):
    base = datetime(2024, 1, 1, 23, 30, tzinfo=timezone.utc)
    rows = [row(i, "a", base + timedelta(minutes=20 * i)) for i in range(60)]
    rows.append(row(99, "a", base + timedelta(hours=50)))
    s = sessions_by_user(W.sessionize(ev(spark, rows)))
    assert s[("a", 1)]["event_count"] == 60
    assert s[("a", 2)]["event_count"] == 1
    assert len(s) == 2


def test_borders_are_stitched():
    end = lambda user, seq, head, tail: Row(user_id=user, seq=seq, head_us=head, tail_us=tail)
    ends = [Row(part=0, first=end("a", 0, 1, 5), last=end("b", 2, 10, 20)),
            Row(part=1, first=end("b", 0, 50, 60), last=end("b", 1, 200, 200)),   # goes on with b's third session
            Row(part=3, first=end("b", 0, 400, 400), last=end("b", 0, 400, None)),  # a new one: 1-3, 4, then 5
            Row(part=4, first=end("b", 0, None, None), last=end("c", 0, 1, 2)),   # time before is unknown: a new one
            Row(part=5, first=end("d", 0, 3, 3), last=end("d", 0, 3, 3)),
            Row(part=6, first=end("d", 0, None, None), last=end("d", 3, None, None))]  # unknown gap: stays
    assert W.stitch(ends, 100) == [(1, "b", 2), (3, "b", 4), (4, "b", 5)]


def test_equal_timestamps_are_one_session_and_deterministic(spark):
    rows = [row(i, "a", T0) for i in range(5)] + [row(9, "a", T0 + timedelta(hours=2))]
    s = sessions_by_user(W.sessionize(ev(spark, rows)))
    assert s[("a", 1)]["event_count"] == 5 and s[("a", 2)]["event_count"] == 1


def _random_events(spark, n_users=12, n_events=1500, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_events):
        u = f"u{rnd.randrange(n_users)}"
        # bursts so that gaps straddle the threshold and midnight often
        t = T0 + timedelta(minutes=rnd.choice([0, 10, 29, 30, 31, 45, 200]) * rnd.randrange(60),
                           seconds=rnd.randrange(3) * 30)
        rows.append(row(i, u, t, rnd.choice(["login", "page_view", "feature_used"]), "team_collab",
                        f"s{rnd.randrange(3)}"))
    return ev(spark, rows)


def test_ranges_equal_whole_user_window(spark, ranges):
    events = _random_events(spark)
    cols = ["user_id", "session_number", "session_start_at", "session_end_at", "event_count",
            "raw_session_id_count", "team_collab_used"]
    a = sorted(map(tuple, W.sessionize(events).select(cols).collect()))
    b = sorted(map(tuple, session_forms.sessions_by_user(events).select(cols).collect()))
    assert a == b


def test_session_window_cross_check(spark):
    events = _random_events(spark, seed=11)
    cols = ["user_id", "session_start_at", "session_end_at", "event_count"]
    a = sorted(map(tuple, W.sessionize(events).select(cols).collect()))
    b = sorted(map(tuple, W.session_windows(events).select(cols).collect()))
    assert a == b


def test_session_window_keeps_events_without_time(spark):
    rows = [row(1, "a", T0), row(2, "a", T0 + timedelta(hours=2)), row(3, "a", None),       # joins the last session
            row(4, "b", None), row(5, "b", None), row(6, "b", None),                        # three sessions
            row(7, "c", T0), row(8, "c", None), row(9, "c", None), row(10, "d", T0),
            row(11, None, T0), row(12, None, None), row(13, None, None)]
    rows += [row(100 + i, "e", None) for i in range(2 * W.LOOSE_BLOCK + 1)]
    events = ev(spark, rows)
    cols = ["user_id", "session_start_at", "session_end_at", "event_count"]
    got = Counter(map(tuple, W.session_windows(events).select(cols).collect()))
    assert got == Counter(map(tuple, W.sessionize(events).select(cols).collect()))
    assert sum(n * c for (*_, n), c in got.items()) == len(rows)
    assert {k[0]: c for k, c in got.items() if k[1] is None} == {"b": 3, "c": 1, None: 1, "e": 2 * W.LOOSE_BLOCK + 1}
    random_events = _random_events(spark, seed=13).withColumn(
        "event_time_final", F.when(F.crc32("event_id") % 50 != 0, F.col("event_time_final")))
    assert (Counter(map(tuple, W.session_windows(random_events).select(cols).collect()))
            == Counter(map(tuple, W.sessionize(random_events).select(cols).collect())))


def test_only_sessions_at_a_border_are_added_up(spark, ranges):
    events = _random_events(spark, seed=17)
    pieces = W.session_pieces(events)
    whole = pieces.where("whole")
    assert whole.count() == whole.select("part", "user_id", "seq").distinct().count()
    parts, batches = pieces.select("part").distinct().count(), 1500 // (7 if ranges == "many" else 10_000) + 1
    cut = pieces.where("not whole").select("part", "user_id", "seq").distinct().count()
    assert 0 < cut <= 2 * (parts + batches)
    plan = W.sessionize(events)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    got = sorted(map(tuple, W.sessionize(events).select("user_id", "session_number", "event_count", "raw_session_id_count").collect()))
    assert got == sorted(map(tuple, session_forms.sessions_by_user(events).select(
        "user_id", "session_number", "event_count", "raw_session_id_count").collect()))


def test_event_count_invariant(spark):
    events = _random_events(spark, seed=3)
    total = W.sessionize(events).agg(F.sum("event_count")).collect()[0][0]
    assert total == events.count()


def test_counts_over_null_event_names_stay_null(spark):
    # SUM((name = 'x')::int) skips NULL names and is NULL when every name is NULL
    rows = [row(1, "a", T0, None), row(2, "a", T0 + timedelta(minutes=1), None),
            row(3, "b", T0, None), row(4, "b", T0 + timedelta(minutes=1), "login")]
    s = sessions_by_user(W.sessionize(ev(spark, rows)))
    assert s[("a", 1)]["login_events"] is None and s[("a", 1)]["event_count"] == 2
    assert s[("b", 1)]["login_events"] == 1 and s[("b", 1)]["page_views"] == 0
    assert s[("a", 1)]["used_team_collab_in_session"] is None


def test_events_without_time_come_last(spark, ranges):
    # the first has an unknown gap and stays; for the others the previous time is unknown
    rows = [row(1, "a", T0), row(2, "a", T0 + timedelta(minutes=5)), row(3, "a", None, sid="x"),
            row(4, "b", None), row(5, "b", None, sid=None), row(6, "b", None),
            row(7, "c", T0), row(8, "c", T0 + timedelta(hours=9)), row(9, "c", None), row(10, "c", None)]
    s = sessions_by_user(W.sessionize(ev(spark, rows)))
    assert {k: r["event_count"] for k, r in s.items()} == {
        ("a", 1): 3, ("b", 1): 1, ("b", 2): 1, ("b", 3): 1, ("c", 1): 1, ("c", 2): 2, ("c", 3): 1}
    assert s[("a", 1)]["raw_session_id_count"] == 2 and s[("b", 2)]["raw_session_id_count"] == 0
    assert s[("b", 1)]["session_start_at"] is None and s[("c", 2)]["session_duration_seconds"] == 0


def test_no_events(spark):
    assert W.sessionize(ev(spark, [])).count() == 0


def test_ranges_equal_whole_user_window_with_missing_times(spark, ranges):
    events = _random_events(spark, seed=5).withColumn(
        "event_time_final", F.when(F.crc32("event_id") % 50 != 0, F.col("event_time_final")))
    cols = ["user_id", "session_number", "event_count", "raw_session_id_count"]
    a = sorted(map(tuple, W.sessionize(events).select(cols).collect()))
    assert a == sorted(map(tuple, session_forms.sessions_by_user(events).select(cols).collect()))
