"""Range join against all pairs, and its plan; windows that no calendar week aligns with."""

import random
from datetime import date

from pyspark.sql import functions as F

from productlens.operators.intervals import range_join

POINTS, INTERVALS = "k string, at long, p long", "k string, lo long, hi long, i long"


def frames(spark, seed, n=300):
    rnd = random.Random(seed)
    points = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(-10**6, 10**6)]) if j % 9 == 0
               else rnd.randrange(-5000, 5000), j) for j in range(n)]
    intervals = []
    for j in range(n):
        lo = rnd.randrange(-5000, 5000)
        length = rnd.choice([0, -4, 1, 2, 3, 64, 65, 100, 3000, 10**6, 2**40])
        intervals.append((rnd.choice(["a", "b", None]), lo if j % 11 else None, lo + length, j))
    return points, intervals, spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS)


def test_range_join_equals_all_pairs(spark):
    for seed in range(2):
        points, intervals, p, i = frames(spark, seed)
        got = [(r.p, r.i) for r in range_join(p, i, "at", "lo", "hi", keys=("k",)).collect()]
        want = {(x[2], y[3]) for x in points for y in intervals
                if None not in (x[0], x[1], y[0], y[1]) and x[0] == y[0] and y[1] <= x[1] < y[2]}
        assert len(got) == len(set(got)) and set(got) == want and want
        free = range_join(p.drop("k"), i.drop("k"), "at", "lo", "hi").count()
        assert free == sum(1 for x in points for y in intervals if None not in (x[1], y[1]) and y[1] <= x[1] < y[2])


def test_range_join_of_no_rows(spark):
    _, _, p, i = frames(spark, 3, 5)
    assert range_join(p, i.limit(0), "at", "lo", "hi", keys=("k",)).count() == 0
    assert range_join(p.limit(0), i, "at", "lo", "hi", keys=("k",)).count() == 0


def test_range_join_plans_no_nested_loop(spark):
    _, _, p, i = frames(spark, 4, 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = range_join(p.drop("k"), i.drop("k"), "at", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_broadcasts_no_side(spark, tmp_path):
    # a small file whose rows become many by explode: estimated as small as the file
    spark.range(100).selectExpr("id", "'a' as k").write.parquet(str(tmp_path / "t"))
    few = spark.read.parquet(str(tmp_path / "t"))
    i = few.select("k", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("lo")).selectExpr("k", "bigint(lo) lo", "bigint(lo + 7) hi")
    joined = range_join(few.selectExpr("k", "id as at"), i, "at", "lo", "hi", keys=("k",))
    assert joined.count() == 100 * sum(1 for at in range(100) for lo in range(100) if lo <= at < lo + 7)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_account_weeks_follow_the_signup(spark, make_users):
    from datetime import timedelta

    from productlens.operators import retention as R
    from tests.conftest import ts, user_row
    start = ts("2024-01-03 00:00:00")
    at = [timedelta(hours=35, minutes=59), timedelta(hours=36), timedelta(days=8, hours=11), timedelta(days=8, hours=12),
          timedelta(days=400)]
    sessions = spark.createDataFrame([("u", start + d, 60) for d in at] + [("x", start + at[1], 60)],
                                     "user_id string, session_start_at timestamp, session_duration_seconds long")
    users = make_users([user_row("u", "2024-01-03 00:00:00"), user_row("quiet")])
    got = R.sessions_by_account_week(sessions, users, 8, 36 * 3_600_000_000).orderBy("account_week").collect()
    assert [tuple(r) for r in got] == [("u", 0, 2, 120), ("u", 1, 1, 60)]


def test_activity_bitmaps_need_no_object_aggregate(spark):
    from productlens.operators import retention as R
    days = spark.range(2000).select(
        F.concat(F.lit("u"), F.col("id") % 7).alias("user_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * F.col("id") * 47_000_000).alias("session_start_at"))
    got = R.active_dates(days, F.to_date("session_start_at"), 1, "dates")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    want = {r.user_id: sorted(r.d) for r in days.groupBy("user_id").agg(F.collect_set(F.to_date("session_start_at")).alias("d")).collect()}
    assert {r.user_id: list(r.dates) for r in got.collect()} == want and max(map(len, want.values())) > 100
    weeks = {r.user_id: list(r.activity_weeks) for r in R.user_activity_weeks(days).collect()}
    plain = days.groupBy("user_id").agg(F.array_sort(F.collect_set(F.to_date(F.date_trunc("week", "session_start_at")))).alias("w"))
    assert weeks == {r.user_id: list(r.w) for r in plain.collect()}
    assert R.user_activity_weeks(days.limit(0)).count() == 0
    far = days.union(spark.sql("select 'u1', timestamp'9999-01-01 00:00:00'"))
    want["u1"].append(date(9999, 1, 1))
    assert {r.user_id: list(r.dates) for r in R.active_dates(far, F.to_date("session_start_at"), 1, "dates").collect()} == want
