import hashlib
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import types as T

from productlens import schemas
from productlens.operators import adoption as A
from productlens.operators import cohorts as K
from productlens.operators import retention as R
from tests.conftest import by_key, ts, user_row

EV = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_time_final", T.TimestampType()),
    T.StructField("feature_name", T.StringType()),
])
SESS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("session_key", T.StringType()),
    T.StructField("session_start_at", T.TimestampType()),
])


def bucket(uid: str) -> int:
    return int(hashlib.md5(uid.encode()).hexdigest()[:8], 16) % 10000


def features(spark, start="2024-01-08 00:00:00"):
    return spark.createDataFrame([("team_collab", ts(start), ts(start), Decimal("20.00"), None)],
                                 schemas.DIM_FEATURES)


def test_cohort_weeks_and_months(spark, make_users):
    users = make_users([
        user_row("sun", "2024-01-07 23:59:59"), user_row("mon", "2024-01-08 00:00:00"),
        user_row("ye", "2023-12-31 12:00:00"), user_row("int", is_internal=True),
        user_row("nul", "2024-01-31 23:59:59", is_internal=None)])
    c = by_key(K.user_cohorts(users).collect(), "user_id")
    assert set(c) == {"sun", "mon", "ye", "nul"}
    assert c["sun"]["signup_week"] == date(2024, 1, 1) and c["mon"]["signup_week"] == date(2024, 1, 8)
    assert c["ye"]["signup_week"] == date(2023, 12, 25) and c["ye"]["signup_month"] == date(2023, 12, 1)
    assert c["nul"]["signup_month"] == date(2024, 1, 1)


def test_rollout_bucket_matches_md5_rule(spark, make_users):
    ids = [f"u_{i}" for i in range(50)]
    users = make_users([user_row(u) for u in ids])
    got = {r["user_id"]: r["rollout_bucket"] for r in A.rollout_buckets(users).collect()}
    assert got == {u: bucket(u) for u in ids}


def _adoption(spark, make_users, events, feats=None, rollout_days=14):
    ids = sorted({e[1] for e in events} | {"idle"})
    users = make_users([user_row(u, "2024-01-05 00:00:00") for u in ids])
    cohorts = K.user_cohorts(users)
    ev = spark.createDataFrame(events, EV)
    return by_key(A.feature_adoption(cohorts, feats if feats is not None else features(spark), ev,
                                     rollout_days=rollout_days).collect(), "user_id")


def test_eligibility_edges(spark, make_users):
    # pick users by bucket so the rule is exercised on both sides
    low = next(f"u{i}" for i in range(1000) if bucket(f"u{i}") < 2000)
    high = next(f"u{i}" for i in range(1000) if bucket(f"u{i}") >= 2000)
    mid = next(f"u{i}" for i in range(1000) if 6000 <= bucket(f"u{i}") < 9000)
    start, end = datetime(2024, 1, 8, tzinfo=timezone.utc), datetime(2024, 1, 22, tzinfo=timezone.utc)
    events = [
        ("1", low, "login", start, None),                                   # at start, bucket < 0.2
        ("2", high, "login", start, None),                                  # at start, bucket >= 0.2
        ("3", "atend", "login", end, None),                                 # exactly at end
        ("4", "beforeend", "login", end - timedelta(microseconds=1), None),  # just before end
        ("5", "before", "login", start - timedelta(days=1), None),          # only before start
        ("6", mid, "login", start + (end - start) * 0.5, None),             # half way: share 0.6
    ]
    a = _adoption(spark, make_users, events)
    assert a[low]["feature_rollout_eligible"] is True
    assert a[high]["feature_rollout_eligible"] is False
    assert a["atend"]["feature_rollout_eligible"] is True
    assert a["beforeend"]["feature_rollout_eligible"] is True
    assert a["before"]["feature_rollout_eligible"] is False and a["before"]["first_activity_after_launch"] is None
    assert a["idle"]["feature_rollout_eligible"] is False
    assert a[mid]["feature_rollout_eligible"] is (bucket(mid) < 6000)


def test_no_feature_row_gives_empty_mart(spark, make_users):
    empty = features(spark).filter("feature_name = 'other'")
    a = _adoption(spark, make_users, [("1", "x", "login", ts("2024-01-09 00:00:00"), None)], feats=empty)
    assert a == {}


def test_adoption_timing(spark, make_users):
    f = "team_collab"
    events = [
        ("1", "useonly", "feature_used", ts("2024-01-06 12:00:00"), f),          # 1.5 days after signup
        ("2", "useonly", "feature_used", ts("2024-01-07 12:00:00"), f),
        ("3", "exponly", "feature_exposed", ts("2024-01-06 00:00:00"), f),
        ("4", "both", "feature_exposed", ts("2024-01-06 00:00:00"), f),
        ("5", "both", "feature_used", ts("2024-01-06 01:00:00"), f),             # 1/24 day = 0.0416.. -> 0.04
        ("6", "early", "feature_used", ts("2024-01-04 00:00:00"), f),            # before signup -> negative
        ("7", "other", "feature_used", ts("2024-01-06 00:00:00"), "other_feature"),
    ]
    a = _adoption(spark, make_users, events)
    assert a["useonly"]["adopted_feature"] and a["useonly"]["days_from_exposure_to_adoption"] is None
    assert a["useonly"]["days_from_signup_to_adoption"] == Decimal("1.50")
    assert a["useonly"]["total_feature_use_events"] == 2
    assert not a["exponly"]["adopted_feature"] and a["exponly"]["days_from_signup_to_adoption"] is None
    assert a["both"]["days_from_exposure_to_adoption"] == Decimal("0.04")
    assert a["early"]["days_from_signup_to_adoption"] == Decimal("-1.00")
    assert not a["other"]["adopted_feature"] and a["other"]["total_feature_use_events"] == 0
    assert a["idle"]["total_feature_use_events"] == 0


def _sessions(spark, rows):
    return spark.createDataFrame([(u, f"{u}_{i}", ts(t)) for i, (u, t) in enumerate(rows)], SESS)


def test_baseline_and_tiers(spark, make_users):
    users = make_users([user_row("a", "2024-01-10 12:00:00"), user_row("b", "2024-01-10 12:00:00"),
                        user_row("int", "2024-01-10 12:00:00", is_internal=True)])
    s = _sessions(spark, [("a", "2024-01-10 12:00:00"), ("a", "2024-01-10 11:59:59"),
                          ("a", "2024-01-17 12:00:00"), ("a", "2024-01-17 11:59:59"),
                          ("int", "2024-01-11 00:00:00")])
    b = by_key(R.baseline_engagement(s, users).collect(), "user_id")
    assert b["a"]["sessions_first_7d"] == 2 and b["b"]["sessions_first_7d"] == 0
    assert b["int"]["sessions_first_7d"] == 1  # baseline covers every user, internal included


def test_tier_edges(spark):
    base = spark.createDataFrame([(f"u{n}", n) for n in (0, 1, 2, 3, 4, 6, 7, 10, 11, 40, None)],
                                 "user_id string, sessions_first_7d long")
    t = {r["sessions_first_7d"]: r["engagement_tier"] for r in R.engagement_tiers(base).collect()}
    assert t == {0: "0-1 sessions", 1: "0-1 sessions", 2: "2-3 sessions", 3: "2-3 sessions", 4: "4-6 sessions",
                 6: "4-6 sessions", 7: "7-10 sessions", 10: "7-10 sessions", 11: "11+ sessions",
                 40: "11+ sessions", None: "11+ sessions"}  # NULL falls to the ELSE tier


def _retention_inputs(spark, make_users):
    # signup Wednesday 2024-01-10 -> signup_week Monday 2024-01-08
    users = make_users([user_row("a", "2024-01-10 12:00:00"), user_row("b", "2024-01-10 12:00:00"),
                        user_row("c", "2024-01-10 12:00:00")])
    adopted = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "user_id string, adopted_feature boolean")
    adoption = K.user_cohorts(users).select("user_id", "signup_week").join(adopted, "user_id")
    s = _sessions(spark, [
        ("a", "2024-01-05 10:00:00"),   # before the signup week: dropped
        ("a", "2024-01-08 00:00:00"),   # week 0 (before signup, same calendar week)
        ("a", "2024-01-21 23:59:59"),   # week 1
        ("a", "2024-01-22 00:00:00"),   # week 2
        ("a", "2024-03-11 00:00:00"),   # week 9 (beyond the dense horizon)
        ("b", "2024-01-29 08:00:00"),   # week 3 only (gap weeks)
        ("b", "2024-01-29 09:00:00"),
    ])
    return adoption, s


def test_cohort_retention_weekly(spark, make_users):
    adoption, s = _retention_inputs(spark, make_users)
    r = {(x["adopted_feature"], x["week_number"]): x for x in
         R.cohort_retention_weekly(s, adoption).collect()}
    assert sorted(r) == [(False, 3), (True, 0), (True, 1), (True, 2), (True, 9)]
    assert r[(False, 3)]["active_users"] == 1 and r[(False, 3)]["cohort_size"] == 2
    assert r[(False, 3)]["retention_rate_pct"] == Decimal("50.00")
    assert r[(True, 9)]["retention_rate_pct"] == Decimal("100.00")


def test_user_week_retention_dense(spark, make_users):
    adoption, s = _retention_inputs(spark, make_users)
    tiers = spark.createDataFrame([("a", "0-1 sessions"), ("b", "0-1 sessions"), ("c", "2-3 sessions")],
                                  "user_id string, engagement_tier string")
    rows = R.user_week_retention(adoption, tiers, s).collect()
    assert len(rows) == 3 * 9
    got = {(x["user_id"], x["week_number"]): x["retained"] for x in rows}
    assert [got[("a", w)] for w in range(9)] == [1, 1, 1, 0, 0, 0, 0, 0, 0]
    assert [got[("b", w)] for w in range(9)] == [0, 0, 0, 1, 0, 0, 0, 0, 0]
    assert sum(got[("c", w)] for w in range(9)) == 0


def test_heatmap_grid_keeps_every_week(spark, make_users):
    from productlens.operators import reports as N
    adoption, s = _retention_inputs(spark, make_users)
    grid = {r["week_number"]: r["retention_rate_pct"] for r in
            N.retention_heatmap_grid(R.cohort_retention_weekly(s, adoption)).collect()}
    assert grid == {w: Decimal("100.00") for w in (0, 1, 2, 9)}


def test_cohort_without_sessions_counts_only_in_sizes(spark, make_users):
    adoption, s = _retention_inputs(spark, make_users)
    assert R.cohort_retention_weekly(s.limit(0), adoption).count() == 0


def test_unknown_rollout_start_leaves_all_users_ineligible(spark, make_raw, make_users):
    from productlens import schemas
    from productlens.operators import clean as C
    from tests.conftest import raw_row
    users = make_users([user_row("a"), user_row("b")])
    events = C.clean_events(make_raw([raw_row("1", "a", "feature_used", feature_name="team_collab")]), users)
    features = spark.createDataFrame([("team_collab", None, None, None, None)], schemas.DIM_FEATURES)
    rows = by_key(A.feature_adoption(K.user_cohorts(users), features, events).collect(), "user_id")
    assert {u: (r["feature_rollout_eligible"], r["adopted_feature"]) for u, r in rows.items()} == {
        "a": (False, True), "b": (False, False)}
    assert rows["a"]["first_activity_after_launch"] is None and rows["a"]["total_feature_use_events"] == 1
    assert A.feature_adoption(K.user_cohorts(users), features.limit(0), events).count() == 0
