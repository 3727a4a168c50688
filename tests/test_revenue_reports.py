import random
from datetime import date
from decimal import Decimal

import pytest

from productlens import schemas
from productlens.operators import cohorts as K
from productlens.operators import distinct_users as D
from productlens.operators import reports as N
from productlens.operators import revenue as V
from tests.conftest import ts, user_row

ADOPT = ("user_id string, adopted_feature boolean, feature_rollout_eligible boolean, first_used_at timestamp, "
         "company_size string, days_from_signup_to_adoption decimal(10,2)")


def invoices(spark, rows):
    full = [(f"i{i}", u, ts(start), None, Decimal(amount), None, None, status)
            for i, (u, start, amount, status) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.FCT_BILLING_INVOICES)


def adoption(spark, rows):
    return spark.createDataFrame(rows, ADOPT)


@pytest.fixture()
def revenue_inputs(spark, make_users):
    users = make_users([user_row("a"), user_row("b"), user_row("never"), user_row("int", is_internal=True)])
    inv = invoices(spark, [
        ("a", "2023-12-05 00:00:00", "10.00", "paid"),
        ("a", "2023-12-20 00:00:00", "5.50", "open"),     # two invoices in one month
        ("a", "2024-01-01 00:00:00", "7.00", "void"),     # not billable
        ("a", "2024-02-01 00:00:00", "3.00", "paid"),
        ("a", None, "1.00", "paid"),                      # NULL period -> NULL month
        ("b", "2024-01-15 00:00:00", "20.00", "paid"),
        ("int", "2024-01-15 00:00:00", "99.00", "paid"),
    ])
    adopt = adoption(spark, [
        ("a", True, True, ts("2024-01-10 00:00:00"), "1-10", Decimal("9.00")),
        ("b", False, True, None, "1-10", None),
        ("never", False, False, None, "11-50", None),
    ])
    return K.user_cohorts(users), V.monthly_revenue(inv), adopt


def test_user_revenue_monthly(revenue_inputs):
    cohorts, rev, adopt = revenue_inputs
    rows = V.user_revenue_monthly(cohorts, rev, adopt).collect()
    got = {(r["user_id"], r["revenue_month"]): r["revenue_usd"] for r in rows}
    assert got == {("a", date(2023, 12, 1)): Decimal("15.50"), ("a", date(2024, 2, 1)): Decimal("3.00"),
                   ("a", None): Decimal("1.00"), ("b", date(2024, 1, 1)): Decimal("20.00"),
                   ("never", None): Decimal("0.00")}


def test_user_numbers_have_no_gaps_and_follow_the_attributes(spark):
    rows = [(f"u{i}", "x" if i % 3 else None, i % 5) for i in range(200)] * 2 + [(None, "x", 1)]
    users = spark.createDataFrame(rows, "user_id string, industry string, size int").repartition(7)
    got = {r.user_id: r.number for r in D.numbered_users(users, ["industry", "size"]).collect()}
    assert sorted(got.values()) == list(range(200))
    attributes = {u: (a is not None, a or "", s, u) for u, a, s in rows if u}
    assert sorted(got, key=got.get) == sorted(got, key=attributes.get)


def test_any_keys_roll_up_to_exact_distinct_users(spark):
    rng = random.Random(5)
    users = [(f"u{i}", rng.choice(["a", "b", None]), rng.choice([True, False, None])) for i in range(300)] + [(None, "a", True)]
    rows = [(u, date(2024, m, 1) if m else None, Decimal(rng.randrange(9999)) / 100, a, b)
            for u, a, b in users for m in rng.sample(range(5), rng.randrange(1, 4))]
    revenue = spark.createDataFrame(rows, "user_id string, revenue_month date, revenue_usd decimal(12,2), industry string,"
                                          " adopted_feature boolean")
    bitmaps = D.impact_bitmaps(revenue, ("revenue_month", "industry", "adopted_feature")).cache()
    for keys in ((), ("industry",), ("revenue_month",), ("adopted_feature", "industry"), ("revenue_month", "adopted_feature")):
        want = {}
        for r in rows:
            cell = dict(zip(("user_id", "revenue_month", "revenue_usd", "industry", "adopted_feature"), r))
            total, who = want.setdefault(tuple(cell[k] for k in keys), (Decimal(0), set()))
            want[tuple(cell[k] for k in keys)] = (total + cell["revenue_usd"], who | {cell["user_id"]} - {None})
        got = {tuple(r[k] for k in keys): (r.total_revenue_usd, r.users) for r in D.rolled_up(bitmaps, *keys).collect()}
        assert got == {k: (t, len(w)) for k, (t, w) in want.items()}
    assert D.rolled_up(D.impact_bitmaps(revenue.limit(0), ("revenue_month", "industry")), "industry").count() == 0


def test_impact_summary_arpu(revenue_inputs, spark):
    cohorts, rev, adopt = revenue_inputs
    s = V.impact_summary(V.user_revenue_monthly(cohorts, rev, adopt), keys=("revenue_month",)).collect()
    got = {r["revenue_month"]: (r["total_revenue_usd"], r["users"], r["arpu_usd"]) for r in s}
    assert got[None] == (Decimal("1.00"), 2, Decimal("0.50"))
    assert got[date(2023, 12, 1)] == (Decimal("15.50"), 1, Decimal("15.50"))


def test_revenue_relative_to_adoption(revenue_inputs):
    cohorts, rev, adopt = revenue_inputs
    rows = V.revenue_relative_to_adoption(adopt, rev).collect()
    got = {(r["user_id"], r["revenue_month"]): r["months_from_adoption"] for r in rows}
    # Dec -> Jan across the year end is -1; NULL months and the uninvoiced user drop out
    assert got == {("a", date(2023, 12, 1)): -1, ("a", date(2024, 2, 1)): 1, ("b", date(2024, 1, 1)): None}


def test_funnel_and_rates(spark):
    a = adoption(spark, [
        ("u1", True, True, None, "1-10", Decimal("1.00")), ("u2", True, False, None, "1-10", Decimal("2.00")),
        ("u3", False, True, None, "11-50", None), ("u4", False, False, None, None, None)])
    f = N.adoption_funnel(a).collect()[0]
    assert (f["total_users"], f["eligible_users"], f["adopters"]) == (4, 2, 2)
    long = sorted(tuple(r) for r in N.funnel_long(N.adoption_funnel(a)).collect())
    assert long == [(1, "Total Users", 4), (2, "Feature Eligible", 2), (3, "Feature Adopted", 2)]
    r = N.adoption_rate(a).collect()[0]
    assert r["adoption_rate_eligible"] == 0.5 and r["adopters_per_eligible"] == 1.0
    by_size = {x["company_size"]: x["adoption_rate"] for x in N.adoption_rate_by_size(a).collect()}
    assert by_size == {"1-10": 1.0, "11-50": 0.0}
    share = {x["company_size"]: (x["share_non_adopters"], x["share_adopters"])
             for x in N.adoption_share_by_size(a).collect()}
    assert share == {"1-10": (None, 1.0), "11-50": (1.0, None)}


def test_histogram_bins(spark):
    vals = [Decimal(v) for v in ("0.00", "1.00", "2.00", "4.00", "4.00")]
    a = adoption(spark, [(f"u{i}", True, True, None, "1-10", v) for i, v in enumerate(vals)]
                 + [("z", False, True, None, "1-10", None)])
    h = {r["bin"]: r for r in N.time_to_adoption_hist(a, bins=4).collect()}
    assert [h[b]["users"] for b in (1, 2, 3, 4)] == [1, 1, 1, 2]  # max falls into the last bin
    assert (h[1]["bin_start"], h[4]["bin_end"]) == (0.0, 4.0)
    one = adoption(spark, [("u", True, True, None, "1-10", Decimal("3.00"))])
    h1 = N.time_to_adoption_hist(one, bins=2).collect()
    assert sum(r["users"] for r in h1) == 1 and min(r["bin_start"] for r in h1) == 2.5


def test_curve_lift_and_heatmap(spark):
    cr = spark.createDataFrame(
        [(date(2024, 1, 1), True, 1, Decimal("50.00")), (date(2024, 1, 8), True, 1, Decimal("25.00")),
         (date(2024, 1, 1), False, 1, Decimal("10.00")), (date(2024, 1, 1), True, 0, Decimal("100.00")),
         (date(2024, 1, 1), True, 9, Decimal("5.00"))],
        "signup_week date, adopted_feature boolean, week_number int, retention_rate_pct decimal(7,2)")
    curve = {(r["week_number"], r["adopted_feature"]): r["retention"] for r in N.retention_curve(cr).collect()}
    assert curve == {(1, True): Decimal("37.500000"), (1, False): Decimal("10.000000")}
    lift = N.retention_lift(N.retention_curve(cr)).collect()[0]
    assert lift["lift_pp"] == Decimal("27.500000")
    hm = {r["signup_week"]: r for r in N.retention_heatmap(cr, range(0, 9)).collect()}
    assert hm[date(2024, 1, 1)]["w0"] == Decimal("100.000000") and hm[date(2024, 1, 8)]["w0"] is None
    dyn = N.retention_heatmap(cr)
    assert "w9" in dyn.columns


def test_tier_reports(spark):
    uw = spark.createDataFrame(
        [("a", "0-1 sessions", True, w, 1 if w in (1, 2) else 0) for w in range(9)]
        + [("b", "0-1 sessions", False, w, 1 if w == 1 else 0) for w in range(9)]
        + [("c", "0-1 sessions", False, w, 0) for w in range(9)],
        "user_id string, engagement_tier string, adopted_feature boolean, week_number int, retained int")
    t = {(r["adopted_feature"], r["week_number"]): r["retention_rate_pct"] for r in N.retention_by_tier(uw).collect()}
    assert t[(True, 1)] == Decimal("100.00") and t[(False, 1)] == Decimal("50.00") and t[(False, 4)] == 0
    act = {(r["week_number"], r["adopted_feature"]): r["retention"] for r in N.activity_curve(uw).collect()}
    assert act[(1, False)] == 0.5 and act[(0, True)] == 0.0
    tiers = spark.createDataFrame([("a", "0-1 sessions"), ("b", "0-1 sessions"), ("x", "2-3 sessions")],
                                  "user_id string, engagement_tier string")
    ad = adoption(spark, [("a", True, True, None, "1-10", None), ("b", False, True, None, "1-10", None)])
    r = N.adoption_by_tier(tiers, ad).collect()
    assert [(x["engagement_tier"], x["users"], x["adopters"], x["adoption_rate"]) for x in r] == \
        [("0-1 sessions", 2, 1, 0.5)]
