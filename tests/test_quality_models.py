import math

import numpy as np
from pyspark.sql import functions as F

from productlens import schemas
from productlens.operators import models as M
from productlens.operators import quality as Q
from tests.conftest import raw_row, ts, user_row


def test_quality_checks(spark, make_users, make_raw):
    users = spark.createDataFrame(
        [user_row("a"), user_row("a"), user_row("b"), (None, ts("2024-01-01 00:00:00"), None, None, None, None, None),
         ("c", None, None, None, None, None, None)],
        "user_id string, signup_at timestamp, industry string, company_size string, country string, "
        "acquisition_channel string, is_internal boolean")
    plans = spark.createDataFrame([("free", "Free", None, False)], schemas.DIM_PLANS)
    subs = spark.createDataFrame([("s1", "a", "free", None, None, "active", None),
                                  ("s2", "zzz", "gold", None, None, "active", None),
                                  ("s3", None, None, None, None, "active", None)], schemas.FCT_SUBSCRIPTIONS)
    inv = spark.createDataFrame([], schemas.FCT_BILLING_INVOICES)
    feats = spark.createDataFrame([], schemas.DIM_FEATURES)
    raw = make_raw([raw_row("e1", "a"), raw_row("e2", "ghost"), raw_row("e3", "ghost")])
    tables = {"dim_users": users, "dim_plans": plans, "dim_features": feats, "fct_subscriptions": subs,
              "fct_billing_invoices": inv, "raw_events": raw}
    pk = {r["table_name"]: r for r in Q.pk_violations(tables).collect()}
    assert (pk["dim_users"]["rows"], pk["dim_users"]["distinct_keys"], pk["dim_users"]["duplicate_keys"],
            pk["dim_users"]["rows_with_duplicate_key"], pk["dim_users"]["null_keys"]) == (5, 3, 1, 2, 1)
    assert pk["fct_billing_invoices"]["rows"] == 0
    nv = Q.null_violations(tables).collect()[0]
    assert nv["null_rows"] == 1
    ok = {(r["table_name"], r["column_name"]): (r["orphan_rows"], r["orphan_keys"])
          for r in Q.orphan_keys(tables).collect()}
    assert ok[("fct_subscriptions", "user_id")] == (1, 1)
    assert ok[("fct_subscriptions", "plan_id")] == (1, 1)
    assert ok[("raw_events", "user_id")] == (2, 1)
    assert ok[("fct_billing_invoices", "user_id")] == (0, 0)


def _adoption_days(spark, values):
    return spark.createDataFrame([(f"u{i}", True, v) for i, v in enumerate(values)],
                                 "user_id string, adopted_feature boolean, days_from_signup_to_adoption double")


def test_kde_matches_scott_gaussian_kde(spark):
    rnd = np.random.default_rng(1)
    vals = [round(float(v), 2) for v in rnd.normal(10, 3, 400)]
    kde = M.time_to_adoption_kde(_adoption_days(spark, vals)).orderBy("grid_index").collect()
    assert len(kde) == 200
    x = np.array(vals)
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.array([r["x"] for r in kde])
    ref = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.allclose([r["density"] for r in kde], ref, rtol=1e-9)
    # the density over the data range integrates to just under 1
    area = np.trapezoid([r["density"] for r in kde], grid)
    assert 0.95 < area <= 1.0


def _baseline_adoption(spark, a_true=-2.0, b_true=0.6, n=4000, seed=5):
    rnd = np.random.default_rng(seed)
    xs = rnd.integers(0, 12, n)
    ys = rnd.random(n) < 1 / (1 + np.exp(-(a_true + b_true * xs)))
    base = spark.createDataFrame([(f"u{i}", int(x)) for i, x in enumerate(xs)], "user_id string, sessions_first_7d long")
    adopt = spark.createDataFrame([(f"u{i}", bool(y)) for i, y in enumerate(ys)], "user_id string, adopted_feature boolean")
    return base, adopt, xs.astype(float), ys.astype(float)


def test_logit_recovers_mle(spark):
    base, adopt, xs, ys = _baseline_adoption(spark)
    out = M.adoption_logit(base, adopt).orderBy("grid_index").collect()
    a, b = M._fit_logit(xs, ys, np.ones_like(xs))
    assert abs(out[0]["intercept"] - a) < 1e-6 and abs(out[0]["coefficient"] - b) < 1e-6
    assert abs(b - 0.6) < 0.1
    assert len(out) == 100 and out[0]["x"] == 0.0 and out[-1]["x"] == 11.0


def test_bootstrap_band_brackets_fit(spark):
    base, adopt, _, _ = _baseline_adoption(spark, n=1500)
    fit = {r["grid_index"]: r["p_adopt"] for r in M.adoption_logit(base, adopt).collect()}
    band = M.adoption_logit_ci(base, adopt, reps=200, points=100).collect()
    assert len(band) == 100
    for r in band:
        assert r["replicates"] == 200
        assert r["p_low"] <= fit[r["grid_index"]] <= r["p_high"]
        assert r["p_high"] - r["p_low"] < 0.5


def test_bootstrap_is_repeatable(spark):
    base, adopt, _, _ = _baseline_adoption(spark, n=500)
    a = sorted(map(tuple, M.adoption_logit_ci(base, adopt, reps=50).select("grid_index", "p_low").collect()))
    b = sorted(map(tuple, M.adoption_logit_ci(base, adopt, reps=50).select("grid_index", "p_low").collect()))
    assert a == b


def test_replicate_weights_have_the_counts_as_mean_and_variance(spark):
    for n in (1.0, 2.0, 5.0, 400.0):
        cells = spark.createDataFrame([(float(x), float(y), n) for x in range(10) for y in (0, 1)], "x double, y double, n double")
        w = M.replicate_weights(cells, 1000).agg(F.avg("w"), F.var_samp("w"), F.min("w")).collect()[0]
        # 20,000 draws: five standard errors of the mean and of the variance
        assert abs(w[0] - n) < 5 * (n / 20_000) ** 0.5 and abs(w[1] - n) < 5 * ((n + 2 * n * n) / 20_000) ** 0.5 and w[2] >= 0


def test_poisson_quantile_inverts_the_distribution_function():
    import math

    import numpy as np
    for n in (1.0, 3.0, 50.0):
        below = np.cumsum([math.exp(-n) * n ** k / math.factorial(k) for k in range(120)])
        u = np.array([1e-12, 0.01, 0.3, 0.5, 0.77, 0.99])
        assert M.poisson_quantile(n, u).tolist() == [float((below < x).sum()) for x in u]
    assert abs(M.poisson_quantile(1e9, np.array([0.5]))[0] - 1e9) <= 1


def test_models_without_rows_are_empty(spark):
    base, adopt, _, _ = _baseline_adoption(spark, n=5)
    none = base.limit(0)
    assert M.adoption_logit(none, adopt).count() == M.adoption_logit_ci(none, adopt, reps=5).count() == 0
    assert M.time_to_adoption_kde(_adoption_days(spark, [1.0]).limit(0)).count() == 0
