"""Statistical report models.

* ``time_to_adoption_kde``: Gaussian kernel density (Scott bandwidth) of days
  from signup to adoption, evaluated on an equal-spaced grid over the data
  range and also scaled to histogram counts (density x n x bin width).
* ``adoption_logit``: logistic curve P(adopted | sessions in first 7 days),
  fitted by Newton steps on the aggregated (x, y, count) cells.
* ``adoption_logit_ci``: percentile bootstrap band of that curve, same estimator.

Scale notes
-----------
The raw observations are first reduced to distinct values with counts
(map-side partial aggregation), so the work that follows grows with the
number of distinct values, not with rows. The KDE expands each distinct
value over the fixed evaluation grid (a linear ``explode``, no join) and sums
per grid point. The bootstrap never resamples rows: a replicate reweights the
cells, is one row holding the cell arrays, and replicates are spread over
tasks with ``mapInPandas`` and fitted with a few Newton steps in numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens import config
from productlens.session import checkpoint_dir, ship_package

SQRT_2PI = math.sqrt(2.0 * math.pi)


def time_to_adoption_kde(adoption: DataFrame, grid: int = config.KDE_GRID,
                         bins: int = config.HIST_BINS) -> DataFrame:
    x = adoption.filter(F.col("adopted_feature")).select(
        F.col("days_from_signup_to_adoption").cast("double").alias("x")).filter(F.col("x").isNotNull())
    values = _reduced(x.groupBy("x").agg(F.count(F.lit(1)).alias("c")))
    stats = values.agg(F.sum("c").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                       (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("mean"))
    n = stats.select("n").scalar()
    lo, hi, mean = stats.select("lo").scalar(), stats.select("hi").scalar(), stats.select("mean").scalar()
    # Sample standard deviation (ddof=1, two-pass) and Scott's factor n^(-1/5).
    ss = values.agg(F.sum(F.col("c") * (F.col("x") - mean) * (F.col("x") - mean))).scalar()
    var = F.when(n > 1, ss / (n - 1).cast("double"))
    bw = F.sqrt(var) * F.pow(n.cast("double"), F.lit(-0.2))
    step = (hi - lo) / F.lit(float(grid - 1))
    g = values.select(F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("grid_index"), "x", "c")
    point = lo + F.col("grid_index") * step
    z = (point - F.col("x")) / bw
    dens = g.groupBy("grid_index").agg(
        F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("_s"))
    density = F.col("_s") / (n * bw * F.lit(SQRT_2PI))
    binwidth = (hi - lo) / F.lit(float(bins))
    return (dens.filter(bw > 0)
            .select("grid_index", point.alias("x"), density.alias("density"),
                    (density * n * binwidth).alias("count_scale")))


def _reduced(df: DataFrame) -> DataFrame:
    """Checkpoint a small reduced table to the session's shared checkpoint folder.

    Multi-pass steps (iterative fits, several scalar statistics) then read
    the checkpoint instead of re-running the pipeline, and a lost executor
    does not replay the lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _cells(baseline: DataFrame, adoption: DataFrame) -> DataFrame:
    """(x = sessions_first_7d, y = adopted, n) over users present in both marts."""
    j = baseline.select("user_id", "sessions_first_7d").join(
        adoption.select("user_id", "adopted_feature"), "user_id")
    return _reduced(j.groupBy(F.col("sessions_first_7d").cast("double").alias("x"),
                              F.col("adopted_feature").cast("double").alias("y")).agg(
        F.count(F.lit(1)).cast("double").alias("n")))


def _fit_logit(x: np.ndarray, y: np.ndarray, w: np.ndarray, iters: int = 50) -> tuple[float, float]:
    """Weighted logistic MLE by Newton-Raphson (2 parameters)."""
    X = np.column_stack([np.ones_like(x), x])
    beta = np.zeros(2)
    for _ in range(iters):
        eta = np.clip(X @ beta, -35, 35)
        p = 1.0 / (1.0 + np.exp(-eta))
        grad = X.T @ (w * (y - p))
        h = X.T @ (X * (w * p * (1 - p))[:, None]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, grad)
        beta = beta + step
        if np.max(np.abs(step)) < 1e-10:
            break
    return float(beta[0]), float(beta[1])


def _curves(weighted: DataFrame, points: int) -> DataFrame:
    """The fitted curve of every replicate: (rep, x, y, w) -> (rep, grid_index, x, p, intercept, coefficient).

    The grid spans the range of x over all cells. Cells are few (distinct
    session counts x 2), so a replicate is one row of arrays and one small fit.
    """
    packed = weighted.groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("x", "y", "w"))).alias("c"),
        F.min("x").alias("lo"), F.max("x").alias("hi")).select("rep", "c.x", "c.y", "c.w", "lo", "hi")

    def fit(batches):
        for pdf in batches:
            out = []
            for rep, xs, ys, ws, lo, hi in pdf.itertuples(index=False):
                a, b = _fit_logit(np.asarray(xs, float), np.asarray(ys, float), np.asarray(ws, float))
                gx = lo + np.arange(points) * (hi - lo) / (points - 1)
                p = 1.0 / (1.0 + np.exp(-np.clip(a + b * gx, -35, 35)))
                out.append(pd.DataFrame({"rep": int(rep), "grid_index": np.arange(points), "x": gx, "p": p,
                                         "intercept": a, "coefficient": b}))
            if out:
                yield pd.concat(out, ignore_index=True)

    ship_package(weighted.sparkSession)
    return packed.mapInPandas(
        fit, "rep int, grid_index int, x double, p double, intercept double, coefficient double")


def adoption_logit(baseline: DataFrame, adoption: DataFrame, points: int = config.LOGIT_GRID) -> DataFrame:
    """Logistic curve fitted to the cells weighted by their counts (the estimator of a row-level fit), on a grid
    over the observed range; no rows without cells."""
    cells = _cells(baseline, adoption).select(F.lit(0).alias("rep"), "x", "y", F.col("n").alias("w"))
    return _curves(cells, points).select("grid_index", "x", F.col("p").alias("p_adopt"), "intercept", "coefficient")


def poisson_quantile(n: float, u: np.ndarray) -> np.ndarray:
    """Smallest k whose Poisson(n) distribution function reaches u, summed from 12 standard deviations below the mean."""
    low = max(0, math.floor(n - 12 * math.sqrt(n) - 20))
    k = np.arange(low, math.ceil(n + 12 * math.sqrt(n) + 41), dtype=float)
    log_factorial = np.fromiter((math.lgamma(x + 1) for x in k), float, len(k))
    reached = np.cumsum(np.exp(k * math.log(n) - n - log_factorial))
    return low + np.minimum(np.searchsorted(reached, u), len(k) - 1).astype(float)


def replicate_weights(cells: DataFrame, reps: int) -> DataFrame:
    """Poisson bootstrap: a cell of n users weighs a Poisson(n) number in each replicate, as n resampled users would.

    The number is the quantile of 52 bits of md5(replicate, x, y), so a replicate is the same on every engine and partitioning.
    """
    each = cells.select(F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"), "x", "y", "n")
    digest = F.md5(F.concat_ws("|", F.col("rep").cast("string"), F.col("x").cast("bigint").cast("string"),
                               F.col("y").cast("bigint").cast("string")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))

    def draw(batches):
        for pdf in batches:
            w = np.zeros(len(pdf))
            for n in np.unique(pdf["n"]):
                own = (pdf["n"] == n).to_numpy()
                w[own] = poisson_quantile(n, pdf["u"].to_numpy()[own])
            yield pd.DataFrame({"rep": pdf["rep"], "x": pdf["x"], "y": pdf["y"], "w": w})

    ship_package(cells.sparkSession)
    return each.withColumn("u", u).mapInPandas(draw, "rep int, x double, y double, w double")


def adoption_logit_ci(baseline: DataFrame, adoption: DataFrame, points: int = config.LOGIT_GRID,
                      reps: int = config.BOOTSTRAP_REPS, level: float = config.CI_LEVEL) -> DataFrame:
    """Percentile bootstrap band of the logistic curve (``reps`` replicates); no rows without cells."""
    curves = _curves(replicate_weights(_cells(baseline, adoption), reps), points)
    q_lo, q_hi = (100.0 - level) / 200.0, 1.0 - (100.0 - level) / 200.0
    return curves.groupBy("grid_index").agg(
        F.first("x").alias("x"),
        F.percentile("p", F.lit(q_lo)).alias("p_low"),
        F.percentile("p", F.lit(q_hi)).alias("p_high"),
        F.count(F.lit(1)).alias("replicates"))
