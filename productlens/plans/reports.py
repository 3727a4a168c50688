"""Build every report table (the data behind each notebook chart) from written marts.

    python -m productlens.plans.reports --warehouse <pipeline output> --out <folder> [--format csv]

Reads the marts that ``plans.pipeline`` wrote, computes each report and
writes it as ``<out>/<report>``. ``to_pandas_checked`` hands a small report
to pandas/plotting code and refuses results above a row bound, so nothing
unbounded is pulled to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from productlens.operators import models as M
from productlens.operators import reports as N
from productlens.plans.marts import TABLE_LAYERS, Marts
from productlens.session import ensure_utc
from productlens.sources.warehouse import Warehouse


def report_tables(m: Marts) -> dict[str, DataFrame]:
    """Every report over a ``Marts`` (lazy or materialised)."""
    adoption, cr, uw = m.fct_feature_adoption, m.mart_cohort_retention_weekly, m.mart_user_week_retention
    curve, by_tier = N.retention_curve(cr, 1, m.weeks), N.retention_by_tier(uw, 1, 4)
    funnel = N.adoption_funnel(adoption)
    return {
        "adoption_funnel": funnel,
        "adoption_funnel_long": N.funnel_long(funnel),
        "time_to_adoption_hist": N.time_to_adoption_hist(adoption),
        "time_to_adoption_kde": M.time_to_adoption_kde(adoption),
        "retention_curve": curve,
        "retention_by_tier": by_tier,
        "revenue_around_adoption": N.revenue_around_adoption(m.mart_revenue_relative_to_adoption),
        "adoption_rate_by_size": N.adoption_rate_by_size(adoption),
        "retention_heatmap": N.retention_heatmap(cr),
        "activity_curve": N.activity_curve(uw),
        "adoption_share_by_size": N.adoption_share_by_size(adoption),
        "adoption_rate": N.adoption_rate(adoption),
        "retention_lift": N.retention_lift(curve),
        "retention_lift_by_tier": N.retention_lift_by_tier(by_tier),
        "adoption_by_tier": N.adoption_by_tier(m.mart_user_engagement_tiers, adoption),
        "adoption_logit": M.adoption_logit(m.mart_user_baseline_engagement, adoption),
        "adoption_logit_ci": M.adoption_logit_ci(m.mart_user_baseline_engagement, adoption),
    }


def marts_from_warehouse(spark: SparkSession, root: str, catalog: bool = False, **params) -> Marts:
    """A ``Marts`` whose tables are the ones a pipeline run wrote under ``root``."""
    wh = Warehouse(spark, root, catalog=catalog)
    derived = {name: wh.read(layer, name) for name, layer in TABLE_LAYERS}
    if "fct_events" in derived and "event_date" in derived["fct_events"].columns:
        derived["fct_events"] = derived["fct_events"].drop("event_date")
    return Marts({}, derived=derived, **params)


def to_pandas_checked(df: DataFrame, max_rows: int):
    """``toPandas`` of a result that the caller knows to have at most ``max_rows`` rows; fails if it has more."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it out instead of collecting it")
    return head


def run(spark: SparkSession, warehouse: str, out: str, fmt: str = "parquet", catalog: bool = False) -> list[str]:
    ensure_utc(spark)
    written = []
    for name, df in report_tables(marts_from_warehouse(spark, warehouse, catalog)).items():
        w = df.coalesce(1).write.mode("overwrite")  # every report is small (bounded by weeks/months/groups)
        (w.option("header", True).csv if fmt == "csv" else w.parquet)(f"{out.rstrip('/')}/{name}")
        written.append(name)
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--warehouse", required=True, help="output folder of plans.pipeline")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    ap.add_argument("--catalog", action="store_true")
    args = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("productlens-reports")
             .config("spark.ui.enabled", "false").getOrCreate())
    for name in run(spark, args.warehouse, args.out, args.format, args.catalog):
        print(name)


if __name__ == "__main__":
    main()
