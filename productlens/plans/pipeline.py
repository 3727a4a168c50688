"""Run the whole pipeline and materialise every table (the production path).

Tables are written in dependency order (core before marts) and each one is
read back before its consumers are built, so a later stage never replays the
lineage of an earlier one and an executor lost in stage N only reruns stage
N's tasks. All tables of a run become visible to readers together at its end;
a run that fails leaves the tables of the run before. Base tables come either from the driver tables or from CSV
exports (``--csv-dir`` with one folder per base table).

    python -m productlens.plans.pipeline --sf-dir /root/testdata/sf0.1 --out /shared/warehouse
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from productlens import config
from productlens.plans.marts import TABLE_LAYERS, Marts
from productlens.session import ensure_utc
from productlens.sources import csv as csv_source
from productlens.sources.driver import DriverSource
from productlens.sources.warehouse import Warehouse

BASE_LAYERS = {"raw_events": "raw"}  # every other base table is a core dimension/fact
# fct_events is partitioned by event date so date-bounded readers prune files.
PARTITIONS = {"fct_events": ("event_date",)}


def load_base(wh: Warehouse, base: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """S3: full-refresh load of the base tables into raw/core."""
    with wh.publishing():
        return {name: wh.write(df, BASE_LAYERS.get(name, "core"), name) for name, df in base.items()}


def run(spark: SparkSession, base: dict[str, DataFrame], out: str, *, catalog: bool = False,
        buckets: int | None = None, tables=None, **params) -> dict[str, float]:
    """Materialise every table of ``TABLE_LAYERS`` (or the ``tables`` subset); returns seconds per table."""
    from pyspark.sql import functions as F

    ensure_utc(spark)
    wh = Warehouse(spark, out, catalog=catalog, buckets=buckets)
    timings: dict[str, float] = {}
    with wh.publishing():
        t0 = time.perf_counter()
        loaded = load_base(wh, dict(base))
        timings["base_tables"] = round(time.perf_counter() - t0, 3)
        marts = Marts(loaded, **params)
        for name, layer in TABLE_LAYERS:
            if tables and name not in tables:
                continue
            t0 = time.perf_counter()
            df = getattr(marts, name)
            parts = PARTITIONS.get(name, ())
            if "event_date" in parts:
                df = df.withColumn("event_date", F.to_date("event_time_final"))
            written = wh.write(df, layer, name, partition_by=parts)
            if "event_date" in parts:
                written = written.drop("event_date")
            marts.__dict__[name] = written  # downstream jobs read the materialised copy
            timings[name] = round(time.perf_counter() - t0, 3)
    return timings


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", help="driver parquet folder (base tables derived from it)")
    ap.add_argument("--csv-dir", help="folder with one CSV folder per base table")
    ap.add_argument("--out", required=True, help="warehouse root (shared storage)")
    ap.add_argument("--catalog", action="store_true", help="register tables in the session catalog")
    ap.add_argument("--buckets", type=int, default=None, help="bucket user-keyed tables (catalog mode)")
    ap.add_argument("--feature", default=config.FEATURE)
    args = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("productlens-pipeline")
             .config("spark.ui.enabled", "false").getOrCreate())
    params = {"feature": args.feature}
    if args.sf_dir:
        src = DriverSource(spark, args.sf_dir, args.feature)
        base = {k: src.tables()[k] for k in src.tables().keys()}
        params["rollout_days"] = src.rollout_days
    elif args.csv_dir:
        base = csv_source.read_tables(spark, args.csv_dir)
    else:
        ap.error("one of --sf-dir / --csv-dir is required")
    for k, v in run(spark, base, args.out, catalog=args.catalog, buckets=args.buckets, **params).items():
        print(f"{k}: {v:.3f}s")


if __name__ == "__main__":
    main()
