import csv
import io
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from productlens.plans import pipeline
from productlens.plans.catalog import marts_for
from productlens.plans.marts import TABLE_LAYERS, Marts
from productlens.sources import csv as csv_source
from productlens.sources.driver import DriverSource
from productlens.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL, raw_row


def test_csv_roundtrip_json_cells_and_header_mapping(spark, make_raw, tmp_path):
    raw = make_raw([
        raw_row("e1", "u1", properties_json='{"screen":"app, main","client_event_time":"2024-01-02T00:00:00"}'),
        raw_row("e2", "u2", event_time=None, device_type=None, properties_json=None),
    ])
    # columns in another order and ingested_at omitted: mapped by name, default filled
    src = raw.select("properties_json", "country", "device_type", "session_id", "feature_name", "event_time",
                     "event_name", "user_id", "event_id")
    path = str(tmp_path / "raw_events")
    csv_source.write_table(src, path)
    load_ts = datetime(2024, 2, 1, tzinfo=timezone.utc)
    back = {r["event_id"]: r for r in csv_source.read_table(spark, path, "raw_events", load_ts).collect()}
    assert back["e1"]["properties_json"] == '{"screen":"app, main","client_event_time":"2024-01-02T00:00:00"}'
    assert back["e2"]["properties_json"] is None and back["e2"]["device_type"] is None
    assert back["e2"]["event_time"] is None
    assert back["e1"]["ingested_at"].replace(tzinfo=timezone.utc) == load_ts
    fails = csv_source.count_cast_failures(spark, path, "raw_events").collect()[0]
    assert fails["event_time"] == 0


def test_csv_bad_values_become_null_and_are_counted(spark, tmp_path):
    path = tmp_path / "dim_users"
    path.mkdir()
    (path / "part-0.csv").write_text(
        "user_id,signup_at,is_internal\nu1,2024-01-01 00:00:00,False\nu2,not-a-date,\nu3,2024-01-02 00:00:00,True\n")
    users = {r["user_id"]: r for r in csv_source.read_table(spark, str(path), "dim_users").collect()}
    assert users["u2"]["signup_at"] is None and users["u2"]["is_internal"] is None  # explicit empty stays NULL
    assert users["u3"]["is_internal"] is True and users["u1"]["industry"] is None
    assert csv_source.count_cast_failures(spark, str(path), "dim_users").collect()[0]["signup_at"] == 1


def test_pipeline_materialises_same_results(spark, tmp_path):
    src = DriverSource(spark, SF_SMALL)
    base = {k: src.tables()[k] for k in src.tables().keys()}
    timings = pipeline.run(spark, base, str(tmp_path / "wh"), rollout_days=src.rollout_days)
    assert set(timings) == {"base_tables"} | {n for n, _ in TABLE_LAYERS}
    lazy = marts_for(spark, SF_SMALL)
    for name, layer in TABLE_LAYERS:
        written = Warehouse(spark, str(tmp_path / "wh")).read(layer, name)
        if name == "fct_events":
            written = written.drop("event_date")
        cols = [c for c in getattr(lazy, name).columns]
        a = getattr(lazy, name).select(cols).exceptAll(written.select(cols)).count()
        b = written.select(cols).exceptAll(getattr(lazy, name).select(cols)).count()
        assert (a, b) == (0, 0), name
    # fct_events is partitioned by event date
    folder = Path(Warehouse(spark, str(tmp_path / "wh")).path("core", "fct_events"))
    assert any(p.name.startswith("event_date=") for p in folder.iterdir())


def test_marts_accepts_materialised_layers(spark):
    lazy = marts_for(spark, SF_SMALL)
    m = Marts(lazy.base, rollout_days=lazy.rollout_days, derived={"fct_events": lazy.fct_events.limit(0)})
    assert m.fct_sessions.count() == 0
    assert F is not None


def test_catalog_mode_buckets_user_tables(spark, tmp_path):
    from productlens.sources.warehouse import Warehouse
    wh = Warehouse(spark, str(tmp_path / "cat"), catalog=True, buckets=4)
    m = marts_for(spark, SF_SMALL)
    sessions = wh.write(m.fct_sessions, "core", "fct_sessions")
    adoption = wh.write(m.fct_feature_adoption, "marts", "fct_feature_adoption")
    assert sessions.count() == m.fct_sessions.count()
    name = wh.table_name("core", "fct_sessions")
    desc = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert spark.table("core.fct_sessions").count() == sessions.count()
    assert "Bucket Columns" in desc and "user_id" in desc["Bucket Columns"]
    # a join of two tables bucketed the same way on user_id needs no shuffle
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = sessions.join(adoption, "user_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        j.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan


def test_export_and_reload_base_tables(spark, tmp_path):
    src = DriverSource(spark, SF_SMALL)
    base = {k: src.tables()[k] for k in src.tables().keys()}
    csv_source.write_tables(base, str(tmp_path / "csv"))
    back = csv_source.read_tables(spark, str(tmp_path / "csv"))
    for name, df in base.items():
        assert df.exceptAll(back[name].select(df.columns)).count() == 0, name
        assert back[name].exceptAll(df).count() == 0, name


def test_reports_from_written_warehouse(spark, tmp_path):
    import pytest

    from productlens.plans import reports
    src = DriverSource(spark, SF_SMALL)
    base = {k: src.tables()[k] for k in src.tables().keys()}
    pipeline.run(spark, base, str(tmp_path / "wh"), rollout_days=src.rollout_days)
    names = reports.run(spark, str(tmp_path / "wh"), str(tmp_path / "rep"))
    assert len(names) == 17
    lazy = marts_for(spark, SF_SMALL)
    got = spark.read.parquet(str(tmp_path / "rep" / "retention_curve"))
    want = reports.report_tables(lazy)["retention_curve"]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    small = reports.to_pandas_checked(reports.report_tables(lazy)["adoption_funnel_long"], max_rows=3)
    assert list(small["stage"]) == ["Total Users", "Feature Eligible", "Feature Adopted"]
    with pytest.raises(ValueError):
        reports.to_pandas_checked(lazy.fct_events, max_rows=10)


def test_catalog_pipeline_answers_sql_on_schema_qualified_marts(spark, tmp_path):
    from decimal import Decimal

    from productlens.operators import reports as N
    src = DriverSource(spark, SF_SMALL)
    base = {k: src.tables()[k] for k in src.tables().keys()}
    pipeline.run(spark, base, str(tmp_path / "catwh"), catalog=True, rollout_days=src.rollout_days)
    got = spark.sql("""
        SELECT week_number, adopted_feature, AVG(retention_rate_pct) AS retention
        FROM marts.mart_cohort_retention_weekly
        WHERE week_number BETWEEN 1 AND 8
        GROUP BY 1, 2""")
    want = N.retention_curve(spark.table("marts.mart_cohort_retention_weekly"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # PostgreSQL-style casts run as written
    row = spark.sql("""
        SELECT ROUND(100.0 * AVG(retained)::numeric, 2) AS pct, COUNT(DISTINCT user_id)::bigint AS users
        FROM marts.mart_user_week_retention WHERE week_number = 0""").collect()[0]
    assert isinstance(row["pct"], Decimal) and row["users"] == spark.table("marts.dim_user_cohorts").count()
    assert spark.table("core.fct_events").count() == spark.table("core.fct_sessions").agg(
        F.sum("event_count")).collect()[0][0]


def test_pipeline_cli_from_csv_exports(spark, tmp_path):
    from productlens.plans.marts import TABLE_LAYERS as LAYERS
    src = DriverSource(spark, SF_SMALL)
    base = {k: src.tables()[k] for k in src.tables().keys()}
    csv_source.write_tables(base, str(tmp_path / "csv"))
    pipeline.main(["--csv-dir", str(tmp_path / "csv"), "--out", str(tmp_path / "wh")])
    # the CSV run uses the default 42-day rollout; compare against the same parameters
    lazy = Marts(base)
    for name, layer in LAYERS:
        got = Warehouse(spark, str(tmp_path / "wh")).read(layer, name)
        want = getattr(lazy, name)
        cols = want.columns
        assert got.select(cols).exceptAll(want).count() == 0, name
        assert want.exceptAll(got.select(cols)).count() == 0, name


def test_csv_files_with_another_header_fail(spark, tmp_path):
    folder = tmp_path / "plans"
    folder.mkdir()
    (folder / "a.csv").write_text("plan_id,plan_name\npro,Pro\n")
    (folder / "b.csv").write_text("plan_name,plan_id\nFree,free\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_source.read_table(spark, str(folder), "dim_plans").collect()


def test_csv_cells_keep_line_breaks(spark, tmp_path):
    folder = tmp_path / "features"
    folder.mkdir()
    (folder / "a.csv").write_text('feature_name,notes\nteam_collab,"line one\nline ""two"""\nother,x\n')
    rows = {r["feature_name"]: r["notes"] for r in csv_source.read_table(spark, str(folder), "dim_features").collect()}
    assert rows == {"team_collab": 'line one\nline "two"', "other": "x"}


def test_partitioned_write_makes_few_files(spark, tmp_path):
    days = spark.range(0, 4000, numPartitions=16).withColumn("event_date", (F.col("id") % 10).cast("string"))
    Warehouse(spark, str(tmp_path)).write(days.repartition(16, "id"), "core", "t", partition_by=("event_date",))
    assert len(list((tmp_path / "core" / "t").rglob("*.parquet"))) <= 20


def test_failed_write_is_never_seen(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write(spark.range(3), "core", "t")
    failing = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        wh.write(failing, "core", "t")
    assert Warehouse(spark, str(tmp_path)).read("core", "t").count() == 3
    with pytest.raises(LookupError):
        wh.read("core", "other")


def test_tables_of_a_block_appear_together(spark, tmp_path):
    wh, reader = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    wh.write(spark.range(1), "core", "a")
    old = reader.pinned()
    with wh.publishing():
        wh.write(spark.range(2), "core", "a")
        wh.write(spark.range(2), "marts", "b")
        assert wh.read("core", "a").count() == 2 and reader.read("core", "a").count() == 1
    assert reader.read("core", "a").count() == 2 and reader.read("marts", "b").count() == 2
    assert old.read("core", "a").count() == 1
    with pytest.raises(RuntimeError):
        with wh.publishing():
            wh.write(spark.range(5), "core", "a")
            raise RuntimeError("later table failed")
    assert reader.read("core", "a").count() == 2
    # two writers: the later one starts from the other's manifest
    Warehouse(spark, str(tmp_path)).write(spark.range(7), "raw", "c")
    wh.write(spark.range(3), "core", "a")
    assert [reader.read(*t).count() for t in (("core", "a"), ("marts", "b"), ("raw", "c"))] == [3, 2, 7]


def test_vacuum_keeps_what_readers_may_hold(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    for n in (1, 2, 3):
        wh.write(spark.range(n), "core", "t")
    assert wh.vacuum(hours=1) == []
    gone = wh.vacuum(hours=-1)  # as if an hour had passed
    assert len(gone) == 2 and wh.read("core", "t").count() == 3
    assert len(list((tmp_path / "core" / "t").iterdir())) == 1
    assert [p.name for p in (tmp_path / "_manifests").glob("0*.json")] == ["00000003.json"]


@pytest.fixture()
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def quoted_file(seed, rows, breaks=("\n", "\r\n", '"', '""', ",", "x", "é", "", " ", "\n\n")):
    rnd = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"]))
    writer.writerow(["feature_name", "notes"])
    want = []
    for i in range(rows):
        cell = "".join(rnd.choice(breaks) for _ in range(rnd.randrange(12)))
        if rnd.random() < 0.05:
            cell = "a\nb" * 500  # longer than a range
        want.append((f"f{i}", cell or None))
        writer.writerow([f"f{i}", cell])
    return out.getvalue(), want


@pytest.mark.parametrize("seed", range(4))
def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path, small_splits, seed):
    folder = tmp_path / "features"
    folder.mkdir()
    text, want = quoted_file(seed, 120)
    (folder / "a.csv").write_text(text, newline="", encoding="utf-8")
    df = csv_source.read_text(spark, str(folder))
    assert df.rdd.getNumPartitions() > 4
    assert sorted((r["feature_name"], r["notes"]) for r in df.collect()) == sorted(want)
    # one task for the whole file gives the same, but for line breaks in cells, which that reader normalises
    unix = F.regexp_replace("notes", "\r\n?", "\n").alias("notes")
    whole = spark.read.options(**csv_source.CSV_OPTIONS).csv(str(folder)).select("feature_name", unix)
    assert df.select("feature_name", unix).exceptAll(whole).count() == 0 and whole.count() == len(want)


def test_files_with_a_lone_quote_are_read_whole(spark, tmp_path, small_splits):
    folder = tmp_path / "features"
    folder.mkdir()
    text, want = quoted_file(9, 60)
    (folder / "a.csv").write_text(text, newline="", encoding="utf-8")
    (folder / "b.csv").write_text('feature_name,notes\ng1,5" pipe\ng2,plain\n')
    (folder / "c.csv").write_text('\ufefffeature_name,notes\r\n\r\nh1,"last\r\nline"')
    got = {(r["feature_name"], r["notes"]) for r in csv_source.read_text(spark, str(folder)).collect()}
    assert got == {*want, ("g1", '5" pipe'), ("g2", "plain"), ("h1", "last\r\nline")}


def test_range_states():
    states, odd = csv_source.range_states([("a", 0, 1), ("a", 10, 0), ("a", 20, 2), ("a", 30, 1), ("b", 0, 0), ("c", 0, 3)])
    assert states == {("a", 0): (False, 0), ("a", 10): (True, 0), ("a", 20): (True, 0), ("a", 30): (True, 20),
                      ("b", 0): (False, 0), ("c", 0): (False, 0)} and odd == ["c"]


def test_empty_csv_folder_gives_no_rows(spark, tmp_path):
    folder = tmp_path / "features"
    folder.mkdir()
    (folder / "a.csv").write_text("feature_name,notes\n")
    assert csv_source.read_table(spark, str(folder), "dim_features").count() == 0
