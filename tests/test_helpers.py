from decimal import Decimal

from pyspark.sql import functions as F

from productlens.functions.columns import days_between, epoch_seconds_rounded, literal_frame, month_diff, pct
from productlens.plans.checks import for_check
from productlens.session import checkpoint_dir
from tests.conftest import ts


def test_literal_frame_is_one_partition_and_typed(spark):
    df = literal_frame(spark, [("a", "1.50", "2024-01-02 03:04:05"), ("b", None, None)],
                       "k string, amount decimal(5,2), at timestamp")
    assert df.rdd.getNumPartitions() == 1
    rows = {r["k"]: r for r in df.collect()}
    assert rows["a"]["amount"] == Decimal("1.50") and rows["b"]["at"] is None
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "decimal(5,2)", "timestamp"]


def test_checkpoint_dir_reads_the_session_setting(spark):
    path = checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark) == path


def test_exact_rounding_helpers(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00.5"), ts("2024-01-02 06:00:00"))],
                               "a timestamp, b timestamp, c timestamp")
    r = df.select(epoch_seconds_rounded("b", "a").alias("s"), epoch_seconds_rounded("a", "b").alias("neg"),
                  days_between("c", "a").alias("d"), days_between("a", "c").alias("nd"),
                  month_diff(F.lit("2024-01-01").cast("date"), F.lit("2023-11-01").cast("date")).alias("m"),
                  pct(F.lit(1), F.lit(8)).alias("p"), pct(F.lit(1), F.lit(0)).alias("p0")).collect()[0]
    assert (r["s"], r["neg"]) == (1, -1)  # half away from zero, both signs
    assert (r["d"], r["nd"]) == (Decimal("1.25"), Decimal("-1.25"))
    assert r["m"] == 2 and r["p"] == Decimal("12.50") and r["p0"] is None


def test_for_check_projection(spark):
    df = spark.createDataFrame([(ts("1970-01-01 00:00:01"), Decimal("1.10"), 3)], "t timestamp, x decimal(5,2), n int")
    out = for_check(df)
    assert out.columns == ["t_us", "x", "n"]
    assert tuple(out.collect()[0]) == (1_000_000, 1.1, 3)
