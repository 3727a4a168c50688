"""SparkSession helpers.

Week and month truncation follow the session time zone, so every job runs
with ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "productlens", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (calendar truncation depends on it)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    and Spark runs in local mode (tests, single-machine runs) a scratch
    folder is created and registered; on a cluster an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Connect session: the server owns the folder
        sc = None
    if sc is not None and not current:
        current = sc.getCheckpointDir()
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="productlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    delete_at_exit(spark, f"file://{path}")
    sc.setCheckpointDir(path)
    return path


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete the folder when the driver's JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def input_version(spark: SparkSession, sf_dir: str, tables) -> str:
    """Names, sizes and times of the tables' files, as one digest."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for t in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            for s in fs.listStatus(path):
                seen.append(f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``productlens`` importable in Python workers (``--py-files`` at runtime).

    Needed before the paths that run Python in tasks, whose functions live in
    this package. Zips the package once per
    application and registers it with ``addPyFile``, which copies it to every
    executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Connect: the package must be installed on the server side
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    from pathlib import Path

    import productlens
    pkg = Path(productlens.__file__).resolve().parent
    out = tempfile.mkdtemp(prefix="productlens-pkg-", dir=os.environ.get("TMPDIR", "/tmp"))
    archive = shutil.make_archive(os.path.join(out, "productlens"), "zip", root_dir=pkg.parent, base_dir=pkg.name)
    sc.addPyFile(archive)
    delete_at_exit(spark, f"file://{os.path.abspath(out)}")
    _SHIPPED.add(app)
