"""Spark session and shared-folder helpers.

Library code never creates a session behind the user's back: every
operator takes DataFrames and returns DataFrames.  ``get_spark`` is for
tests, ``bench.py`` and local use.  Scratch space for written tables and
streaming checkpoints always comes from ``spark.checkpoint.dir`` (the
shared folder a cluster names); only when that is unset, as in tests, do
we point it at a fresh local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cores: int | str = "*", app: str = "embedflow", shuffle_partitions: int | None = None) -> SparkSession:
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; unset, a local folder on a local master, an error on a cluster."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="embedflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``embedflow`` importable in Python workers (as ``--py-files`` would), once per context.

    Arrow UDF functions are pickled by reference to their module, so workers
    must be able to import the package even when the driver's working
    directory is elsewhere.  The zip goes to the shared checkpoint folder
    when that is a plain path, else to a driver-local file that Spark ships.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    local = base.startswith("/") or base.startswith("file:")
    folder = base.replace("file:", "", 1) if local else tempfile.mkdtemp(prefix="embedflow-pkg-")
    os.makedirs(folder, exist_ok=True)
    zpath = os.path.join(folder, f"embedflow-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
