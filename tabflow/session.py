"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only fills
settings that are still unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the package relies on (UTC dates, AQE re-planning,
# Arrow for the few pandas steps).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a query's shuffle files go when it ends, so a job of several written steps needs the disk of one
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabflow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def ship_code() -> None:
    """Pickle this package's functions by value, so Python workers need no install of it."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__package__])


def set_by_user(spark: SparkSession, key: str) -> bool:
    """Whether the session carries its own value (``conf.get`` also returns built-in defaults)."""
    return key in spark.conf.getAll


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where unset, ship the package code and make sure a checkpoint folder exists."""
    ship_code()
    for k, v in DEFAULTS.items():
        if not set_by_user(spark, k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


SHARED_SCHEMES = ("hdfs", "s3", "s3a", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "dbfs", "viewfs", "webhdfs", "ofs", "cosn")


def needs_shared_folder(master: str, folder: str | None) -> bool:
    """True when ``folder`` cannot serve a session on ``master``: unset on anything but a local master."""
    return not folder and not master.startswith("local[") and master != "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; a scratch folder only when unset on a local master (tests).

    On a cluster a machine-local folder would hold a part of the data on every executor, so an unset
    folder is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if needs_shared_folder(sc.master if sc is not None else "remote", d):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share "
                         f"(for example on {', '.join(SHARED_SCHEMES[:4])}); a temporary folder is only used on a local master")
    if not d:
        d = tempfile.mkdtemp(prefix="tabflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
