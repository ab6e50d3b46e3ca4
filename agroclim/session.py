"""Spark session defaults and the shared checkpoint folder.

The library never creates a session on a cluster: callers pass their own.
``local_session`` is for tests, the bench and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours runs with. ANSI stays on (Spark 4 default):
# bad input must go through try_* functions, never silently to null.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partition values in bronze paths (ingest_date, region_code) stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "agroclim") -> SparkSession:
    """A local session for tests and benchmarks (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("AGROCLIM_DRIVER_MEMORY", "8g"))
    )
    if not SparkSession.getActiveSession():
        # Tests and benches only: a scratch checkpoint folder when none is named.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="agroclim-ckpt-"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the SQL settings the operators rely on to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster it must be set and must be a shared file system. Only when it is
    unset (tests, local runs) do we create a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="agroclim-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def session_key(spark: SparkSession) -> str:
    """A key unique to this session for the lifetime of the process (memo keys):
    the session UUID plus the application id, never a reusable object address."""
    jss = spark._jsparkSession
    try:
        uuid = jss.sessionUUID()
    except Exception:  # noqa: BLE001 - older JVM side
        uuid = str(jss.hashCode())
    return f"{spark.sparkContext.applicationId}/{uuid}"
