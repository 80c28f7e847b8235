"""Session helpers: the settings the operators assume, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator relies on. Timestamps are naive UTC end to end.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "gaugeflow") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives
    and call :func:`configure` on it."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("GAUGEFLOW_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when nothing is configured (local
    runs and tests) a scratch folder is created and registered; on a cluster a
    missing setting is an error, because executors do not see the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="gaugeflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/gaugeflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes from these files, not from
    the sources) and lets several consumers share one computation. Preferred
    to ``Dataset.checkpoint``, which computes an unpersisted plan twice and
    stores Java-serialised rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._scratch = path
    return out


def discard(*tables) -> None:
    """Deletes tables that :func:`materialize` wrote, once nothing reads them any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(table._scratch)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished queries now: it does so for plans that
    the driver's garbage collection finds unused, which else runs when the driver's heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
