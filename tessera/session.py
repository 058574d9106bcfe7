"""Spark session settings shared by tests, the bench and the driver entry.

The settings lean on Catalyst and AQE rather than hand scheduling: adaptive
execution coalesces small shuffle partitions, turns sort-merge joins into
broadcast joins when the runtime size of a side is small, and splits skewed
join partitions.  Nothing here pins a physical plan.

Sizing on a cluster: keep ``spark.sql.shuffle.partitions`` at least at the
shuffled bytes divided by ~128 MB (tens of thousands for 100 TB inputs) —
AQE merges the partitions that turn out small, so a generous value costs
little while a small one makes partitions spill; scan splits follow
``spark.sql.files.maxPartitionBytes`` (128 MB by default).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should carry.  Shuffle partitions
# are left to the caller (cluster default in production, cores in tests).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder used to cut lineage and stage written tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path
    named by the cluster); without it written tables would lie on one machine,
    so that is an error.  Only a ``local`` master, as in tests, gets a private
    folder under the system temp dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session has no SparkContext
        sc = None
    if sc is None:
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint area for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"tables/{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: fixed data for
    later passes, and nothing to recompute when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
