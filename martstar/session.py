"""Spark session settings for the warehouse jobs.

ANSI mode stays on (Spark 4 default), the session time zone is UTC (the
reference normalises every timestamp to UTC) and AQE re-plans joins and
shuffle partition counts at runtime.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join on (stock, day) leaves a table that is bucketed by stock where it is
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # keyed rewrites of the fact tables only replace the partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "martstar") -> SparkSession:
    """Build (or reuse) a session with the warehouse settings.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of DEFAULT_CONF to an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


def build_session(spark: SparkSession, buckets: int) -> SparkSession:
    """A session of the same application whose shuffles have as many partitions as a table has
    buckets: with more, a join would deal rows out anew that lie as the buckets do."""
    own = spark.newSession()
    apply_conf(own)
    own.conf.set("spark.sql.shuffle.partitions", str(buckets))
    return own


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a private folder; on a cluster its
    absence is an error, as executors cannot see the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared folder for intermediate tables")
        current = tempfile.mkdtemp(prefix="martstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not (hasattr(sc, "getCheckpointDir") and sc.getCheckpointDir()):
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)
