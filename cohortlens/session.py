"""Spark session helpers.

Library code never creates its own session; callers pass one in. These
helpers exist for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run relies on. AQE is what turns the dimension joins into
# broadcast joins once their real size is known, coalesces small shuffle
# partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the cluster deployment (~100 TB of input, ~1000 executors).
# AQE starts from many shuffle partitions and coalesces them towards the
# advisory size, so each reducer holds ~256 MiB and spills rarely; scans
# split files at 256 MiB; skewed join partitions are split above 5x the
# median / 1 GiB; broadcasts stay below 64 MiB at runtime.
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cohortlens", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("COHORTLENS_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    local = master.startswith("local")
    conf = dict(BASE_CONF if local else CLUSTER_CONF)
    if shuffle_partitions or local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def delete_on_exit(sc, path: str) -> None:
    """Have the file system remove ``path`` when the driver's JVM ends."""
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; without it a cluster session is an error, since executors
    would each write to a disk of their own. Only a local session gets a
    scratch folder, which is removed when the session's JVM ends.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the session conf is visible
        sc = None
    if sc is not None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
    d = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            d = None
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        delete_on_exit(sc, d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d
