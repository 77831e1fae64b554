"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.
#  * UTC session zone: the telemetry timestamps carry no zone.
#  * AQE: runtime coalescing of small shuffles, skew-join splitting and
#    size-checked broadcast conversion of joins whose side is small at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "fleetscope",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster call it without ``master``; the launcher supplies it.
    ``shuffle_partitions`` should be sized so one shuffle partition is
    ~128-256 MB at the target scale (AQE coalesces the excess down).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate() may hand back an existing session: re-apply SQL confs.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.3,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Scan and shuffle sizing for a job reading ``input_bytes`` on ``total_cores`` cores.

    * scan splits of ``target_partition_bytes`` (Parquet row groups permitting);
    * shuffle partitions so that the largest shuffle -- assumed to be
      ``shuffle_fraction`` of the input after column pruning -- gives about one
      target-sized partition each (at least two waves of tasks); AQE then
      coalesces small ones to the advisory size, at every size alike;
    * skew splitting above 4x the target, and a checked 64 MB broadcast bound.
    E.g. 100 TB on 1000 executors x 8 cores -> 111 759 shuffle partitions of 256 MB.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    n = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder in that setting and it
    is used as is.  Only when it is unset *and* the master is local (tests) a
    scratch folder is created and registered; on a cluster an unset setting
    is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    if d := sc.getCheckpointDir():
        return d  # setting it once more would nest a new folder in it
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder")
        d = tempfile.mkdtemp(prefix="fleetscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d
