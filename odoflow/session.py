"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone UTC keeps TIMESTAMP_NTZ <-> TIMESTAMP
# casts from shifting at DST changes; AQE re-plans joins (runtime broadcast of
# small sides, skew splitting) and coalesces small shuffle partitions.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "odoflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition after
    the first shuffle).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, settings[key])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there (HDFS, object store); we read it
    from the session. Only when it is unset and the master is local do we pick a
    fresh folder of our own and register it; on a cluster an unset folder is an
    error, as a machine-local one would not be seen by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="odoflow-ckpt-", dir=os.environ.get("ODOFLOW_LOCAL_DIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def size_for_input(spark: SparkSession, input_bytes: int, total_cores: int, target_bytes: int = 256 << 20) -> int:
    """Size shuffles for a run over ``input_bytes`` of input on ``total_cores`` cores.

    Shuffle partitions = input / target (at least 2 waves of the cores), AQE's
    advisory size and the file split size = target, so a task handles about
    ``target_bytes`` before and after each shuffle; AQE still coalesces small
    shuffles and splits skewed ones. Returns the partition count set.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    return parts
