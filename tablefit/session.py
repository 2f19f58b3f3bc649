"""Session construction and the shared scratch / checkpoint location.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by
whoever runs the cluster).  Only when it is unset -- local tests, the bench --
do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configuration we rely on; everything else is Spark's default.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app: str = "tablefit",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or a directory already given to
    ``setCheckpointDir``).  If neither is set -- local runs only -- a fresh
    temporary folder is created and registered as the checkpoint dir; on a
    cluster, where such a folder is not shared, this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tablefit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df):
    """Reliable checkpoint of ``df`` into the shared checkpoint folder (eager):
    later jobs -- iterative fits, several metric passes -- read the written
    blocks, and a lost executor costs a re-read, not a recomputation of the
    whole upstream plan.  Never ``localCheckpoint``: that data dies with the
    executor that holds it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
