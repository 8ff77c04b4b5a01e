"""Session helpers.

`get_session` only *adds* defaults that are unset, so a cluster submit
(spark-submit --conf ...) always wins over what is written here.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults for a session we build ourselves (tests, bench, local runs).  On a
# cluster the submit-time configuration is already set and is left untouched.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (`spark.checkpoint.dir`).

    Only on a local master, where driver and executors are one process, a
    scratch folder stands in for a missing setting and is recorded in the
    session, so every later call agrees on it.  Elsewhere a missing setting is
    an error: executors would write to their own disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): the data is written to
    the cluster file system and the plan restarts from there.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
