"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage between heavy stages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "roomrate",
                  shuffle_partitions: int = 8, driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session
    the platform gives you and leave these settings to its config."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", driver_memory)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset *and* Spark runs in local
    mode (tests, bench) do we create one; a cluster without the setting is a
    configuration error, because a machine-local folder would not survive
    the loss of the executor that wrote it.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(HDFS, S3, ...) before running staged plans on a cluster")
        root = tempfile.mkdtemp(prefix="roomrate-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for one staged table."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
