"""Session helpers: tuned defaults for tests/bench and a shared checkpoint folder."""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package assumes. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splits hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lendspark") -> SparkSession:
    """A local session for tests and the bench (the cluster supplies its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LENDSPARK_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local session (tests, bench) without one gets a fresh scratch
    folder; on a cluster a folder of one machine would lose every other machine's files, so there it is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lendspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
