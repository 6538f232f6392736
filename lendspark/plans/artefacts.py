"""What one step publishes and later steps read: split scores, decision policy, portfolio (E2, E4 of the survey).

Each artefact is a ``VersionedTable`` in the shared checkpoint folder, below a name made of the application, the input
folder and the state of its files: a step that needs one reads its current version, and the first that finds none
publishes it. Steps read columns of Parquet files, not row checkpoints, and no threshold is written in code."""
from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendspark.session import ensure_checkpoint_dir
from lendspark.sources.versions import BucketedTable, VersionedTable


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input tables' files: another state, another set of artefacts."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = top.getFileSystem(conf)
    found = []
    for table in fs.listStatus(top):
        for f in fs.listStatus(table.getPath()) if table.isDirectory() else [table]:
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def _place(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    run = hashlib.sha256(f"{spark.sparkContext.applicationId} {sf_dir}".encode()).hexdigest()[:16]
    return f"{root}/published/{run}-{input_state(spark, sf_dir)}/{name}"


def artefact(spark: SparkSession, sf_dir: str, name: str) -> VersionedTable:
    return VersionedTable(spark, _place(spark, sf_dir, name))


def bucketed(spark: SparkSession, sf_dir: str, name: str, key: str, buckets: int, build: Callable[[], DataFrame]) -> DataFrame:
    """Like ``published``, bucketed by ``key``, which is unique."""
    table = BucketedTable(spark, f"{_place(spark, sf_dir, name)}-{buckets}", key, buckets)
    return table.read(table.current() or table.publish(build(), key, note=f"from {sf_dir}"))


def published(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], key: str | None = None,
              contracts: dict[str, str] | None = None) -> DataFrame:
    """The artefact's current version; ``build`` makes the first one."""
    table = artefact(spark, sf_dir, name)
    return table.read(table.current() or table.publish(build(), key, contracts, note=f"from {sf_dir}"))
