"""Versioned tables. A new version is written beside the old ones, checked, and only then becomes the current one.

Layout below a shared root::

    versions/<sequence>-<random>/   data files of one version, never changed once published
    pointer/                        one small row for each published version, appended as one file

The current version is the published one of the highest sequence number. A reader resolves the pointer once and keeps
reading its version's files, whatever is published meanwhile; a job that fails, or whose rows break a contract, never
reaches the pointer. Appending one file is atomic for readers: they see the row or they don't. Two writers that publish
at once get the same sequence number; the one of the lesser name wins and the other is told so.

Contracts are checked on the written version, which reads back only the columns they name. (Observed metrics would save
that scan, but a session that has observed once can no longer run some of Spark's own feature transformers.) Old versions are dropped by ``vacuum`` only, which keeps the last few.

A ``BucketedTable`` deals each version's rows to a fixed number of buckets by a key, one file a bucket, so that tables
with the same buckets are joined on that key, version by version, without moving a row of them again.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.functions.local import local_frame
from lendspark.sources.tables import assert_unique

POINTER = "sequence long, version string, rows long, note string, published timestamp"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class ContractError(ValueError):
    """The written rows break a contract; nothing was published."""


class PublishConflict(RuntimeError):
    """Another writer published at the same time and won."""


class MissingArtefact(LookupError):
    """Nothing has been published there."""


@dataclass(frozen=True)
class Version:
    sequence: int
    name: str
    rows: int
    note: str


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, version: Version) -> str:
        return f"{self.root}/versions/{version.name}"

    def history(self) -> list[Version]:
        """Published versions, the current one first (one row each, as many as publications)."""
        if not exists(self.spark, f"{self.root}/pointer"):
            return []
        rows = self.spark.read.schema(POINTER).parquet(f"{self.root}/pointer").collect()
        winners: dict[int, Version] = {}
        for r in sorted(rows, key=lambda r: (r["sequence"], r["version"])):
            winners.setdefault(r["sequence"], Version(r["sequence"], r["version"], r["rows"], r["note"]))
        return sorted(winners.values(), key=lambda v: -v.sequence)

    def current(self) -> Version | None:
        return next(iter(self.history()), None)

    def read(self, version: Version | None = None) -> DataFrame:
        """The current version (or a given one). The frame stays on that version."""
        version = version or self.current()
        if version is None:
            raise MissingArtefact(f"nothing is published at {self.root}")
        return self.spark.read.parquet(self._path(version))

    def _write(self, df: DataFrame, name: str, partition_by: tuple[str, ...]) -> None:
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/versions/{name}")

    def publish(self, df: DataFrame, key: str | list[str] | None = None, contracts: dict[str, str] | None = None,
                note: str = "", partition_by: tuple[str, ...] = ()) -> Version:
        """Write, check, switch. ``contracts``: by name, the SQL text of an aggregate that must be true of all rows
        (NULL, as of no rows, is allowed)."""
        before = self.current()
        sequence = before.sequence + 1 if before else 1
        name = f"{sequence:08d}-{uuid.uuid4().hex}"
        names = list(contracts or {})
        self._write(df, name, partition_by)
        facts = self.spark.read.schema(df.schema).parquet(f"{self.root}/versions/{name}").agg(
            F.count(F.lit(1)).alias("rows"), *[F.expr(contracts[n]).alias(f"c{i}") for i, n in enumerate(names)]).first()
        broken = [n for i, n in enumerate(names) if facts[f"c{i}"] is False]
        if broken:
            raise ContractError(f"{self.root}: {', '.join(broken)}")
        written = Version(sequence, name, facts["rows"], note)
        if key is not None:
            try:
                assert_unique(self.read(written), key)
            except ValueError as e:
                raise ContractError(f"{self.root}: {e}") from e
        row = local_frame(self.spark, [(sequence, name, written.rows, note)], "sequence long, version string, rows long, note string")
        row.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")
        won = next(v for v in self.history() if v.sequence == sequence)
        if won.name != name:
            raise PublishConflict(f"{self.root}: {won.name} was published first")
        return written

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop the data of versions before the last ``keep`` published ones; names of what went. Versions that are being
        written (a sequence above the current one) stay, as do all that open readers of the last ``keep`` use."""
        kept = self.history()[:max(1, keep)]
        if not kept:
            return []
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        gone = []
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if int(name.split("-")[0]) <= kept[0].sequence and name not in {v.name for v in kept}:
                fs.delete(entry.getPath(), True)
                gone.append(name)
        return sorted(gone)


class BucketedTable(VersionedTable):
    """Versions bucketed and sorted by ``key``. Bucketing is a property of a catalogue table, so each version that is read
    or written has an entry ``version_<random>`` in the session's current database, an external table on the version's
    files; a session that lacks the entry makes it. Rows of a NULL key share one bucket."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int):
        super().__init__(spark, root)
        self.key, self.buckets = key, buckets

    def _write(self, df: DataFrame, name: str, partition_by: tuple[str, ...]) -> None:
        if partition_by:
            raise ValueError("a bucketed table is not partitioned by columns")
        dealt = df.repartition(self.buckets, self.key)          # the rule that buckets follow: one file for each
        dealt.write.format("parquet").mode("errorifexists").bucketBy(self.buckets, self.key).sortBy(self.key).option(
            "path", f"{self.root}/versions/{name}").saveAsTable(_entry(name))

    def read(self, version: Version | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise MissingArtefact(f"nothing is published at {self.root}")
        entry = _entry(version.name)
        if not self.spark.catalog.tableExists(entry):
            columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in super().read(version).schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) "
                           f"SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self._path(version)}'")
        return self.spark.table(entry)

    def vacuum(self, keep: int = 2) -> list[str]:
        gone = super().vacuum(keep)
        for name in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {_entry(name)}")
        return gone


def _entry(name: str) -> str:
    return f"version_{name.split('-')[1]}"
