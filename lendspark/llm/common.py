"""Shared helpers: word patterns, shared scratch tables, small column idioms."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Only the named columns of a table: the scan reads nothing else."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def words(text: Column) -> Column:
    """Array of the words of a text (null text: no words): runs of anything but ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def long_array(values) -> Column:
    """A constant array of whole numbers (or of the text of a list); the optimiser folds it into one literal."""
    text = values if isinstance(values, str) else ",".join(map(str, values))
    return F.split(F.lit(text), ",").cast("array<bigint>")


def slot_list(sums: DataFrame, slots: int) -> str:
    """``sums`` (slot, value) as the text of a list with a value, else 0, for each of a fixed number of slots."""
    all_slots = sums.sparkSession.range(slots).join(sums, F.col("id") == F.col("slot"), "left")
    pairs = F.sort_array(F.collect_list(F.struct("id", F.coalesce("value", F.lit(0).cast("long")).alias("value"))))
    return all_slots.agg(F.array_join(F.transform(pairs, lambda x: x["value"].cast("string")), ",")).first()[0]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``. Where that is
    unset (tests, one machine), a folder below the SQL warehouse is used."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-scratch"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's own setting: a job's shuffle files go when it ends, instead of when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, *, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and
    a lost executor loses nothing. Its shuffle files are freed once it is written."""
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that are dropped once what reads them is stored itself. Nothing lazy may read them after ``drop``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.top, self.made = spark, shared_folder(spark), 0

    def stored(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return stored(df, folder=f"{self.top}/{self.made}")

    def drop(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.top)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
