"""Line dedup frees the disk of its earlier steps, and long sets are told apart before they are paired."""
import os

from pyspark.sql import functions as F

from lendspark.functions.local import local_frame
from lendspark.llm import line_dedup
from lendspark.llm.common import shared_folder, stored


def tables(spark) -> dict[str, list[str]]:
    """Columns of the tables below the scratch folder."""
    top = os.path.dirname(shared_folder(spark)).removeprefix("file:")
    found = [d for d, _, names in os.walk(top) if any(n.endswith(".parquet") for n in names)]
    return {d: spark.read.parquet(d).columns for d in found}


def shuffle_files(spark) -> int:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(str(blocks.apply(i)).startswith("shuffle_") for i in range(blocks.size()))


def test_steps_that_are_read_no_more_are_dropped(spark):
    before = tables(spark)
    lines = [" ".join(f"w{(7 * d + j) % 50}" for j in range(12)) for d in range(40)]
    docs = local_frame(spark, [(d, line) for d, line in enumerate(lines)], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs, line_dedup.EVERY_LINE).count() == 40
    left = [columns for d, columns in tables(spark).items() if d not in before]
    assert left and not [columns for columns in left if {"prefix", "t", "s"} & set(columns)]


def test_shuffle_files_go_with_their_job(spark):
    before = shuffle_files(spark)
    rows = stored(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert shuffle_files(spark) <= before
    assert rows.count() == 10


def test_long_sets_have_more_classes(spark):
    """Two long sets without a common token but one: the classes of ``sig`` alone would let them pass."""
    sets = spark.range(2).select(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda x: F.xxhash64(x, F.col("id"))).alias("s"))
    odd = line_dedup._parities("s", 2, 1)
    one = sets.select(F.lit(60).alias("n"), F.lit(0).alias("p"), F.lit(0).cast("long").alias("sig"), odd.alias("more"))
    x, y = (one.where(F.col("more") == m) for m in [r["more"] for r in one.collect()])
    passed = lambda more: x.withColumn("more", more).alias("x").crossJoin(y.withColumn("more", more).alias("y")).where(
        line_dedup._can_match("x", "y", 80)).count()
    assert (passed(F.col("more")), passed(F.lit(None).cast("long"))) == (0, 1)
    words = sets.select(line_dedup._parities("s").alias("all"), odd.alias("odd"), line_dedup._parities("s", 2, 0).alias("even"))
    assert words.where(F.col("all") != F.col("odd").bitwiseXOR(F.col("even"))).count() == 0
