"""Versions are written beside each other and switched by a pointer."""
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lendspark.operators import scorecard as sc
from lendspark.plans import q_scoring as qs
from lendspark.plans.artefacts import artefact, input_state, published
from lendspark.sources.versions import BucketedTable, ContractError, MissingArtefact, PublishConflict, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def test_open_readers_keep_their_version(spark, table):
    assert table.current() is None and table.history() == []
    with pytest.raises(MissingArtefact):
        table.read()
    one = table.publish(spark.range(5), key="id", note="first")
    reader = table.read()
    two = table.publish(spark.range(7), key="id")
    assert (one.sequence, one.rows, two.sequence, two.rows) == (1, 5, 2, 7)
    assert reader.count() == 5 and table.read().count() == 7 and table.read(one).count() == 5
    assert [v.note for v in table.history()] == ["", "first"]


def test_broken_contracts_publish_nothing(spark, table):
    table.publish(spark.range(3), key="id")
    with pytest.raises(ContractError, match="primary key"):
        table.publish(spark.range(3).union(spark.range(1)), key="id")
    with pytest.raises(ContractError, match="small ids"):
        table.publish(spark.range(300), contracts={"small ids": "max(id) < 100", "fine": "count(id) > 0"})
    with pytest.raises(Exception, match="boom"):
        table.publish(spark.range(3).select(F.when(F.col("id") < 9, F.raise_error(F.lit("boom"))).alias("id")))
    assert table.read().count() == 3 and len(table.history()) == 1
    assert table.publish(spark.range(4)).sequence == 2


def test_an_empty_version_is_a_version(spark, table):
    table.publish(spark.range(0), key="id", contracts={"small ids": "max(id) < 100"})
    assert table.current().rows == 0 and table.read().count() == 0


def test_two_writers_at_once(spark, table, monkeypatch):
    """Both saw version 1: one of their versions 2 becomes the current one, the other writer is told."""
    table.publish(spark.range(1))
    stale = table.current()
    names = []
    for n in (2, 3):
        writer = VersionedTable(spark, table.root)
        real = writer.history
        calls = iter([[stale]])
        monkeypatch.setattr(writer, "history", lambda real=real, calls=calls: next(calls, None) or real())
        try:
            names.append(writer.publish(spark.range(n)).name)
        except PublishConflict:
            names.append(None)
    assert names[0] is not None                          # at its time it was the only one
    assert [v.sequence for v in table.history()] == [2, 1]
    assert (names[1] is None) == (table.current().name == names[0])


def test_vacuum_keeps_the_last_versions(spark, table):
    made = [table.publish(spark.range(n)) for n in range(1, 5)]
    assert table.vacuum(keep=2) == [made[0].name, made[1].name]
    assert table.read().count() == 4 and table.read(made[2]).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table.read(made[0]).count()
    assert VersionedTable(spark, table.root + "-none").vacuum() == []


def test_artefacts_follow_the_input(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(3).write.parquet(f"{folder}/a.parquet")
    state = input_state(spark, folder)
    read = lambda: published(spark, folder, "n", lambda: spark.read.parquet(f"{folder}/a.parquet")).count()
    assert read() == 3 and input_state(spark, folder) == state
    spark.range(2).write.mode("append").parquet(f"{folder}/a.parquet")
    assert input_state(spark, folder) != state and read() == 5


def test_views_scan_the_published_portfolio(spark):
    p = qs.portfolio(spark, SF001)
    table = artefact(spark, SF001, "portfolio")
    assert table.current().rows == p.count()
    view = qs.mon.kpi_by_split(qs.portfolio(spark, SF001))
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert table.current().name[:20] in plan or "published" in plan
    assert "Scan ExistingRDD" not in plan and "occupation" not in plan       # pruned columns of files, no row checkpoint
    with pytest.raises(MissingArtefact):
        qs.threshold(spark, SF001, "no such model")


def test_bucketed_versions_join_without_exchange(spark, tmp_path):
    one = BucketedTable(spark, str(tmp_path / "one"), "id", 4)
    two = BucketedTable(spark, str(tmp_path / "two"), "id", 4)
    with pytest.raises(MissingArtefact):
        one.read()
    rows = spark.range(1000).withColumn("v", F.col("id") % 7)
    first = one.publish(rows, key="id")
    two.publish(rows.where("id % 3 = 0").withColumnRenamed("v", "w"), key="id")
    joined = one.read().join(two.read().hint("merge"), "id", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert joined.where("w IS NOT NULL AND w = v").count() == 334 and joined.count() == 1000
    spark.sql(f"DROP TABLE version_{first.name.split('-')[1]}")          # another session: the entry is made anew
    again = one.read()
    assert again.count() == 1000 and "Exchange" not in again.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    reader = one.read(first)
    one.publish(rows.limit(5), key="id")
    assert reader.count() == 1000 and one.read().count() == 5
    one.publish(rows.limit(6), key="id")
    assert one.vacuum(keep=2) == [first.name] and one.read().count() == 6
    with pytest.raises(ContractError):
        one.publish(rows.union(rows), key="id")
    with pytest.raises(ValueError, match="not partitioned"):
        one.publish(rows, partition_by=("v",))


def test_reversed_scorecard_is_not_published(spark, table):
    rows = [(i, float(i), int(i > 50), "validation" if i % 2 else "train") for i in range(100)]
    right = spark.createDataFrame(rows, "id int, points double, target int, split string")
    contract = {"direction": sc.DIRECTION_HOLDS}
    with pytest.raises(ContractError, match="direction"):
        table.publish(right, key="id", contracts=contract)                  # more points, more default
    table.publish(right.withColumn("points", -F.col("points")), key="id", contracts=contract)
    only_train_reversed = right.withColumn("points", F.when(F.col("split") == "train", F.col("points")).otherwise(-F.col("points")))
    table.publish(only_train_reversed, key="id", contracts=contract)
    table.publish(right.withColumn("points", F.lit(1.0)), key="id", contracts=contract)         # no direction
    assert table.current().sequence == 3
