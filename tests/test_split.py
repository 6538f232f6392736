"""Split invariants (repeatable, order-free, disjoint, complete, stratified)."""
from pyspark.sql import functions as F

from conftest import SF01
from lendspark.operators.split import stratified_split
from lendspark.sources import fixtures


def test_split_golden_and_invariants(spark):
    d = fixtures.load(spark, SF01, "scored")
    s = stratified_split(d, "id", "target")
    counts = {(r["split"], r["target"]): r["count"] for r in s.groupBy("split", "target").count().collect()}
    assert counts == {("test", 0): 2750, ("test", 1): 250, ("validation", 0): 2750, ("validation", 1): 250,
                      ("train", 0): 8251, ("train", 1): 749}
    shuffled = stratified_split(d.repartition(7).orderBy(F.rand(999)), "id", "target")
    a = {r["id"]: r["split"] for r in s.select("id", "split").collect()}
    b = {r["id"]: r["split"] for r in shuffled.select("id", "split").collect()}
    assert a == b and len(a) == d.count()
    rates = {r["split"]: r["rate"] for r in s.groupBy("split").agg(F.avg("target").alias("rate")).collect()}
    assert max(rates.values()) - min(rates.values()) < 0.002
