"""Requests are read in one pass, not searched for every feature of the model."""
from pyspark.sql import functions as F

from lendspark.operators import conformance as conf

NAMES = tuple(f"f{i:03d}" for i in range(60))
SCHEMA = conf.RequestSchema(NAMES, {"kind": ("a", "b")})


def test_requests_of_many_features_are_read_once(spark):
    full = {n: str(i) for i, n in enumerate(NAMES)} | {"kind": "b"}
    data = [(1, full), (2, dict(reversed(full.items()))), (3, {NAMES[7]: "7.5"}), (4, full | {"zzz": "1"}), (5, {}), (6, None), (7, full | {NAMES[3]: None})]
    out = conf.conform(spark.createDataFrame(data, "f008_ int, f map<string,string>"), "f", SCHEMA)
    assert "element_at" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["f008_", "reason", *NAMES, "kind"]
    got = {r["f008_"]: r for r in out.collect()}
    everything = [float(i) for i in range(60)]
    assert list(got[1][1:]) == list(got[2][1:]) == [None, *everything, "b"]
    assert list(got[4][1:]) == ["unknown features: zzz", *everything, "b"]
    assert [c for c in out.columns[2:] if got[3][c] is not None] == [NAMES[7]] and got[3][NAMES[7]] == 7.5
    assert got[5]["reason"] == got[6]["reason"] == "empty request" and set(got[6][2:]) == {None}
    assert got[7][NAMES[3]] is None and got[7][NAMES[4]] == 4.0


def test_a_model_without_features(spark):
    rows = spark.createDataFrame([(1, {"a": "1"}), (2, {})], "id int, f map<string,string>")
    got = conf.conform(rows, "f", conf.RequestSchema((), {})).orderBy("id").select(F.col("reason")).collect()
    assert [r["reason"] for r in got] == ["unknown features: a", "empty request"]
