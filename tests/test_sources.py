"""Ingest and table-contract helpers."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from lendspark.sources import tables


def test_normalise_and_widen():
    assert tables.normalise_name(" AMT Credit-Sum (%) ") == "amt_credit_sum____"
    assert tables.normalise_name("1st flag") == "1st_flag"
    assert tables.normalise_name("Şube Adı") == "şube_adı"
    with pytest.raises(ValueError):
        tables.normalise_names(["a b", "A-B"])
    assert isinstance(tables.widen(T.IntegerType()), T.LongType)
    assert isinstance(tables.widen(T.FloatType()), T.DoubleType)
    assert isinstance(tables.widen(T.DateType()), T.StringType)


def test_csv_round_trip(spark):
    src = tables.read_table(spark, SF001, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    folder = tempfile.mkdtemp(prefix="lendspark-csv-", dir=spark.sparkContext.getCheckpointDir().replace("file:", ""))
    csv_dir = os.path.join(folder, "in")
    (src.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")))
        .withColumnsRenamed({"o_orderkey": "Order Key", "o_totalprice": "Total-Price"})
        .write.option("header", True).csv(csv_dir))
    schema = tables.infer_csv_schema(spark, csv_dir)
    assert [f.name for f in schema.fields] == ["order_key", "total_price", "o_orderpriority"]
    assert [type(f.dataType) for f in schema.fields] == [T.LongType, T.DoubleType, T.StringType]
    back = tables.load_csv_to_parquet(spark, csv_dir, schema, os.path.join(folder, "out"))
    assert back.count() == src.count()
    assert back.where(F.col("o_orderpriority").isNull()).count() == src.where(F.col("o_orderkey") % 5 == 0).count()


def test_lookup_and_keys(spark):
    cust = tables.read_table(spark, SF001, "customer")
    ids = spark.createDataFrame([(1,), (2,), (999999999,)], "c_custkey long")
    found, missing = tables.lookup(ids, cust, "c_custkey")
    assert found.count() == 2 and [r["c_custkey"] for r in missing.collect()] == [999999999]
    tables.assert_unique(cust, "c_custkey")
    with pytest.raises(ValueError):
        tables.assert_unique(cust.unionByName(cust.limit(1)), "c_custkey")
    counts = {r["name"]: r["rows"] for r in tables.row_counts({"a": cust, "b": ids}).collect()}
    assert counts["b"] == 3


def test_inference_reads_the_first_rows_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "Id,A Flag,amount,big,none,mixed\n" + "".join(f"{i},{'TRUE' if i % 2 else 'false'},{i / 4},{i}{'0' * 12},,{i}\n" for i in range(500)) + "x,y,z,w,v,u\n"
    (tmp_path / "in" / "Table One.csv").write_text(text)
    (tmp_path / "in" / "Other.CSV").write_text('n,note\n1,"a, b"\n,\n')
    (tmp_path / "in" / "columns_description.csv").write_text("junk\n")
    (tmp_path / "in" / "readme.txt").write_text("junk")
    got = tables.infer_csv_folder(spark, str(tmp_path / "in"), skip=["columns_description.csv"], rows=500)
    assert {t: [(f.name, f.dataType.simpleString()) for f in s.fields] for t, s in got.items()} == {
        "table_one": [("id", "bigint"), ("a_flag", "boolean"), ("amount", "double"), ("big", "bigint"), ("none", "double"), ("mixed", "bigint")],
        "other": [("n", "bigint"), ("note", "string")]}
    every = tables.infer_csv_schema(spark, str(tmp_path / "in" / "Table One.csv"), rows=501)
    assert {f.dataType.simpleString() for f in every.fields} == {"string"}
    (tmp_path / "in" / "table-one.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="two files"):
        tables.infer_csv_folder(spark, str(tmp_path / "in"))


def test_inference_of_a_file_without_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert [f.dataType.simpleString() for f in tables.infer_csv_schema(spark, str(tmp_path / "empty.csv")).fields] == ["double", "double"]
