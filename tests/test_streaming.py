"""Streaming = batch: the streaming scorer and drift job give the same rows as the same column code applied to a batch
read; late, unknown and bad rows are kept with a reason; nothing is repeated by a restart."""
from pyspark.sql import functions as F

from conftest import SF001
from lendspark.plans import q_stream
from lendspark.sources import fixtures
from lendspark.streaming import scoring as st

KEY = ["event_id", "probability", "decision", "confidence", "reason"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_stream_score_equals_batch(spark):
    streamed = q_stream.stream_results(spark, SF001)
    score = q_stream.scorer(spark, SF001)[1]
    requests = fixtures.load(spark, SF001, "requests").withColumn("ts", F.col("ts").cast("timestamp")).drop("arrival")
    batch = score(requests)                                   # without a watermark: nothing is late
    on_time = streamed.where("reason IS NULL OR reason <> 'late'")
    assert rows(on_time, *KEY) == rows(batch.join(on_time.select("event_id"), "event_id", "left_semi"), *KEY)
    assert streamed.count() == requests.count() == streamed.select("event_id").distinct().count()
    assert streamed.where("status = 'accepted' AND decision NOT IN ('approve', 'reject', 'review')").count() == 0
    first = streamed.where("status = 'accepted'").first()
    shares = [abs(x["contribution"]) for x in first["reasons"]]
    assert shares == sorted(shares, reverse=True) and len(shares) <= 8


def test_rejects_have_all_reasons(spark):
    got = {r["reason"]: r["count"] for r in q_stream.q_stream_rejects(spark, SF001).groupBy("reason").count().collect()}
    assert set(got) == {"unknown customer", "missing requested amount", "late"} and min(got.values()) > 0


REQUESTS = "event_id long, ts string, sk_id_curr long, requested_amount double"


def request_frame(spark, data):
    return spark.createDataFrame(data, REQUESTS).withColumn("ts", F.col("ts").cast("timestamp"))


def test_one_stream_two_sinks_restarts_and_late_rows(spark, tmp_path):
    customers = spark.createDataFrame([(1,), (2,)], "sk_id_curr long")
    inbox, sink = str(tmp_path / "in"), st.RequestSink(spark, str(tmp_path / "out"), lambda b, w: st.judge(b, customers, w))
    first = [(1, "2024-01-05 00:00:00", 1, 10.0), (2, "2024-01-01 00:00:00", 2, 10.0), (3, None, 1, 1.0)]
    second = [(4, "2024-01-03 23:59:59", 1, 10.0), (5, "2024-01-04 00:00:00", 1, 10.0), (6, "2024-01-09 00:00:00", 9, 1.0),
              (7, "2024-01-09 00:00:00", 1, None), (8, "2024-01-09 00:00:00", None, 1.0), (9, "2024-01-09 00:00:00", 2, float("nan"))]
    for delivery in (first, second):
        request_frame(spark, delivery).coalesce(1).write.mode("append").parquet(inbox)
        sink.run(st.read_requests(spark, inbox))
    want = [(1, None), (2, None), (3, "missing time"), (4, "late"), (5, None), (6, "unknown customer"), (7, "missing requested amount"),
            (8, "unknown customer"), (9, "missing requested amount")]
    assert rows(sink.results(), "event_id", "reason") == sorted(want, key=str)
    assert rows(sink.results().where("status = 'accepted'"), "event_id") == [(1,), (2,), (5,)]
    sink.run(st.read_requests(spark, inbox))                  # nothing new
    sink(request_frame(spark, second), 1)                     # a batch whose commit was lost runs again
    sink(request_frame(spark, first), 0)
    assert rows(sink.results(), "event_id", "reason") == sorted(want, key=str)


def test_stream_psi_shape(spark):
    out = q_stream.q_stream_psi(spark, SF001)
    found = out.collect()
    assert len(found) == 30 and all(r["psi"] is not None and r["psi"] >= 0 for r in found)
