"""Structured Streaming surfaces.

R1 ``RequestSink``: applications arrive as rows of a stream; each is joined
once with the static customer feature table, judged, scored with the *same*
scorecard column expressions as the batch job (no training/serving skew),
given a data-quality confidence, a decision (low confidence → manual review)
and reason codes, or rejected with a reason, in one pass over the batch.

R2 ``drift_stream``: daily event windows under a watermark are binned against
reference edges (a static, bounded array) and counted; state is bounded by
windows × bins. PSI per window is computed from those counts.

R3: late, malformed and unknown rows go to the reject output with a reason;
nothing is dropped.

Checkpoints and outputs live under the session's ``spark.checkpoint.dir``
(shared storage on a cluster), never in a machine-local folder.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.operators import monitoring as mon
from lendspark.operators import quality
from lendspark.operators import scorecard as sc
from lendspark.operators.psi import SHARE_FLOOR, verdict
from lendspark.session import ensure_checkpoint_dir
from lendspark.sources.versions import exists

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ONLINE_BAND_LABELS = mon.RISK_BAND_LABELS


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def read_event_stream(spark: SparkSession, directory: str, pattern: str = "events*.parquet",
                      max_files: int = 1) -> DataFrame:
    """File stream over ``directory`` (new files matching ``pattern`` arrive as
    micro-batches). Event time becomes a TIMESTAMP for watermarking."""
    raw = (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files)
           .option("pathGlobFilter", pattern).parquet(directory))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


REQUEST_SCHEMA = "event_id long, ts timestamp, sk_id_curr long, requested_amount double"
LATENESS = "1 day"
ACCEPTED, REJECTED = "accepted", "rejected"


def judge(requests: DataFrame, customers: DataFrame, watermark: datetime | None = None) -> DataFrame:
    """Requests joined once with the static customer table, with the ``reason`` of a rejection (NULL: accepted):
    unknown customer, missing amount, or later than the watermark."""
    amount = F.col("requested_amount")
    late = F.lit(False) if watermark is None else F.coalesce(F.col("ts") < F.lit(watermark), F.lit(False))
    joined = requests.join(customers.withColumn("_known", F.lit(True)), "sk_id_curr", "left")
    return joined.withColumn("reason", F.when(F.col("_known").isNull(), F.lit("unknown customer"))
                             .when(amount.isNull() | F.isnan(amount), F.lit("missing requested amount"))
                             .when(F.col("ts").isNull(), F.lit("missing time")).when(late, F.lit("late"))).drop("_known")


class RequestSink:
    """One stream, two sinks: each micro-batch is judged and scored in one pass and written below
    ``data/batch_id=N/status=accepted|rejected``. A batch that is run again (restart, lost commit) overwrites its own
    folder, so nothing is repeated; its watermark comes from the batches before it alone, so it is judged the same."""

    def __init__(self, spark: SparkSession, out: str, score: Callable[[DataFrame, datetime | None], DataFrame], lateness: str = LATENESS):
        self.spark, self.out, self.score, self.lateness = spark, out.rstrip("/"), score, lateness

    def watermark(self, batch_id: int) -> datetime | None:
        """The greatest event time of the batches before this one, less the allowed lateness."""
        if not exists(self.spark, f"{self.out}/progress"):
            return None
        seen = self.spark.read.schema("batch_id long, latest timestamp").parquet(f"{self.out}/progress")
        at = F.max("latest") - F.expr(f"INTERVAL {self.lateness}")
        return seen.where(F.col("batch_id") < batch_id).agg(at.alias("w")).first()["w"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        at = f"{self.out}/data/batch_id={batch_id}"
        scored = self.score(batch, self.watermark(batch_id))
        scored.withColumn("status", F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)).write.mode("overwrite").partitionBy("status").parquet(at)
        written = self.spark.read.schema("ts timestamp").parquet(at)
        latest = written.agg(F.max("ts").alias("latest")).select(F.lit(batch_id).cast("long").alias("batch_id"), "latest")
        latest.coalesce(1).write.mode("overwrite").parquet(f"{self.out}/progress/part={batch_id}")

    def run(self, requests: DataFrame) -> None:
        """Everything that has arrived, then stop."""
        q = (requests.writeStream.option("checkpointLocation", f"{self.out}/_checkpoint").foreachBatch(self).trigger(availableNow=True).start())
        q.awaitTermination()

    def results(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/data")


def read_requests(spark: SparkSession, directory: str) -> DataFrame:
    """File stream of requests: all files that arrived since the last run are one micro-batch."""
    return spark.readStream.schema(REQUEST_SCHEMA).parquet(directory)


def online_band(p: str) -> F.Column:
    """Left-closed online risk bands (p < 0.02 → first, ...)."""
    from lendspark.functions.exprs import band

    return band(p, mon.ONLINE_BAND_EDGES, ONLINE_BAND_LABELS, closed="left")


def score_requests(judged: DataFrame, bmap: sc.BinMap, numeric: Sequence[str], categorical: Sequence[str], intercept: float,
                   coefs: dict, means: dict, checked: Sequence[str], threshold: float, reasons: int = 8) -> DataFrame:
    """R1 core, shared by batch and stream: WOE → score → confidence → decision → reasons of judged requests (joined with
    the customers' features). Rejected ones keep their row, without a score."""
    qual = quality.confidence(judged, checked)
    woe = bmap.transform(qual, [f for f in numeric if f in coefs], [f for f in categorical if f in coefs],
                         ["event_id", "ts", "sk_id_curr", "requested_amount", "reason", "confidence", "unexpected_nulls"])
    scored = sc.contributions(sc.score_columns(woe, intercept, coefs), coefs, means)
    decision = (F.when(F.col("confidence") == "low", F.lit(mon.REVIEW))
                .when(F.col("probability") < F.lit(threshold), F.lit(mon.APPROVE)).otherwise(F.lit(mon.REJECT)))
    given = {"probability": F.round("probability", 6), "points": F.col("points"), "risk_band": online_band("probability"),
             "confidence": F.col("confidence"), "unexpected_nulls": F.col("unexpected_nulls"), "decision": decision,
             "reasons": sc.top_reasons(F.col("contribs"), reasons)}
    return scored.select("event_id", "ts", "sk_id_curr", "requested_amount", "reason",
                         *[F.when(F.col("reason").isNull(), c).alias(name) for name, c in given.items()])


def drift_counts(events: DataFrame, edges: Sequence[float], watermark: str = "1 day",
                 window: str = "1 day") -> DataFrame:
    """R2 state: (window, bin) counts; bins are left-closed over the inner
    reference edges (a literal array of ≤ 11 values)."""
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]])
    v = F.col("value").cast("double")
    b = F.size(F.filter(inner, lambda e: e <= v))
    return (events.where(v.isNotNull() & ~F.isnan(v)).withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))


def window_psi(counts: DataFrame, reference_shares: DataFrame) -> DataFrame:
    """PSI per window from (w, bin, n) counts and (bin, r_share) reference
    shares (all bins listed, empty ones included)."""
    win = counts.groupBy("w").agg(F.sum("n").alias("y_n"))
    # every (window, bin): the bin list comes from the reference table (≤ 10 rows)
    bins = reference_shares.select(F.collect_list(F.struct("bin", "r_share")).alias("b"))
    full = win.withColumn("_k", F.lit(1)).join(F.broadcast(bins.withColumn("_k", F.lit(1))), "_k") \
        .select("w", "y_n", F.explode("b").alias("rb")).select("w", "y_n", "rb.bin", "rb.r_share")
    full = full.join(counts, ["w", "bin"], "left")
    ys = F.greatest(F.coalesce(F.col("n"), F.lit(0)) / F.col("y_n"), F.lit(SHARE_FLOOR))
    rs = F.greatest(F.col("r_share"), F.lit(SHARE_FLOOR))
    out = full.groupBy("w", "y_n").agg(F.sum((ys - rs) * F.log(ys / rs)).alias("psi"))
    return out.select(F.date_format(F.col("w.start"), "yyyy-MM-dd").alias("window_start"),
                      F.col("y_n").alias("rows"), "psi", verdict("psi").alias("verdict"))
