"""Streaming queries (R1–R3), run to completion with ``availableNow`` over the
event table; each returns the sink's contents as a DataFrame (rows-only)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.operators import conformance as conf
from lendspark.operators import fairness as fair
from lendspark.operators import profit as prof
from lendspark.operators import quality
from lendspark.operators import scorecard as sc
from lendspark.operators.histogram import quantile_edges
from lendspark.plans.artefacts import published
from lendspark.plans.oracle import fx
from lendspark.plans.q_audit import customer_split, sql_customer_split
from lendspark.plans.q_scorecard import CATEGORICAL, NUMERIC, fit_scorecard
from lendspark.plans.registry import query
from lendspark.sources import fixtures
from lendspark.sources.tables import column_roles, read_table
from lendspark.streaming import scoring as st

REFERENCE_END = "2024-01-08"     # events before this instant form the drift reference


def _events_path(sf_dir: str) -> str:
    return sf_dir.rstrip("/")


def scorecard_cutoff(spark: SparkSession, sf_dir: str) -> float:
    """The scorecard's published cut-off: highest profit on validation customers."""
    def build() -> DataFrame:
        amounts = customer_split(spark, sf_dir).select("sk_id_curr", "amt_credit")
        valid = fit_scorecard(spark, sf_dir).frame.where(F.col("split") == "validation").join(amounts, "sk_id_curr")
        curve = prof.profit_curve(valid.withColumn("model", F.lit("scorecard")), ["model"], "probability", "target", "amt_credit")
        return prof.best_threshold(curve, ["model"])

    return published(spark, sf_dir, "scorecard_policy", build, key="model").first()["best_threshold"]


def scorer(spark: SparkSession, sf_dir: str):
    """(customers with their features, requests and watermark -> judged and scored requests)."""
    card = fit_scorecard(spark, sf_dir)
    customers = customer_split(spark, sf_dir).drop("target")
    features = [c for c in customers.columns if c not in ("sk_id_curr", "split")]
    train = customers.where(F.col("split") == "train")
    checked = [r["column_name"] for r in quality.missing_rates(train, features).collect()           # one row a feature
               if r["missing_rate"] < quality.RARE_NULL_RATE]
    used = sorted({*checked, *card.kept})
    static, bmap, cut = customers.select("sk_id_curr", *used), sc.BinMap.collect(card.bins), scorecard_cutoff(spark, sf_dir)

    def score(requests: DataFrame, watermark=None) -> DataFrame:
        return st.score_requests(st.judge(requests, static, watermark), bmap, NUMERIC, CATEGORICAL, card.intercept, card.coefs,
                                 card.means, checked, cut)

    return static, score


ARRIVALS = 3        # the stand-in requests come in three deliveries


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests through the stream, delivery by delivery; every run starts again from the checkpoint of the last."""
    inbox, sink = st.scratch(spark, "requests"), st.RequestSink(spark, st.scratch(spark, "stream-score"), scorer(spark, sf_dir)[1])
    requests = fixtures.load(spark, sf_dir, "requests").withColumn("ts", F.col("ts").cast("timestamp"))
    for n in range(ARRIVALS):
        requests.where(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(inbox)
        sink.run(st.read_requests(spark, inbox))
    return sink.results()


def stream_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's results, published once; a request that was judged twice would break the contract."""
    return published(spark, sf_dir, "stream_results", lambda: score_stream(spark, sf_dir), key="event_id", contracts={
        "rejected requests have a reason": f"count_if((status = '{st.REJECTED}') <> (reason IS NOT NULL)) = 0"})


def sql_judged() -> str:
    return fx("fx_requests", "fx_application") + """,
seen AS (SELECT arrival, max(ts) AS latest FROM fx_requests GROUP BY arrival),
marks AS (SELECT a.arrival, max(b.latest) - INTERVAL 1 DAY AS mark FROM seen a LEFT JOIN seen b ON b.arrival < a.arrival GROUP BY a.arrival),
judged AS (
  SELECT r.*, CASE WHEN c.sk_id_curr IS NULL THEN 'unknown customer' WHEN requested_amount IS NULL OR isnan(requested_amount) THEN 'missing requested amount'
    WHEN r.ts < mark THEN 'late' END AS reason
  FROM fx_requests r JOIN marks USING (arrival) LEFT JOIN fx_application c ON c.sk_id_curr = r.sk_id_curr
)"""


@query("stream_score", "R1,P16,M37,M38,J5")
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_results(spark, sf_dir).where(F.col("status") == st.ACCEPTED).drop("status", "reason", "batch_id")


@query("stream_rejects", "R3,S5,P25", sql=lambda: sql_judged() + """
SELECT event_id, sk_id_curr, requested_amount, reason FROM judged WHERE reason IS NOT NULL""")
def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_results(spark, sf_dir).where(F.col("status") == st.REJECTED).select("event_id", "sk_id_curr", "requested_amount", "reason")


@query("stream_requests", "R1,R3", sql=lambda: sql_judged() + """
SELECT CAST(arrival AS INTEGER) AS batch_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, coalesce(reason, 'none') AS reason,
  count(*) AS requests, count(DISTINCT event_id) AS events FROM judged GROUP BY ALL""")
def q_stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch accepted and rejected."""
    rows = stream_results(spark, sf_dir)
    return rows.groupBy(F.col("batch_id").cast("int").alias("batch_id"), "status", F.coalesce("reason", F.lit("none")).alias("reason")).agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("event_id").alias("events"))


# --- P25: requests that bring their own features ---------------------------------------

GIVEN = 10          # features that the scanty stand-in requests bring


def request_features(spark: SparkSession, sf_dir: str) -> list[str]:
    roles = column_roles(customer_split(spark, sf_dir).drop("split"), "sk_id_curr", "target")
    return fair.compliant_features(sorted(roles["numeric"] + roles["bool"] + roles["categorical"]))


def feature_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, conf.RequestSchema]:
    """Stand-in requests (event_id, features): the customer's features as text; some empty, some with a name that no model
    knows, some with few features."""
    s, names = customer_split(spark, sf_dir), request_features(spark, sf_dir)
    roles = column_roles(s.select(*names), "", "")
    schema = conf.RequestSchema.of_training(s.where(F.col("split") == "train"), sorted(roles["numeric"] + roles["bool"]), sorted(roles["categorical"]),
                                            "sk_id_curr", "target")
    full = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    few = F.create_map(*[x for n in names[:GIVEN] for x in (F.lit(n), F.col(n).cast("string"))])
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    features = (F.when(F.col("event_id") % 7 == 0, none).when(F.col("event_id") % 11 == 0, F.map_concat(few, F.create_map(F.lit("made_up_column"), F.lit("1"))))
                .when(F.col("event_id") % 5 == 1, few).otherwise(full))
    events = read_table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("sk_id_curr"))
    return events.join(s.select("sk_id_curr", *names), "sk_id_curr").select("event_id", features.alias("features")), schema


def sql_request_conformance() -> str:
    from lendspark.plans.oracle import describe

    cols = [c for c in describe(sql_customer_split() + "\nSELECT * EXCLUDE (sk_id_curr, target, split) FROM msplit")]
    names = fair.compliant_features(sorted(c for c, _ in cols))
    text = [c for c, kind in cols if kind == "VARCHAR" and c in names]
    number = [c for c in names if c not in text]
    return sql_customer_split() + f""",
ord AS (SELECT unnest([{', '.join(f"'{n}'" for n in names)}]) AS feature, unnest(range({len(names)})) AS place),
tr AS (SELECT * FROM msplit WHERE split = 'train'),
rates AS (UNPIVOT (SELECT {', '.join(f'avg(CAST({n} IS NULL AS DOUBLE)) AS {n}' for n in names)} FROM tr) ON {', '.join(names)} INTO NAME feature VALUE rate),
checked AS (SELECT feature, place FROM rates JOIN ord USING (feature) WHERE rate < 0.02),
lc AS (SELECT * FROM (SELECT {', '.join(text)} FROM tr) UNPIVOT (level FOR feature IN ({', '.join(text)}))),
known AS (SELECT feature, level FROM (SELECT feature, level, count(*) AS c, sum(count(*)) OVER (PARTITION BY feature) AS a FROM lc GROUP BY feature, level) WHERE c >= {sc.RARE_SHARE!r} * a),
cells AS (
  SELECT sk_id_curr, feature, is_null = 1 AS is_null FROM (SELECT sk_id_curr, {', '.join(f'CAST({n} IS NULL AS INTEGER) AS {n}' for n in number)} FROM msplit)
    UNPIVOT (is_null FOR feature IN ({', '.join(number)}))
  UNION ALL
  SELECT t.sk_id_curr, t.feature, k.level IS NULL FROM (SELECT * FROM (SELECT sk_id_curr, {', '.join(text)} FROM msplit)
    UNPIVOT INCLUDE NULLS (level FOR feature IN ({', '.join(text)}))) t LEFT JOIN known k ON k.feature = t.feature AND k.level = t.level
),
per AS (SELECT sk_id_curr, count_if(is_null) AS full_nulls, count_if(is_null OR place >= {GIVEN}) AS few_nulls FROM cells JOIN checked USING (feature) GROUP BY sk_id_curr),
judged AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'empty request' WHEN event_id % 11 = 0 THEN 'unknown features: made_up_column' END AS reason,
    CASE WHEN event_id % 5 = 1 THEN few_nulls ELSE full_nulls END AS n
  FROM events JOIN per ON sk_id_curr = user_id
)
SELECT event_id, reason, CASE WHEN reason IS NULL THEN CAST(n AS INTEGER) END AS unexpected_nulls,
  CASE WHEN reason IS NULL THEN CASE WHEN n > 30 THEN 'low' WHEN n > 8 THEN 'medium' ELSE 'high' END END AS confidence,
  reason IS NULL AND n > 30 AS manual_review
FROM judged"""


@query("request_conformance", "P25,M37,P20", sql=sql_request_conformance)
def q_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests judged and typed; with too few of the features that training always had, no automatic decision is made."""
    requests, schema = feature_requests(spark, sf_dir)
    train = customer_split(spark, sf_dir).where(F.col("split") == "train")
    checked = [r["column_name"] for r in quality.missing_rates(train, schema.names).collect() if r["missing_rate"] < quality.RARE_NULL_RATE]
    out = quality.confidence(conf.conform(requests, "features", schema), checked)
    ok = F.col("reason").isNull()
    return out.select("event_id", "reason", F.when(ok, F.size("unexpected_nulls")).alias("unexpected_nulls"), F.when(ok, F.col("confidence")).alias("confidence"),
                      (ok & (F.col("confidence") == "low")).alias("manual_review"))


def drift_reference(spark: SparkSession, sf_dir: str):
    ev = read_table(spark, sf_dir, "events").where(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz"))
    edges_row = quantile_edges(ev, "value", 10).first()                         # ≤ 11 values
    edges = [float(x) for x in edges_row["edges"]] if edges_row else []
    inner = F.array(*[F.lit(e) for e in edges[1:-1]])
    v = F.col("value").cast("double")
    counts = ev.where(v.isNotNull() & ~F.isnan(v)).groupBy(F.size(F.filter(inner, lambda e: e <= v)).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("c"))
    n_bins = max(len(edges) - 1, 1)
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))   # the bin ids of the edge set
    total = F.sum(F.coalesce("c", F.lit(0))).over(Window.partitionBy(F.lit(0)))     # ≤ 10 rows
    shares = bins.join(counts, "bin", "left").select("bin", (F.coalesce("c", F.lit(0)) / total).alias("r_share"))
    return edges, shares


def sql_stream_psi() -> str:
    from lendspark.plans.q_scoring import deciles, sql_verdict

    probs = ", ".join(repr(p) for p in deciles(10))
    return f"""WITH ev AS (SELECT * FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
ref AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{REFERENCE_END}'),
pe AS (SELECT list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges FROM ref),
rc AS (SELECT len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin, count(*) AS c FROM ref, pe GROUP BY 1),
bins AS (SELECT CAST(unnest(range(0, len(edges) - 1)) AS BIGINT) AS bin FROM pe),
rs AS (SELECT bins.bin, CAST(coalesce(c, 0) AS DOUBLE) / sum(coalesce(c, 0)) OVER () AS r_share FROM bins LEFT JOIN rc USING (bin)),
yc AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin,
              count(*) AS n FROM ev, pe GROUP BY 1, 2),
yn AS (SELECT day, sum(n) AS y_n FROM yc GROUP BY day),
fl AS (SELECT yn.day, yn.y_n, rs.bin, rs.r_share, coalesce(yc.n, 0) AS n FROM yn CROSS JOIN rs LEFT JOIN yc ON yc.day = yn.day AND yc.bin = rs.bin),
ps AS (SELECT day, y_n, sum((greatest(n / y_n, 1e-6) - greatest(r_share, 1e-6)) * ln(greatest(n / y_n, 1e-6) / greatest(r_share, 1e-6))) AS psi
       FROM fl GROUP BY day, y_n)
SELECT day AS window_start, CAST(y_n AS BIGINT) AS rows, psi, {sql_verdict()} AS verdict FROM ps"""


@query("stream_psi", "R2,M13,M14", sql=sql_stream_psi)
def q_stream_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, shares = drift_reference(spark, sf_dir)
    counts = st.drift_counts(st.read_event_stream(spark, _events_path(sf_dir)), edges)
    out = st.scratch(spark, "stream-psi")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out + "/data")

    q = (counts.writeStream.outputMode("update").option("checkpointLocation", out + "/_checkpoint")
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()
    raw = spark.read.parquet(out + "/data")
    latest = raw.groupBy("w", "bin").agg(F.max_by("n", "batch_id").alias("n"))      # last update wins
    return st.window_psi(latest, shares)
