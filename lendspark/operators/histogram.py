"""Ordered statistics without a global sort in one task.

``cumulative_below`` is the one primitive behind ranking metrics, exact
quantiles and the split: given an already aggregated histogram (one row per
key group and distinct order value) it returns, for every row, the sums of the
measures over the rows of the same group with a *smaller* order value, and the
group totals.

Two phases, both distributed:
1. range buckets: ~``n_buckets`` approximate quantiles of the order value
   (``percentile_approx``, a bounded array on the driver) cut the histogram
   into buckets of similar size (``Bucketizer`` does a binary search JVM-side);
   per (group, bucket) totals are a small table whose running sums give each
   bucket's offset;
2. inside one (group, bucket) a window ordered by the value adds the local
   running sum. No window ever runs without a partition key on raw rows, and a
   hot value is a single histogram row however many input rows it had.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.local import local_frame

BUCKET = "_range_bucket"


ROWS_PER_BUCKET = 1_000_000     # target histogram rows per window partition
MAX_BUCKETS = 200_000           # edges collected to the driver: ≤ 1.6 MB


def _edges(hist: DataFrame, order: str, n_buckets: int, accuracy: int) -> tuple[int, list[float]]:
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = hist.agg(F.count(F.lit(1)).alias("n"),
                   F.percentile_approx(F.col(order).cast("double"), probs, accuracy).alias("e")).first()
    edges = sorted({float(x) for x in (row["e"] or []) if x is not None and not math.isnan(x)})
    return int(row["n"] or 0), edges


def _range_buckets(hist: DataFrame, order: str, n_buckets: int, accuracy: int) -> DataFrame:
    """Bucket the histogram by approximate quantiles of ``order``. The bucket
    count grows with the histogram (one more pass only when the first guess
    would leave more than ROWS_PER_BUCKET rows per bucket)."""
    n_rows, edges = _edges(hist, order, n_buckets, accuracy)
    wanted = min(MAX_BUCKETS, math.ceil(n_rows / ROWS_PER_BUCKET))
    if wanted > n_buckets:
        _, edges = _edges(hist, order, wanted, max(accuracy, 10 * wanted))
    if not edges:
        return hist.withColumn(BUCKET, F.lit(0.0))
    splits = [-math.inf] + edges + [math.inf]
    tmp = "_range_order_d"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep")
    return b.transform(hist.withColumn(tmp, F.col(order).cast("double"))).drop(tmp)


def cumulative_below(hist: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str],
                     n_buckets: int = 256, accuracy: int = 20000) -> DataFrame:
    """Adds ``{m}_below`` (sum over strictly smaller ``order`` in the group) and
    ``{m}_total`` for each measure. ``hist`` must be unique on keys + order.

    ``n_buckets`` range buckets split every key group; use 1 only when the key
    groups themselves bound the rows per window partition (e.g. one bootstrap
    replicate of a histogram already known to be small)."""
    keys = list(keys)
    if n_buckets <= 1:
        if not keys:
            raise ValueError("a single bucket needs key groups to partition the window")
        w_keys = Window.partitionBy(*keys)
        w_prev = w_keys.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        w_all = w_keys.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return hist.select(
            *hist.columns,
            *[F.coalesce(F.sum(m).over(w_prev), F.lit(0)).alias(f"{m}_below") for m in measures],
            *[F.sum(m).over(w_all).alias(f"{m}_total") for m in measures],
        )
    b = _range_buckets(hist, order, n_buckets, accuracy)
    per_bucket = b.groupBy(*keys, BUCKET).agg(*[F.sum(m).alias(f"_bk_{m}") for m in measures])
    w_keys = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w_prev = w_keys.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys, BUCKET,
        *[F.coalesce(F.sum(f"_bk_{m}").over(w_prev), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_bk_{m}").over(w_keys.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
          .alias(f"{m}_total") for m in measures],
    )
    # One row per (group, bucket): bounded by groups × n_buckets; AQE broadcasts
    # it when its runtime size is under the threshold, else it is a shuffle join.
    joined = b.join(offsets, [*keys, BUCKET], "inner")
    w_local = Window.partitionBy(*keys, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = joined.select(
        *[c for c in b.columns if c != BUCKET],
        *[(F.col(f"_off_{m}") + F.coalesce(F.sum(m).over(w_local), F.lit(0))).alias(f"{m}_below") for m in measures],
        *[F.col(f"{m}_total") for m in measures],
    )
    return out


BRACKETS_PER_OCTAVE = 256
SUB_BRACKETS = 4096
ROWS_TO_SORT = 1_000_000        # rows of one bracket that a task may sort


def _bracket(v: Column) -> Column:
    """An order-preserving whole number of a double: sign, binary exponent and the first bits of the mantissa. Equal
    brackets are neighbours; ``log2`` may err by one next to a power of two, which the clamp keeps in order."""
    a = F.abs(v)
    e = F.floor(F.log2(a))
    m = F.floor((a / F.pow(F.lit(2.0), e) - 1.0) * BRACKETS_PER_OCTAVE)
    code = (e + 1100) * BRACKETS_PER_OCTAVE + F.least(F.greatest(m, F.lit(0)), F.lit(BRACKETS_PER_OCTAVE - 1)) + 1
    code = F.when(a == float("inf"), F.lit(1 << 40)).otherwise(code)
    return F.when(v == 0, F.lit(0)).when(v > 0, code).otherwise(-code).cast("long")


def _hits(counted: DataFrame, group: Sequence[str], order: str, probs: Sequence[float], first: bool) -> DataFrame:
    """Of counted brackets (or values) those that hold a wanted rank, with the number of rows ``below`` them."""
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    below = F.coalesce(F.sum("n").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = counted.withColumn("_inside", below)
    if first:
        t = t.withColumns({"_total": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "_below": F.lit(0)})
    t = t.withColumn("below", F.col("_below") + F.col("_inside"))
    last = F.col("_total") - 1
    covered = lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n"))
    ranks = [r for p in probs for r in (F.floor(F.lit(float(p)) * last), F.least(F.floor(F.lit(float(p)) * last) + 1, last))]
    wanted = None
    for r in ranks:
        wanted = covered(r) if wanted is None else wanted | covered(r)
    return t.where(wanted).drop("_inside", "_below")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                    rows_to_sort: int = ROWS_TO_SORT) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``percentile`` / SQL ``quantile_cont``) per key group: rows
    (keys..., q_index, prob, quantile). NULL and NaN are ignored; a group without values has no row.

    Selection instead of sorting: one pass counts the rows of each bracket (order-preserving, computed from the value
    alone, so partial sums meet in a small shuffle); only rows of the brackets that hold a wanted rank are looked at
    again, and only where a bracket has different values. Brackets of more than ``rows_to_sort`` rows are cut finer
    first. No pass exchanges all (key, value) pairs. The driver sees at most two brackets for each key group and
    probability; key groups are models, features or scenarios, not rows."""
    spark, keys, probs = df.sparkSession, list(keys), [float(p) for p in probs]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, (v + F.lit(0.0)).alias("_v")).withColumn("_b", _bracket(F.col("_v")))
    stats = [F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    found = _hits(rows.groupBy(*keys, "_b").agg(*stats), keys, "_b", probs, True)
    schema = T.StructType([f for f in found.schema.fields if f.name in [*keys, "_b", "_lo", "_hi", "_total"]] + [T.StructField("_below", T.LongType())])
    values: dict[tuple, list] = {}                       # key group -> (first rank, ranks, value)
    totals: dict[tuple, int] = {}

    def settle(hits: list) -> list:
        """Keeps the brackets of one value, returns the others."""
        open_ = []
        for r in hits:
            k = tuple(r[c] for c in keys)
            totals[k] = r["_total"]
            if r["_lo"] == r["_hi"]:
                values.setdefault(k, []).append((r["below"], r["n"], r["_lo"]))
            else:
                open_.append(r)
        return open_

    def rows_of(hits: list) -> DataFrame:
        table = local_frame(spark, [tuple(r["below"] if f.name == "_below" else r[f.name] for f in schema.fields) for r in hits], schema)
        other = table.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(keys)], F.col("_b").alias("_wb"),
                             F.col("_lo").alias("_wlo"), F.col("_hi").alias("_whi"), "_total", "_below")
        on = (F.col("_b") == F.col("_wb")) & F.col("_v").between(F.col("_wlo"), F.col("_whi"))
        for i, c in enumerate(keys):
            on &= F.col(c).eqNullSafe(F.col(f"_w{i}"))
        return rows.join(F.broadcast(other), on)          # two brackets a probability and key group at most

    open_ = settle(found.collect())
    while open_:
        big, small = [r for r in open_ if r["n"] > rows_to_sort], [r for r in open_ if r["n"] <= rows_to_sort]
        if small:
            each = rows_of(small).groupBy(*keys, "_b", "_wlo", "_total", "_below", "_v").agg(F.count(F.lit(1)).alias("n"))
            settle(_hits(each.withColumns({"_lo": F.col("_v"), "_hi": F.col("_v")}), [*keys, "_b", "_wlo"], "_v", probs, False).collect())
        open_ = []
        if big:
            part = F.floor((F.col("_v") - F.col("_wlo")) / (F.col("_whi") - F.col("_wlo")) * SUB_BRACKETS)
            cut = rows_of(big).withColumn("_part", part).groupBy(*keys, "_b", "_wlo", "_total", "_below", "_part").agg(*stats)
            open_ = settle(_hits(cut, [*keys, "_b", "_wlo"], "_part", probs, False).collect())

    def at(k: tuple, rank: int) -> float:
        return next(x for first, n, x in values[k] if first <= rank < first + n)

    out = []
    for k, total in totals.items():
        for i, p in enumerate(probs):
            h = p * (total - 1)
            low = math.floor(h)
            a, b = at(k, low), at(k, min(low + 1, total - 1))
            out.append((*k, i, p, a if h == low else a + (h - low) * (b - a)))
    fields = [f for f in rows.schema.fields if f.name in keys]
    fields += [T.StructField("q_index", T.IntegerType()), T.StructField("prob", T.DoubleType()), T.StructField("quantile", T.DoubleType())]
    return local_frame(spark, out, T.StructType(fields))


def quantile_edges(df: DataFrame, value: str, n_bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct quantile edges at 0, 1/n, ..., 1 per key group:
    rows (keys..., edges array<double>)."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(df, value, probs, keys)
    return q.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("edges"))


def attach_edges(df: DataFrame, edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Put each group's edge array on its rows. Without keys the single edge
    row is inlined as a literal (bounded: one array of n_bins+1 doubles);
    with keys it is a join to a table of one row per group."""
    keys = list(keys)
    if not keys:
        row = edges.first()
        arr = [float(x) for x in (row["edges"] if row else [])]
        return df.withColumn("edges", F.array(*[F.lit(x) for x in arr]).cast("array<double>"))
    return df.join(F.broadcast(edges), keys, "left")


def qcut_index(value: str, edges: str = "edges") -> F.Column:
    """Equal-frequency bucket (1-based) with right-closed bins, lowest edge
    included: 1 + number of inner edges strictly below the value; NULL for a
    NULL value."""
    inner = F.slice(F.col(edges), 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.when(F.col(value).isNotNull(), F.lit(1) + F.size(F.filter(inner, lambda e: e < F.col(value))))


def histogram_bin(value: str, edges: str = "edges") -> F.Column:
    """Left-closed bin index (0-based) over edges whose ends are ±inf."""
    inner = F.slice(F.col(edges), 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e <= F.col(value)))
