"""Weight-of-evidence scorecard (M19–M28, M41, M42) as Spark jobs.

* Binning: numeric features get interpolated-decile pre-bins (exact quantiles
  per feature from one long-form job, right-closed, duplicate edges dropped);
  categorical features bin by level; NULL is always its own ``missing`` bin.
  Counts for every feature and bin come from ONE grouped aggregate over the
  long form.
* WOE = ln(good share / bad share) with 0.5 added to each bin count (keeps
  empty cells finite); IV = Σ (good share − bad share) · WOE; JS divergence.
* Levels of less than one per cent of the rows are pooled before anything is
  collected. Numeric bins are pooled to a monotone event rate (pool adjacent
  violators) by column expressions on the small bin table.
* The WOE transform is pure column expressions generated from the (bounded)
  bin table — no join, no shuffle.
* Correlation pruning uses ``ml.stat.Correlation`` (one pass, k×k matrix) and a
  greedy walk on the driver; the logistic fit is ``ml.LogisticRegression``.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.operators.histogram import attach_edges, quantile_edges

# Fixed values of the scorecard method.
IV_MIN, IV_MAX = 0.02, 0.60
IV_WEAK, IV_MEDIUM = 0.10, 0.30
CORRELATION_LIMIT = 0.75
SMOOTHING = 0.5
PDO, PDO_ODDS, PDO_POINTS = 20.0, 20.0, 600.0
MISSING = "missing"
POOLED = "*"            # the bin of all rare levels of a categorical feature
TREND_NOISE = 1e-12     # a covariance this small is rounding
RARE_SHARE = 0.01       # levels of a smaller share of the rows are rare
N_PREBINS = 10


def numeric_bin_label(idx: Column) -> Column:
    text = idx.cast("string")
    return F.concat(F.lit("q"), F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text))


def long_numeric(df: DataFrame, features: Sequence[str], id_col: str, label: str) -> DataFrame:
    return df.select(id_col, label, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [id_col, label], list(features), "feature", "value")


def long_categorical(df: DataFrame, features: Sequence[str], id_col: str, label: str) -> DataFrame:
    return df.select(id_col, label, *[F.col(f).cast("string").alias(f) for f in features]).unpivot(
        [id_col, label], list(features), "feature", "level")


def prebin_edges(train: DataFrame, numeric: Sequence[str], id_col: str, label: str, n_bins: int = N_PREBINS) -> DataFrame:
    """(feature, edges) — distinct interpolated quantile edges per feature."""
    return quantile_edges(long_numeric(train, numeric, id_col, label), "value", n_bins, ["feature"])


def frequent_levels(levels: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """(feature, level, _frequent): levels of at least ``share`` of their feature's rows, so at most 1 / share a feature
    however many there are. All others are pooled."""
    counts = levels.where(F.col("level").isNotNull()).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.groupBy("feature").agg(F.sum("_c").alias("_all"))                  # one row a feature
    kept = counts.join(F.broadcast(total), "feature").where(F.col("_c") >= F.lit(share) * F.col("_all"))
    return F.broadcast(kept.select("feature", "level", F.lit(True).alias("_frequent")))


def assign_bins(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], edges: DataFrame,
                id_col: str, label: str) -> DataFrame:
    """Long form (id, label, feature, bin, lower, upper) for every feature."""
    ln = attach_edges(long_numeric(df, numeric, id_col, label), edges, ["feature"])
    inner = F.slice(F.col("edges"), 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    idx = F.lit(1) + F.size(F.filter(inner, lambda e: e < F.col("value")))
    n_inner = F.size(inner)
    lower = F.when(idx == 1, F.lit(None).cast("double")).otherwise(F.element_at(inner, (idx - 1).cast("int")))
    upper = F.when(idx > n_inner, F.lit(None).cast("double")).otherwise(F.element_at(inner, idx.cast("int")))
    num = ln.select(
        id_col, label, "feature",
        F.when(F.col("value").isNull(), F.lit(MISSING)).otherwise(numeric_bin_label(idx)).alias("bin"),
        F.when(F.col("value").isNotNull(), lower).alias("lower"),
        F.when(F.col("value").isNotNull(), upper).alias("upper"),
    )
    if not categorical:
        return num
    levels = long_categorical(df, categorical, id_col, label)
    cat = levels.join(frequent_levels(levels), ["feature", "level"], "left").select(
        id_col, label, "feature",
        F.when(F.col("level").isNull(), F.lit(MISSING)).when(F.col("_frequent"), F.concat(F.lit("="), F.col("level"))).otherwise(F.lit(POOLED)).alias("bin"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
    )
    return num.unionByName(cat)


def woe_table(binned: DataFrame, label: str, smoothing: float = SMOOTHING) -> DataFrame:
    """Counts per (feature, bin) in one aggregate, then WOE and IV."""
    y = F.col(label).cast("long")
    return woe_of_counts(binned.groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.lit(1) - y).alias("good"),
        F.sum(y).alias("bad"),
        F.min("lower").alias("lower"),
        F.max("upper").alias("upper"),
    ), smoothing)


def woe_of_counts(t: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """Per (feature, bin) with n, good, bad: event rate, smoothed shares, WOE, IV part; the feature's IV and JS divergence
    (window over a few dozen rows per feature)."""
    w = Window.partitionBy("feature")
    k = F.count(F.lit(1)).over(w).cast("double")
    s = F.lit(smoothing)
    g_share = (F.col("good") + s) / (F.sum("good").over(w) + s * k)
    b_share = (F.col("bad") + s) / (F.sum("bad").over(w) + s * k)
    t = t.withColumns({"good_share": g_share, "bad_share": b_share})
    t = t.withColumns({
        "event_rate": F.col("bad") / F.col("n"),
        "woe": F.log(F.col("good_share") / F.col("bad_share")),
    })
    m = (F.col("good_share") + F.col("bad_share")) / 2
    t = t.withColumns({
        "iv_part": (F.col("good_share") - F.col("bad_share")) * F.col("woe"),
        "_js": 0.5 * F.col("good_share") * F.log(F.col("good_share") / m)
        + 0.5 * F.col("bad_share") * F.log(F.col("bad_share") / m),
    })
    return t.withColumns({"iv": F.sum("iv_part").over(w), "js": F.sum("_js").over(w)}).drop("_js")


def strength(iv: Column) -> Column:
    """IV strength label."""
    return F.when(iv < IV_WEAK, F.lit("weak")).when(iv < IV_MEDIUM, F.lit("medium")).otherwise(F.lit("strong"))


def iv_summary(woe: DataFrame) -> DataFrame:
    """One row per feature with IV, JS, bin count, strength, and the
    IV-range selection (too high is a leakage suspicion)."""
    s = woe.groupBy("feature").agg(F.max("iv").alias("iv"), F.max("js").alias("js"), F.count(F.lit(1)).alias("n_bins"))
    return s.withColumns({
        "strength": strength(F.col("iv")),
        "selected": (F.col("iv") >= IV_MIN) & (F.col("iv") <= IV_MAX),
    })


# --- monotone merge (small table) ---------------------------------------------

def monotone_merge(woe: DataFrame) -> DataFrame:
    """Numeric bins of each feature pooled until their event rate is monotone in the direction of its trend (pool adjacent
    violators): rows feature, bin, n, good, bad, lower, upper. Missing and categorical bins stay as they are.

    The fitted rate of bin i is the greatest, over a <= i, of the least, over b >= i, of the rate of bins a..b; adjacent
    bins of one fitted rate become one. That is arithmetic on at most (bins) cubed numbers a feature, in its own row."""
    numeric = woe.where(F.col("bin").startswith("q")).groupBy("feature").agg(F.sort_array(F.collect_list(F.struct(
        F.substring("bin", 2, 9).cast("int").alias("i"), "n", "good", "bad", "lower", "upper"))).alias("b"),
        F.covar_pop(F.substring("bin", 2, 9).cast("int"), F.col("bad") / F.col("n")).alias("trend"))
    sign = F.when(F.col("trend") < -TREND_NOISE, -1).otherwise(1)
    last = F.size("b") - 1

    def sums(c: str) -> Column:
        """Sums of the first 0, 1, ... bins."""
        return F.transform(F.sequence(F.lit(0), F.size("b")), lambda k: F.aggregate(
            F.slice("b", 1, k), F.lit(0).cast("long"), lambda acc, x: acc + x[c]))

    numeric = numeric.withColumns({"to_n": sums("n"), "to_bad": sums("bad")})

    def rate(a: Column, b: Column) -> Column:
        total = lambda c: F.get(F.col(f"to_{c}"), b + 1) - F.get(F.col(f"to_{c}"), a)
        return (sign * total("bad")).cast("double") / total("n")

    def fitted(i: Column) -> Column:
        return F.array_max(F.transform(F.sequence(F.lit(0), i), lambda a: F.array_min(F.transform(F.sequence(i, last), lambda b: rate(a, b)))))

    rows = numeric.withColumn("f", F.transform(F.sequence(F.lit(0), last), fitted)).withColumn(
        "x", F.explode(F.arrays_zip("b", "f"))).select("feature", "x.f", "x.b.*")
    ranked = rows.withColumn("k", F.dense_rank().over(Window.partitionBy("feature").orderBy("f")))      # a few rows a feature
    merged = ranked.groupBy("feature", numeric_bin_label(F.col("k")).alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
        F.min_by("lower", "i").alias("lower"), F.max_by("upper", "i").alias("upper"))
    rest = woe.where(~F.col("bin").startswith("q")).select("feature", "bin", "n", "good", "bad", "lower", "upper")
    return merged.unionByName(rest)


# --- transform --------------------------------------------------------------------

@dataclass
class BinMap:
    """Driver-side copy of the bin/WOE table (bounded: features × bins)."""
    rows: dict[str, list[dict]] = field(default_factory=dict)

    @classmethod
    def collect(cls, woe: DataFrame) -> BinMap:
        out: dict[str, list[dict]] = {}
        for r in woe.select("feature", "bin", "lower", "upper", "woe", "event_rate", "n").collect():
            out.setdefault(r["feature"], []).append(r.asDict())
        for f in out:
            out[f].sort(key=lambda d: (int(d["bin"][1:]) if d["bin"][1:].isdigit() and d["bin"][0] == "q" else 0, d["bin"]))
        return cls(out)

    def woe_column(self, feature: str, numeric: bool) -> Column:
        """WOE of a raw column as a CASE chain (rare or unseen level: the pooled bin's, 0 without one)."""
        rows = self.rows[feature]
        c = F.col(feature)
        miss = next((r["woe"] for r in rows if r["bin"] == MISSING), 0.0)
        expr = F.when(c.isNull(), F.lit(float(miss)))
        if numeric:
            num = [r for r in rows if r["bin"].startswith("q")]
            for r in num[:-1]:
                expr = expr.when(c.cast("double") <= F.lit(float(r["upper"])), F.lit(float(r["woe"])))
            if num:
                expr = expr.otherwise(F.lit(float(num[-1]["woe"])))
            return expr
        for r in rows:
            if r["bin"].startswith("="):
                expr = expr.when(c.cast("string") == F.lit(r["bin"][1:]), F.lit(float(r["woe"])))
        return expr.otherwise(F.lit(float(next((r["woe"] for r in rows if r["bin"] == POOLED), 0.0))))

    def transform(self, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str]) -> DataFrame:
        """Wide frame of WOE columns ``woe_<feature>``."""
        cols = [self.woe_column(f, True).alias(f"woe_{f}") for f in numeric if f in self.rows]
        cols += [self.woe_column(f, False).alias(f"woe_{f}") for f in categorical if f in self.rows]
        return df.select(*keep, *cols)


def correlation_prune(woe_df: DataFrame, ranked: Sequence[str], limit: float = CORRELATION_LIMIT) -> list[tuple]:
    """Visit features by IV (desc); drop one whose |r| with any kept feature
    exceeds ``limit``. One distributed pass builds the k×k Pearson matrix."""
    cols = [f"woe_{f}" for f in ranked]
    if not cols:
        return []
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="keep").transform(woe_df).select("_v")
    mat = Correlation.corr(vec, "_v").head()[0].toArray()
    kept: list[int] = []
    out = []
    for i, f in enumerate(ranked):
        r = [abs(mat[i, j]) for j in kept]
        worst = max(r) if r else 0.0
        if r and worst > limit:
            out.append((f, False, float(worst), ranked[kept[int(np.argmax(r))]]))
        else:
            kept.append(i)
            out.append((f, True, float(worst), None))
    return out


def fit_logit(woe_df: DataFrame, features: Sequence[str], label: str, n_rows: int, max_iter: int = 200):
    """L2 logistic regression equal to C=1 without class weights
    (regParam = 1/n, no standardisation). Without features the intercept is the
    log odds of the rows, which is the same fit; one class only: infinite."""
    if not features:
        y = woe_df.agg(F.sum(F.col(label).cast("double")).alias("bad"), F.count(label).alias("n")).first()
        if not y["n"]:
            raise ValueError("no rows to fit")
        good = y["n"] - y["bad"]
        return math.log(y["bad"] / good) if y["bad"] and good else math.inf if y["bad"] else -math.inf, {}
    cols = [f"woe_{f}" for f in features]
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(woe_df).select(
        "features", F.col(label).cast("double").alias("label"))
    lr = LogisticRegression(regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=1e-8)
    model = lr.fit(data)
    return float(model.intercept), dict(zip(features, [float(x) for x in model.coefficients.toArray()]))


def sign_repair(woe_df: DataFrame, features: Sequence[str], label: str, n_rows: int, max_rounds: int = 200):
    """Refit, dropping the largest positive coefficient each round, until
    all coefficients are negative (stop at two features). Returns
    (kept, intercept, coefficients, rounds, dropped)."""
    kept = list(features)
    dropped = []
    intercept, coefs = fit_logit(woe_df, kept, label, n_rows)
    rounds = 0
    while rounds < max_rounds:
        positive = {f: c for f, c in coefs.items() if c > 0}
        if not positive or len(kept) <= 2:
            break
        worst = max(positive, key=positive.get)
        kept.remove(worst)
        dropped.append(worst)
        rounds += 1
        intercept, coefs = fit_logit(woe_df, kept, label, n_rows)
    return kept, intercept, coefs, rounds, dropped


def pdo_factor(pdo: float = PDO) -> float:
    return pdo / math.log(2.0)


def pdo_offset(pdo: float = PDO, odds: float = PDO_ODDS, points: float = PDO_POINTS) -> float:
    return points - pdo_factor(pdo) * math.log(odds)


def points_table(bins: DataFrame, intercept: float, coefs: dict[str, float]) -> DataFrame:
    """Points per bin = −(β·WOE + α/n)·factor + offset/n (high = low risk). A scorecard without features has no rows."""
    n = max(len(coefs), 1)
    factor, offset = pdo_factor(), pdo_offset()
    beta = F.create_map(*[x for f, c in coefs.items() for x in (F.lit(f), F.lit(c))]).cast("map<string,double>")
    t = bins.where(F.col("feature").isin(list(coefs))).withColumn("coefficient", beta[F.col("feature")])
    pts = -(F.col("coefficient") * F.col("woe") + F.lit(intercept / n)) * F.lit(factor) + F.lit(offset / n)
    return t.withColumn("points", pts)


def score_columns(woe_df: DataFrame, intercept: float, coefs: dict[str, float]) -> DataFrame:
    """Logit, probability and total points per row."""
    logit = F.lit(intercept)
    for f, c in coefs.items():
        logit = logit + F.lit(c) * F.col(f"woe_{f}")
    factor, offset = pdo_factor(), pdo_offset()
    return woe_df.withColumns({
        "logit": logit,
        "probability": F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)),
        "points": F.lit(offset) - F.lit(factor) * logit,
    })


# M27 (total) as a contract of the scored customers: on validation rows points must not rise with default by more than chance
# allows (one-sided 5 % of a correlation's standard error, 1/sqrt(n), which vanishes as rows grow). Constant points or labels
# have no direction and pass. Written without a division by the deviations.
DIRECTION_NOISE = 1.645
_VALID = "FILTER (WHERE split = 'validation')"
DIRECTION_HOLDS = (
    f"coalesce(covar_pop(points, CAST(target AS DOUBLE)) {_VALID}, 0D) * sqrt(count(points) {_VALID}) <= "
    f"{DIRECTION_NOISE} * coalesce(stddev_pop(points) {_VALID} * stddev_pop(target) {_VALID}, 0D)")


def direction_audit(points: DataFrame) -> DataFrame:
    """M27 (per variable): corr(event rate, points) over real bins (no missing,
    n > 0, at least 2 bins) must be negative."""
    real = points.where((F.col("bin") != MISSING) & (F.col("n") > 0))
    a = real.groupBy("feature").agg(F.try_divide(F.covar_pop("event_rate", "points"), F.stddev_pop("event_rate") * F.stddev_pop("points")).alias("direction_corr"),
                                    F.count(F.lit(1)).alias("bins"))
    a = a.where(F.col("bins") >= 2)
    return a.withColumn("status", F.when(F.col("direction_corr") < 0, "correct")
                        .when(F.col("direction_corr").isNull(), "flat").otherwise("reversed"))


def points_bands(scored: DataFrame, label: str, n_bands: int = 10) -> DataFrame:
    """M28 + M42: equal-width bands of total points over the observed range
    (right-closed, lowest included) with size and default rate; the range and
    mean come with every row."""
    rng = scored.agg(F.min("points").alias("lo"), F.max("points").alias("hi"), F.avg("points").alias("mean_points"))
    d = scored.select("points", label).withColumn("_k", F.lit(1)).join(
        F.broadcast(rng.withColumn("_k", F.lit(1))), "_k")          # one-row side
    width = (F.col("hi") - F.col("lo")) / n_bands
    raw = F.ceil((F.col("points") - F.col("lo")) / width)
    band_no = F.when(width == 0, F.lit(1)).otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(n_bands)))
    return d.groupBy(band_no.alias("band"), "lo", "hi", "mean_points").agg(
        F.count(F.lit(1)).alias("applications"),
        F.avg(F.col(label).cast("double")).alias("default_rate"),
    ).select("band", (F.col("lo") + (F.col("band") - 1) * (F.col("hi") - F.col("lo")) / n_bands).alias("band_low"),
             (F.col("lo") + F.col("band") * (F.col("hi") - F.col("lo")) / n_bands).alias("band_high"),
             "applications", "default_rate", F.col("lo").alias("min_points"), F.col("hi").alias("max_points"),
             "mean_points")


def contributions(scored: DataFrame, coefs: dict[str, float], means: dict[str, float]) -> DataFrame:
    """Exact additive contributions β·(WOE − mean WOE) per feature, as an
    array of (feature, contribution, woe) structs; Σ = logit − mean logit."""
    arr = F.array(*[F.struct(F.lit(f).alias("feature"),
                             (F.lit(c) * (F.col(f"woe_{f}") - F.lit(means[f]))).alias("contribution"),
                             F.col(f"woe_{f}").alias("woe")) for f, c in coefs.items()])
    return scored.withColumn("contribs", arr.cast("array<struct<feature:string,contribution:double,woe:double>>"))


def top_reasons(contrib: Column, k: int) -> Column:
    """Q2: the k largest |contribution| per row (array sort, no explode)."""
    keyed = F.transform(contrib, lambda x: F.struct(F.abs(x["contribution"]).alias("abs"), x.alias("c")))
    ordered = F.array_sort(keyed, lambda a, b: F.when(a["abs"] > b["abs"], -1).when(a["abs"] < b["abs"], 1)
                           .otherwise(F.when(a["c"]["feature"] < b["c"]["feature"], -1).otherwise(1)))
    top = F.slice(ordered, 1, k)
    return F.transform(top, lambda x: F.struct(
        x["c"]["feature"].alias("feature"), x["c"]["contribution"].alias("contribution"),
        F.when(x["c"]["contribution"] > 0, F.lit("raises risk")).otherwise(F.lit("lowers risk")).alias("direction"),
        x["c"]["woe"].alias("woe")))


# --- M41 funnel, J3 ranks -----------------------------------------------------------

def selection_funnel(stages: Sequence[tuple[str, Sequence[str]]]) -> list[tuple]:
    """(step, stage, features left, features that the step removed) for each stage. A stage that holds a feature which
    the one before does not is an error."""
    out, before = [], None
    for step, (stage, features) in enumerate(stages):
        left = set(features)
        if before is not None and left - before:
            raise ValueError(f"{stage}: not in the stage before: {sorted(left - before)}")
        out.append((step, stage, len(left), sorted(before - left) if before is not None else []))
        before = left
    return out


def rank_features(importance: DataFrame, value: str, rank: str) -> DataFrame:
    """Rank 1, 2, ... by ``value``, largest first, equal ones by name. One row per feature."""
    return importance.withColumn(rank, F.row_number().over(Window.orderBy(F.desc(value), "feature")))


def rank_disagreement(contribution: DataFrame, gain: DataFrame) -> DataFrame:
    """Features by contribution rank beside their gain rank, counted from 1 among the same features, and ``disagreement``,
    the gain rank less the contribution rank. Both sides hold one row per feature."""
    both = contribution.join(gain, "feature", "left")
    among = F.row_number().over(Window.orderBy(F.asc_nulls_last("gain_rank"), "feature"))
    both = both.withColumn("gain_rank_here", F.when(F.col("gain_rank").isNotNull(), among))
    return both.withColumn("disagreement", F.col("gain_rank_here") - F.col("contribution_rank"))
