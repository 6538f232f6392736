"""Stratified, order-independent train / validation / test split.

Within each label stratum rows are ordered by (md5(id), id); the first round(test * n) are test, the next up to
round((test + valid) * n) are validation, the rest train. Depends on ids only, never on row order or partitioning.

No row is ranked or moved: the split is a comparison with two cut values a stratum. They are found by radix selection:
rows are counted by (label, next hex digits of the md5), the digits that hold the wanted rank are kept, and only rows
with that prefix are looked at again, until few enough are left to sort (1 / 65,536 of a stratum after one count).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.local import local_frame

TEST_SHARE = 0.20
VALID_SHARE = 0.20
SPLIT_NAMES = ("test", "validation", "train")
DIGITS = 4
ROWS_TO_SORT = 1_000_000


def _hash(id_col: str) -> Column:
    return F.md5(F.col(id_col).cast("string"))


def _wanted(counted: DataFrame, order: list[str], cuts: list[dict]) -> list[tuple[dict, dict]]:
    """For each cut the counted group (label, prefix, ..., n) that holds its rank, with the rows ``below`` it."""
    spark = counted.sparkSession
    ranks = local_frame(spark, [(i, c["stratum"], c["prefix"], c["rank"]) for i, c in enumerate(cuts)], "cut int, _s int, _p string, rank long")
    w = Window.partitionBy("_stratum", "_prefix").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    below = counted.withColumn("below", F.coalesce(F.sum("n").over(w), F.lit(0)))
    hit = below.join(F.broadcast(ranks), (F.col("_stratum") == F.col("_s")) & (F.col("_prefix") == F.col("_p"))
                     & (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
    return [(cuts[r["cut"]], r.asDict()) for r in hit.collect()]        # one row a cut


def cut_values(keys: DataFrame, id_col: str, label: str, shares: list[float], rows_to_sort: int = ROWS_TO_SORT) -> list[dict]:
    """For each label value and share the (hash, id) of the first row that is not among the first round(share * n): dicts
    of label, share number, ``hash`` and ``id`` (None: no row is before it), or ``all`` (every row is)."""
    spark = keys.sparkSession
    n = F.count(F.lit(1))
    strata = keys.groupBy(label).agg(n.alias("n"), *[F.round(n.cast("double") * F.lit(s)).cast("long").alias(f"r{i}") for i, s in enumerate(shares)]).collect()
    out = []
    for number, r in enumerate(strata):                                   # as many as label values
        for i in range(len(shares)):
            out.append({"label": r[label], "stratum": number, "share": i, "rank": r[f"r{i}"], "prefix": "", "hash": None, "id": None,
                        "all": r[f"r{i}"] >= r["n"]})
    names = local_frame(spark, [(number, r[label]) for number, r in enumerate(strata)], f"_stratum int, _label {keys.schema[label].dataType.simpleString()}")
    rows = keys.select(F.col(label).alias("_y"), F.col(id_col).alias("_id"), _hash(id_col).alias("_h")).join(
        F.broadcast(names), F.col("_y").eqNullSafe(F.col("_label"))).drop("_y", "_label")

    def of(wanted: list[dict]) -> DataFrame:
        """Rows whose hash starts as one of the cuts' prefixes."""
        some = local_frame(spark, sorted({(c["stratum"], c["prefix"]) for c in wanted}), "_s int, _prefix string")
        return rows.join(F.broadcast(some), (F.col("_stratum") == F.col("_s")) & F.col("_h").startswith(F.col("_prefix"))).drop("_s")

    open_ = [c for c in out if not c["all"] and c["rank"] > 0]
    while open_:
        following = F.expr(f"substring(_h, length(_prefix) + 1, {DIGITS})")
        counted = of(open_).groupBy("_stratum", "_prefix", following.alias("_next")).agg(n.alias("n"))
        few, deeper = [], []
        for cut, r in _wanted(counted, ["_next"], open_):
            cut["prefix"] += r["_next"]
            cut["rank"] -= r["below"]
            (few if r["n"] <= rows_to_sort or len(cut["prefix"]) == 32 else deeper).append(cut)
        if few:
            for cut, r in _wanted(of(few).withColumn("n", F.lit(1)), ["_h", "_id"], few):
                cut["hash"], cut["id"] = r["_h"], r["_id"]
        open_ = deeper
    return out


def _before(cut: dict, id_col: str, id_type) -> Column:
    if cut["all"] or cut["hash"] is None:
        return F.lit(cut["all"])
    return (_hash(id_col) < cut["hash"]) | ((_hash(id_col) == cut["hash"]) & (F.col(id_col) < F.lit(cut["id"]).cast(id_type)))


def stratified_split(df: DataFrame, id_col: str, label: str, test: float = TEST_SHARE, valid: float = VALID_SHARE,
                     out: str = "split", keys: DataFrame | None = None, rows_to_sort: int = ROWS_TO_SORT) -> DataFrame:
    """``df`` with its split. ``keys``: where ids and labels can be read more cheaply than from ``df`` (the same rows)."""
    keys = df if keys is None else keys
    cuts = cut_values(keys.select(id_col, label), id_col, label, [test, test + valid], rows_to_sort)
    split = F.lit(SPLIT_NAMES[2])
    for number in {c["stratum"] for c in cuts}:                           # as many as label values
        first, second = [c for c in cuts if c["stratum"] == number]
        own = (F.when(_before(first, id_col, df.schema[id_col].dataType), SPLIT_NAMES[0])
               .when(_before(second, id_col, df.schema[id_col].dataType), SPLIT_NAMES[1]).otherwise(SPLIT_NAMES[2]))
        split = F.when(F.col(label).eqNullSafe(F.lit(first["label"])), own).otherwise(split)
    return df.withColumn(out, split)
