"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

Every source has a token target: its weight's share of all tokens, at most ``max_repeats``
times its size; what that leaves over is shared out again by weight. A source's documents
are dealt by hash into shards of about ``shard_tokens`` tokens, so that a source that holds
most rows is many shards. Within a shard the documents, in hash order, form one token axis,
cut into n = ceil(size / B) blocks whose lengths differ by one token at most. B is the same
in all shards of a source: at most a 64th of its target and of its size, so that rounding
costs small sources and small targets no more of their share than large ones.

Sainte-Lague: a source with target t holds the quotients t / (k + 1/2), k = 0, 1, ...; the
highest quotients win a block each, down to the divisor, its blocks' mean length, which
gives N blocks the integer quota floor(N * t / size + 1/2). Its shards, in order, share it
by the same rule: what N counts up to a shard, less what it counts before. A source at its
cap takes every block ``max_repeats`` times. A shard's quota of q on n blocks takes every
block q // n times, and q mod n of them, those first in a seeded order, once more. So no
block and no document is taken more than ``max_repeats`` times, and a rerun takes the same.

Null or wordless text: size 0, never taken. Null source: a source of its own, last in
order. Null doc_id and repeated rows keep a row each; rows alike in doc_id share a place in
the order. No tokens at all: all targets 0. Empty table: no rows.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import stored


#: Least number of blocks that make up a source, and its target.
FINENESS = 64


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_repeats: int = 3
    shard_tokens: int = 250_000
    least_block: int = 64
    most_blocks: int = 1 << 22
    seed: str = "mix"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(*parts: Column) -> Column:
    """A whole number below 2^48 from md5 (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 12), 16, 10).cast("long")


def source_targets(per_source: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``per_source`` (source, source_size: one row per source) with weight and target."""
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(w) for w in mix.weights])
    weighed = (
        per_source.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(mix.weights)))))
        .withColumn("cap", F.lit(mix.max_repeats) * F.col("source_size"))
    )
    # in order of cap / weight, the first sources stop at their caps and the others share the rest by weight
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    leveled = weighed.withColumn("_level", level).withColumn("_free", F.col("cap") > F.col("weight") * F.col("_level"))
    common = F.min(F.when(F.col("_free"), F.struct(F.col("cap") / F.col("weight"), F.col("_level").alias("level")))).over(every)
    return leveled.withColumn(
        "target", F.when(F.col("_free"), F.col("weight") * common["level"]).otherwise(F.col("cap").cast("double"))
    ).select("source", "source_size", "weight", "target")


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` (doc_id, text, source, any other columns but the text) with size, source_size, target and taken."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("text", "size", "source_size", "target", "taken") and not c.startswith("_mix_")]
    seed = F.lit(mix.seed)
    sized = stored(docs.select(*kept, n_tokens(F.col("text")).alias("size"),
                               _hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_mix_hash")))
    targets = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), mix))
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    widest = max(mix.least_block, -(-total // mix.most_blocks))

    shards_of = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / F.lit(mix.shard_tokens)))
    dealt = (
        sized.join(targets.select(F.col("source").alias("_mix_source"), "source_size", "target"),
                   F.col("source").eqNullSafe(F.col("_mix_source")))
        .withColumn("_mix_shard", F.pmod(F.col("_mix_hash"), shards_of))
        .drop("_mix_source")
    )
    shard = ["source", "_mix_shard"]
    block = F.greatest(F.lit(1).cast("long"), F.least(
        F.lit(widest).cast("long"), F.floor(F.col("source_size") / FINENESS), F.floor(F.col("target") / FINENESS)))
    share = F.col("target") / F.greatest(F.col("source_size"), F.lit(1).cast("long"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("_mix_shard"))
    shards = stored(
        dealt.groupBy(*shard).agg(F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
        .withColumn("n", F.ceil(F.col("shard_size") / block))
        .withColumn("upto", upto)
        .withColumn("quota", F.floor(share * F.col("upto") + 0.5) - F.floor(share * (F.col("upto") - F.col("n")) + 0.5))
        .withColumn("every", F.when(F.col("n") > 0, F.floor(F.col("quota") / F.col("n"))).otherwise(F.lit(0).cast("long")))
        .select(*shard, "shard_size", "n", "every", (F.col("quota") - F.col("every") * F.col("n")).alias("more")))
    axis = Window.partitionBy(*shard).orderBy("_mix_hash", "doc_id", "size")
    placed = stored(
        dealt.join(shards.select(F.col("source").alias("_s"), F.col("_mix_shard").alias("_h"), F.col("shard_size").alias("_mix_size"),
                                 F.col("n").alias("_mix_blocks"), F.col("every").alias("_mix_all"), F.col("more").alias("_mix_more")),
                   F.col("source").eqNullSafe(F.col("_s")) & (F.col("_mix_shard") == F.col("_h"))).drop("_s", "_h")
        .withColumn("_mix_end", F.sum("size").over(axis.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_mix_start", F.col("_mix_end") - F.col("size")))
    seeded = Window.partitionBy(*shard).orderBy("draw", "b")
    drawn = (
        shards.where("more > 0")
        .withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("draw", _hash(seed, F.lit("block"), F.coalesce("source", F.lit("")), F.col("_mix_shard").cast("string"),
                                  F.col("b").cast("string")))
        .repartition(*shard)  # a shard's blocks are made in few tasks from one row each: deal them anew
        .withColumn("place", F.row_number().over(seeded))
        .where("place <= more")
        .select(F.col("source").alias("_s"), F.col("_mix_shard").alias("_h"), "b")
    )
    touched = (
        placed.where((F.col("size") > 0) & (F.col("_mix_more") > 0))
        .select(*shard, "_mix_start", "_mix_end", "_mix_size", "_mix_blocks",
                F.expr("explode(sequence(((_mix_start + 1) * _mix_blocks - 1) div _mix_size, (_mix_end * _mix_blocks - 1) div _mix_size))").alias("b"))
        .withColumn("begin", F.expr("(b * _mix_size) div _mix_blocks"))
        .withColumn("end", F.expr("((b + 1) * _mix_size) div _mix_blocks"))
    )
    again = (
        touched.alias("t").join(drawn.hint("merge").alias("d"), (F.col("t.b") == F.col("d.b")) & (F.col("_mix_shard") == F.col("_h"))
                                & F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("words", F.least("_mix_end", "end") - F.greatest("_mix_start", "begin"))
        .groupBy(F.col("source").alias("_s"), F.col("_mix_shard").alias("_h"), F.col("_mix_start").alias("_p"))
        .agg(F.sum("words").alias("_more"))
    )
    return (
        placed.join(again.hint("merge"), (F.col("_mix_start") == F.col("_p")) & (F.col("_mix_shard") == F.col("_h"))
                    & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") > 0), "left")
        .withColumn("taken", F.col("_mix_all") * F.col("size") + F.coalesce("_more", F.lit(0).cast("long")))
        .select(*kept, "size", "source_size", "target", "taken")
    )
