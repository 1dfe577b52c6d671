"""Mixing sources to target weights by entropy balancing (native Spark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightloom.operators.graph import forget

from .common import WORD, checkpointed, table

#: Fraction bits of the fixed-point copy rates, so that their running sums are exact.
BITS = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Add ``target`` to a table of one row per source (``_key``, ``source``, ``source_size``).

    Sources by code point, null last, take the weights in turn. ``share`` of all sizes is dealt out by
    weight; no target exceeds ``cap`` times its source, the excess going to the others by weight. In the
    order of size per weight that is one running sum: a source is full if the level that fills those
    before it and it leaves it at its cap. The table has one row per source, not per document.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sources.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    by_level = W.orderBy(F.col("_cap") / F.col("_weight"), "_key")
    rest = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(1))
    w = w.withColumns(
        {"_left": F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)), "_weights": F.sum("_weight").over(rest)}
    ).withColumn("_level", F.greatest(F.col("_left"), F.lit(0.0)) / F.col("_weights"))
    # The level at the first source that is not full holds for all behind it.
    full = F.col("_cap") <= F.col("_level") * F.col("_weight")
    level = F.min(F.when(~full, F.struct(F.col("_cap") / F.col("_weight"), "_key", F.col("_level").alias("level")))).over(whole)["level"]
    return w.withColumn("target", F.when(full, F.col("_cap")).otherwise(F.least("_cap", level * F.col("_weight")))).drop("_weight", "_cap", "_left", "_weights", "_level")


def balance(classes: DataFrame, sources: DataFrame, cap: float, steps: int, tolerance: float) -> DataFrame:
    """Solve the dual: one multiplier per source with sum(n * size * rate) equal to the target.

    The rates minimise the relative entropy to one copy each, bounded by 0 and ``cap``; so rate / (cap - rate)
    is exp(lambda * size / mean size) times what makes a rate of 1 at lambda 0. The dual is convex with
    one equation per source. Every Newton step is one aggregate of gradient and curvature over the classes;
    a step that leaves the bracket known to hold the root is replaced by its middle. A source is solved when it is within ``tolerance`` of its
    target, or within what fixed-point sums can tell (2^-20 words a document). ``steps`` halvings are more than doubles can tell apart,
    so not to be done by then is an error, not a result.
    """
    ratio = F.try_divide("target", "source_size")
    state = sources.select(
        "_key", "source_size", "target", "_docs", (F.col("source_size") / F.col("_docs")).alias("_mean"),
        F.lit(0.0).alias("_lambda"), F.lit(-(2.0**20)).alias("_low"), F.lit(2.0**20).alias("_high"),
        ((F.col("source_size") == 0) | (ratio >= cap) | (ratio <= 0)).alias("_done"),
    )
    state = checkpointed(state)
    before = state
    for _ in range(steps):
        rate = tilted(F.col("size"), F.col("_lambda"), F.col("_mean"), cap)
        sums = classes.join(state.filter("not _done").select("_key", "_lambda", "_mean"), "_key").groupBy("_key").agg(
            exact_sum(F.col("_n") * F.col("size") * rate).alias("_got"),
            exact_sum(F.col("_n") * F.col("size") * F.col("size") / F.col("_mean") * rate * (1 - rate / F.lit(float(cap)))).alias("_slope"),
        )
        gap = F.col("target") - F.col("_got")
        near = F.abs(gap) <= tolerance * F.col("target") + F.col("_docs") * F.lit(2.0**-20)
        low = F.when(gap > 0, F.col("_lambda")).otherwise(F.col("_low"))
        high = F.when(gap > 0, F.col("_high")).otherwise(F.col("_lambda"))
        most = F.greatest(F.lit(8.0), F.abs("_lambda"))  # a flat dual must not throw the multiplier far off
        newton = F.col("_lambda") + F.greatest(-most, F.least(most, gap / F.greatest(F.col("_slope"), F.lit(1e-6))))
        state = state.join(sums, "_key", "left").withColumns({"_low2": low, "_high2": high, "_newton": newton}).select(
            "_key", "source_size", "target", "_docs", "_mean",
            F.when(F.col("_done") | near, F.col("_lambda"))
            .when((F.col("_newton") > F.col("_low2")) & (F.col("_newton") < F.col("_high2")), F.col("_newton"))
            .otherwise((F.col("_low2") + F.col("_high2")) / 2).alias("_lambda"),
            F.col("_low2").alias("_low"), F.col("_high2").alias("_high"),
            (F.col("_done") | near).alias("_done"),
        )
        state = checkpointed(state)
        forget(before)
        before = state
        if state.filter("not _done").isEmpty():
            return state
    raise ArithmeticError(f"no multipliers after {steps} steps for the sources {[r['_key'] for r in state.filter('not _done').select('_key').take(5)]}")


def exact_sum(x: Column) -> Column:
    """A sum that does not depend on its order: each term is rounded to a fixed point first."""
    return (F.sum(F.round(x * F.lit(2.0**20)).cast("decimal(38,0)")) / F.lit(2.0**20)).cast("double")


def tilted(size: Column, lam: Column, mean: Column, cap: float) -> Column:
    """The rate of a document: ``cap`` / (1 + (cap - 1) * exp(-lambda * size / mean)); 1 at lambda 0."""
    return F.lit(float(cap)) / (1 + F.lit(cap - 1.0) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.try_divide(-lam * size, mean)))))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, steps: int = 120, tolerance: float = 1e-9) -> DataFrame:
    """Document copies that bring each source to its share: doc_id, source, size, source_size, target, rate, copies, taken.

    Rates come from :func:`balance`. They are rounded by systematic sampling: in each source documents
    stand by size, longest first, and a document gets one more copy where the running sum of the fractional
    rates passes a half; so the words taken miss the target by less than the longest document. Running sums
    are kept per class (source, size), per hash bucket of a class, and per row of a bucket; about sqrt(rows)
    buckets keep each such window to about sqrt(rows) rows even if one source, or one size in it, holds a third of all.

    Null texts and texts without a word have size 0 and take nothing. A null source is a source of its own.
    Null or repeated ids and repeated rows each count as documents of their own; which of several equal
    rows gets an odd copy does not show. Empty tables give empty results. Reruns agree: nothing is random. Other columns of ``docs`` are left out; a text's length
    matters only through its words, which are counted in place.
    """
    key = F.coalesce(F.concat(F.lit("+"), F.col(source).cast("string")), F.lit("-"))
    rows = checkpointed(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key.alias("_key")))
    classes = checkpointed(rows.groupBy("_key", "source", "size").agg(F.count("*").alias("_n")))
    sources = classes.groupBy("_key", "source").agg(F.sum(F.col("_n") * F.col("size")).alias("source_size"), F.sum("_n").alias("_docs"))
    sources = checkpointed(source_targets(sources, weights, share, float(cap)))
    solved = balance(classes, sources, float(cap), steps, tolerance)

    ratio = F.try_divide("target", "source_size")
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).when(ratio >= cap, F.lit(float(cap))).when(ratio <= 0, F.lit(0.0)).otherwise(tilted(F.col("size"), F.col("_lambda"), F.col("_mean"), float(cap)))
    rate = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.least(F.lit(float(cap)), rate))
    one = 1 << BITS
    fixed = F.round(F.col("rate") * one).cast("bigint")
    by_size = W.partitionBy("_key").orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, -1)
    rated = (
        classes.join(solved.select("_key", "source_size", "target", "_lambda", "_mean"), "_key")
        .withColumn("rate", rate)
        .withColumn("_whole", F.shiftright(fixed, BITS))
        .withColumn("_part", fixed - F.col("_whole") * one)
        .withColumn("_start", F.coalesce(F.sum(F.col("_n") * F.col("_part")).over(by_size), F.lit(0)))
        .select("_key", "size", "source_size", "target", "rate", "_whole", "_part", "_start")
    )
    n_rows = classes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    n_buckets = max(1, int(n_rows**0.5))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets)))
    buckets = dealt.groupBy("_key", "size", "_bucket").agg(F.count("*").alias("_m"))
    ahead = W.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.withColumn("_ahead", F.coalesce(F.sum("_m").over(ahead), F.lit(0))).drop("_m").join(rated, ["_key", "size"])
    within = W.partitionBy("_key", "size", "_bucket").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id")
    ranked = dealt.withColumn("_rank", F.row_number().over(within)).join(starts, ["_key", "size", "_bucket"])
    upto = lambda k: F.shiftright(F.col("_start") + k * F.col("_part") + F.lit(one // 2), BITS)
    k = F.col("_ahead") + F.col("_rank")
    copies = (F.col("_whole") + upto(k) - upto(k - 1)).cast("int")
    return ranked.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
