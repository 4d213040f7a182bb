"""Mixing sources to target weights by entropy balancing.

Among all document rates with the wanted number of words per source and no rate
above ``cap``, those of least relative entropy to "every document once" are
``min(cap, exp(lam * size / mean))`` with one multiplier ``lam`` per source. The
multipliers are the root of a monotone function (the gradient of the convex
dual), found for all sources together by Newton steps inside a bracket. Rates
become whole copies by systematic rounding over the documents ordered by size,
and the few words still missing or left over are settled by single copies.

Everything is DataFrame operations. Sums are decimal, so reruns agree exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadpanel.scale import lookup_join, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
# Rows that are ranked together when some documents of one size get a copy more than others.
RANKED = 100_000
MAX_STEPS = 80
TOLERANCE = 1e-9
EXACT = "decimal(36,9)"


def _source_key() -> Column:
    """Sorts like the source by code point, null last; never null itself."""
    return F.when(F.col("source").isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), F.col("source").cast("string")))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as one column, beside its source, size and a fixed pseudo-random order."""
    return docs.select(
        F.struct("*").alias("row"),
        _source_key().alias("skey"),
        word_count().alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("order"),
    )


def _weighted(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """The weights in turn over the sources in order, without one task for all sources."""
    ranged = materialize(
        sources.repartitionByRange("skey").withColumn("part", F.spark_partition_id()), "mix-sources"
    )
    sizes = ranged.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("part").orderBy("skey")) - 1 + F.col("before")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return (
        ranged.join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
        .withColumn("weight", F.element_at(turn, (place % len(weights) + 1).cast("int")))
        .drop("part", "before")
    )


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Adds each source's ``target``: a share by weight of ``share`` times all words, at most ``cap`` times its own.

    What a full source cannot take is shared again by weight among the others,
    until none is above its limit.
    """
    table = materialize(_weighted(sources, weights), "mix-weights")
    limit = F.col("source_size") * float(cap)
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        # Sources whose limit is below the level are full; the rest share what remains.
        is_full = limit <= F.col("weight") * F.lit(level)
        n, used, rest = table.agg(
            F.coalesce(F.sum(is_full.cast("long")), F.lit(0)),
            F.sum(F.when(is_full, F.col("source_size")).otherwise(0)),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight")).cast(EXACT)),
        ).first()
        if n == full or not rest:
            return table.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))
        full, level = n, (total - used * float(cap)) / float(rest)


def _rate(cap: int) -> Column:
    tilted = F.exp(F.col("lam") * F.col("size") / F.col("mean"))
    return F.when(F.col("all_capped"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), tilted))


def multipliers(groups: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """One multiplier per source: Newton steps on the dual, by bisection where a step leaves the bracket.

    Raises if a source has not settled after ``MAX_STEPS``, some twenty more than it takes to halve a bracket of
    doubles to nothing.
    """
    size, target = F.col("source_size").cast("double"), F.col("target")
    idle = (size == 0) | (target <= 0)
    state = sources.select(
        "skey",
        "source_size",
        "target",
        (F.col("source_size") / F.col("docs")).alias("mean"),
        (target >= size * cap * (1 - 1e-12)).alias("all_capped"),
        F.lit(0.0).alias("lam"),
        # x * exp(lam * x) is at most 1 / (-lam * e), which bounds the root from below;
        # beyond the upper end every document with words is at the cap.
        F.when(idle, 0.0).otherwise(-size / (target * math.e)).alias("lo"),
        F.when(idle, 0.0)
        .otherwise(math.log(cap) * F.col("source_size") / F.col("docs") / F.col("smallest"))
        .alias("hi"),
    )
    state = materialize(state, "mix-state")
    for _ in range(MAX_STEPS):
        rate = _rate(cap)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            lookup_join(groups, state.select("skey", "lam", "mean", "all_capped"), ["skey"], spread="size")
            .filter("size > 0")
            .groupBy("skey")
            .agg(F.sum(words.cast(EXACT)).cast("double").alias("g"), F.sum(slope.cast(EXACT)).cast("double").alias("h"))
        )
        off = F.col("g") - F.col("target")
        # A bracket that doubles cannot halve any more is as near as they come.
        closed = F.col("hi") - F.col("lo") <= 4e-16 * F.greatest(F.abs("lo"), F.abs("hi"))
        settled = F.col("all_capped") | F.col("g").isNull() | (F.abs(off) <= F.col("target") * TOLERANCE) | closed
        lo, hi = F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.when(F.col("h") > 0, F.col("lam") - off / F.nullif(F.col("h"), F.lit(0.0)))
        inside = step.isNotNull() & (step > F.col("lo2")) & (step < F.col("hi2"))
        moved = (
            state.join(sums, "skey", "left")
            .withColumns({"settled": settled, "lo2": lo, "hi2": hi})
            .withColumn(
                "lam", F.when(F.col("settled"), F.col("lam")).when(inside, step).otherwise((F.col("lo2") + F.col("hi2")) / 2)
            )
        )
        moved = moved.select(
            "skey", "source_size", "target", "mean", "all_capped", "lam",
            F.when(F.col("settled"), F.col("lo")).otherwise(F.col("lo2")).alias("lo"),
            F.when(F.col("settled"), F.col("hi")).otherwise(F.col("hi2")).alias("hi"),
            "settled",
        )
        state = materialize(moved, "mix-state")
        if state.filter("not settled").isEmpty():
            break
        state = state.drop("settled")
    else:
        raise RuntimeError(f"{MAX_STEPS} steps did not settle every source's rate")
    return state.select("skey", "source_size", "target", "mean", "all_capped", "lam")


def _settle(groups: DataFrame, cap: int) -> DataFrame:
    """One copy more or less in each source where that brings its words nearer to the target."""
    by_source = Window.partitionBy("skey")
    off = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(by_source)
    sign = F.when(F.col("off") > 0, 1).otherwise(-1)
    can = F.when(sign > 0, F.col("copies") < F.col("n") * cap).otherwise(F.col("copies") > 0)
    left = F.abs(F.col("off") - sign * F.col("size"))
    better = can & (F.col("size") > 0) & (left < F.abs(F.col("off")))
    first = F.row_number().over(by_source.orderBy(F.col("left").asc_nulls_last(), "size")) == 1
    return (
        groups.withColumn("off", off)
        .withColumn("left", F.when(better, left))
        .withColumn("copies", F.col("copies") + F.when(F.col("left").isNotNull() & first, sign).otherwise(0))
        .drop("off", "left")
    )


def copies_by_size(groups: DataFrame, state: DataFrame, cap: int = CAP) -> DataFrame:
    """How many copies the documents of each (source, size) get together.

    Windows run over the distinct sizes of a source, not over its documents.
    """
    rated = lookup_join(groups, state, ["skey"], spread="size").withColumn("rate", _rate(cap))
    upto = Window.partitionBy("skey").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    share = (F.col("n") * F.col("rate")).cast(EXACT)
    total = F.floor(F.sum(share).over(upto) + F.lit("0.5").cast(EXACT)).cast("long")
    before = F.lag("upto", 1, 0).over(Window.partitionBy("skey").orderBy("size"))
    out = rated.withColumn("upto", total).withColumn("copies", F.col("upto") - before).drop("upto")
    for _ in range(3):
        out = _settle(out, cap)
    return out.select("skey", "size", "n", "source_size", "target", "rate", "copies")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    ranked: int = RANKED,
) -> DataFrame:
    """The rows of ``docs`` (as struct ``row``) with size, source_size, target, rate, copies and taken.

    ``size`` counts the words of the whole text; a null text has none, and a
    document without words keeps one copy, which takes nothing. A null source is a
    source of its own, the last in order. Columns of ``docs`` other than doc_id,
    text and source are only carried along. Repeated rows count as often as they
    occur. Without rows, no rows.
    """
    rows = _rows(docs)
    groups = materialize(rows.groupBy("skey", "size").agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    sources = groups.groupBy("skey").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.sum("n").alias("docs"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"),
    )
    sources = materialize(targets(sources, weights, share, cap), "mix-targets")
    state = multipliers(groups, sources, cap)
    plan = copies_by_size(groups, state, cap)
    plan = materialize(
        plan.withColumn("base", F.floor(F.col("copies") / F.col("n")).cast("long"))
        .withColumn("more", F.col("copies") - F.col("base") * F.col("n"))
        .withColumn("buckets", F.ceil(F.col("n") / ranked).cast("long"))
        .drop("copies"),
        "mix-plan",
    )
    known = lookup_join(rows, plan, ["skey", "size"], spread="order")
    even = known.filter("more = 0").withColumn("copies", F.col("base"))
    # Of n documents of one size ``more`` get a copy more: each bucket its share of them, inside it by rank.
    odd = known.filter("more > 0").withColumn("bucket", F.pmod("order", "buckets"))
    counted = odd.groupBy("skey", "size", "bucket", "more", "n").agg(F.count(F.lit(1)).alias("held"))
    upto = F.sum("held").over(
        Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    part = lambda reached: F.floor(reached.cast(EXACT) * F.col("more") / F.col("n")).cast("long")
    shares = materialize(
        counted.withColumn("upto", upto).select(
            "skey", "size", "bucket", (part(F.col("upto")) - part(F.col("upto") - F.col("held"))).alias("bucket_more")
        ),
        "mix-shares",
    )
    odd = lookup_join(odd, shares, ["skey", "size", "bucket"], spread="order")
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bucket").orderBy("order"))
    odd = odd.withColumn("copies", F.col("base") + (rank <= F.col("bucket_more")).cast("long"))
    columns = ["row", "size", "source_size", "target", "rate", "copies"]
    both = even.select(*columns).unionByName(odd.select(*columns))
    return both.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it has copies."""
    repeated = mix(docs).filter("copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeated.select("row.*")
