"""Exact order statistics per group, for groups of any size.

Spark's ``percentile`` is exact but keeps every distinct value of a group in one
buffer. It is used for groups known to be small. In a larger group the wanted
ranks are bracketed: each round counts rows in equal-width value bins
(combined map-side, so a round ships bins and not rows) and keeps the bin that
holds the rank, until a bracket is small enough to be counted value by value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loadpanel.scale import groups_within, is_small, lookup_join, materialize

GROUP_ROWS = 500_000
BINS = 8192

_V = "_value"
INFINITY = float("inf")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    group_rows: int = GROUP_ROWS,
    bins: int = BINS,
    total: int | None = None,
) -> DataFrame:
    """One row per group with the interpolated quantiles in ``probs`` (name -> p).

    NULL and NaN do not count; a group with nothing else gets NULL quantiles.
    Infinite values rank at the ends. ``total`` is an upper bound of the rows of
    ``df``, if known, and may save a count.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    base = df.select(*keys, F.when(~F.isnan(number), number).alias(_V))
    if groups_within(base, keys, group_rows, total):
        return _buffered(base, keys, probs)
    # Every round below reads the values again.
    base = materialize(base, "quantile-values")
    finite = F.when(_finite(), F.col(_V))
    sizes = base.groupBy(*keys).agg(
        F.count(_V).alias("n"),
        F.min(finite).alias("lo"),
        F.max(finite).alias("hi"),
        F.count_if(F.col(_V) == -INFINITY).alias("n_low"),
        F.count_if(F.col(_V) == INFINITY).alias("n_high"),
    )
    # Each has more than group_rows rows, so there cannot be many of them.
    large = materialize(sizes.where(F.col("n") > group_rows), "large-groups")
    rest = base.join(_side(large.select(*keys), is_small(large)), keys, "left_anti")
    return _buffered(rest, keys, probs).unionByName(_bracketed(base, large, keys, probs, group_rows, bins))


def _finite() -> Column:
    return (F.col(_V) > -INFINITY) & (F.col(_V) < INFINITY)


def _side(table: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(table) if small else table


def _buffered(base: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    wanted = F.percentile(_V, [float(p) for p in probs.values()])
    return base.groupBy(*keys).agg(wanted.alias("q")).select(
        *keys, *[F.col("q")[i].alias(name) for i, name in enumerate(probs)]
    )


def _bracketed(
    base: DataFrame,
    groups: DataFrame,
    keys: list[str],
    probs: Mapping[str, float],
    group_rows: int,
    bins: int,
) -> DataFrame:
    values = base.where(_finite())
    ranks = F.array_distinct(
        F.flatten(F.array(*[F.array(_below(p), _above(p)) for p in probs.values()]))
    )
    # One row per wanted rank: the bracket [lo, hi], the rows of the group below
    # it, and the rows inside it.
    ranked = groups.select("*", F.explode(ranks).alias("rank"))
    low, high = F.col("rank") < F.col("n_low"), F.col("rank") >= F.col("n") - F.col("n_high")
    # Infinite values stand at the ends; a rank among them is settled at once.
    end = F.when(low, -INFINITY).when(high, INFINITY)
    state = ranked.select(
        *keys,
        "rank",
        F.coalesce(end, "lo").alias("lo"),
        F.coalesce(end, "hi").alias("hi"),
        F.col("n_low").alias("below"),
        (F.col("n") - F.col("n_low") - F.col("n_high")).alias("inside"),
    )
    wide = (F.col("inside") > group_rows) & (F.col("lo") < F.col("hi"))
    while state.where(wide).limit(1).count():
        state = materialize(
            state.where(~wide).unionByName(_narrow(values, state.where(wide), keys, bins)),
            "quantile-brackets",
        )
    by_rank = (
        _read_off(values, state, keys)
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    )
    return groups.join(by_rank, keys).select(
        *keys, *[_interpolate(p).alias(name) for name, p in probs.items()]
    )


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("n") - 1)


def _below(p: float) -> Column:
    return F.floor(_position(p)).cast("long")


def _above(p: float) -> Column:
    return F.ceil(_position(p)).cast("long")


def _interpolate(p: float) -> Column:
    pos, lo, hi = _position(p), F.col("at")[_below(p)], F.col("at")[_above(p)]
    return F.when((_below(p) == _above(p)) | (lo == hi), lo).otherwise(
        (_above(p) - pos) * lo + (pos - _below(p)) * hi
    )


def _inside(values: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Each value with the bracket it falls in (the brackets of a group are disjoint)."""
    return lookup_join(values, brackets, keys, spread=_V).where(F.col(_V).between(F.col("lo"), F.col("hi")))


def _pick(state: DataFrame, counted: DataFrame, bracket: list[str], order: str) -> DataFrame:
    """Join each rank to the run of rows, in ``order`` inside its bracket, that holds it."""
    upto = W.partitionBy(*bracket).orderBy(order)
    runs = counted.withColumn("upto", F.sum("rows").over(upto))
    offset = F.col("rank") - F.col("below")
    return state.join(runs, bracket).where(
        (offset < F.col("upto")) & (offset >= F.col("upto") - F.col("rows"))
    )


def _narrow(values: DataFrame, state: DataFrame, keys: list[str], bins: int) -> DataFrame:
    bracket = [*keys, "lo", "hi"]
    # Halved before subtracting, so that the width of the widest bracket is finite.
    share = F.try_divide(F.col(_V) / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2)
    # Neighbouring tiny numbers have no width when halved. In any case the least and
    # the largest value fall into different bins, so that every round shrinks.
    place = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("long")
    ends = F.when(F.col(_V) >= F.col("hi"), bins - 1).when(F.col(_V) <= F.col("lo"), 0)
    counted = (
        _inside(values, state.select(*bracket).distinct(), keys)
        .withColumn("bin", F.coalesce(ends.cast("long"), place, F.lit(0).cast("long")))
        .groupBy(*bracket, "bin")
        .agg(F.count("*").alias("rows"), F.min(_V).alias("bin_lo"), F.max(_V).alias("bin_hi"))
    )
    return _pick(state, counted, bracket, "bin").select(
        *keys,
        "rank",
        F.col("bin_lo").alias("lo"),
        F.col("bin_hi").alias("hi"),
        (F.col("below") + F.col("upto") - F.col("rows")).alias("below"),
        F.col("rows").alias("inside"),
    )


def _read_off(values: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    bracket = [*keys, "lo", "hi"]
    single = state.where("lo = hi").select(*keys, "rank", F.col("lo").alias("v"))
    spread = state.where("lo < hi")
    counted = (
        _inside(values, spread.select(*bracket).distinct(), keys)
        .groupBy(*bracket, _V)
        .agg(F.count("*").alias("rows"))
    )
    picked = _pick(spread, counted, bracket, _V).select(*keys, "rank", F.col(_V).alias("v"))
    return single.unionByName(picked)
