"""Plausibility bands around the per-entity median, and actual/forecast pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loadpanel.functions.columns import relative_error
from loadpanel.functions.quantiles import exact_quantiles
from loadpanel.scale import lookup_join, materialize, row_bound

# The chosen band and the bands it was weighed against.
BAND = (0.2, 3.0)
BANDS = ((0.1, 5.0), (0.2, 3.0), (0.3, 2.5), (0.5, 2.0))
MAX_RELATIVE_ERROR = 0.5


def entity_medians(obs: DataFrame, series: str = "D") -> DataFrame:
    """Median of the raw series per entity, bad rows included, computed once."""
    raw = obs.where(F.col("series_type") == series)
    medians = exact_quantiles(raw, ["entity_id"], "value", {"med": 0.5}, total=row_bound(obs))
    return materialize(medians, "medians")


def with_median(
    obs: DataFrame, series: str | None = "D", medians: DataFrame | None = None
) -> DataFrame:
    """Rows of one series (all series if None) with the ``D`` median of their entity."""
    medians = entity_medians(obs) if medians is None else medians
    rows = obs if series is None else obs.where(F.col("series_type") == series)
    return lookup_join(rows, medians, ["entity_id"], spread="ts_utc")


def in_band(lo: float, hi: float) -> Column:
    return F.col("value").between(F.col("med") * lo, F.col("med") * hi)


def plausible(
    obs: DataFrame,
    lo: float = BAND[0],
    hi: float = BAND[1],
    series: str | None = None,
    medians: DataFrame | None = None,
) -> DataFrame:
    """Rows above zero and within [lo, hi] times the median of their entity."""
    rows = with_median(obs, series, medians)
    return rows.where((F.col("value") > 0) & in_band(lo, hi)).select(*obs.columns)


def implausible_counts(
    obs: DataFrame, lo: float = BAND[0], hi: float = BAND[1], medians: DataFrame | None = None
) -> DataFrame:
    """Per entity: rows at or below zero, below the band, above it, and in all."""
    v, med = F.col("value"), F.col("med")
    return (
        with_median(obs, "D", medians)
        .groupBy("entity_id")
        .agg(
            F.count_if(v <= 0).alias("non_positive"),
            F.count_if((v > 0) & (v < med * lo)).alias("too_low"),
            F.count_if(v > med * hi).alias("too_high"),
            F.count("*").alias("total"),
        )
    )


def absolute_outliers(obs: DataFrame, limit: float = 500_000.0, series: str = "D") -> DataFrame:
    """Rows at or below zero or above an absolute limit, in key order."""
    bad = (F.col("value") <= 0) | (F.col("value") > limit)
    return (
        obs.where((F.col("series_type") == series) & bad)
        .select("entity_id", "ts_utc", "value")
        .orderBy("entity_id", "ts_utc")
    )


def band_sensitivity(
    obs: DataFrame,
    bands: Sequence[tuple[float, float]] = BANDS,
    medians: DataFrame | None = None,
) -> DataFrame:
    """Rows each band would remove, all bands in one pass over the data."""
    outside = [
        F.count_if((F.col("value") <= 0) | ~in_band(lo, hi)).alias(f"band{i}")
        for i, (lo, hi) in enumerate(bands)
    ]
    rows = [
        F.struct(
            F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.col(f"band{i}").alias("removed")
        )
        for i, (lo, hi) in enumerate(bands)
    ]
    return with_median(obs, "D", medians).agg(*outside).select(F.inline(F.array(*rows)))


def marginal_rows(
    obs: DataFrame,
    outer: tuple[float, float] = BANDS[0],
    inner: tuple[float, float] = BAND,
    medians: DataFrame | None = None,
) -> DataFrame:
    """Rows the inner band removes and the outer band keeps, by ratio to the median."""
    return (
        with_median(obs, "D", medians)
        .where(in_band(*outer) & ~in_band(*inner))
        .select(
            "entity_id",
            "ts_utc",
            "value",
            F.round("med").alias("median_mw"),
            F.round(F.try_divide("value", "med"), 3).alias("ratio"),
        )
        .orderBy("ratio", "entity_id", "ts_utc")
    )


def pair(
    obs: DataFrame,
    actual: str = "D",
    forecast: str = "DF",
    max_rel_err: float | None = None,
) -> DataFrame:
    """Hours that have both series, as (entity_id, ts_utc, actual, forecast).

    The key (entity, hour, series) is unique, so one grouped pass lines the two
    series up: the data are shuffled once, where a self-join would do it twice.
    ``max_rel_err`` keeps pairs whose relative error is below it.
    """
    is_actual, is_forecast = (F.col("series_type") == s for s in (actual, forecast))
    pairs = (
        obs.where(is_actual | is_forecast)
        .groupBy("entity_id", "ts_utc")
        .agg(
            F.max(F.when(is_actual, F.col("value"))).alias("actual"),
            F.max(F.when(is_forecast, F.col("value"))).alias("forecast"),
            F.bool_or(is_actual).alias("has_actual"),
            F.bool_or(is_forecast).alias("has_forecast"),
        )
        .where("has_actual and has_forecast")
        .drop("has_actual", "has_forecast")
    )
    if max_rel_err is None:
        return pairs
    return pairs.where(relative_error(F.col("actual"), F.col("forecast")) < max_rel_err)
