"""Quantile sketches: small summaries that merge, with a stated error of rank.

A declared option for panels whose exact quantiles cost too much, and for quantiles of many periods: sketches are
stored per (entity, month), and any span of months is a merge of those, without reading a row again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Size of a sketch: it keeps some three times as many values, whatever the number of rows.
K = 2048


def rank_error(k: int = K) -> float:
    """How far, as a share of the rows, the rank of a found value may be from the wanted one, in 99 of 100 cases.

    The published bound of KLL sketches.
    """
    return 2.296 / k**0.9723


def _value(value: str) -> Column:
    """The values that count: neither null nor NaN, as for exact quantiles."""
    number = F.col(value).cast("double")
    return F.when(~F.isnan(number), number)


def monthly_sketches(df: DataFrame, value: str, k: int = K, keys: Sequence[str] = ("entity_id",), ts: str = "ts_utc") -> DataFrame:
    """keys, month, sketch, n, lo and hi of every month; sketches combine before the shuffle.

    Months without a value have no row.
    """
    known = df.select(*keys, F.trunc(ts, "month").alias("month"), _value(value).alias("_v")).where("_v is not null")
    return known.groupBy(*keys, "month").agg(
        F.kll_sketch_agg_double("_v", k).alias("sketch"), F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    )


def merged(sketches: DataFrame, keys: Sequence[str] = ("entity_id",), k: int = K) -> DataFrame:
    """One sketch for each key from those of its months, wherever they were made."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def quantiles_of(sketches: DataFrame, probs: Mapping[str, float], keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """The quantiles in ``probs`` (name -> p) of each sketch: values that occur, 0 and 1 exactly the ends."""
    ends = {0.0: F.col("lo"), 1.0: F.col("hi")}
    found = {name: ends.get(float(p), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))) for name, p in probs.items()}
    return sketches.select(*keys, *[column.alias(name) for name, column in found.items()])


def sketched_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], k: int = K) -> DataFrame:
    """As ``exact_quantiles``, from one sketch per group and within ``rank_error(k)``; groups without a value are left out."""
    known = df.select(*keys, _value(value).alias("_v")).where("_v is not null")
    whole = known.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", k).alias("sketch"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    return quantiles_of(whole, probs, keys)
