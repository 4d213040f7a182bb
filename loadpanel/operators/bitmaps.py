"""Coverage by bitmaps: a bit for every hour, one bitmap for each (entity, series, 32,768 hours).

What is shuffled are bitmaps of four kilobytes, not rows: an hour that a hundred rows have is one bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from loadpanel.functions.columns import HOUR_US, floor_div, micros
from loadpanel.scale import materialize

# Bits of a bitmap, as Spark's bitmap functions have them.
BITS = 32_768


def hour_bitmaps(obs: DataFrame, a: str = "D", b: str = "DF") -> DataFrame:
    """entity_id, series_type, block, hours (a bitmap) and n_rows of two series; bitmaps combine before the shuffle.

    A time that is not a whole hour raises, since a bit stands for an hour.
    """
    hour = floor_div(micros("ts_utc"), HOUR_US)
    rows = obs.where(F.col("series_type").isin(a, b)).select(
        "entity_id",
        "series_type",
        floor_div(hour, BITS).alias("block"),
        F.pmod(hour, F.lit(BITS).cast("long")).alias("bit"),
        F.pmod(micros("ts_utc"), F.lit(HOUR_US).cast("long")).alias("past"),
    )
    found = materialize(
        rows.groupBy("entity_id", "series_type", "block").agg(
            F.bitmap_construct_agg("bit").alias("hours"), F.count("*").alias("n_rows"), F.max("past").alias("past")
        ),
        "hour-bitmaps",
    )
    if found.where("past > 0").limit(1).count():
        raise ValueError("bitmaps need whole hours")
    return found.drop("past")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _only_first(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Hours of the first bitmap that the second lacks: AND NOT over whole words."""
    none = bytes(BITS // 8)
    for first, second, block in batches:
        out = []
        for x, y, at in zip(first, second, block):
            left = np.frombuffer(x or none, np.uint64) & ~np.frombuffer(y or none, np.uint64)
            out.append(np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little")) + at * BITS)
        yield pd.Series(out, dtype=object)


def _side_by_side(bitmaps: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each (entity, block) with the bitmaps of both series and how many hours each and either has."""

    def of(series: str, column: str) -> Column:
        return F.any_value(F.when(F.col("series_type") == series, F.col(column)), ignoreNulls=True)

    both = bitmaps.groupBy("entity_id", "block").agg(
        of(a, "hours").alias("a"),
        of(b, "hours").alias("b"),
        F.bitmap_or_agg("hours").alias("either"),
        F.coalesce(of(a, "n_rows"), F.lit(0)).alias("rows_a"),
        F.coalesce(of(b, "n_rows"), F.lit(0)).alias("rows_b"),
    )

    def bits(c: str) -> Column:
        return F.coalesce(F.bitmap_count(c), F.lit(0)).cast("long")

    return both.withColumns({"n_a": bits("a"), "n_b": bits("b"), "n_either": bits("either")}).drop("either")


def _instant(hours: Column) -> Column:
    """The UTC wall clock of an hour counted from 1970, in a session of any zone."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_add("HOUR", hours.cast("int"), epoch)


def _missing(pairs: DataFrame, have: str, lack: str) -> Column:
    """Hours that one bitmap has and the other lacks; blocks in which the counts agree are not looked into."""
    return F.when(F.col("n_either") > F.col(f"n_{lack}"), _only_first(have, lack, "block"))


def coverage_by_bitmaps(obs: DataFrame, a: str = "D", b: str = "DF") -> DataFrame:
    """``coverage``, with what is missing counted by ``either`` less the other one."""
    pairs = _side_by_side(hour_bitmaps(obs, a, b), a, b)
    pairs = pairs.withColumns({"no_b": _missing(pairs, "a", "b"), "no_a": _missing(pairs, "b", "a")})

    return pairs.groupBy("entity_id").agg(
        F.sum("rows_a").alias("demand_rows"),
        F.sum("rows_b").alias("forecast_rows"),
        F.sum("n_a").alias("demand_hours"),
        F.sum("n_b").alias("forecast_hours"),
        F.sum(F.col("n_either") - F.col("n_b")).alias("missing_forecast"),
        F.sum(F.col("n_either") - F.col("n_a")).alias("missing_actual"),
        _instant(F.min(F.array_min("no_b"))).alias("first_missing_forecast"),
        _instant(F.max(F.array_max("no_b"))).alias("last_missing_forecast"),
        _instant(F.min(F.array_min("no_a"))).alias("first_missing_actual"),
        _instant(F.max(F.array_max("no_a"))).alias("last_missing_actual"),
    )


def missing_by_bitmaps(obs: DataFrame, have: str, lack: str) -> DataFrame:
    """``missing_hours``: hours that have series ``have`` and not ``lack``."""
    pairs = _side_by_side(hour_bitmaps(obs, have, lack), have, lack).where("n_either > n_b")
    hours = pairs.select("entity_id", F.explode(_only_first("a", "b", "block")).alias("hour"))
    return hours.select("entity_id", _instant(F.col("hour")).alias("ts_utc"))
