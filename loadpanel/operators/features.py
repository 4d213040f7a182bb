"""Model-ready features: cleaned demand, covariates, degree days, local calendar."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.columns import calendar_fields, degree_fields, fixed_sum, local_time
from loadpanel.operators.plausibility import BAND, plausible
from loadpanel.operators.reshape import pivot
from loadpanel.scale import lookup_join
from loadpanel.schema import COVARIATE_COLUMNS, KEYS

BALANCE_POINT_C = 18.0

# Zones up to which each is compiled into the plan; the result is the same beyond.
MAX_ZONES = 64


def local_calendar(df: DataFrame, tz: DataFrame, ts: str = "ts_utc") -> DataFrame:
    """Append the local calendar columns; ``tz`` maps entity_id to tzname.

    Rows of entities that ``tz`` does not list are dropped (inner join); where it
    lists a null zone, the calendar is null.
    """
    zoned = lookup_join(df, tz, ["entity_id"], spread=ts)
    return (
        zoned.withColumn("_wall", local_time(ts, "tzname", _zones(tz)))
        .withColumns(calendar_fields(F.col("_wall")))
        .drop("_wall", *[c for c in tz.columns if c != "entity_id"])
    )


def _zones(tz: DataFrame) -> list[str]:
    """The zones of a lookup table that names few, none otherwise; a null zone is no name."""
    names = tz.select("tzname").where("tzname is not null").distinct().limit(MAX_ZONES + 1).collect()
    return sorted(r["tzname"] for r in names) if len(names) <= MAX_ZONES else []


def degree_days(
    df: DataFrame, base: float = BALANCE_POINT_C, temp: str = "temp_c"
) -> DataFrame:
    return df.withColumns(degree_fields(F.col(temp), base))


def demand(
    obs: DataFrame, band: tuple[float, float] = BAND, medians: DataFrame | None = None
) -> DataFrame:
    """Cleaned demand: the plausible rows of series ``D``."""
    return plausible(obs, *band, series="D", medians=medians).select(
        *KEYS, F.col("value").alias("demand_mw")
    )


def build_features(
    obs: DataFrame,
    cov: DataFrame,
    tz: DataFrame,
    base: float = BALANCE_POINT_C,
    band: tuple[float, float] = BAND,
    medians: DataFrame | None = None,
) -> DataFrame:
    """The 18-column feature table.

    Pivot and join both partition by (entity, hour), so the long covariates are
    shuffled once; hours that lack demand or weather are dropped.
    """
    joined = demand(obs, band, medians).join(pivot(cov), list(KEYS))
    fields = ["hdd", "cdd", "temp_sq", "hour_local", "dayofweek", "month_local", "dayofyear", "year"]
    return local_calendar(degree_days(joined, base), tz).select(
        *KEYS, "demand_mw", *COVARIATE_COLUMNS.values(), *fields, "is_weekend"
    )


def demand_temperature(
    obs: DataFrame, cov: DataFrame, medians: DataFrame | None = None
) -> DataFrame:
    """Cleaned demand beside the temperature of the same hour."""
    temperature = cov.where(F.col("feature") == "temperature_2m").select(
        *KEYS, F.col("value").alias("temp_c")
    )
    return demand(obs, medians=medians).join(temperature, list(KEYS))


def response_curve(pairs: DataFrame, width: float = 1.0) -> DataFrame:
    """Mean demand per entity and temperature bin: the plotted curve as a table."""
    low_edge = F.floor(F.col("temp_c") / width) * F.lit(float(width))
    return pairs.groupBy("entity_id", low_edge.alias("temp_bin")).agg(
        F.count("*").alias("n"),
        (fixed_sum("demand_mw") / F.count("demand_mw")).alias("mean_demand_mw"),
    )


def feature_sanity(features: DataFrame) -> DataFrame:
    """Per entity: mean degree days and the range of the local hour."""
    return (
        features.groupBy("entity_id")
        .agg(
            F.round(F.avg("hdd"), 1).alias("avg_hdd"),
            F.round(F.avg("cdd"), 1).alias("avg_cdd"),
            F.min("hour_local").alias("min_hr"),
            F.max("hour_local").alias("max_hr"),
        )
        .orderBy(F.desc("avg_cdd"), "entity_id")
    )


def timezone_check(features: DataFrame, tz: DataFrame) -> DataFrame:
    """Each instant beside its local wall clock and the stored local hour."""
    zoned = lookup_join(features, tz, ["entity_id"], spread="ts_utc")
    return zoned.select(
        "entity_id", "ts_utc", local_time("ts_utc", "tzname", _zones(tz)).alias("ts_local"), "hour_local"
    )


def rename_covariates(wide: DataFrame, columns: Mapping[str, str] = COVARIATE_COLUMNS) -> DataFrame:
    return wide.withColumnsRenamed(dict(columns))
