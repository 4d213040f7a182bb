"""Audits: keys, coverage, distributions, null profiles, time ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from loadpanel.functions.columns import DAY_US, micros
from loadpanel.functions.quantiles import exact_quantiles
from loadpanel.functions.sketches import sketched_quantiles
from loadpanel.scale import key_filter, materialize, row_bound
from loadpanel.schema import EmptyColumn, KeyViolation

# The reported points of the value distribution.
DISTRIBUTION = {"p001": 0.001, "median_val": 0.5, "p999": 0.999}


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` if its key is unique and never null, else raise with examples."""
    absent = F.lit(False)
    for k in keys:
        absent = absent | F.col(k).isNull()
    bad = df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where((F.col("n_rows") > 1) | absent)
    examples = [tuple(r) for r in bad.limit(5).collect()]
    if examples:
        raise KeyViolation(f"repeated or null keys {tuple(keys)}, among them {examples}")
    return df


def duplicate_rows(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Every row whose key is repeated, or the first ``limit`` of them in full order.

    The whole listing is not sorted: a range sort would bring all copies of one
    key into one task.
    """
    repeated = materialize(key_violations(df, keys).select(*keys), "repeated-keys")
    rows = key_filter(df, repeated, keys)
    if limit is None:
        return rows
    rest = [c for c in df.columns if c not in keys]
    return rows.orderBy(*keys, *rest).limit(limit)


def row_counts(df: DataFrame, by: Sequence[str] = ("entity_id", "series_type")) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def hour_presence(obs: DataFrame, a: str = "D", b: str = "DF") -> DataFrame:
    """Per (entity, hour): rows of each of two series."""
    return (
        obs.where(F.col("series_type").isin(a, b))
        .groupBy("entity_id", "ts_utc")
        .agg(
            F.count_if(F.col("series_type") == a).alias("rows_a"),
            F.count_if(F.col("series_type") == b).alias("rows_b"),
        )
    )


def coverage(obs: DataFrame, a: str = "D", b: str = "DF") -> DataFrame:
    """Two-way coverage per entity: rows, distinct hours and gaps of both series.

    Both directions come from one grouping, since a one-way check hides the
    hours that only the other series has.
    """
    has_a, has_b = F.col("rows_a") > 0, F.col("rows_b") > 0
    no_forecast, no_actual = has_a & ~has_b, has_b & ~has_a
    return (
        hour_presence(obs, a, b)
        .groupBy("entity_id")
        .agg(
            F.sum("rows_a").alias("demand_rows"),
            F.sum("rows_b").alias("forecast_rows"),
            F.count_if(has_a).alias("demand_hours"),
            F.count_if(has_b).alias("forecast_hours"),
            F.count_if(no_forecast).alias("missing_forecast"),
            F.count_if(no_actual).alias("missing_actual"),
            F.min(F.when(no_forecast, F.col("ts_utc"))).alias("first_missing_forecast"),
            F.max(F.when(no_forecast, F.col("ts_utc"))).alias("last_missing_forecast"),
            F.min(F.when(no_actual, F.col("ts_utc"))).alias("first_missing_actual"),
            F.max(F.when(no_actual, F.col("ts_utc"))).alias("last_missing_actual"),
        )
    )


def missing_hours(obs: DataFrame, have: str, lack: str) -> DataFrame:
    """Hours that have series ``have`` and not ``lack``."""
    return (
        hour_presence(obs, have, lack)
        .where("rows_a > 0 and rows_b = 0")
        .select("entity_id", "ts_utc")
    )


def first_missing_hours(obs: DataFrame, have: str, lack: str, n: int = 20) -> DataFrame:
    """The ``n`` earliest missing hours of each entity; all but n go before the shuffle."""
    number = F.row_number().over(W.partitionBy("entity_id").orderBy("ts_utc"))
    return missing_hours(obs, have, lack).withColumn("_n", number).where(F.col("_n") <= n).drop("_n")


def value_distribution(
    obs: DataFrame, series: str = "D", probs: Mapping[str, float] = DISTRIBUTION, sketch: int | None = None
) -> DataFrame:
    """Per entity: minimum, quantiles and maximum; exact, unless a ``sketch`` of that size is asked for."""
    points = {"min_val": 0.0, **probs, "max_val": 1.0}
    rows = obs.where(F.col("series_type") == series)
    if sketch is not None:
        return sketched_quantiles(rows, ["entity_id"], "value", points, sketch)
    return exact_quantiles(rows, ["entity_id"], "value", points, total=row_bound(obs))


def covariate_profile(cov: DataFrame) -> DataFrame:
    """Per feature: rows and rounded minimum, mean and maximum."""
    return cov.groupBy("feature").agg(
        F.count("*").alias("n"),
        F.round(F.min("value"), 1).alias("min_v"),
        F.round(F.avg("value"), 1).alias("avg_v"),
        F.round(F.max("value"), 1).alias("max_v"),
    )


def null_counts_by(df: DataFrame, columns: Mapping[str, str], by: str = "entity_id") -> DataFrame:
    """Per group: rows, and nulls of each column (output name -> column)."""
    nulls = [F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()]
    return df.groupBy(by).agg(F.count("*").alias("total"), *nulls)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its nulls and the rows of the frame, in one pass."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot(["_rows"], list(columns), "column_name", "n_null").select(
        "column_name", "n_null", F.col("_rows").alias("n_rows")
    )


def surviving_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in all, and rows in which every named column has a value."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.agg(F.count("*").alias("n_rows"), F.count_if(whole).alias("n_complete"))


def assert_no_empty_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if a column is null in every row, which would empty the model matrix."""
    profile = null_profile(df, columns).where("n_null = n_rows and n_rows > 0")
    empty = sorted(r["column_name"] for r in profile.collect())
    if empty:
        raise EmptyColumn(f"columns without a single value: {empty}")
    return df


def time_range(df: DataFrame, ts: str = "ts_utc") -> DataFrame:
    """First and last instant and the whole days between them."""
    span = F.call_function("div", micros(F.max(ts)) - micros(F.min(ts)), F.lit(DAY_US))
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), span.alias("span_days"))


def time_range_by_entity(df: DataFrame, ts: str = "ts_utc") -> DataFrame:
    span = F.call_function("div", micros(F.max(ts)) - micros(F.min(ts)), F.lit(DAY_US))
    return df.groupBy("entity_id").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), span.alias("span_days")
    )


def daily_profile(obs: DataFrame, series: str = "D", hours: int = 24) -> DataFrame:
    """Peak and minimum hour of each UTC day that has at least ``hours`` rows.

    Ties go to the earliest hour.
    """
    hour = F.hour("ts_utc").cast("long")
    peak = F.max(F.struct(F.col("value"), (-hour).alias("neg_hour")))
    low = F.min(F.struct(F.col("value"), hour.alias("hour")))
    return (
        obs.where((F.col("series_type") == series) & F.col("value").isNotNull())
        .groupBy("entity_id", F.to_date("ts_utc").alias("day"))
        .agg(F.count("*").alias("n"), peak.alias("peak"), low.alias("low"))
        .where(F.col("n") >= hours)
        .select(
            "entity_id",
            "day",
            (-F.col("peak.neg_hour")).alias("peak_hour"),
            F.col("peak.value").alias("peak_value"),
            F.col("low.hour").alias("min_hour"),
        )
    )
