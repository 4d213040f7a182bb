"""Table shapes and the checks made where data enter.

``ts_utc`` is a TIMESTAMP_NTZ that holds the UTC wall clock. A zone-less type
cannot be shifted by the session zone, so the two instants that share a local
hour when clocks go back stay two keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from loadpanel.scale import local_table

KEYS = ("entity_id", "ts_utc")

OBSERVATIONS = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("ts_utc", T.TimestampNTZType(), False),
        T.StructField("series_type", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)

COVARIATES = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("ts_utc", T.TimestampNTZType(), False),
        T.StructField("feature", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)

OBSERVATION_KEYS = ("entity_id", "ts_utc", "series_type")
COVARIATE_KEYS = ("entity_id", "ts_utc", "feature")

# The covariate vocabulary and its column names in the wide table.
COVARIATE_COLUMNS = {
    "temperature_2m": "temp_c",
    "dewpoint_2m": "dewpoint_c",
    "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_kmh",
    "cloud_cover": "cloud_pct",
    "shortwave_radiation": "radiation_wm2",
}

# The 17 model inputs.
MODEL_FEATURES = (
    "hdd",
    "cdd",
    "temp_c",
    "temp_sq",
    "humidity_pct",
    "wind_kmh",
    "cloud_pct",
    "radiation_wm2",
    "hour_local",
    "dayofweek",
    "month_local",
    "is_weekend",
    "lag_48h",
    "lag_168h",
    "lag_336h",
    "same_hour_4wk_avg",
    "rolling_24h_mean",
)

# Grid region, time zone, and the city that stands for its weather.
REGIONS = (
    ("BPAT", "America/Los_Angeles", "Portland", 45.52, -122.68),
    ("CISO", "America/Los_Angeles", "Los Angeles", 34.05, -118.24),
    ("ERCO", "America/Chicago", "Houston", 29.76, -95.37),
    ("FPL", "America/New_York", "Miami", 25.76, -80.19),
    ("ISNE", "America/New_York", "Boston", 42.36, -71.06),
    ("MISO", "America/Chicago", "Chicago", 41.88, -87.63),
    ("NYIS", "America/New_York", "New York", 40.71, -74.01),
    ("PJM", "America/New_York", "Philadelphia", 39.95, -75.17),
)


def regions(spark: SparkSession) -> DataFrame:
    """The region table as a DataFrame (entity_id, tzname, city, lat, lon)."""
    return local_table(
        spark, REGIONS, "entity_id string, tzname string, city string, lat double, lon double"
    )


class SchemaError(ValueError):
    """A frame does not have the shape an operator needs."""


class KeyViolation(ValueError):
    """A key that must be unique and present is not."""


class EmptyColumn(ValueError):
    """A column that must carry data is null in every row."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise before any job runs if a named column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"columns not in the frame: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order and check their types."""
    require_columns(df, schema.fieldNames())
    wrong = {
        f.name: df.schema[f.name].dataType.simpleString()
        for f in schema
        if df.schema[f.name].dataType != f.dataType
    }
    if wrong:
        raise SchemaError(f"unexpected column types: {wrong}")
    return df.select(*schema.fieldNames())
