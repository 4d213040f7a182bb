"""Panels derived from the driver's tables, in the shape of the raw tables.

``daily_obs`` and ``weather`` come from ``lineitem`` (three entities, about
2,500 days), ``hourly_obs`` from ``events`` (five entities, 30 days of hours
with gaps both ways). The aggregations combine map-side, so the two or three
entities do not limit their parallelism.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadpanel.operators.reshape import melt
from loadpanel.scale import local_table, materialize
from loadpanel.schema import COVARIATE_KEYS, OBSERVATION_KEYS
from loadpanel.session import pin_utc
from loadpanel.sources.tables import load

ZONES = (("A", "America/Los_Angeles"), ("N", "America/Chicago"), ("R", "America/New_York"))


def _hundredths(column: str) -> Column:
    """A two-decimal column as a whole number of hundredths; ``rint`` is one JVM instruction."""
    return F.rint(F.col(column) * 100).cast("long")


def daily_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue as series ``D`` and revenue after discount and tax as ``DF``.

    Sums run over whole numbers: exact in any order, and they raise if they overflow.
    """
    cents = _hundredths("l_extendedprice")
    charged = cents * (100 - _hundredths("l_discount")) * (100 + _hundredths("l_tax"))
    days = (
        load(pin_utc(spark), sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("entity_id"), F.col("l_shipdate").alias("ts_utc"))
        .agg(
            (F.sum(cents) / 100).alias("D"),
            (_two_decimals(F.sum(charged)) / 10000).alias("DF"),
        )
    )
    return days.unpivot(["entity_id", "ts_utc"], ["D", "DF"], "series_type", "value")


def _two_decimals(hundredths: Column) -> Column:
    return (hundredths.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("double")


def hourly_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly event value; even event ids give series ``D``, odd ones ``DF``."""
    series = F.when(F.col("event_id") % 2 == 0, "D").otherwise("DF")
    return (
        load(pin_utc(spark), sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("entity_id"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_utc"),
            series.alias("series_type"),
        )
        .agg((F.sum(_hundredths("value")) / 100).alias("value"))
        .select(*OBSERVATION_KEYS, "value")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide covariates on the daily grid."""
    rows = F.count("*")
    open_lines = F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0))
    return (
        load(pin_utc(spark), sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("entity_id"), F.col("l_shipdate").alias("ts_utc"))
        .agg(
            F.when(rows > 1, F.avg("l_quantity") - 7.5).alias("temperature_2m"),
            F.nullif(F.min("l_quantity"), F.lit(1.0)).alias("dewpoint_2m"),
            (F.sum(_hundredths("l_discount")).cast("double") / rows * 10).alias("relative_humidity_2m"),
            (F.sum(_hundredths("l_tax")).cast("double") / rows).alias("wind_speed_10m"),
            (F.lit(100.0) * open_lines.cast("double") / rows).alias("cloud_cover"),
            (F.max("l_extendedprice") / 100).alias("shortwave_radiation"),
        )
    )


def covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt(weather(spark, sf_dir)).select(*COVARIATE_KEYS, "value")


def zones(spark: SparkSession) -> DataFrame:
    return local_table(spark, ZONES, "entity_id string, tzname string")


def stored(df: DataFrame, label: str) -> DataFrame:
    """A panel as a table, for queries that read it more than once."""
    return materialize(df, label)
