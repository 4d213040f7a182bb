"""What a data source offers, and the source over stored tables."""

from __future__ import annotations

from datetime import datetime
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, functions as F

from loadpanel.schema import COVARIATES, OBSERVATIONS, conform


@runtime_checkable
class DataSource(Protocol):
    """Long panels between two UTC instants, both included."""

    name: str

    def fetch_observations(self, start: datetime, end: datetime) -> DataFrame: ...

    def fetch_covariates(self, start: datetime, end: datetime) -> DataFrame: ...

    def fetch_external_baseline(self, start: datetime, end: datetime) -> DataFrame | None: ...


def between(df: DataFrame, start: datetime, end: datetime, ts: str = "ts_utc") -> DataFrame:
    """Rows in [start, end], UTC; the bounds are pushed down to a Parquet scan."""
    lo, hi = (F.to_timestamp_ntz(F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f"))) for t in (start, end))
    return df.where(F.col(ts).between(lo, hi))


class PanelTables:
    """A source over an observation table and a covariate table.

    ``actual`` and ``forecast`` name the measured and the published series.
    """

    def __init__(
        self,
        observations: DataFrame,
        covariates: DataFrame,
        actual: str = "D",
        forecast: str | None = "DF",
        name: str = "tables",
    ) -> None:
        self.name = name
        self._observations = conform(observations, OBSERVATIONS)
        self._covariates = conform(covariates, COVARIATES)
        self._actual, self._forecast = actual, forecast

    def fetch_observations(self, start: datetime, end: datetime) -> DataFrame:
        rows = self._observations.where(F.col("series_type") == self._actual)
        return between(rows, start, end)

    def fetch_covariates(self, start: datetime, end: datetime) -> DataFrame:
        return between(self._covariates, start, end)

    def fetch_external_baseline(self, start: datetime, end: datetime) -> DataFrame | None:
        if self._forecast is None:
            return None
        rows = self._observations.where(F.col("series_type") == self._forecast)
        return between(rows, start, end)
