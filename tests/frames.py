"""Small hand-made panels."""

from __future__ import annotations

import datetime as dt

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
OBS = "entity_id string, ts_utc timestamp_ntz, series_type string, value double"
COV = "entity_id string, ts_utc timestamp_ntz, feature string, value double"


def obs(spark, values, entity="X", series="D", start=T0):
    """One value per hour from ``start``; None leaves the hour out."""
    rows = [(entity, start + i * HOUR, series, v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame([(e, t, s, float(v)) for e, t, s, v in rows], OBS)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
