import datetime as dt

import pytest
from frames import COV, HOUR, T0, obs, rows

from loadpanel.operators import features as feat
from loadpanel.operators.quality import assert_key, null_profile
from loadpanel.operators.reshape import melt, pivot, union_all
from loadpanel.schema import COVARIATE_COLUMNS, regions


def calendar(spark, instants, zone="America/Los_Angeles"):
    df = spark.createDataFrame([("X", t) for t in instants], "entity_id string, ts_utc timestamp_ntz")
    tz = spark.createDataFrame([("X", zone)], "entity_id string, tzname string")
    return df, feat.local_calendar(df, tz).orderBy("ts_utc").collect()


@pytest.mark.parametrize("session_zone", ["UTC", "America/Los_Angeles"])
def test_clocks_going_back(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        instants = [dt.datetime(2020, 11, 1, h, 30) for h in (7, 8, 9, 10)]
        df, local = calendar(spark, instants)
        assert [r["hour_local"] for r in local] == [0, 1, 1, 2]
        assert assert_key(df, ["entity_id", "ts_utc"]).count() == 4
        assert all((r["dayofweek"], r["is_weekend"]) == (0, 1) for r in local)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clocks_going_forward(spark):
    _, local = calendar(spark, [dt.datetime(2020, 3, 8, h) for h in (9, 10, 11)])
    assert [r["hour_local"] for r in local] == [1, 3, 4]


def test_local_date_differs_from_utc(spark):
    _, local = calendar(spark, [dt.datetime(2021, 1, 1, 3)])
    r = local[0]
    assert (r["hour_local"], r["dayofweek"], r["month_local"], r["dayofyear"], r["year"]) == (19, 4, 12, 366, 2020)


def cov(spark, table):
    """feature -> list of hourly values."""
    data = [
        ("X", T0 + i * HOUR, f, float(v))
        for f, vs in table.items()
        for i, v in enumerate(vs)
        if v is not None
    ]
    return spark.createDataFrame(data, COV)


def test_missing_temperature_reads_as_zero_degree_days_and_is_flagged(spark):
    covariates = cov(spark, {"temperature_2m": [10, None, 25], "cloud_cover": [1, 2, 3]})
    tz = regions(spark).where("entity_id = 'CISO'").selectExpr("'X' as entity_id", "tzname")
    table = feat.build_features(obs(spark, [100.0, 101.0, 102.0, 103.0]), covariates, tz)
    assert len(table.columns) == 18
    got = rows(table, "ts_utc", "hdd", "cdd", "temp_sq")
    assert got == [(T0, 8.0, 0.0, 100.0), (T0 + HOUR, 0.0, 0.0, None), (T0 + 2 * HOUR, 0.0, 7.0, 625.0)]
    nulls = dict(rows(null_profile(table, ["temp_c", "wind_kmh"]), "column_name", "n_null"))
    assert nulls == {"temp_c": 1, "wind_kmh": 3}


def test_entity_without_a_zone_is_dropped(spark):
    tz = spark.createDataFrame([("Y", "UTC")], "entity_id string, tzname string")
    assert feat.local_calendar(obs(spark, [1.0]), tz).count() == 0


def test_pivot_undoes_melt(spark):
    table = {f: [i + 0.5, i + 1.5] for i, f in enumerate(COVARIATE_COLUMNS)}
    wide = pivot(cov(spark, table))
    back = melt(wide.withColumnsRenamed({v: k for k, v in COVARIATE_COLUMNS.items()}))
    columns = ("entity_id", "ts_utc", "feature", "value")
    assert rows(back, *columns) == rows(cov(spark, table), *columns)


def test_union_matches_by_name(spark):
    a = obs(spark, [1.0])
    assert union_all(a, a.select(*reversed(a.columns))).select("value").distinct().count() == 1


def test_response_curve_bins_by_degree(spark):
    pairs = feat.demand_temperature(
        obs(spark, [100.0, 110.0, 90.0]), cov(spark, {"temperature_2m": [-0.5, -0.1, 3.0]})
    )
    assert rows(feat.response_curve(pairs), "temp_bin", "n", "mean_demand_mw") == [
        (-1.0, 2, 105.0), (3.0, 1, 90.0),
    ]


def test_null_zone_gives_a_null_calendar(spark):
    frame = obs(spark, [1.0], entity="X").unionByName(obs(spark, [1.0], entity="Y"))
    tz = spark.createDataFrame([("X", "America/Chicago"), ("Y", None)], "entity_id string, tzname string")
    found = {r["entity_id"]: r["hour_local"] for r in feat.local_calendar(frame, tz).collect()}
    assert found == {"X": 18, "Y": None}
