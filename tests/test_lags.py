import datetime as dt

import pandas as pd
import pytest
from frames import HOUR, T0, obs

from loadpanel.operators import lags
from loadpanel.operators.lags import LeadError, add_lags

COLUMNS = ["lag_48h", "lag_168h", "lag_336h", "same_hour_4wk_avg", "rolling_24h_mean"]


def panel(spark, gaps=True):
    """One long history, one short one and one with a burst; with holes if ``gaps``."""
    out = []
    for entity, n, step in (("long", 3_000, 1), ("short", 700, 1), ("sparse", 900, 37)):
        for i in range(n):
            if gaps and (i * 7919) % 23 == 0:
                continue
            out.append((entity, T0 + i * step * HOUR, float((i * 31) % 101) + 0.25))
    out += [("burst", T0 - 40_000 * HOUR, 5.0)] + [
        ("burst", T0 + dt.timedelta(minutes=i), float(i % 17)) for i in range(1_500)
    ]
    return spark.createDataFrame(out, "entity_id string, ts_utc timestamp_ntz, demand_mw double")


def by_rows(pdf):
    def one(g):
        g = g.sort_values("ts_utc")
        y = g["demand_mw"]
        for n in (48, 168, 336):
            g[f"lag_{n}h"] = y.shift(n)
        g["same_hour_4wk_avg"] = (y.shift(168) + y.shift(336) + y.shift(504) + y.shift(672)) / 4
        g["rolling_24h_mean"] = y.shift(48).rolling(24, min_periods=1).mean()
        return g

    return pd.concat([one(g.copy()) for _, g in pdf.groupby("entity_id")])


def by_hours(pdf):
    def one(g):
        y = dict(zip(g["ts_utc"], g["demand_mw"]))
        at = lambda t, n: y.get(t - n * HOUR, float("nan"))
        for n in (48, 168, 336):
            g[f"lag_{n}h"] = [at(t, n) for t in g["ts_utc"]]
        g["same_hour_4wk_avg"] = [sum(at(t, n) for n in (168, 336, 504, 672)) / 4 for t in g["ts_utc"]]
        s = g.set_index("ts_utc")["demand_mw"].sort_index()
        g["rolling_24h_mean"] = [
            s[t - 71 * HOUR : t - 48 * HOUR].mean() for t in g["ts_utc"]
        ]
        return g

    return pd.concat([one(g.copy()) for _, g in pdf.groupby("entity_id")])


def assert_same(got, want):
    key = ["entity_id", "ts_utc"]
    got, want = (f.sort_values(key).reset_index(drop=True)[[*key, "demand_mw", *COLUMNS]] for f in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9)


@pytest.mark.parametrize("task_rows", [1_000_000, 1_000, 700, 10])
def test_row_lags_however_the_histories_are_cut(spark, task_rows):
    df = panel(spark)
    assert_same(add_lags(df, task_rows=task_rows).toPandas(), by_rows(df.toPandas()))


@pytest.mark.parametrize("span_hours", [4_380, 500, 24])
def test_time_lags_however_the_time_is_cut(spark, span_hours):
    df = panel(spark).where("entity_id <> 'burst'")
    assert_same(add_lags(df, strict=True, span_hours=span_hours).toPandas(), by_hours(df.toPandas()))


def test_both_forms_agree_without_gaps_and_not_with_them(spark):
    whole = panel(spark, gaps=False).where("entity_id = 'long'")
    assert_same(add_lags(whole).toPandas(), add_lags(whole, strict=True).toPandas())
    holed = panel(spark).where("entity_id = 'long'")
    a, b = add_lags(holed).toPandas(), add_lags(holed, strict=True).toPandas()
    assert not a.sort_values("ts_utc")["lag_48h"].reset_index(drop=True).equals(
        b.sort_values("ts_utc")["lag_48h"].reset_index(drop=True)
    )


def test_lags_inside_the_lead_are_refused(spark):
    df = obs(spark, [1.0]).withColumnRenamed("value", "demand_mw")
    for bad in ({"lags": (24, 48)}, {"weekly": (24,)}, {"rolling": (71, 38)}, {"rolling": (40, 48)}):
        with pytest.raises(LeadError):
            add_lags(df, **bad)


def test_null_counts_and_correlations(spark):
    lagged = add_lags(panel(spark, gaps=False).where("entity_id = 'long'"))
    c = lags.lag_correlations(lagged, ["lag_48h"]).first()
    pdf = lagged.toPandas()
    assert c["c_48h"] == pytest.approx(pdf["demand_mw"].corr(pdf["lag_48h"]), abs=6e-4)


@pytest.mark.parametrize("strict", [False, True])
def test_rolling_mean_of_large_values(spark, strict):
    out = add_lags(obs(spark, [4e12] * 100).withColumnRenamed("value", "demand_mw"), strict=strict)
    assert {r[0] for r in out.where("rolling_24h_mean is not null").select("rolling_24h_mean").collect()} == {4e12}
