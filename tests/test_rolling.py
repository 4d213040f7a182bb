"""Training sums carried on by new rows equal a rerun over everything."""

import datetime as dt

import numpy as np
import pytest
from frames import T0

from loadpanel.models import MeanForecaster, RidgeForecaster
from loadpanel.operators.folds import FoldPlan
from loadpanel.plans.backtest import Backtest
from loadpanel.plans.rolling import RollingFit, StepError

SCHEMA = "entity_id string, ts_utc timestamp_ntz, a double, b double, demand_mw double"
FEATURES = ["a", "b"]
HOURLY = FoldPlan(n_folds=4, test_days=2, gap_hours=39, min_train_days=5)


def made(spark, days=30, entities=("x", "y"), first=0):
    rng, data = np.random.default_rng(4), []
    for k, entity in enumerate(entities):
        for i in range(24 * days):
            a, b = rng.normal(), float(i % 24)
            y = 1000 * (k + 1) + 50 * a + 3 * b + rng.normal()
            t = T0 + dt.timedelta(hours=24 * first + i)
            data.append((entity, t, None if i % 37 == 5 else a, b, float(y)))
    return spark.createDataFrame(data, SCHEMA).cache()


def compare(whole, state):
    """Means to the last bit, ridge predictions to 1e-9."""
    run = Backtest(whole, FEATURES, plan=HOURLY)
    key = lambda r: (r["entity_id"], r["fold"])
    want = {key(r): r["mean"] for r in run.fitted(MeanForecaster()).means.collect()}
    assert {key(r): r["mean"] for r in state.mean().means.collect()} == want and want
    want = {key(r): np.array(r["beta"]) for r in run.fitted(RidgeForecaster(0.5)).coefficients.collect()}
    got = {key(r): np.array(r["beta"]) for r in state.ridge(0.5).coefficients.collect()}
    assert got.keys() == want.keys()
    x = np.array([1.0, 0.7, 13.0])
    for k in want:
        assert got[k] @ x == pytest.approx(want[k] @ x, rel=1e-9)


def test_day_by_day_equals_a_rerun(spark):
    whole = made(spark)
    day = lambda lo, hi: whole.where(f"ts_utc >= '{T0 + dt.timedelta(days=lo)}' and ts_utc < '{T0 + dt.timedelta(days=hi)}'")
    state = RollingFit.start(day(0, 20), FEATURES, plan=HOURLY)
    for lo, hi in ((20, 21), (21, 25), (25, 30)):
        state = state.extend(day(lo, hi))
    compare(whole, state)
    # What lies before the first bound is one row; a bucket is three hours here.
    assert state.sums.groupBy("entity_id").count().agg({"count": "max"}).first()[0] <= 8 * (4 * 2 + 2) + 1


def test_late_rows_and_new_entities(spark, tmp_path):
    old, new = made(spark, 30, ("x",)), made(spark, 12, ("late",), first=18)
    late = old.where("b = 3 and ts_utc < '2024-01-20'")
    state = RollingFit.start(old.exceptAll(late), FEATURES, plan=HOURLY)
    state.save(str(tmp_path / "state"))
    state = RollingFit.load(spark, str(tmp_path / "state"), FEATURES, plan=HOURLY)
    state = state.extend(late.unionByName(new))
    compare(old.unionByName(new), state)


def test_only_new_rows_are_read(spark, tmp_path):
    """The files of the first history are gone when the state is extended."""
    whole = made(spark, 24, ("x",))
    first = tmp_path / "first"
    whole.where("ts_utc < '2024-01-23'").write.parquet(str(first))
    state = RollingFit.start(spark.read.parquet(str(first)), FEATURES, plan=HOURLY)
    for file in first.glob("*.parquet"):
        file.write_bytes(b"")
    compare(whole, state.extend(whole.where("ts_utc >= '2024-01-23'")))


def test_a_history_that_ends_between_steps_raises(spark):
    whole = made(spark, 20, ("x",))
    state = RollingFit.start(whole.where("ts_utc < '2024-01-15'"), FEATURES, plan=HOURLY)
    with pytest.raises(StepError, match="24 hours"):
        state.extend(whole.where("ts_utc between '2024-01-15' and '2024-01-15 07:00:00'"))
