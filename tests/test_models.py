import datetime as dt

import numpy as np
import pandas as pd
import pytest
from frames import T0

from loadpanel.models import BoostedTreesForecaster, Forecaster, MeanForecaster, RidgeForecaster
from loadpanel.operators.folds import FoldPlan
from loadpanel.plans.backtest import Backtest, fold_summary, model_ladder, skill
from loadpanel.schema import MODEL_FEATURES, SchemaError

PLAN = FoldPlan(n_folds=3, test_days=20, gap_hours=39, min_train_days=60)
INPUTS = ["a", "b", "c"]


def table(seed=3):
    """Two entities, one of them three times as long, with a few incomplete rows."""
    rng = np.random.default_rng(seed)
    parts = []
    for entity, days, level in (("long", 360, 20_000.0), ("late", 115, 500.0)):
        n = days * 4
        x = rng.normal(size=(n, 3)) * [1.0, 30.0, 0.01] + [5.0, 1e4, 0.0]
        y = level + level / 10 * np.tanh(x[:, 0] - 5) + 0.01 * level * (x[:, 1] - 1e4) / 30 + rng.normal(size=n)
        frame = pd.DataFrame(x, columns=INPUTS)
        frame.insert(0, "entity_id", entity)
        frame.insert(1, "ts_utc", [T0 + dt.timedelta(hours=6 * i) for i in range(n)])
        frame["demand_mw"] = y
        frame.loc[rng.choice(n, 15, replace=False), "a"] = None
        parts.append(frame)
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def pdf():
    return table()


@pytest.fixture(scope="module")
def backtest(spark, pdf):
    schema = "entity_id string, ts_utc timestamp_ntz, a double, b double, c double, demand_mw double"
    rows = [
        (r[0], r[1].to_pydatetime(), *(None if v != v else v for v in r[2:]))
        for r in pdf.itertuples(index=False)
    ]
    return Backtest(spark.createDataFrame(rows, schema), INPUTS, plan=PLAN)


def direct(pdf, fit, plan=PLAN):
    """The protocol fold by fold in pandas."""
    out = {}
    for entity, df in pdf.groupby("entity_id"):
        first, last = df["ts_utc"].min(), df["ts_utc"].max()
        span, gap = pd.Timedelta(days=plan.test_days), pd.Timedelta(hours=plan.gap_hours)
        for k in range(plan.n_folds):
            end = last - (plan.n_folds - 1 - k) * span
            cut = end - span - gap
            if cut - first < pd.Timedelta(days=plan.min_train_days):
                continue
            train = df[df["ts_utc"] <= cut].dropna()
            test = df[(df["ts_utc"] > end - span) & (df["ts_utc"] <= end)].dropna()
            predict = fit(train[INPUTS].to_numpy(), train["demand_mw"].to_numpy())
            y, p = test["demand_mw"].to_numpy(), predict(test[INPUTS].to_numpy())
            out[entity, k] = (
                len(train), len(test), np.abs(y - p).mean(), (np.abs(y - p) / y).mean() * 100,
                train["demand_mw"].to_numpy() - predict(train[INPUTS].to_numpy()),
            )
    return out


def fit_mean(x, y):
    return lambda z: np.full(len(z), y.mean())


def fit_ridge(alpha):
    def fit(x, y):
        mx, my = x.mean(0), y.mean()
        b = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
        return lambda z: my + (z - mx) @ b

    return fit


def assert_scores(results, want):
    got = {(r["entity_id"], r["fold"]): r for r in results.collect()}
    assert set(got) == set(want)
    for key, (n_train, n_test, mae, mape, _) in want.items():
        assert (got[key]["n_train"], got[key]["n_test"]) == (n_train, n_test)
        assert got[key]["mae"] == pytest.approx(mae, rel=1e-7)
        assert got[key]["mape"] == pytest.approx(mape, rel=1e-7)


def test_mean_equals_the_fold_by_fold_run(backtest, pdf):
    want = direct(pdf, fit_mean)
    assert {e for e, _ in want} == {"long", "late"} and len(want) < 2 * PLAN.n_folds
    assert_scores(backtest.run(MeanForecaster()), want)


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_equals_the_fold_by_fold_run(backtest, pdf, alpha):
    assert_scores(backtest.run(RidgeForecaster(alpha)), direct(pdf, fit_ridge(alpha)))


def test_seventeen_inputs_equal_a_direct_solve(spark, sf_dir):
    """Ridge on the full matrix against numpy on the same rows."""
    from loadpanel.plans import catalog

    shared = catalog._backtest(spark, sf_dir)
    got = {(r["entity_id"], r["fold"]): r["mape"] for r in shared.run(RidgeForecaster()).collect()}
    rows, names = shared.rows.toPandas(), list(MODEL_FEATURES)
    for (entity, fold), mape in got.items():
        mine = rows[rows["entity_id"] == entity]
        train = mine[mine["first_train_fold"] <= fold]
        test = mine[mine["test_fold"] == fold]
        y = test["demand_mw"].to_numpy()
        predict = fit_ridge(1.0)(train[names].to_numpy(float), train["demand_mw"].to_numpy())
        assert mape == pytest.approx((np.abs(y - predict(test[names].to_numpy(float))) / y).mean() * 100, rel=1e-6)


def test_trees_beat_the_mean(backtest):
    trees = BoostedTreesForecaster(n_trees=8, learning_rate=0.4, depth=4, min_rows=5, seed=1)
    ladder = model_ladder(backtest, [MeanForecaster(), trees]).collect()
    score = {(r["entity_id"], r["model"]): r["mean_mape"] for r in ladder}
    for entity in ("long", "late"):
        assert score[entity, "boosted_trees"] < score[entity, "mean"]


@pytest.mark.parametrize("model, fit", [(MeanForecaster(), fit_mean), (RidgeForecaster(), fit_ridge(1.0))])
def test_quantiles_come_from_training_residuals(backtest, pdf, model, fit):
    want = direct(pdf, fit)
    fitted = backtest.fitted(model)
    rows = fitted.predict_quantiles(backtest.test_rows(), [0.1, 0.5, 0.9]).collect()
    for r in rows:
        residuals = want[r["entity_id"], r["fold"]][4]
        shift = np.array(r["quantiles"]) - r["prediction"]
        assert shift == pytest.approx(np.quantile(residuals, [0.1, 0.5, 0.9]), rel=1e-6, abs=1e-6)


def test_summary_rounds_and_shows_dates(backtest):
    row = fold_summary(backtest.run(MeanForecaster())).orderBy("entity_id", "fold").first()
    assert isinstance(row["train_end"], dt.date) and row["mape"] == round(row["mape"], 2)


def test_missing_features_are_named(spark, backtest):
    with pytest.raises(SchemaError, match="windspeed"):
        Backtest(backtest.rows, ["a", "windspeed"])


def test_short_history_gives_no_rows(spark):
    rows = [("X", T0 + dt.timedelta(days=i), 1.0, 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, "entity_id string, ts_utc timestamp_ntz, a double, demand_mw double")
    short = Backtest(df, ["a"])
    for model in (MeanForecaster(), RidgeForecaster(), BoostedTreesForecaster(n_trees=1)):
        assert short.run(model).count() == 0


def test_skill_scores_only_hours_both_have(spark):
    schema = "entity_id string, ts_utc timestamp_ntz, fold long, demand_mw double, prediction double"
    hours = [T0 + dt.timedelta(hours=i) for i in range(4)]
    predictions = spark.createDataFrame([("X", t, 0, 100.0, 90.0) for t in hours], schema)
    pairs = spark.createDataFrame(
        [("X", t, 100.0, 80.0) for t in hours[:3]],
        "entity_id string, ts_utc timestamp_ntz, actual double, forecast double",
    )
    r = skill(predictions, pairs).first()
    assert (r["n_test"], r["n_both"], r["coverage"]) == (4, 3, 0.75)
    assert r["mape_model"] == pytest.approx(10) and r["mape_base"] == pytest.approx(20)
    assert r["skill"] == pytest.approx(0.5)


def test_every_model_meets_the_contract():
    for model in (MeanForecaster(), RidgeForecaster(), BoostedTreesForecaster()):
        assert isinstance(model, Forecaster)
