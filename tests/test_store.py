"""Raw files to scored models, on a year and a half of made-up hours."""

import datetime as dt
import json
import math

import pytest

from loadpanel.models import MeanForecaster, RidgeForecaster
from loadpanel.operators.folds import FoldPlan
from loadpanel.operators.plausibility import implausible_counts
from loadpanel.plans import store
from loadpanel.schema import COVARIATE_COLUMNS, EmptyColumn

HOURS = 9_600
T0 = dt.datetime(2023, 1, 1)


def temperature(i):
    return 15 + 10 * math.sin(i / 8766 * 2 * math.pi) + 6 * math.sin(i / 24 * 2 * math.pi)


def write_region(folder, region, level, features=tuple(COVARIATE_COLUMNS)):
    load = [level * (1 + 0.02 * abs(temperature(i) - 18) + 0.05 * math.cos(i / 12 * math.pi)) for i in range(HOURS)]
    load[500], load[501] = 2_147_483_647, 0
    times = [T0 + dt.timedelta(hours=i) for i in range(HOURS)]
    for series, factor in (("D", 1.0), ("DF", 1.01)):
        rows = [
            {"period": t.strftime("%Y-%m-%dT%H"), "respondent": region, "type": series, "value": str(v * factor)}
            for t, v in zip(times, load)
        ]
        (folder / f"{region}_{series}.json").write_text(json.dumps(rows))
    hourly = {"time": [t.strftime("%Y-%m-%dT%H:%M") for t in times]}
    for k, name in enumerate(features):
        hourly[name] = [temperature(i) + k * (i % (7 + k)) for i in range(HOURS)]
    (folder / f"{region}_weather.json").write_text(json.dumps({"hourly": hourly}))


def test_files_to_scores(spark, tmp_path):
    for region, level in (("CISO", 24_000), ("FPL", 14_000)):
        write_region(tmp_path, region, level)
    root = str(tmp_path / "tables")
    obs = store.load_observations(spark, f"{tmp_path}/*_D*.json", root)
    cov = store.load_covariates(spark, f"{tmp_path}/*_weather.json", root)
    assert (obs.count(), cov.count()) == (4 * HOURS, 12 * HOURS)
    bad = implausible_counts(obs).collect()
    assert [(r["non_positive"], r["too_high"]) for r in bad] == [(1, 1), (1, 1)]
    features = store.store_features(obs, cov, root)
    assert (features.count(), len(features.columns)) == (2 * (HOURS - 2), 18)
    lagged = store.store_lagged(features, root)
    assert len(lagged.columns) == 23
    plan = FoldPlan(n_folds=2, test_days=10, min_train_days=300)
    ladder = store.score_models(lagged, [MeanForecaster(), RidgeForecaster()], plan=plan).collect()
    score = {(r["entity_id"], r["model"]): r["mean_mape"] for r in ladder}
    assert all(r["n_folds"] == 2 for r in ladder) and len(score) == 4
    assert score["CISO", "ridge"] < score["CISO", "mean"] / 2


def test_misspelt_covariate_is_an_error(spark, tmp_path):
    write_region(tmp_path, "CISO", 24_000, features=("temperature_2m", "winds_peed_10m"))
    root = str(tmp_path / "tables")
    obs = store.load_observations(spark, f"{tmp_path}/*_D*.json", root)
    cov = store.load_covariates(spark, f"{tmp_path}/*_weather.json", root)
    with pytest.raises(EmptyColumn, match="wind_kmh"):
        store.store_features(obs, cov, root)
