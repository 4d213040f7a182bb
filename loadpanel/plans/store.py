"""From raw JSON files to stored tables and a scored model ladder.

Each step reads the table the step before it has stored, as a user would run
them one after another; ``root`` is a folder every executor can reach.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loadpanel.models import Forecaster
from loadpanel.operators.features import build_features
from loadpanel.operators.folds import FoldPlan
from loadpanel.operators.lags import add_lags
from loadpanel.operators.quality import assert_no_empty_column
from loadpanel.plans.backtest import Backtest, model_ladder
from loadpanel.schema import COVARIATE_KEYS, KEYS, MODEL_FEATURES, OBSERVATION_KEYS, regions
from loadpanel.sources import read_columnar, read_rowwise, replace_table


def load_observations(spark: SparkSession, files: str | Sequence[str], root: str) -> DataFrame:
    """Row-wise files to the observation table; its key is checked first."""
    return replace_table(
        read_rowwise(spark, files), f"{root}/observations_raw", OBSERVATION_KEYS, "series_type"
    )


def load_covariates(spark: SparkSession, files: str, root: str) -> DataFrame:
    """Columnar files to the covariate table; its key is checked first."""
    return replace_table(read_columnar(spark, files), f"{root}/covariates_raw", COVARIATE_KEYS, "feature")


def store_features(
    obs: DataFrame, cov: DataFrame, root: str, tz: DataFrame | None = None
) -> DataFrame:
    """The feature table; a covariate that never joined is an error and not an empty model."""
    tz = regions(obs.sparkSession).select("entity_id", "tzname") if tz is None else tz
    features = build_features(obs, cov, tz)
    columns = [c for c in features.columns if c not in KEYS]
    return replace_table(features, f"{root}/features", check=lambda table: assert_no_empty_column(table, columns))


def store_lagged(features: DataFrame, root: str, **options) -> DataFrame:
    """The feature table with lags; ``options`` go to ``add_lags``."""
    return replace_table(add_lags(features, **options), f"{root}/features_lagged")


def score_models(
    lagged: DataFrame,
    forecasters: Sequence[Forecaster],
    features: Sequence[str] = MODEL_FEATURES,
    plan: FoldPlan = FoldPlan(),
) -> DataFrame:
    """Mean MAPE per entity and model."""
    return model_ladder(Backtest(lagged, features, plan=plan), forecasters)
