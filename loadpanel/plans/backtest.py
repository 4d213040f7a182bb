"""Rolling-origin backtest of any forecaster, for all entities and folds at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.columns import abs_error, relative_error
from loadpanel.models.base import GROUP, Forecaster
from loadpanel.operators.folds import FoldPlan, assign_folds, fold_bounds, history, trained_folds
from loadpanel.operators.reshape import union_all
from loadpanel.scale import materialize
from loadpanel.schema import KEYS, MODEL_FEATURES, require_columns

TARGET = "demand_mw"


def model_matrix(
    lagged: DataFrame, features: Sequence[str] = MODEL_FEATURES, target: str = TARGET
) -> DataFrame:
    """Keys, features and target of the rows in which all of them have a value."""
    return complete_rows(lagged.select(*KEYS, *features, target), [*features, target])


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


class Backtest:
    """The stored matrix of one panel with its folds, shared by every forecaster."""

    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str] = MODEL_FEATURES,
        target: str = TARGET,
        plan: FoldPlan = FoldPlan(),
    ) -> None:
        require_columns(df, [*KEYS, *features, target])
        self.features, self.target, self.plan = list(features), target, plan
        # History spans all rows; only complete ones train and test.
        narrow = df.select(*KEYS, *self.features, target)
        self.history = materialize(history(narrow), "history")
        assigned = assign_folds(narrow, self.history, plan)
        self.rows = materialize(
            complete_rows(assigned, [*self.features, target]).where(
                "test_fold is not null or first_train_fold is not null"
            ),
            "fold-rows",
        )
        self.bounds = fold_bounds(self.history, plan)

    def train_sizes(self) -> DataFrame:
        per_segment = (
            self.rows.where("first_train_fold is not null")
            .groupBy("entity_id", "first_train_fold")
            .count()
        )
        return (
            per_segment.withColumn("fold", F.explode(trained_folds(self.plan)))
            .groupBy(*GROUP)
            .agg(F.sum("count").alias("n_train"))
        )

    def test_rows(self) -> DataFrame:
        """Complete test rows, with their ``fold``."""
        tested = self.rows.where("test_fold is not null").drop("first_train_fold")
        return tested.withColumnRenamed("test_fold", "fold")

    def fold_sizes(self) -> DataFrame:
        """Training and test rows per fold; folds in which either is empty are left out."""
        tests = self.test_rows().groupBy(*GROUP).agg(F.count("*").alias("n_test"))
        return self.bounds.join(self.train_sizes(), GROUP).join(tests, GROUP)

    def fitted(self, forecaster: Forecaster) -> Forecaster:
        return forecaster.fit(self.rows, self.features, self.target, self.plan)

    def predictions(self, forecaster: Forecaster) -> DataFrame:
        """Test rows with ``prediction``, from a freshly fitted forecaster."""
        return self.fitted(forecaster).predict(self.test_rows())

    def run(self, forecaster: Forecaster) -> DataFrame:
        """One row per (entity, fold): bounds, sizes, MAE and MAPE."""
        y, p = F.col(self.target), F.col("prediction")
        scores = (
            self.predictions(forecaster)
            .groupBy(*GROUP)
            .agg(
                F.count("*").alias("n_test"),
                F.avg(abs_error(y, p)).alias("mae"),
                (F.avg(relative_error(y, p)) * 100).alias("mape"),
            )
        )
        return (
            self.bounds.join(self.train_sizes(), GROUP)
            .join(scores, GROUP)
            .select(
                F.lit(forecaster.name).alias("model"),
                *GROUP,
                "train_end",
                "test_start",
                "test_end",
                "n_train",
                "n_test",
                "mae",
                "mape",
            )
        )


def fold_summary(results: DataFrame) -> DataFrame:
    """Fold results for reading: dates, and rounded errors."""
    return results.select(
        "model",
        *GROUP,
        F.to_date("train_end").alias("train_end"),
        F.to_date("test_end").alias("test_end"),
        "n_train",
        "n_test",
        F.round("mae", 1).alias("mae"),
        F.round("mape", 2).alias("mape"),
    )


def model_ladder(backtest: Backtest, forecasters: Sequence[Forecaster]) -> DataFrame:
    """Mean MAPE over folds per entity and model; folds count alike, whatever their size."""
    results = union_all(*[backtest.run(f).select("model", "entity_id", "mape") for f in forecasters])
    return results.groupBy("entity_id", "model").agg(
        F.count("*").alias("n_folds"), F.avg("mape").alias("mean_mape")
    )


def skill(predictions: DataFrame, pairs: DataFrame, target: str = TARGET) -> DataFrame:
    """Per (entity, fold): model and published forecast on the hours both have.

    ``coverage`` is the share of test hours that have a published forecast and
    ``skill`` is 1 - model MAPE / published MAPE. The hours are matched on
    (entity, hour), which spreads evenly.
    """
    published = pairs.select(*KEYS, F.col("forecast"), F.lit(True).alias("_both"))
    y, p, f = F.col(target), F.col("prediction"), F.col("forecast")
    return (
        predictions.select(*KEYS, "fold", target, "prediction")
        .join(published, list(KEYS), "left")
        .groupBy(*GROUP)
        .agg(
            F.count("*").alias("n_test"),
            F.count("_both").alias("n_both"),
            (F.avg(F.when(F.col("_both"), relative_error(y, p))) * 100).alias("mape_model"),
            (F.avg(F.when(F.col("_both"), relative_error(y, f))) * 100).alias("mape_base"),
        )
        .withColumn("coverage", F.col("n_both") / F.col("n_test"))
        .withColumn("skill", 1 - F.try_divide("mape_model", "mape_base"))
    )


def ladder_with_baseline(scored: DataFrame, by: Sequence[str] = ("entity_id",)) -> DataFrame:
    """``skill`` rows averaged over folds per entity (and model, where ``by`` names it)."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("n_folds"),
        (F.sum("n_both") / F.sum("n_test")).alias("coverage"),
        F.avg("mape_model").alias("mape_model"),
        F.avg("mape_base").alias("mape_base"),
    )
