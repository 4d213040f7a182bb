"""Predict the training mean: the floor other models must beat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.columns import MILLION, millionths, wide_sum
from loadpanel.models.base import GROUP, ResidualQuantiles
from loadpanel.operators.folds import FoldPlan, trained_folds
from loadpanel.scale import lookup_join, materialize


class MeanForecaster(ResidualQuantiles):
    def __init__(self, name: str = "mean") -> None:
        self.name = name

    def fit(
        self, rows: DataFrame, features: Sequence[str], target: str, plan: FoldPlan
    ) -> MeanForecaster:
        self._remember(rows, target, plan)
        # One partial sum per (entity, first fold); each then counts for every
        # fold from there on, which is a step on n_folds rows per entity.
        partial = (
            rows.where("first_train_fold is not null")
            .groupBy("entity_id", "first_train_fold")
            .agg(wide_sum(millionths(target)).alias("s"), F.count(target).alias("n"))
        )
        total = (
            partial.withColumn("fold", F.explode(trained_folds(plan)))
            .groupBy(*GROUP)
            .agg((F.sum("s").cast("double") / MILLION / F.sum("n")).alias("mean"))
        )
        self.means = materialize(total, "train-means")
        return self

    def predict(self, rows: DataFrame) -> DataFrame:
        return lookup_join(rows, self.means, GROUP, spread="ts_utc").withColumnRenamed("mean", "prediction")
