"""The contract every forecaster meets, and the quantiles they share.

A forecaster is fitted for all entities and folds at once. Training rows carry
``first_train_fold``: fold ``k`` trains on the rows where it is at most ``k``.
Rows to predict carry ``fold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.quantiles import exact_quantiles
from loadpanel.operators.folds import FoldPlan, trained_folds
from loadpanel.scale import lookup_join, materialize, row_bound

GROUP = ["entity_id", "fold"]


@runtime_checkable
class Forecaster(Protocol):
    name: str

    def fit(self, rows: DataFrame, features: Sequence[str], target: str, plan: FoldPlan) -> Forecaster: ...

    def predict(self, rows: DataFrame) -> DataFrame: ...

    def predict_quantiles(self, rows: DataFrame, quantiles: Sequence[float]) -> DataFrame: ...


class ResidualQuantiles:
    """Quantile forecasts from the training residuals of each (entity, fold).

    The point forecast is shifted by the exact residual quantiles. Needs
    ``_train``, ``_target`` and ``_plan`` to be set by ``fit``.
    """

    _train: DataFrame
    _target: str
    _plan: FoldPlan

    def _remember(self, rows: DataFrame, target: str, plan: FoldPlan) -> None:
        self._train, self._target, self._plan = rows, target, plan

    def training_rows(self) -> DataFrame:
        """One row per training row and fold that trains on it."""
        return self._train.where("first_train_fold is not null").withColumn(
            "fold", F.explode(trained_folds(self._plan))
        )

    def training_residuals(self) -> DataFrame:
        """entity_id, fold and residual of every training row in every fold that trains on it."""
        residual = F.col(self._target) - F.col("prediction")
        return self.predict(self.training_rows()).select(*GROUP, residual.alias("residual"))

    def predict_quantiles(self, rows: DataFrame, quantiles: Sequence[float]) -> DataFrame:
        """Append ``prediction`` and the array ``quantiles`` in the order asked for."""
        # Read for the group sizes and in each round: three narrow columns, stored once.
        residuals = materialize(self.training_residuals(), "residuals")
        names = {f"_r{i}": float(q) for i, q in enumerate(quantiles)}
        found = exact_quantiles(residuals, GROUP, "residual", names, total=row_bound(residuals))
        shifts = materialize(found, "residual-quantiles")
        spread = F.array(*[F.col("prediction") + F.col(name) for name in names])
        return (
            lookup_join(self.predict(rows), shifts, GROUP, spread="ts_utc")
            .withColumn("quantiles", spread)
            .drop(*names)
        )
