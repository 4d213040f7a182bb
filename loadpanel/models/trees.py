"""Gradient-boosted trees, one ensemble per fold over all entities."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loadpanel.models import boosting
from loadpanel.models.base import ResidualQuantiles
from loadpanel.models.mean import MeanForecaster
from loadpanel.operators.folds import FoldPlan, trained_folds
from loadpanel.scale import lookup_join, materialize

LEVEL, SHARE = "_level", "_share"


class BoostedTreesForecaster(ResidualQuantiles):
    """One boosted ensemble per fold, over all entities.

    The trees learn the target as a share of the mean of the entity's training rows
    in that fold, so that large entities do not outweigh small ones; that mean is
    also an input. Trees grow best first to ``leaves`` leaves of any depth; without
    ``leaves`` they grow to ``depth``. All folds are fitted together: inputs are cut
    into bins once, over all rows that train, and a pass over the rows serves every
    fold. Nothing is drawn at random, so ``seed`` changes nothing.
    """

    quantile: float | None = None

    def __init__(
        self,
        n_trees: int = 400,
        learning_rate: float = 0.05,
        depth: int = 6,
        min_rows: int = 50,
        seed: int = 0,
        leaves: int | None = None,
        name: str = "boosted_trees",
    ) -> None:
        self.n_trees, self.learning_rate, self.depth = n_trees, learning_rate, depth
        self.min_rows, self.seed, self.leaves = min_rows, seed, leaves
        self.name = name

    def _settings(self, quantile: float | None) -> boosting.Settings:
        best_first = self.leaves is not None
        leaves, depth = (self.leaves, None) if best_first else (2**self.depth, self.depth)
        return boosting.Settings(self.n_trees, self.learning_rate, self.min_rows, leaves, depth, quantile)

    def fit(
        self, rows: DataFrame, features: Sequence[str], target: str, plan: FoldPlan
    ) -> BoostedTreesForecaster:
        self._remember(rows, target, plan)
        self.features = list(features)
        means = MeanForecaster().fit(rows, features, target, plan).means
        # An entity that is zero on average keeps its own scale.
        level = F.coalesce(F.nullif(F.col("mean"), F.lit(0.0)), F.lit(1.0))
        self.levels = materialize(means.select("entity_id", "fold", level.alias(LEVEL)), "levels")
        train = rows.where("first_train_fold is not null")
        self._cuts = next(iter(boosting.bin_edges(train, self.features).values()), [])
        self._level_cuts = boosting.bin_edges(self.levels, [LEVEL], by="fold")
        once = train.select("entity_id", "ts_utc", "first_train_fold", target, self._binned().alias("bins"))
        by_fold = once.withColumn("fold", F.explode(trained_folds(plan)))
        levelled = lookup_join(by_fold, self.levels, ["entity_id", "fold"], spread="ts_utc")
        self._rows = materialize(
            levelled.select(
                F.col("fold").cast("int").alias("fit"),
                F.concat("bins", self._level_bin()).alias("bins"),
                (F.col(target) / F.col(LEVEL)).alias("y"),
            ),
            "binned",
        )
        self._n_rows = {r["fit"]: r["count"] for r in self._rows.groupBy("fit").count().collect()}
        self._models: dict[float | None, boosting.Model] = {}
        self.models = self._model(self.quantile)
        return self

    def _model(self, quantile: float | None) -> boosting.Model:
        """The trees of every fold for the mean, or for a quantile; fitted when first asked for."""
        if quantile not in self._models:
            self._models[quantile] = boosting.fit(self._rows, self._sizes(), self._settings(quantile), self._n_rows)
        return self._models[quantile]

    def _sizes(self) -> dict[int, list[int]]:
        return {k: [len(c) + 1 for c in [*self._cuts, *self._level_cuts[k]]] for k in self._n_rows}

    def _binned(self) -> Column:
        """Bins of the inputs as bytes."""
        cuts = self._cuts

        @F.pandas_udf("binary")
        def bins(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                found = [boosting.binned(c.to_numpy(float), own) for c, own in zip(columns, cuts)]
                yield pd.Series(boosting.packed(np.stack(found, axis=1)), dtype=object)

        return bins(*self.features) if self.features else F.lit(b"")

    def _level_bin(self) -> Column:
        cuts = {k: own[0] for k, own in self._level_cuts.items()}

        @F.pandas_udf("binary")
        def bins(levels: pd.Series, folds: pd.Series) -> pd.Series:
            found = [int(np.searchsorted(cuts[k], v, "left")) for v, k in zip(levels, folds)]
            return pd.Series([bytes([b]) for b in found], dtype=object)

        return bins(LEVEL, "fold")

    def _predicted(self, rows: DataFrame, quantiles: Sequence[float | None]) -> Column:
        """Targets predicted by the model of each quantile, as an array; ``rows`` have a level."""
        models = [self._model(q) for q in quantiles]
        sizes, rate = self._sizes(), self.learning_rate
        cuts, level_cuts = self._cuts, self._level_cuts

        @F.pandas_udf("array<double>")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for fold, level, *inputs in batches:
                folds, levels = fold.to_numpy(), level.to_numpy(float)
                out = np.zeros((len(folds), len(models)))
                for k in np.unique(folds).tolist():
                    own = np.flatnonzero(folds == k)
                    bins = [boosting.binned(c.to_numpy(float)[own], x) for c, x in zip(inputs, cuts)]
                    bins.append(boosting.binned(levels[own], level_cuts[k][0]))
                    layout = boosting.Layout(sizes[k])
                    flat = layout.flat(np.stack(bins, axis=1))
                    for i, model in enumerate(models):
                        out[own, i] = boosting.predict(flat, layout, *model[k], rate) * levels[own]
                yield pd.Series(list(out), dtype=object)

        return predict("fold", LEVEL, *self.features)

    def predict(self, rows: DataFrame) -> DataFrame:
        if not self.models:
            return rows.withColumn("prediction", F.lit(0.0)).where(F.lit(False))
        levelled = lookup_join(rows, self.levels, ["entity_id", "fold"], spread="ts_utc")
        return levelled.withColumn("prediction", self._predicted(rows, [self.quantile])[0]).drop(LEVEL)


class QuantileTreesForecaster(BoostedTreesForecaster):
    """Quantiles that the trees themselves learn, one ensemble per fold and quantile.

    The gradients are those of the pinball loss and a leaf has the quantile of its residuals, so a band widens where
    the target varies more. The forecast is the median. Quantiles of one row are put in rising order, so they never
    cross. An ensemble is fitted when its quantile is first asked for.
    """

    quantile = 0.5

    def __init__(
        self,
        n_trees: int = 100,
        learning_rate: float = 0.1,
        depth: int = 4,
        min_rows: int = 50,
        seed: int = 0,
        leaves: int | None = 15,
        name: str = "quantile_trees",
    ) -> None:
        super().__init__(n_trees, learning_rate, depth, min_rows, seed, leaves, name)

    def predict_quantiles(self, rows: DataFrame, quantiles: Sequence[float]) -> DataFrame:
        """Append ``prediction`` and the array ``quantiles`` in the order asked for."""
        if not self.models:
            return self.predict(rows).withColumn("quantiles", F.array().cast("array<double>"))
        rising = sorted(set(map(float, quantiles)))
        levelled = lookup_join(rows, self.levels, ["entity_id", "fold"], spread="ts_utc")
        found = levelled.withColumn("_found", self._predicted(rows, [self.quantile, *rising]))
        sorted_ = F.array_sort(F.slice("_found", 2, len(rising)))
        ordered = found.withColumn("_sorted", sorted_)
        asked = F.array(*[F.col("_sorted")[rising.index(float(q))] for q in quantiles])
        return ordered.withColumns({"prediction": F.col("_found")[0], "quantiles": asked}).drop("_found", "_sorted", LEVEL)
