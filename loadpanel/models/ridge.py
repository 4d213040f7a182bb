"""Ridge regression for every (entity, fold) from one pass of sums.

Minimises |y - b0 - Xb|^2 + alpha |b|^2 with an unpenalised intercept. The
second moments of a row add up, and training sets are nested, so each row adds
to one partial sum and the folds are running totals of those.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadpanel.models.base import GROUP, ResidualQuantiles
from loadpanel.operators.folds import FoldPlan
from loadpanel.scale import is_small, lookup_join, materialize
from loadpanel.session import setting


class RidgeForecaster(ResidualQuantiles):
    def __init__(self, alpha: float = 1.0, name: str = "ridge") -> None:
        self.alpha = float(alpha)
        self.name = name

    def fit(
        self, rows: DataFrame, features: Sequence[str], target: str, plan: FoldPlan
    ) -> RidgeForecaster:
        self._remember(rows, target, plan)
        self.features = list(features)
        variables = [*self.features, target]
        train = rows.where("first_train_fold is not null").dropna(subset=variables)
        # Sums of squares of raw values lose digits; any fixed shift per entity
        # leaves slopes and predictions as they are.
        centre = centres(train, variables)
        partial = moment_sums(train, centre, variables, ["entity_id", "first_train_fold"])
        self.coefficients = solve_folds(partial, centre, len(self.features), self.alpha, plan.n_folds)
        return self

    def predict(self, rows: DataFrame) -> DataFrame:
        """Append ``prediction``; ``beta`` is the intercept followed by the slopes."""
        line = F.col("beta")[0]
        for i, c in enumerate(self.features):
            line = line + F.col("beta")[i + 1] * F.col(c)
        return (
            lookup_join(rows, self.coefficients, GROUP, spread="ts_utc")
            .withColumn("prediction", line)
            .drop("beta")
        )


def centres(rows: DataFrame, variables: Sequence[str]) -> DataFrame:
    """entity_id and the mean of each variable, as an array."""
    means = [F.avg(c) for c in variables]
    return materialize(rows.groupBy("entity_id").agg(F.array(*means).alias("centre")), "ridge-centre")


def _number_of_sums(n_variables: int) -> int:
    return n_variables + n_variables * (n_variables + 1) // 2


def moment_sums(rows: DataFrame, centre: DataFrame, variables: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """keys, n and moments: sums of the centred variables and of their products; combined map-side."""
    shifted = lookup_join(rows, centre, ["entity_id"], spread="ts_utc").selectExpr(
        *keys,
        # No value is null any more; saying so spares a null check per product.
        *[f"coalesce(`{c}` - centre[{i}], 0d) as _z{i}" for i, c in enumerate(variables)],
    )
    z = range(len(variables))
    sums = [f"sum(_z{i})" for i in z] + [f"sum(_z{i} * _z{j})" for i in z for j in z if i <= j]
    return shifted.groupBy(*keys).agg(
        F.expr("cast(count(*) as double) as n"), F.expr(f"array({', '.join(sums)}) as moments")
    )


def added_moments(n_variables: int) -> Column:
    """Sum of arrays of moments, value by value."""
    return F.array(*[F.sum(F.col("moments")[i]) for i in range(_number_of_sums(n_variables))])


def solve_folds(partial: DataFrame, centre: DataFrame, p: int, alpha: float, n_folds: int) -> DataFrame:
    """Coefficients of every (entity, fold) from (entity_id, first_train_fold, n, moments)."""
    # At most n_folds rows per entity from here on.
    few = is_small(centre)
    solved = (
        lookup_join(partial, centre, ["entity_id"], spread="first_train_fold", small=few)
        .groupBy("entity_id")
        .applyInPandas(_solver(p, alpha, n_folds), "entity_id string, fold long, beta array<double>")
    )
    # Whole-stage code generation stops at 100 columns by default.
    with wide_codegen(partial.sparkSession, p + 1):
        return materialize(solved, "ridge-coefficients")


def wide_codegen(spark: SparkSession, n_variables: int):
    return setting(spark, "spark.sql.codegen.maxFields", str(10 * _number_of_sums(n_variables)))


def _solver(p: int, alpha: float, n_folds: int):
    """Per entity: partial sums by first fold -> (entity, fold, intercept and slopes)."""
    upper = np.triu_indices(p + 1)

    def solve(segments: pd.DataFrame) -> pd.DataFrame:
        segments = segments.sort_values("first_train_fold")
        count, moments, out = 0.0, np.zeros(p + 1 + len(upper[0])), []
        starts = dict(zip(segments["first_train_fold"], zip(segments["n"], segments["moments"])))
        centre = np.asarray(segments["centre"].iloc[0])
        for fold in range(int(min(starts)), n_folds):
            if fold in starts:
                count, moments = count + starts[fold][0], moments + np.asarray(starts[fold][1])
            mean = moments[: p + 1] / count
            products = np.zeros((p + 1, p + 1))
            products[upper] = moments[p + 1 :]
            scatter = products - count * np.triu(np.outer(mean, mean))
            gram = scatter + np.triu(scatter, 1).T
            slopes = np.linalg.solve(gram[:p, :p] + alpha * np.eye(p), gram[:p, p])
            level = centre + mean
            out.append((fold, np.concatenate([[level[p] - slopes @ level[:p]], slopes])))
        frame = pd.DataFrame(out, columns=["fold", "beta"])
        frame.insert(0, "entity_id", segments["entity_id"].iloc[0])
        return frame

    return solve
