"""A backtest that goes on: the training sums of all folds as a stored state, carried on by new rows alone.

Fold bounds move with the end of a history, by whole steps. Between any two bounds that can ever be, rows of an entity
always train together, so their sums are one row of state: counts, exact sums of the target, and sums of products.
What lies before the first fold's bound stays there for good and is one row. So the state of an entity has a bounded
number of rows, and adding a day reads that day and the state, never the history.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadpanel.functions.columns import HOUR_US, MILLION, floor_div, micros, millionths, wide_sum
from loadpanel.models import MeanForecaster, RidgeForecaster
from loadpanel.models.ridge import added_moments, centres, moment_sums, solve_folds, wide_codegen
from loadpanel.operators.folds import FoldPlan, first_kept_fold, first_train_fold, trained_folds
from loadpanel.plans.backtest import TARGET, complete_rows
from loadpanel.scale import lookup_join, materialize
from loadpanel.schema import KEYS, MODEL_FEATURES, require_columns

GROUP = ["entity_id", "fold"]


class StepError(ValueError):
    """A history ends where no whole number of steps leads."""


class _Carried:
    """A forecaster that is fitted already."""

    def fit(self, rows: DataFrame, features: Sequence[str], target: str, plan: FoldPlan):
        return self


class CarriedMean(_Carried, MeanForecaster):
    pass


class CarriedRidge(_Carried, RidgeForecaster):
    pass


@dataclass(frozen=True)
class RollingFit:
    """Training sums of one panel.

    ``ends`` has first, last and anchor of each entity in microseconds, ``centre`` the shift of its variables, fixed
    when the entity is first met, ``sums`` its buckets: bucket b holds the rows after ``anchor + (b - 1) * unit`` and
    up to ``anchor + b * unit``.
    """

    ends: DataFrame
    centre: DataFrame
    sums: DataFrame
    features: tuple[str, ...]
    target: str
    plan: FoldPlan
    step_hours: int

    @classmethod
    def start(
        cls,
        rows: DataFrame,
        features: Sequence[str] = MODEL_FEATURES,
        target: str = TARGET,
        plan: FoldPlan = FoldPlan(),
        step_hours: int = 24,
    ) -> RollingFit:
        """The state of a first history. Histories are to grow by whole multiples of ``step_hours``."""
        require_columns(rows, [*KEYS, *features, target])
        spark = rows.sparkSession
        variables = [*features, target]
        none = (
            spark.createDataFrame([], "entity_id string, first long, last long, anchor long"),
            spark.createDataFrame([], "entity_id string, centre array<double>"),
            spark.createDataFrame([], "entity_id string, bucket long, s decimal(38,0), n double, moments array<double>"),
        )
        return cls(*none, tuple(features), target, plan, step_hours)._with(rows.select(*KEYS, *variables))

    def extend(self, rows: DataFrame) -> RollingFit:
        """The state with rows added; only these rows and the state are read.

        Rows may be late, but none may have been added before. Raises if an entity's history would not end a
        whole number of steps after its first end.
        """
        require_columns(rows, [*KEYS, *self._variables])
        return self._with(rows.select(*KEYS, *self._variables))

    @property
    def _variables(self) -> list[str]:
        return [*self.features, self.target]

    @property
    def _unit(self) -> int:
        """Longest time of which span, gap and step are multiples, in microseconds."""
        return math.gcd(self.plan.span_us, self.plan.gap_us, self.step_hours * HOUR_US)

    def _with(self, rows: DataFrame) -> RollingFit:
        rows = materialize(rows.withColumn("_at", micros("ts_utc")), "rolling-new")
        new = rows.groupBy("entity_id").agg(F.min("_at").alias("first"), F.max("_at").alias("last"))
        both = self.ends.unionByName(new.withColumn("anchor", F.lit(None).cast("long")))
        ends = both.groupBy("entity_id").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("anchor").alias("anchor"))
        ends = materialize(ends.withColumn("anchor", F.coalesce("anchor", "last")), "rolling-ends")
        off = ends.where(F.pmod(F.col("last") - F.col("anchor"), F.lit(self.step_hours * HOUR_US)) != 0).limit(5).collect()
        if off:
            raise StepError(f"histories must grow by {self.step_hours} hours or multiples; not so {[r['entity_id'] for r in off]}")

        complete = complete_rows(rows, self._variables)
        fresh = centres(complete.join(self.centre.select("entity_id"), "entity_id", "left_anti"), self._variables)
        centre = materialize(self.centre.unionByName(fresh), "rolling-centre")
        # Upper ends belong to a bucket: (ts - anchor) / unit, rounded up.
        anchored = lookup_join(complete, ends.select("entity_id", "anchor"), ["entity_id"], spread="ts_utc")
        placed = anchored.withColumn("bucket", -floor_div(F.col("anchor") - F.col("_at"), self._unit))
        keys = ["entity_id", "bucket"]
        with wide_codegen(rows.sparkSession, len(self._variables)):
            exact = placed.groupBy(*keys).agg(wide_sum(millionths(self.target)).alias("s"))
            added = moment_sums(placed, centre, self._variables, keys).join(exact, keys)
            added = materialize(added.select(*keys, "s", "n", "moments"), "rolling-added")
            # All up to the first fold's bound trains in every fold, now and later.
            settled = floor_div(self._bound(0) - F.col("anchor"), self._unit)
            merged = lookup_join(self.sums.unionByName(added), ends, ["entity_id"], spread="bucket")
            sums = merged.groupBy("entity_id", F.greatest("bucket", settled).alias("bucket")).agg(
                F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n"), added_moments(len(self._variables)).alias("moments")
            )
            sums = materialize(sums, "rolling-sums")
        return RollingFit(ends, centre, sums, self.features, self.target, self.plan, self.step_hours)

    def _bound(self, fold: int) -> Column:
        """Where training of a fold ends."""
        return F.col("last") - self.plan.gap_us - (self.plan.n_folds - fold) * self.plan.span_us

    def _by_first_fold(self) -> DataFrame:
        """The buckets with the first fold that trains on them."""
        at = F.col("anchor") + F.col("bucket") * self._unit
        trained = first_train_fold(at, F.col("last"), self.plan)
        kept = first_kept_fold(F.col("first"), F.col("last"), self.plan)
        first = F.when(trained.isNotNull() & (kept < self.plan.n_folds), F.greatest(trained, kept))
        placed = lookup_join(self.sums, self.ends, ["entity_id"], spread="bucket")
        return placed.withColumn("first_train_fold", first).where("first_train_fold is not null")

    def mean(self) -> CarriedMean:
        """The mean model of every fold."""
        by_fold = self._by_first_fold().withColumn("fold", F.explode(trained_folds(self.plan)))
        total = F.sum("s").cast("double") / MILLION / F.sum("n")
        model = CarriedMean()
        model.means = materialize(by_fold.groupBy(*GROUP).agg(total.alias("mean")), "train-means")
        return model

    def ridge(self, alpha: float = 1.0) -> CarriedRidge:
        """Ridge regression of every fold."""
        model = CarriedRidge(alpha)
        model.features = list(self.features)
        n = len(self._variables)
        with wide_codegen(self.sums.sparkSession, n):
            partial = self._by_first_fold().groupBy("entity_id", "first_train_fold").agg(F.sum("n").alias("n"), added_moments(n).alias("moments"))
            partial = materialize(partial, "rolling-partial")
        model.coefficients = solve_folds(partial, self.centre, n - 1, model.alpha, self.plan.n_folds)
        return model

    def save(self, path: str) -> None:
        for name in ("ends", "centre", "sums"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        path: str,
        features: Sequence[str] = MODEL_FEATURES,
        target: str = TARGET,
        plan: FoldPlan = FoldPlan(),
        step_hours: int = 24,
    ) -> RollingFit:
        """A saved state; the settings are those it was started with."""
        tables = [spark.read.parquet(f"{path}/{name}") for name in ("ends", "centre", "sums")]
        return cls(*tables, tuple(features), target, plan, step_hours)
