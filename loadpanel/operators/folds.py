"""Rolling-origin folds without a range join.

Test windows tile the end of each history and training sets are nested, so the
test fold of a row and the first fold that trains on it follow from the row's
distance to the end of its entity's history by integer arithmetic. A row is
touched once, however many folds train on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loadpanel.functions.columns import DAY_US, HOUR_US, floor_div, micros
from loadpanel.scale import is_small, lookup_join


@dataclass(frozen=True)
class FoldPlan:
    """Number of folds, days per test window, gap in hours, shortest training span."""

    n_folds: int = 8
    test_days: int = 30
    gap_hours: int = 39
    min_train_days: int = 365

    @property
    def span_us(self) -> int:
        return self.test_days * DAY_US

    @property
    def gap_us(self) -> int:
        return self.gap_hours * HOUR_US


def history(df: DataFrame, entity: str = "entity_id", ts: str = "ts_utc") -> DataFrame:
    """First and last instant per entity, over all rows, complete or not."""
    return df.groupBy(entity).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def fold_bounds(ends: DataFrame, plan: FoldPlan = FoldPlan(), entity: str = "entity_id") -> DataFrame:
    """The folds of each entity, from its ``history``.

    A fold whose training span is shorter than ``min_train_days`` is left out;
    the others keep their number.
    """
    left = F.lit(plan.n_folds - 1) - F.col("fold")

    def days(n: Column) -> Column:
        return F.make_dt_interval((n * plan.test_days).cast("int"))

    numbered = ends.select("*", F.explode(F.sequence(F.lit(0), F.lit(plan.n_folds - 1))).alias("fold"))
    bounds = (
        numbered.withColumn("test_end", F.col("last_ts") - days(left))
        .withColumn("test_start", F.col("last_ts") - days(left + 1))
        .withColumn(
            "train_end",
            F.col("test_start") - F.make_dt_interval(F.lit(0), F.lit(plan.gap_hours)),
        )
    )
    long_enough = micros("train_end") - micros("first_ts") >= plan.min_train_days * DAY_US
    return bounds.where(long_enough).select(
        entity, F.col("fold").cast("long").alias("fold"), "train_end", "test_start", "test_end"
    )


def test_fold(at: Column, end: Column, plan: FoldPlan) -> Column:
    """Fold whose test window (start, end] holds the row, NULL if none does.

    ``at`` and ``end`` are microseconds, here and below.
    """
    k = F.lit(plan.n_folds - 1) - floor_div(end - at, plan.span_us)
    return F.when(k.between(0, plan.n_folds - 1), k)


def first_train_fold(at: Column, end: Column, plan: FoldPlan) -> Column:
    """First fold that trains on the row (all later ones do too), NULL if none does."""
    j = F.lit(plan.n_folds) - floor_div(end - at - plan.gap_us, plan.span_us)
    return F.when(j < plan.n_folds, F.greatest(j, F.lit(0).cast("long")))


def first_kept_fold(start: Column, end: Column, plan: FoldPlan) -> Column:
    """First fold with a long enough training span; ``n_folds`` or more if none has."""
    slack = end - start - plan.gap_us - plan.min_train_days * DAY_US
    return F.greatest(F.lit(0).cast("long"), F.lit(plan.n_folds) - floor_div(slack, plan.span_us))


def assign_folds(
    df: DataFrame,
    ends: DataFrame,
    plan: FoldPlan = FoldPlan(),
    entity: str = "entity_id",
    ts: str = "ts_utc",
) -> DataFrame:
    """Append ``test_fold`` and ``first_train_fold``, counting only folds that are kept.

    ``ends`` is the ``history``. Both columns are NULL for a row no fold uses.
    """
    at, end, kept = micros(ts), F.col("_end"), F.col("_kept")
    tested, trained = test_fold(at, end, plan), first_train_fold(at, end, plan)
    first, last = micros("first_ts"), micros("last_ts")
    small = is_small(ends)
    per_entity = ends.select(
        entity, last.alias("_end"), first_kept_fold(first, last, plan).alias("_kept")
    )
    return (
        lookup_join(df, per_entity, [entity], spread=ts, small=small)
        .withColumn("test_fold", F.when(tested >= kept, tested))
        .withColumn(
            "first_train_fold",
            F.when(trained.isNotNull() & (kept < plan.n_folds), F.greatest(trained, kept)),
        )
        .drop("_end", "_kept")
    )


def trained_folds(plan: FoldPlan) -> Column:
    """Array of every fold that trains on a row (or on a per-fold partial sum)."""
    return F.sequence(F.col("first_train_fold"), F.lit(plan.n_folds - 1).cast("long"))
