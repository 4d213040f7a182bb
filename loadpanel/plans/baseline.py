"""Score of the published external forecast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.columns import abs_error, relative_error
from loadpanel.functions.quantiles import exact_quantiles
from loadpanel.functions.sketches import sketched_quantiles
from loadpanel.operators.plausibility import MAX_RELATIVE_ERROR, pair, plausible
from loadpanel.scale import materialize, row_bound

# The reported points of the error distribution.
ERROR_POINTS = {"p50": 0.50, "p90": 0.90, "p99": 0.99}


def paired_forecasts(
    obs: DataFrame, max_rel_err: float | None = MAX_RELATIVE_ERROR, medians: DataFrame | None = None
) -> DataFrame:
    """Hours with a plausible actual and a plausible forecast."""
    return pair(plausible(obs, medians=medians), max_rel_err=max_rel_err)


def errors(pairs: DataFrame) -> DataFrame:
    """Absolute and percentage error of every pair."""
    actual, forecast = F.col("actual"), F.col("forecast")
    return pairs.select(
        "entity_id",
        abs_error(actual, forecast).alias("abs_err"),
        relative_error(actual, forecast).alias("ape"),
    )


def _score(errors: DataFrame) -> DataFrame:
    return errors.groupBy("entity_id").agg(
        F.count("*").alias("n_hours"),
        F.round(F.avg("abs_err"), 1).alias("mae_mw"),
        F.round(F.avg("ape") * 100, 2).alias("mape_pct"),
    )


def baseline_score(pairs: DataFrame) -> DataFrame:
    """Per entity: hours, mean absolute error, mean and median percentage error."""
    found = materialize(errors(pairs), "baseline-errors")
    medians = exact_quantiles(
        found, ["entity_id"], "ape", {"m": 0.5}, total=row_bound(found)
    ).select("entity_id", F.round(F.col("m") * 100, 2).alias("median_ape_pct"))
    return _score(found).join(medians, "entity_id").orderBy("mape_pct", "entity_id")


def error_quantiles(
    pairs: DataFrame, probs: Mapping[str, float] = ERROR_POINTS, sketch: int | None = None
) -> DataFrame:
    """Per entity: quantiles of the percentage error; exact, unless a ``sketch`` of that size is asked for."""
    if sketch is not None:
        points = sketched_quantiles(errors(pairs), ["entity_id"], "ape", probs, sketch)
    else:
        found = materialize(errors(pairs), "baseline-errors")
        points = exact_quantiles(found, ["entity_id"], "ape", probs, total=row_bound(found))
    rounded = [F.round(F.col(name) * 100, 2).alias(name) for name in probs]
    return points.select("entity_id", *rounded).orderBy(next(iter(probs)), "entity_id")


def raw_baseline_score(obs: DataFrame) -> DataFrame:
    """The score before any plausibility filter; only positive actuals."""
    return _score(errors(pair(obs).where("actual > 0"))).orderBy("mape_pct", "entity_id")
