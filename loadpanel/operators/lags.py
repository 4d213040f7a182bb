"""Lagged features that look no nearer than the forecast lead allows.

``row`` lags count rows, ``time`` lags count hours; on a gapless panel they
agree. Neither form ever puts a whole long history into one task:

* time lags cut each entity into spans of time and copy the rows a span looks
  back at into it, so one shuffle and one sort serve every lag;
* row lags use a plain per-entity window while every history is known to fit a
  task, and otherwise number the rows and cut them into equal runs, each with a
  copy of the rows before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from loadpanel.functions.columns import HOUR_US, MILLION, floor_div, micros, millionths, safe_corr
from loadpanel.scale import groups_within, lookup_join, materialize, row_bound

# Lags, weekly offsets, rolling frame and the longest lead, in hours.
LAGS = (48, 168, 336)
WEEKLY = (168, 336, 504, 672)
ROLLING = (71, 48)
MIN_LEAD = 39

# Longest history, in rows, that one window task takes.
TASK_ROWS = 1_000_000
# Length of a span of the time form, in hours (about half a year).
SPAN_HOURS = 4_380

# Stretches of time per run of rows: finer than needed for evenly spaced rows, so
# that a burst of rows in a short time is still spread.
STRETCHES_PER_RUN = 16

_OWN, _PART, _ORDER = "_own", "_part", "_order"


class LeadError(ValueError):
    """A feature would use values that are unknown when the forecast is made."""


def check_lead(lags: Sequence[int], rolling: tuple[int, int] | None, min_lead: int) -> None:
    near = [n for n in lags if n < min_lead]
    if near:
        raise LeadError(f"lags {near} are nearer than the lead of {min_lead}")
    if rolling and (rolling[1] < min_lead or rolling[0] < rolling[1]):
        raise LeadError(f"rolling frame {rolling} must end at least {min_lead} back")


def add_lags(
    features: DataFrame,
    lags: Sequence[int] = LAGS,
    weekly: Sequence[int] = WEEKLY,
    rolling: tuple[int, int] | None = ROLLING,
    min_lead: int = MIN_LEAD,
    strict: bool = False,
    value: str = "demand_mw",
    entity: str = "entity_id",
    ts: str = "ts_utc",
    task_rows: int = TASK_ROWS,
    span_hours: int = SPAN_HOURS,
) -> DataFrame:
    """Append ``lag_<n>h``, the same-hour weekly mean and the rolling mean.

    ``strict`` counts hours instead of rows. Pass a stored table: unless its size
    is known, the row form counts its rows before it decides how to run.
    """
    check_lead([*lags, *weekly], rolling, min_lead)
    reach = max([*lags, *weekly, *(rolling or ())])
    if strict:
        framed, window = _cut_by_time(features, entity, ts, reach, span_hours), _hours
    elif groups_within(features, [entity], task_rows, row_bound(features)):
        framed = features.withColumns(
            {_OWN: F.lit(True), _PART: F.lit(0), _ORDER: F.col(ts)}
        )
        window = _rows
    else:
        framed, window = _cut_by_rows(features, entity, ts, reach, max(task_rows, reach)), _rows
    ordered = W.partitionBy(entity, _PART).orderBy(_ORDER)

    def back(n: int) -> Column:
        return window(ordered, value, n)

    columns = {f"lag_{n}h": back(n) for n in lags}
    if weekly:
        total = back(weekly[0])
        for n in weekly[1:]:
            total = total + back(n)
        columns[f"same_hour_{len(weekly)}wk_avg"] = total / float(len(weekly))
    if rolling:
        far, near = rolling
        frame = (
            ordered.rangeBetween(-far * HOUR_US, -near * HOUR_US)
            if strict
            else ordered.rowsBetween(-far, -near)
        )
        columns[f"rolling_{far - near + 1}h_mean"] = F.try_divide(
            _fixed_sum_over(value, frame), F.count(value).over(frame)
        )
    return framed.withColumns(columns).where(_OWN).drop(_OWN, _PART, _ORDER)


def _fixed_sum_over(value: str, frame: WindowSpec) -> Column:
    return F.sum(millionths(value)).over(frame).cast("double") / MILLION


def _rows(ordered: WindowSpec, value: str, n: int) -> Column:
    return F.lag(value, n).over(ordered)


def _hours(ordered: WindowSpec, value: str, n: int) -> Column:
    return F.max(value).over(ordered.rangeBetween(-n * HOUR_US, -n * HOUR_US))


def _cut_by_time(df: DataFrame, entity: str, ts: str, reach: int, span_hours: int) -> DataFrame:
    """Rows in their own time span, and copied into each later span within reach."""
    at = micros(ts)
    own = floor_div(at, span_hours * HOUR_US)
    last = floor_div(at + F.lit(reach * HOUR_US), span_hours * HOUR_US)
    return (
        df.withColumns({_ORDER: at, "_home": own, _PART: F.explode(F.sequence(own, last))})
        .withColumn(_OWN, F.col(_PART) == F.col("_home"))
        .drop("_home")
    )


def _cut_by_rows(df: DataFrame, entity: str, ts: str, reach: int, run: int) -> DataFrame:
    """Rows in runs of ``run`` per entity, each with the ``reach`` rows before it.

    Row numbers come from a count per stretch of time, a running total of those
    counts, and a row number inside the stretch.
    """
    at = micros(ts)
    stretches = F.ceil(F.count("*") * F.lit(STRETCHES_PER_RUN) / F.lit(run))
    width = F.call_function("div", F.max(at) - F.min(at), stretches) + 1
    spans = materialize(
        df.groupBy(entity).agg(F.min(at).alias("_lo"), width.alias("_width")), "lag-spans"
    )
    stretch = F.call_function("div", at - F.col("_lo"), F.col("_width"))
    placed = (
        lookup_join(df, spans, [entity], spread=ts)
        .withColumn("_stretch", stretch)
        .drop("_lo", "_width")
    )
    before = W.partitionBy(entity).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialize(
        placed.groupBy(entity, "_stretch")
        .agg(F.count("*").alias("_n"))
        .select(entity, "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
        "lag-offsets",
    )
    within = W.partitionBy(entity, "_stretch").orderBy(ts)
    number = F.col("_before") + F.row_number().over(within) - 1
    home = F.call_function("div", F.col(_ORDER), F.lit(run).cast("long"))
    near_end = F.col(_ORDER) % run >= run - reach
    return (
        lookup_join(placed, offsets, [entity, "_stretch"], spread=ts)
        .withColumn(_ORDER, number)
        .withColumn("_home", home)
        .withColumn(
            _PART,
            F.explode(
                F.when(near_end, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(
                    F.array("_home")
                )
            ),
        )
        .withColumn(_OWN, F.col(_PART) == F.col("_home"))
        .drop("_home", "_stretch", "_before")
    )


def lag_correlations(
    lagged: DataFrame,
    columns: Sequence[str] = ("lag_48h", "lag_168h", "lag_336h", "hdd", "cdd"),
    target: str = "demand_mw",
) -> DataFrame:
    """Per entity: correlation of the target with each column, NULL if one is constant."""
    return lagged.groupBy("entity_id").agg(
        *[F.round(safe_corr(target, c), 3).alias(f"c_{c.removeprefix('lag_')}") for c in columns]
    )
