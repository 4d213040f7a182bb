"""Every operator as a named query over the driver's tables.

Averages and scores are rounded to a few digits at the very end, since the sum
of doubles depends on the order in which partitions are merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from loadpanel.models import (
    BoostedTreesForecaster,
    Forecaster,
    MeanForecaster,
    QuantileTreesForecaster,
    RidgeForecaster,
)
from loadpanel.functions.columns import HOUR_US, micros
from loadpanel.functions.sketches import K, merged, monthly_sketches, quantiles_of, rank_error, sketched_quantiles
from loadpanel.operators import bitmaps, lags, plausibility, quality, reshape
from loadpanel.operators import features as feat
from loadpanel.operators.folds import FoldPlan, assign_folds, fold_bounds, history
from loadpanel.plans import baseline
from loadpanel.plans.backtest import (
    Backtest,
    fold_summary,
    ladder_with_baseline,
    model_ladder,
    model_matrix,
    skill,
)
from loadpanel.plans.rolling import RollingFit
from loadpanel.scale import materialize, scratch_dir
from loadpanel.schema import COVARIATE_COLUMNS, KEYS, MODEL_FEATURES, OBSERVATION_KEYS
from loadpanel.sources import (
    PanelTables,
    load,
    parse_columnar,
    parse_rowwise,
    replace_table,
    scan_entity,
)
from loadpanel.sources.append import append_table
from loadpanel.sources.buckets import store_bucketed
from loadpanel.sources.json_splits import read_rowwise_split
from loadpanel.sources.driver_tables import (
    covariates,
    daily_obs,
    hourly_obs,
    stored,
    weather,
    zones,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

SMALL_MODEL = ("hdd", "cdd", "hour_local", "lag_48h", "lag_168h")
STUMP = ("is_weekend", "month_local")
# Two days per test window, so that the hourly panel of a month has all its folds.
HOURLY_PLAN = FoldPlan(n_folds=8, test_days=2, min_train_days=7)


def query(fn: Query) -> Query:
    # A trailing underscore keeps a query apart from the operator it is named after.
    _QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- shared inputs -----------------------------------------------------------


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(daily_obs(spark, sf_dir), "daily-obs")


def _features(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    obs = _daily(spark, sf_dir) if obs is None else obs
    return feat.build_features(obs, covariates(spark, sf_dir), zones(spark))


def _lagged(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    return lags.add_lags(materialize(_features(spark, sf_dir, obs), "features"))


def _backtest(spark: SparkSession, sf_dir: str, inputs=MODEL_FEATURES, plan=FoldPlan()) -> Backtest:
    return Backtest(_lagged(spark, sf_dir), inputs, plan=plan)


# --- sources and sinks -------------------------------------------------------


@query
def ingest_rowwise_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise JSON texts, one array per entity and day, back to observations."""
    record = F.struct(
        F.date_format("ts_utc", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("entity_id").alias("respondent"),
        F.col("series_type").alias("type"),
        F.col("value").cast("string").alias("value"),
    )
    documents = (
        hourly_obs(spark, sf_dir)
        .groupBy("entity_id", F.to_date("ts_utc").alias("day"))
        .agg(F.to_json(F.collect_list(record)).alias("body"))
    )
    return parse_rowwise(documents)


@query
def ingest_rowwise_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of many objects each, written and read back by byte ranges."""
    record = F.struct(
        F.date_format("ts_utc", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("entity_id").alias("respondent"),
        F.col("series_type").alias("type"),
        F.col("value").cast("string").alias("value"),
    )
    path = _table_path(spark, "documents")
    hourly_obs(spark, sf_dir).select(F.to_json(record)).write.option("lineSep", ",\n").text(path)
    return read_rowwise_split(spark, path)


@query
def ingest_columnar_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columnar JSON texts, one per entity and month, to long covariates."""
    hours = F.sort_array(
        F.collect_list(
            F.struct(
                F.date_format("ts_utc", "yyyy-MM-dd'T'HH:mm").alias("time"),
                *[F.col(c) for c in COVARIATE_COLUMNS],
            )
        )
    )
    lists = [F.col("hours")[c].alias(c) for c in ("time", *COVARIATE_COLUMNS)]
    documents = (
        weather(spark, sf_dir)
        .groupBy("entity_id", F.trunc("ts_utc", "month").alias("month"))
        .agg(hours.alias("hours"))
        .select(
            F.concat("entity_id", F.lit("_weather.json")).alias("file_name"),
            F.to_json(
                F.struct(F.struct(*lists).alias("hourly")), {"ignoreNullFields": "false"}
            ).alias("body"),
        )
    )
    return parse_columnar(documents)


def _table_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}/{name}"


@query
def store_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked replacement of the observation table, read back."""
    obs = daily_obs(spark, sf_dir).select(*OBSERVATION_KEYS, "value")
    path = _table_path(spark, "observations")
    return replace_table(obs, path, keys=OBSERVATION_KEYS, partition_by="series_type")


@query
def append_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation table, stored up to 1997 and then appended to year by year, read back."""
    obs = _daily(spark, sf_dir).select(*OBSERVATION_KEYS, "value")
    path = _table_path(spark, "observations")
    year = F.year("ts_utc")
    replace_table(obs.where(year <= 1997), path, keys=OBSERVATION_KEYS, partition_by="series_type")
    last = obs.agg(F.max(year)).first()[0] or 1997
    for y in range(1998, last + 1):
        append_table(obs.where(year == y), path, OBSERVATION_KEYS, partition_by="series_type")
    return spark.read.schema(obs.schema).parquet(path).select(*obs.columns)


@query
def features_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table from tables in buckets by (entity, hour): its joins move no rows."""
    obs, cov = _daily(spark, sf_dir).select(*OBSERVATION_KEYS, "value"), covariates(spark, sf_dir)
    medians = plausibility.entity_medians(obs)
    folder = _table_path(spark, "buckets")
    tables = [
        store_bucketed(df, f"{name}_{uuid.uuid4().hex}", f"{folder}/{name}", buckets=8)
        for name, df in (("observations", obs), ("covariates", cov))
    ]
    return feat.build_features(*tables, zones(spark), medians=medians)


@query
def store_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, stored as derived table and read back by a narrow scan."""
    table = replace_table(_features(spark, sf_dir), _table_path(spark, "features"))
    return table.groupBy("entity_id").agg(
        F.count("*").alias("n_rows"), F.max("demand_mw").alias("max_demand_mw")
    )


@query
def scan_entity_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_entity(daily_obs(spark, sf_dir), "R")


@query
def source_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source contract over a stored panel: both series in a closed time range."""
    source = PanelTables(_daily(spark, sf_dir).select(*OBSERVATION_KEYS, "value"), covariates(spark, sf_dir))
    first, last = datetime(1997, 3, 1), datetime(1998, 2, 28)
    return reshape.union_all(
        source.fetch_observations(first, last), source.fetch_external_baseline(first, last)
    )


@query
def source_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = daily_obs(spark, sf_dir).select(*OBSERVATION_KEYS, "value")
    source = PanelTables(obs, covariates(spark, sf_dir))
    return source.fetch_covariates(datetime(1999, 12, 1), datetime(2000, 2, 29))




@query
def union_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and hourly panels as one table."""
    return reshape.union_all(
        daily_obs(spark, sf_dir).select(*OBSERVATION_KEYS, "value"), hourly_obs(spark, sf_dir)
    )


# --- audits ------------------------------------------------------------------

LINE_KEY = ("l_orderkey", "l_linenumber")


@query
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_violations(load(spark, sf_dir, "lineitem"), LINE_KEY)


@query
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_extendedprice")
    return quality.duplicate_rows(lines, LINE_KEY)


@query
def first_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_extendedprice")
    return quality.duplicate_rows(lines, LINE_KEY, limit=20)


@query
def rowcount_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(hourly_obs(spark, sf_dir))


@query
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(hourly_obs(spark, sf_dir))


@query
def missing_forecast_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_hours(hourly_obs(spark, sf_dir), "D", "DF")


@query
def missing_actual_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_hours(hourly_obs(spark, sf_dir), "DF", "D")


@query
def first_missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.first_missing_hours(hourly_obs(spark, sf_dir), "D", "DF")


@query
def coverage_counts_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.coverage_by_bitmaps(hourly_obs(spark, sf_dir))


@query
def missing_forecast_hours_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.missing_by_bitmaps(hourly_obs(spark, sf_dir), "D", "DF")


@query
def missing_actual_hours_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmaps.missing_by_bitmaps(hourly_obs(spark, sf_dir), "DF", "D")


def _ranks_hold(rows: DataFrame, value: str, found: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Per entity: rows, and whether the rank of every found point is within the sketch's bound of the wanted one."""
    held = rows.where(F.col(value).isNotNull()).join(F.broadcast(found), "entity_id")
    off = {
        name: F.greatest(p - F.avg((F.col(value) <= F.col(name)).cast("int")), F.avg((F.col(value) < F.col(name)).cast("int")) - p)
        for name, p in probs.items()
    }
    return held.groupBy("entity_id").agg(F.count("*").alias("n"), *[(o <= rank_error(K)).alias(name) for name, o in off.items()])


@query
def value_distribution_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged monthly sketches: ends and rows are exact, every quantile's rank within the stated bound."""
    obs = _daily(spark, sf_dir).where("series_type = 'D'")
    months = materialize(monthly_sketches(obs, "value"), "monthly-sketches")
    points = {"min_val": 0.0, **quality.DISTRIBUTION, "max_val": 1.0}
    found = materialize(quantiles_of(merged(months), points), "sketched")
    return _ranks_hold(obs, "value", found, quality.DISTRIBUTION).join(found.select("entity_id", "min_val", "max_val"), "entity_id")


@query
def baseline_error_quantiles_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the published forecast's error from a sketch, held against the exact ranks."""
    errors = stored(baseline.errors(baseline.paired_forecasts(_daily(spark, sf_dir), max_rel_err=None)), "errors")
    found = materialize(sketched_quantiles(errors, ["entity_id"], "ape", baseline.ERROR_POINTS), "sketched")
    return _ranks_hold(errors, "ape", found, baseline.ERROR_POINTS)


@query
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = quality.value_distribution(_daily(spark, sf_dir))
    return rounded(spread, p001=4, median_val=4, p999=4)


@query
def implausible_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.implausible_counts(_daily(spark, sf_dir))


@query
def implausible_counts_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.implausible_counts(stored(hourly_obs(spark, sf_dir), "hourly-obs"))


@query
def absolute_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.absolute_outliers(daily_obs(spark, sf_dir))


@query
def band_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.band_sensitivity(_daily(spark, sf_dir))


@query
def marginal_band_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.marginal_rows(_daily(spark, sf_dir))


@query
def plausible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.plausible(_daily(spark, sf_dir))


@query
def covariate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.covariate_profile(covariates(spark, sf_dir))


@query
def covariate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(covariates(spark, sf_dir), ["feature"])


@query
def lag_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nulls = {f"null_{n}": f"lag_{n}h" for n in lags.LAGS}
    return quality.null_counts_by(_lagged(spark, sf_dir), nulls)


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_lagged(spark, sf_dir), [*MODEL_FEATURES, "dewpoint_c", "demand_mw"])


@query
def surviving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.surviving_rows(_lagged(spark, sf_dir), [*MODEL_FEATURES, "demand_mw"])


@query
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.time_range(hourly_obs(spark, sf_dir))


@query
def time_range_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.time_range_by_entity(daily_obs(spark, sf_dir))


@query
def daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak and minimum hour per day of the load summed over all entities."""
    total = (
        hourly_obs(spark, sf_dir)
        .groupBy(F.lit("all").alias("entity_id"), "ts_utc", "series_type")
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
    )
    return quality.daily_profile(total).withColumn("day", F.col("day").cast("string"))


# --- reshaping, features, calendar -------------------------------------------


@query
def melt_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.melt(weather(spark, sf_dir))


@query
def pivot_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.pivot(covariates(spark, sf_dir))


@query
def degree_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = feat.rename_covariates(weather(spark, sf_dir)).select(*KEYS, "temp_c")
    return feat.degree_days(wide)


@query
def local_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.local_calendar(weather(spark, sf_dir).select(*KEYS), zones(spark))


@query
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


@query
def feature_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.feature_sanity(_features(spark, sf_dir))


@query
def timezone_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.timezone_check(_features(spark, sf_dir), zones(spark))


@query
def demand_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.demand_temperature(_daily(spark, sf_dir), covariates(spark, sf_dir))


@query
def response_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.response_curve(demand_temperature(spark, sf_dir))


# --- lags --------------------------------------------------------------------

LAG_COLUMNS = ("lag_48h", "lag_168h", "lag_336h", "same_hour_4wk_avg")


@query
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lagged(spark, sf_dir).select(*KEYS, "demand_mw", *LAG_COLUMNS)


@query
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lagged(spark, sf_dir).select(*KEYS, "demand_mw", "rolling_24h_mean")


@query
def lag_features_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags by hours over the demand panel, gaps and all."""
    demand = feat.demand(_daily(spark, sf_dir))
    return lags.add_lags(demand, strict=True)


@query
def lag_features_strict_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the hourly panel, where about every twentieth hour is missing."""
    demand = feat.demand(stored(hourly_obs(spark, sf_dir), "hourly-obs"))
    return lags.add_lags(demand, strict=True)


@query
def features_lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lagged(spark, sf_dir)


@query
def lag_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags.lag_correlations(_lagged(spark, sf_dir))


@query
def model_matrix_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_matrix(_lagged(spark, sf_dir))


# --- published forecast ------------------------------------------------------


@query
def paired_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.paired_forecasts(_daily(spark, sf_dir))


@query
def baseline_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.baseline_score(baseline.paired_forecasts(_daily(spark, sf_dir)))


@query
def baseline_score_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = stored(hourly_obs(spark, sf_dir), "hourly-obs")
    return baseline.baseline_score(baseline.paired_forecasts(obs))


@query
def baseline_error_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = baseline.paired_forecasts(_daily(spark, sf_dir), max_rel_err=None)
    return baseline.error_quantiles(pairs)


@query
def baseline_score_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.raw_baseline_score(hourly_obs(spark, sf_dir))


# --- folds, backtests --------------------------------------------------------


@query
def fold_bounds_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_bounds(history(daily_obs(spark, sf_dir)))


@query
def fold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = materialize(_features(spark, sf_dir).select(*KEYS), "grid")
    ends = materialize(history(features), "history")
    return assign_folds(features, ends).select(*KEYS, "test_fold", "first_train_fold")


@query
def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backtest(spark, sf_dir).fold_sizes()


def _scored(results: DataFrame) -> DataFrame:
    return rounded(results, mae=2, mape=4)


@query
def backtest_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_backtest(spark, sf_dir).run(MeanForecaster()))


@query
def backtest_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean model on five inputs, so that fewer rows are incomplete."""
    results = _backtest(spark, sf_dir, SMALL_MODEL).run(MeanForecaster())
    summary = fold_summary(results)
    return summary.withColumns({c: F.col(c).cast("string") for c in ("train_end", "test_end")})


@query
def backtest_ridge_1f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_backtest(spark, sf_dir, ["lag_48h"]).run(RidgeForecaster()))


@query
def backtest_ridge_2f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_backtest(spark, sf_dir, ["cloud_pct", "temp_c"]).run(RidgeForecaster()))


@query
def backtest_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_backtest(spark, sf_dir).run(RidgeForecaster()))


@query
def backtest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of one split on the weekend, the month and the entity's level: the best variance cut of each fold."""
    stump = BoostedTreesForecaster(n_trees=1, learning_rate=1.0, depth=1, min_rows=1, name="stump")
    return _scored(_backtest(spark, sf_dir, STUMP).run(stump))


def boosted_trees() -> BoostedTreesForecaster:
    """Trees of the ladder, at the reference's settings."""
    return BoostedTreesForecaster(leaves=63)


@query
def backtest_two_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boosting steps at half rate, each a tree of one split on the weekend, the month or the entity's level."""
    steps = BoostedTreesForecaster(n_trees=2, learning_rate=0.5, min_rows=1, leaves=2, name="two_steps")
    return _scored(_backtest(spark, sf_dir, STUMP).run(steps))


@query
def backtest_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on all inputs and all folds."""
    return _backtest(spark, sf_dir).run(boosted_trees())


@query
def backtest_gbt_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trees on five inputs, so that fewer rows are incomplete."""
    return _backtest(spark, sf_dir, SMALL_MODEL).run(boosted_trees())


@query
def ladder_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three rungs on the same rows: mean model, ridge and boosted trees."""
    shared = _backtest(spark, sf_dir)
    rungs = [MeanForecaster(), RidgeForecaster(), boosted_trees()]
    return rounded(model_ladder(shared, rungs), mean_mape=4)


@query
def fold_assignment_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds of the hourly panel, where the gap of 39 hours ends inside a day."""
    demand = feat.demand(stored(hourly_obs(spark, sf_dir), "hourly-obs")).select(*KEYS)
    grid = materialize(demand, "grid")
    ends = materialize(history(grid), "history")
    return assign_folds(grid, ends, HOURLY_PLAN).select(*KEYS, "test_fold", "first_train_fold")


@query
def backtest_mean_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = feat.demand(stored(hourly_obs(spark, sf_dir), "hourly-obs"))
    return _scored(Backtest(demand, [], plan=HOURLY_PLAN).run(MeanForecaster()))


def _extended(spark: SparkSession, sf_dir: str, inputs, days: int = 45) -> tuple[Backtest, RollingFit]:
    """A backtest, and its training sums from a history that ended ``days`` earlier, carried on in three steps."""
    lagged = materialize(_lagged(spark, sf_dir), "lagged")
    whole = Backtest(lagged, inputs)
    left = micros("last_ts") - micros("ts_utc")
    dated = lagged.join(F.broadcast(whole.history), "entity_id").withColumn("_left", F.call_function("div", left, F.lit(24 * HOUR_US)))
    state = RollingFit.start(dated.where(F.col("_left") >= days), inputs)
    for first in range(days, 0, -15):
        state = state.extend(dated.where((F.col("_left") < first) & (F.col("_left") >= first - 15)))
    return whole, state


@query
def backtest_mean_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean model of every fold from training sums that were carried on day by day."""
    whole, state = _extended(spark, sf_dir, MODEL_FEATURES)
    return _scored(whole.run(state.mean()))


@query
def backtest_ridge_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge of every fold from the same."""
    whole, state = _extended(spark, sf_dir, ["cloud_pct", "temp_c"])
    return _scored(whole.run(state.ridge()))


@query
def fold_summary_(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = fold_summary(_backtest(spark, sf_dir).run(MeanForecaster()))
    return summary.withColumns({c: F.col(c).cast("string") for c in ("train_end", "test_end")})


@query
def model_ladder_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean model and one-input ridge on the same rows: mean MAPE over folds."""
    shared = _backtest(spark, sf_dir, ["lag_48h"])
    return rounded(model_ladder(shared, [MeanForecaster(), RidgeForecaster()]), mean_mape=4)


@query
def ladder_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean model and ridge on all 17 inputs; ladder_gbt has the trees beside them."""
    shared = _backtest(spark, sf_dir)
    return rounded(model_ladder(shared, [MeanForecaster(), RidgeForecaster()]), mean_mape=4)


def _skill(spark: SparkSession, sf_dir: str, *more: Forecaster) -> DataFrame:
    """Mean model, ridge and ``more`` beside the published forecast; one backtest serves all."""
    obs = _daily(spark, sf_dir)
    shared, pairs = Backtest(_lagged(spark, sf_dir, obs)), stored(baseline.paired_forecasts(obs), "pairs")
    scored = [
        skill(shared.predictions(model), pairs).withColumn("model", F.lit(model.name))
        for model in (MeanForecaster(), RidgeForecaster(), *more)
    ]
    return reshape.union_all(*scored)


@query
def skill_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_skill(spark, sf_dir), mape_model=4, mape_base=4, coverage=4, skill=4)


@query
def ladder_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ladder_with_baseline(_skill(spark, sf_dir), by=("model", "entity_id"))
    return rounded(scored, coverage=4, mape_model=4, mape_base=4)


@query
def skill_vs_baseline_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill of all three rungs; skill_vs_baseline has those that SQL can state."""
    return rounded(_skill(spark, sf_dir, boosted_trees()), mape_model=4, mape_base=4, coverage=4, skill=4)


@query
def ladder_vs_baseline_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three rungs beside the published forecast."""
    scored = ladder_with_baseline(_skill(spark, sf_dir, boosted_trees()), by=("model", "entity_id"))
    return rounded(scored, coverage=4, mape_model=4, mape_base=4)


@query
def quantile_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean model with the 5th, 50th and 95th percentile of its training residuals."""
    shared = _backtest(spark, sf_dir, ["lag_48h"])
    model = shared.fitted(MeanForecaster())
    q = model.predict_quantiles(shared.test_rows(), [0.05, 0.5, 0.95])
    return q.select(
        *KEYS,
        "fold",
        "prediction",
        *[F.round(F.col("quantiles")[i], 5).alias(n) for i, n in enumerate(("q05", "q50", "q95"))],
    )


@query
def quantile_forecast_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge on 17 inputs: share of test rows inside the 5 to 95 % band, per fold."""
    shared = _backtest(spark, sf_dir)
    model = shared.fitted(RidgeForecaster())
    q = model.predict_quantiles(shared.test_rows(), [0.05, 0.95])
    inside = F.col("demand_mw").between(F.col("quantiles")[0], F.col("quantiles")[1])
    return q.groupBy("entity_id", "fold").agg(
        F.count("*").alias("n_test"), F.avg(inside.cast("int")).alias("share_inside")
    )


@query
def quantile_forecast_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles that trees learn on 17 inputs: share of test rows inside the 5 to 95 % band, and its mean width."""
    shared = _backtest(spark, sf_dir)
    model = shared.fitted(QuantileTreesForecaster())
    q = model.predict_quantiles(shared.test_rows(), [0.05, 0.95])
    low, high = F.col("quantiles")[0], F.col("quantiles")[1]
    return q.groupBy("entity_id", "fold").agg(
        F.count("*").alias("n_test"),
        F.avg(F.col("demand_mw").between(low, high).cast("int")).alias("share_inside"),
        F.avg((high - low) / F.col("demand_mw")).alias("mean_width"),
    )
