import pytest
from frames import COV, HOUR, OBS, T0, obs, rows

from loadpanel.functions.columns import safe_corr
from loadpanel.operators import plausibility as pl
from loadpanel.operators import quality as q
from loadpanel.plans.baseline import baseline_score, paired_forecasts, raw_baseline_score
from loadpanel.schema import EmptyColumn, KeyViolation, SchemaError, require_columns

KEY = ["entity_id", "ts_utc", "series_type"]


def test_sentinel_is_removed_and_stops_inflating_the_error(spark):
    values = [24_000.0 + i for i in range(20)] + [2_147_483_647.0]
    panel = obs(spark, values).unionByName(obs(spark, [24_000.0] * 21, series="DF"))
    assert raw_baseline_score(panel).first()["mae_mw"] > 1e7
    cleaned = baseline_score(paired_forecasts(panel)).first()
    assert cleaned["n_hours"] == 20 and cleaned["mae_mw"] == pytest.approx(9.5)


def test_zero_run_and_negative_midnight_are_counted(spark):
    panel = obs(spark, [100.0] * 10 + [0.0] * 6 + [-6813.0])
    counts = pl.implausible_counts(panel).first()
    assert (counts["non_positive"], counts["too_low"], counts["too_high"], counts["total"]) == (7, 0, 0, 17)
    assert pl.absolute_outliers(panel).count() == 7
    assert pl.plausible(panel).count() == 10


def test_near_zero_value_needs_the_band(spark):
    panel = obs(spark, [24_296.0] * 9 + [14.0])
    assert panel.where("value > 0").count() == 10
    assert pl.plausible(panel).count() == 9
    assert pl.implausible_counts(panel).first()["too_low"] == 1


def test_partial_report_is_caught_only_against_the_forecast(spark):
    panel = obs(spark, [26_000.0] * 9 + [13_000.0]).unionByName(obs(spark, [26_000.0] * 10, series="DF"))
    assert pl.plausible(panel).count() == 20
    assert paired_forecasts(panel, max_rel_err=None).count() == 10
    assert paired_forecasts(panel).count() == 9


def test_bands_are_swept_in_one_pass_and_nulls_are_not_counted(spark):
    panel = spark.createDataFrame(
        [("X", T0 + i * HOUR, "D", v) for i, v in enumerate([100.0] * 7 + [15.0, 450.0, 700.0, None])], OBS
    )
    assert rows(pl.band_sensitivity(panel), "lo", "hi", "removed") == [
        (0.1, 5.0, 1), (0.2, 3.0, 3), (0.3, 2.5, 3), (0.5, 2.0, 3),
    ]
    assert [r["value"] for r in pl.marginal_rows(panel).collect()] == [15.0, 450.0]


def test_duplicate_key_raises_and_all_members_are_listed(spark):
    panel = obs(spark, [1.0, 2.0]).unionByName(obs(spark, [9.0]))
    assert rows(q.key_violations(panel, KEY), "n_rows") == [(2,)]
    assert sorted(r["value"] for r in q.duplicate_rows(panel, KEY).collect()) == [1.0, 9.0]
    with pytest.raises(KeyViolation):
        q.assert_key(panel, KEY)


def test_null_key_raises(spark):
    with pytest.raises(KeyViolation):
        q.assert_key(spark.createDataFrame([(None, T0, "D", 1.0)], OBS), KEY)
    assert q.assert_key(obs(spark, [1.0]), KEY).count() == 1


def test_coverage_looks_both_ways(spark):
    panel = obs(spark, [1.0, 2.0, None]).unionByName(obs(spark, [None, 5.0, 6.0], series="DF"))
    c = q.coverage(panel).first()
    assert (c["missing_forecast"], c["missing_actual"]) == (1, 1)
    assert c["first_missing_actual"] == c["last_missing_actual"] == T0 + 2 * HOUR
    assert rows(q.missing_hours(panel, "DF", "D"), "ts_utc") == [(T0 + 2 * HOUR,)]


def test_one_way_gap(spark):
    panel = obs(spark, [1.0, None]).unionByName(obs(spark, [5.0, 6.0], series="DF"))
    c = q.coverage(panel).first()
    assert (c["missing_forecast"], c["missing_actual"]) == (0, 1)


def test_equal_peaks_go_to_the_earliest_hour(spark):
    day = [5.0] * 24
    day[7] = day[19] = 9.0
    day[3] = day[4] = 1.0
    profile = q.daily_profile(obs(spark, day + [1.0] * 23)).collect()
    assert [(r["peak_hour"], r["peak_value"], r["min_hour"]) for r in profile] == [(7, 9.0, 3)]


def test_null_profile_and_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert rows(q.null_profile(df, ["a", "b"]), "column_name", "n_null") == [("a", 1), ("b", 2)]
    assert tuple(q.surviving_rows(df, ["a"]).first()) == (2, 1)
    assert q.assert_no_empty_column(df, ["a"]) is df
    with pytest.raises(EmptyColumn, match="b"):
        q.assert_no_empty_column(df, ["a", "b"])


def test_missing_columns_are_named_without_a_job(spark):
    df = obs(spark, [1.0])
    with pytest.raises(SchemaError, match="wind"):
        require_columns(df, ["value", "wind"])


def test_span_counts_whole_days(spark):
    span = q.time_range(obs(spark, [1.0] * 48)).first()
    assert (span["first_ts"], span["last_ts"], span["span_days"]) == (T0, T0 + 47 * HOUR, 1)


def test_constant_series_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y")).first()[0] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "x double, y double")
    assert line.agg(safe_corr("x", "y")).first()[0] == pytest.approx(1.0)


def test_covariate_profile_rounds(spark):
    cov = spark.createDataFrame([("X", T0, "t", 1.04), ("X", T0 + HOUR, "t", 2.0)], COV)
    assert tuple(q.covariate_profile(cov).first()) == ("t", 2, 1.0, 1.5, 2.0)


def test_first_missing_hours_of_each_entity(spark):
    both = obs(spark, [1.0] * 60).unionByName(obs(spark, [1.0] * 30, entity="Y")).unionByName(obs(spark, [1.0], series="DF"))
    got = q.first_missing_hours(both, "D", "DF").collect()
    hours = {e: sorted(r["ts_utc"] for r in got if r["entity_id"] == e) for e in "XY"}
    assert hours == {"X": [T0 + i * HOUR for i in range(1, 21)], "Y": [T0 + i * HOUR for i in range(20)]}
