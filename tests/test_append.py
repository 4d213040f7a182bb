"""Appends that keep the key, with the files that had to be read; and joins of bucketed tables."""

import datetime as dt
import re
import uuid

import pytest
from frames import COV, OBS, T0, rows

from loadpanel.operators.features import build_features
from loadpanel.operators.plausibility import entity_medians
from loadpanel.schema import COVARIATE_COLUMNS, OBSERVATION_KEYS, KeyViolation
from loadpanel.sources import append, replace_table
from loadpanel.sources.buckets import store_bucketed


def hours(spark, first, n, entity="X", series="D"):
    return spark.createDataFrame([(entity, T0 + dt.timedelta(hours=first + i), series, float(i)) for i in range(n)], OBS)


@pytest.fixture
def table(spark, tmp_path):
    """Two months in a file each, by series."""
    path = str(tmp_path / "observations")
    replace_table(hours(spark, 0, 700).coalesce(1), path, OBSERVATION_KEYS, "series_type")
    append.append_table(hours(spark, 720, 700), path, OBSERVATION_KEYS, "series_type")
    return path


def content(spark, path):
    return rows(spark.read.schema(OBS).parquet(path), "entity_id", "ts_utc", "series_type", "value")


def test_new_hours_read_no_file(spark, table):
    assert append.append_table(hours(spark, 1440, 50), table, OBSERVATION_KEYS, "series_type") == []
    assert append.append_table(hours(spark, 0, 50, series="DF"), table, OBSERVATION_KEYS, "series_type") == []
    parts = [hours(spark, 0, 700), hours(spark, 720, 700), hours(spark, 1440, 50), hours(spark, 0, 50, series="DF")]
    assert content(spark, table) == sorted(r for part in parts for r in rows(part, "entity_id", "ts_utc", "series_type", "value"))


def test_a_clash_raises_and_leaves_the_table(spark, table):
    before = content(spark, table)
    with pytest.raises(KeyViolation, match="stored already"):
        append.append_table(hours(spark, 1415, 30), table, OBSERVATION_KEYS, "series_type")
    with pytest.raises(KeyViolation, match="repeated or null"):
        append.append_table(hours(spark, 2000, 2).unionAll(hours(spark, 2000, 2)), table, OBSERVATION_KEYS, "series_type")
    assert content(spark, table) == before


def test_only_files_with_likely_keys_are_looked_into(spark, table):
    """A late hour inside the first file's times, that the file lacks, reads nothing; one it has names that file."""
    index = append._index(spark, table)
    assert index.select("file").distinct().count() >= 2
    late = hours(spark, 10, 3, entity="late")
    assert append.append_table(late, table, OBSERVATION_KEYS, "series_type") == []
    found = append.likely_files(hours(spark, 699, 1).unionAll(hours(spark, 705, 1)), append._index(spark, table), OBSERVATION_KEYS)
    assert len(rows(found, "file")) == 1 and rows(found, "ts_utc") == [(T0 + dt.timedelta(hours=699),)]


def test_no_stored_key_is_missed_and_few_others_match(spark, table):
    index = append._index(spark, table)
    assert append.likely_files(hours(spark, 0, 700), index, OBSERVATION_KEYS).count() == 700
    others = spark.createDataFrame([(f"e{i}", T0 + dt.timedelta(hours=5), "D", 0.0) for i in range(5000)], OBS)
    assert append.likely_files(others, index, OBSERVATION_KEYS).count() < 25


def test_an_interrupted_run_is_indexed_by_the_next(spark, table):
    hours(spark, 3000, 5).write.mode("append").partitionBy("series_type").parquet(table)
    with pytest.raises(KeyViolation, match="stored already"):
        append.append_table(hours(spark, 3004, 3), table, OBSERVATION_KEYS, "series_type")


def test_features_over_bucketed_tables_need_no_exchange(spark, tmp_path):
    n = 400
    obs = hours(spark, 0, n).selectExpr("entity_id", "ts_utc", "series_type", "100 + value as value")
    cov = spark.createDataFrame([("X", T0 + dt.timedelta(hours=i), f, float(i % 30)) for i in range(n) for f in COVARIATE_COLUMNS], COV)
    tz = spark.createDataFrame([("X", "UTC")], "entity_id string, tzname string")
    medians = entity_medians(obs)
    plain = build_features(obs, cov, tz, medians=medians)
    name = uuid.uuid4().hex
    try:
        tables = [store_bucketed(df, f"{t}_{name}", str(tmp_path / t), buckets=4) for t, df in (("obs", obs), ("cov", cov))]
        features = build_features(*tables, tz, medians=medians)
        plan = features._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"(?<!Broadcast)Exchange (hash|range|round|single)", plan)
        assert re.search(r"Exchange hashpartitioning", plain._jdf.queryExecution().executedPlan().toString())
        assert rows(features, *features.columns) == rows(plain, *plain.columns)
    finally:
        for t in ("obs", "cov"):
            spark.sql(f"drop table if exists {t}_{name}")
