import json

import pytest
from frames import HOUR, T0, obs, rows
from pyspark.sql import functions as F

from loadpanel.models import Forecaster
from loadpanel.schema import COVARIATES, OBSERVATION_KEYS, OBSERVATIONS, KeyViolation, SchemaError
from loadpanel.sources import (
    DataSource,
    PanelTables,
    parse_columnar,
    parse_rowwise,
    read_columnar,
    read_rowwise,
    replace_table,
    scan_entity,
)


def record(period, value, entity="CISO", series="D"):
    return {"period": period, "respondent": entity, "type": series, "value": value, "value-units": "MWh"}


def test_rowwise_files(spark, tmp_path):
    (tmp_path / "CISO_D.json").write_text(json.dumps([record("2024-01-01T00", "12.5"), record("2024-01-01T01", None)]))
    (tmp_path / "CISO_DF.json").write_text(json.dumps([record("2024-01-01T00", "13", series="DF")], indent=1))
    table = read_rowwise(spark, str(tmp_path))
    assert rows(table, "series_type", "ts_utc", "entity_id") == [
        ("D", T0, "CISO"), ("D", T0 + HOUR, "CISO"), ("DF", T0, "CISO"),
    ]
    assert sorted((r["value"] for r in table.collect()), key=str) == [12.5, 13.0, None]
    assert [f.dataType for f in table.schema] == [f.dataType for f in OBSERVATIONS]


def test_bad_number_raises(spark):
    texts = spark.createDataFrame([(json.dumps([record("2024-01-01T00", "abc")]),)], "body string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_rowwise(texts).collect()


def test_nan_text_becomes_null(spark):
    texts = spark.createDataFrame([(json.dumps([record("2024-01-01T00", "NaN")]),)], "body string")
    assert parse_rowwise(texts).first()["value"] is None


def test_columnar_files(spark, tmp_path):
    body = {
        "hourly_units": {"temperature_2m": "C"},
        "hourly": {
            "time": ["2024-01-01T00:00", "2024-01-01T01:00"],
            "temperature_2m": [1.5, None],
            "cloud_cover": [10, 20],
        },
    }
    (tmp_path / "ERCO_weather.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "PJM_weather.json").write_text(json.dumps(body))
    table = read_columnar(spark, str(tmp_path))
    assert rows(table.where("entity_id = 'ERCO'"), "feature", "ts_utc", "value") == [
        ("cloud_cover", T0, 10.0), ("cloud_cover", T0 + HOUR, 20.0), ("temperature_2m", T0, 1.5),
    ]
    assert table.count() == 6
    assert [f.dataType for f in table.schema] == [f.dataType for f in COVARIATES]


def test_columnar_entity_comes_from_the_file_name(spark):
    texts = spark.createDataFrame(
        [('{"hourly": {"time": ["2024-01-01T00:00"], "cloud_cover": [1]}}', "FPL_weather.json")],
        "body string, file_name string",
    )
    assert rows(parse_columnar(texts), "entity_id", "feature") == [("FPL", "cloud_cover")]


def test_replace_checks_the_key_and_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "observations")
    first = obs(spark, [1.0, 2.0]).unionByName(obs(spark, [3.0], series="DF"))
    stored = replace_table(first, path, OBSERVATION_KEYS, "series_type")
    assert stored.columns == first.columns and rows(stored, "value") == [(1.0,), (2.0,), (3.0,)]
    with pytest.raises(KeyViolation):
        replace_table(first.unionByName(first), path, OBSERVATION_KEYS, "series_type")
    assert spark.read.parquet(path).count() == 3
    replace_table(obs(spark, [9.0]), path, OBSERVATION_KEYS, "series_type")
    assert rows(spark.read.parquet(path), "value") == [(9.0,)]


def test_scan_binds_the_entity(spark):
    table = obs(spark, [1.0]).unionByName(obs(spark, [2.0], entity="O'Hare' or '1'='1"))
    assert rows(scan_entity(table, "X"), "value") == [(1.0,)]
    assert rows(scan_entity(table, "O'Hare' or '1'='1"), "value") == [(2.0,)]


def test_source_bounds_are_inclusive_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "obs")
    obs(spark, [float(i + 1) for i in range(200)]).unionByName(
        obs(spark, [5.0] * 200, series="DF")
    ).write.parquet(path)
    cov = spark.createDataFrame([], COVARIATES)
    source = PanelTables(spark.read.parquet(path), cov)
    assert isinstance(source, DataSource)
    week = source.fetch_observations(T0, T0 + 168 * HOUR)
    assert week.count() == 169
    assert source.fetch_external_baseline(T0, T0).count() == 1
    assert source.fetch_covariates(T0, T0).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = source.fetch_observations(T0, T0 + 168 * HOUR)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(ts_utc" in pushed and "LessThanOrEqual(ts_utc" in pushed
    assert PanelTables(spark.read.parquet(path), cov, forecast=None).fetch_external_baseline(T0, T0) is None


def test_source_refuses_other_types(spark):
    naive = obs(spark, [1.0]).withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    with pytest.raises(SchemaError, match="ts_utc"):
        PanelTables(naive, spark.createDataFrame([], COVARIATES))


def stub(*members):
    """An object with the named members and nothing else."""
    return type("Stub", (), {m: "stub" if m == "name" else lambda self, *args: None for m in members})()


FETCH = ("fetch_observations", "fetch_covariates", "fetch_external_baseline")
MODEL = ("fit", "predict", "predict_quantiles")


@pytest.mark.parametrize("contract, members", [(DataSource, FETCH), (Forecaster, MODEL)])
def test_contracts_need_every_member(contract, members):
    assert isinstance(stub("name", *members), contract)
    for left_out in ("name", *members):
        assert not isinstance(stub(*({"name", *members} - {left_out})), contract)


def test_every_member_of_a_columnar_document_is_a_feature(spark):
    body = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "snow": [NaN, 1.5], "rain": [null, 2]}}'
    texts = spark.createDataFrame([(body, "FPL_weather.json")], "body string, file_name string")
    assert rows(parse_columnar(texts), "feature", "value") == [("rain", 2.0), ("snow", 1.5)]
    assert rows(parse_columnar(texts, features=["snow"]), "feature") == [("snow",)]
    with pytest.raises(Exception, match="no entity in the file name"):
        parse_columnar(texts.withColumn("file_name", F.lit("FPL.json"))).collect()


def test_replacement_leaves_nothing_of_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    d, df = obs(spark, [1.0, 2.0]), obs(spark, [3.0], series="DF")
    replace_table(d, path, OBSERVATION_KEYS, "series_type")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert rows(replace_table(df, path, OBSERVATION_KEYS, "series_type"), "value") == [(3.0,)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_a_failing_check_or_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_table(obs(spark, [1.0]), path)

    def refuse(table):
        raise KeyViolation("no")

    with pytest.raises(KeyViolation):
        replace_table(obs(spark, [2.0]), path, check=refuse)
    with pytest.raises(Exception, match="broken"):
        replace_table(obs(spark, [2.0]).withColumn("value", F.raise_error(F.lit("broken")).cast("double")), path)
    assert [r["value"] for r in spark.read.parquet(path).collect()] == [1.0]
