"""Every query that SQL can state gives the same names, rows and values in DuckDB."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_one_row_per_entity_and_model(spark):
    result = driver.entry(spark)
    assert result.columns == ["entity_id", "model", "n_folds", "mean_mape"]
    assert result.count() == 6


def test_trees_run_all_folds_of_all_entities(spark, sf_dir):
    score = {(r["entity_id"], r["model"]): (r["n_folds"], r["mean_mape"]) for r in QUERIES["ladder_gbt"](spark, sf_dir).collect()}
    entities = {e for e, _ in score}
    assert len(score) == 9 and {n for n, _ in score.values()} == {8}
    for e in entities:
        assert score[e, "boosted_trees"][1] < 1.5 * score[e, "mean"][1]


def test_quantile_band_covers_most_test_rows(spark, sf_dir):
    rows = QUERIES["quantile_forecast_ridge"](spark, sf_dir).collect()
    assert len(rows) == 24
    assert sum(r["share_inside"] for r in rows) / len(rows) > 0.75
