"""The paths taken when a table is too large to broadcast give the same rows."""

import pytest
from frames import HOUR, T0

from loadpanel import scale
from loadpanel.operators import plausibility
from loadpanel.scale import groups_within, is_small, key_filter, lookup_join, materialize, row_bound


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to one entity."""
    rows = [("hot" if i % 3 == 0 else f"e{i % 7}", T0 + i * HOUR, "D", float(i % 50 + 1)) for i in range(3_000)]
    return spark.createDataFrame(rows, "entity_id string, ts_utc timestamp_ntz, series_type string, value double")


@pytest.fixture(scope="module")
def levels(spark):
    return spark.createDataFrame([("hot", 1), ("e1", 2), ("e2", 3)], "entity_id string, level int")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_beyond_the_bound_is_salted_and_equal(skewed, levels):
    small = lookup_join(skewed, levels, ["entity_id"], spread="ts_utc")
    large = lookup_join(skewed, levels, ["entity_id"], spread="ts_utc", max_rows=2)
    assert "BroadcastHashJoin" in plan_of(small) and "_salt" in plan_of(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.select(*small.columns).collect()))


def test_hot_entity_is_spread_over_the_salts(skewed, levels):
    from pyspark.sql import functions as F

    salt = F.pmod(F.xxhash64("ts_utc"), F.lit(scale.SALTS))
    hot = skewed.where("entity_id = 'hot'").groupBy(salt).count().agg(F.max("count"), F.count("*")).first()
    assert hot[1] > scale.SALTS / 2 and hot[0] < 1_000 / 8


def test_key_filter_beyond_the_bound(skewed, levels):
    keys = levels.select("entity_id")
    a = key_filter(skewed, keys, ["entity_id"])
    b = key_filter(skewed, keys, ["entity_id"], max_rows=1)
    assert a.count() == b.count() == skewed.where("entity_id in ('hot', 'e1', 'e2')").count()


def test_band_without_broadcast(skewed, monkeypatch):
    want = sorted(map(tuple, plausibility.plausible(skewed).collect()))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 1)
    got = plausibility.plausible(skewed)
    assert "_salt" in plan_of(got)
    assert sorted(map(tuple, got.collect())) == want


def test_sizes(skewed, levels):
    assert is_small(levels, 3) and not is_small(levels, 2)
    assert groups_within(skewed, ["entity_id"], 1_000) and not groups_within(skewed, ["entity_id"], 999)
    assert groups_within(skewed, ["entity_id"], 5_000, total=4_000)


def test_materialized_tables_are_counted_and_pruned(spark, skewed):
    stored = materialize(skewed, "skewed")
    assert row_bound(stored) == 3_000 and row_bound(skewed) is None
    assert "ReadSchema: struct<value:double>" in plan_of(stored.select("value"))


def test_empty_frames_are_stored_too(spark, levels):
    for nothing in (levels.where("false"), levels.where("level > 9"), spark.createDataFrame([], "a int")):
        assert row_bound(materialize(nothing, "nothing")) == 0


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = scale.scratch_dir(spark)
    assert folder == named if named else folder
    assert folder in materialize(spark.range(5), "five").inputFiles()[0]


def test_a_cluster_without_a_shared_folder_gets_one_clear_error():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scale.scratch_dir(Session())
