"""Quantile sketches: rank error on skewed, repeated and merged values."""

import datetime as dt
import random

import numpy as np
import pytest
from frames import T0, obs

from loadpanel.functions.sketches import merged, monthly_sketches, quantiles_of, rank_error, sketched_quantiles
from loadpanel.operators.quality import value_distribution
from loadpanel.plans.baseline import error_quantiles

PROBS = {f"p{i}": i / 100 for i in (1, 10, 25, 50, 75, 90, 99)}


def values(kind, n=40_000):
    rng = np.random.default_rng(11)
    if kind == "skewed":
        return np.exp(rng.normal(0, 3, n))
    if kind == "repeated":
        return rng.choice([1.0, 2.0, 2.0, 2.0, 50.0, -3.0], n)
    return np.sort(rng.uniform(-5, 5, n))[::-1]


def off(v, found, p):
    """How far the ranks that a value has are from the wanted one."""
    return max(0.0, (v < found).mean() - p, p - (v <= found).mean())


@pytest.mark.parametrize("kind", ["skewed", "repeated", "falling"])
@pytest.mark.parametrize("k", [200, 2048])
def test_ranks_within_the_stated_error(spark, kind, k):
    v = values(kind)
    months = [("X", T0 + dt.timedelta(days=int(i * 700 / len(v))), float(x)) for i, x in enumerate(v)]
    frame = spark.createDataFrame(months, "entity_id string, ts_utc timestamp_ntz, value double").repartition(5)
    sketches = monthly_sketches(frame, "value", k)
    assert sketches.count() == 23
    row = quantiles_of(merged(sketches, k=k), {**PROBS, "lo": 0.0, "hi": 1.0}).first()
    assert (row["lo"], row["hi"]) == (v.min(), v.max())
    # Merging keeps the bound; it holds in 99 of 100 cases, so a fifth is added.
    assert all(off(v, row[name], p) <= 1.2 * rank_error(k) for name, p in PROBS.items())


def test_merged_months_are_any_span_without_reading_rows(spark):
    rng = random.Random(3)
    data = [("X" if i % 3 else "Y", T0 + dt.timedelta(days=i // 10), rng.gauss(0, 1)) for i in range(1500)]
    frame = spark.createDataFrame(data, "entity_id string, ts_utc timestamp_ntz, value double")
    sketches = monthly_sketches(frame, "value")
    some = merged(sketches.where("month between '2024-02-01' and '2024-03-01'"))
    got = {r["entity_id"]: (r["n"], r["lo"]) for r in some.collect()}
    for entity in ("X", "Y"):
        own = [v for e, t, v in data if e == entity and t.month in (2, 3)]
        assert got[entity] == (len(own), min(own))


def test_nulls_do_not_count_and_small_groups_are_exact(spark):
    frame = obs(spark, [5.0, 1.0, float("nan"), 3.0]).unionByName(obs(spark, [float("nan")], entity="none"))
    row = sketched_quantiles(frame, ["entity_id"], "value", {"lo": 0.0, "m": 0.5, "hi": 1.0}).collect()
    assert [tuple(r) for r in row] == [("X", 1.0, 3.0, 5.0)]


def test_option_on_the_reports(spark):
    rng = np.random.default_rng(5)
    v = rng.uniform(100, 200, 3000)
    frame = obs(spark, v.tolist())
    row = value_distribution(frame, sketch=1024).first()
    assert row.asDict().keys() == value_distribution(frame).first().asDict().keys()
    assert (row["min_val"], row["max_val"]) == (v.min(), v.max()) and off(v, row["median_val"], 0.5) <= rank_error(1024)
    pairs = spark.createDataFrame([("X", 100.0, 100.0 + i) for i in range(100)], "entity_id string, actual double, forecast double")
    assert abs(error_quantiles(pairs, sketch=1024).first()["p50"] - 49.5) <= 1
