"""Boosted trees against a plain leaf-wise learner, tasks against rounds, and learnt quantiles."""

import datetime as dt
import heapq

import numpy as np
import pytest
from frames import T0
from pyspark.sql import functions as F

from loadpanel.models import BoostedTreesForecaster, Forecaster, QuantileTreesForecaster, boosting
from loadpanel.operators.folds import FoldPlan
from loadpanel.plans.backtest import Backtest


def plain_tree(bins, g, leaves, min_rows, depth=None):
    """Splits in order as (path, input, bin): one leaf at a time, every cut of every leaf tried from scratch."""

    def best(rows, level):
        found = (0.0, None)
        if depth is not None and level >= depth:
            return found
        for i in range(bins.shape[1]):
            for cut in range(int(bins[:, i].max())):
                goes = bins[rows, i] <= cut
                a, b = rows[goes], rows[~goes]
                if min(len(a), len(b)) < max(min_rows, 1):
                    continue
                gain = float(g[a].sum()) ** 2 / len(a) + float(g[b].sum()) ** 2 / len(b) - float(g[rows].sum()) ** 2 / len(rows)
                if gain > found[0]:
                    found = (gain, (i, cut))
        return found

    everything = np.arange(len(g))
    gain, cut = best(everything, 0)
    queue, splits, ends = [(-gain, 1, cut, everything, 0)], [], {1: everything}
    while queue and len(splits) < leaves - 1:
        less, path, cut, rows, level = heapq.heappop(queue)
        if cut is None or less >= 0:
            break
        splits.append((path, *cut))
        del ends[path]
        goes = bins[rows, cut[0]] <= cut[1]
        for child, own in ((2 * path, rows[goes]), (2 * path + 1, rows[~goes])):
            ends[child] = own
            gain, found = best(own, level + 1)
            heapq.heappush(queue, (-gain, child, found, own, level + 1))
    return splits, ends


def data(n=300, seed=3):
    rng = np.random.default_rng(seed)
    sizes = [12, 3, 20, 5]
    bins = np.stack([rng.integers(0, s, n) for s in sizes], axis=1).astype(np.uint8)
    y = 1 + 0.2 * (bins[:, 0] > 5) * (bins[:, 2] / 20) - 0.3 * (bins[:, 1] == 1) + rng.normal(0, 0.1, n)
    return bins, y, sizes


@pytest.mark.parametrize("leaves, depth, min_rows", [(9, None, 5), (40, None, 1), (8, 3, 10), (2, 1, 1)])
def test_leaf_wise_tree_split_by_split(leaves, depth, min_rows):
    bins, y, sizes = data()
    layout = boosting.Layout(sizes)
    flat, g = layout.flat(bins), np.rint((y - y.mean()) * boosting.SCALE).astype(np.int64)
    settings = boosting.Settings(1, 1.0, min_rows, leaves, depth)
    growing, passes = boosting.Growing(layout, settings), 1
    growing.start(layout.sums(flat, g))
    while wanted := growing.replay()[1]:
        made = growing.expand(wanted)
        at = boosting.route(*growing.routing(), flat, layout)
        growing.give(made, [layout.sums(flat[at == small], g[at == small]) for _, small, _ in made])
        passes += 1
    splits, ends = plain_tree(bins, g, leaves, min_rows, depth)
    nodes = [growing.nodes[i] for i in growing.replay()[0]]
    assert [(n.path, int(layout.input[n.cut]), int(n.cut - layout.starts[layout.input[n.cut]])) for n in nodes] == splits
    tree, order = growing.tree()
    leaf = tree.leaf_of(flat, layout)
    assert {growing.nodes[order[i]].path: set(np.flatnonzero(leaf == i)) for i in set(leaf.tolist())} == {p: set(r) for p, r in ends.items()}
    assert passes <= len(splits) + 1  # rounds serve several leaves


def test_sums_of_the_other_child_are_what_is_left():
    bins, y, sizes = data()
    layout = boosting.Layout(sizes)
    flat, g = layout.flat(bins), np.rint(y * boosting.SCALE).astype(np.int64)
    growing = boosting.Growing(layout, boosting.Settings(1, 1.0, 1, 4))
    growing.start(layout.sums(flat, g))
    made = growing.expand(growing.replay()[1])
    at = boosting.route(*growing.routing(), flat, layout)
    growing.give(made, [layout.sums(flat[at == made[0][1]], g[at == made[0][1]])])
    other = made[0][2]
    assert (growing.nodes[other].sums == layout.sums(flat[at == other], g[at == other])).all()


@pytest.mark.parametrize("quantile", [None, 0.9])
def test_rounds_over_a_table_equal_fits_in_tasks(spark, monkeypatch, quantile):
    bins, y, sizes = data(400)
    rows = [(int(k), bytes(b), float(v)) for k in (0, 3) for b, v in zip(bins[: 400 - 60 * k], y[: 400 - 60 * k])]
    frame = spark.createDataFrame(rows, "fit int, bins binary, y double").repartition(3)
    settings = boosting.Settings(4, 0.3, 4, 6, None, quantile)
    by_fit, n_rows = {0: sizes, 3: sizes}, {0: 400, 3: 220}
    want = boosting.fit(frame, by_fit, settings, n_rows)
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)  # fit 0 by rounds, fit 3 in a task
    monkeypatch.setattr(boosting, "STORED_TREES", 2)
    got = boosting.fit(frame, by_fit, settings, n_rows)
    for k in (0, 3):
        assert got[k][0] == pytest.approx(want[k][0], rel=1e-12) and len(got[k][1]) == len(want[k][1])
        for a, b in zip(got[k][1], want[k][1]):
            assert (a.cut == b.cut).all() and (a.left == b.left).all() and a.value == pytest.approx(b.value, abs=1e-12)


def test_bins_of_few_and_of_many_values(spark):
    rows = [(float(i % 7), float(i), None if i % 10 else float("nan")) for i in range(3000)]
    cuts = boosting.bin_edges(spark.createDataFrame(rows, "a double, b double, c double").repartition(4), ["a", "b", "c"])[0]
    assert cuts[0].tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and len(cuts[2]) == 0
    counts = np.bincount(boosting.binned(np.arange(3000.0), cuts[1]))
    assert 250 <= len(counts) <= 255 and counts.max() < 3 * counts.mean()
    assert boosting.binned(np.array([np.nan, -9.0]), cuts[0]).tolist() == [6, 0]


PLAN = FoldPlan(n_folds=3, test_days=60, min_train_days=200)


@pytest.fixture(scope="module")
def panel(spark):
    """Two entities of different size whose noise grows with an input."""
    rng, rows = np.random.default_rng(7), []
    for entity, size in (("small", 100.0), ("large", 5000.0)):
        for i in range(1500):
            a, b = rng.uniform(0, 1), float(rng.integers(0, 3))
            y = size * (1 + 0.3 * b + (0.05 + 0.3 * a) * rng.normal())
            rows.append((entity, T0 + dt.timedelta(days=i), a, b, float(max(y, size / 10))))
    return spark.createDataFrame(rows, "entity_id string, ts_utc timestamp_ntz, a double, b double, demand_mw double")


def test_learnt_quantiles_cover_and_do_not_cross(spark, panel):
    run = Backtest(panel, ["a", "b"], plan=PLAN)
    model = run.fitted(QuantileTreesForecaster(n_trees=40, leaves=6, min_rows=60))
    assert isinstance(model, Forecaster)
    asked = [0.95, 0.05, 0.5, 0.3]
    got = model.predict_quantiles(run.test_rows(), asked).toPandas()
    q = np.stack(got["quantiles"].to_numpy())
    assert len(got) == 2 * 3 * 60
    assert (np.diff(q[:, np.argsort(asked)], axis=1) >= 0).all()
    inside = (got["demand_mw"] >= q[:, 1]) & (got["demand_mw"] <= q[:, 0])
    assert abs(inside.mean() - 0.90) <= 0.03
    width = (q[:, 0] - q[:, 1]) / np.where(got["entity_id"] == "small", 100.0, 5000.0)
    assert width[got["a"] > 0.7].mean() > 1.5 * width[got["a"] < 0.3].mean()
    assert got["prediction"].to_numpy() == pytest.approx(q[:, 2])


def test_all_folds_of_all_trees_take_few_jobs(spark, panel):
    """Far fewer jobs than eight fits, or than one for each tree."""
    run = Backtest(panel, ["a", "b"], plan=PLAN)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("trees", "trees")
    try:
        run.fitted(BoostedTreesForecaster(n_trees=30, leaves=8))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(tracker.getJobIdsForGroup("trees")) < 30


def test_best_first_beats_the_mean(spark, panel):
    run = Backtest(panel, ["a", "b"], plan=PLAN)
    scores = run.run(BoostedTreesForecaster(n_trees=40, learning_rate=0.1, leaves=6)).agg(F.avg("mape")).first()[0]
    flat = run.run(BoostedTreesForecaster(n_trees=1, learning_rate=0.0, leaves=2)).agg(F.avg("mape")).first()[0]
    assert scores < 0.9 * flat
