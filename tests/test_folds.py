import datetime as dt

import pytest
from frames import HOUR, T0

from loadpanel.operators.folds import FoldPlan, assign_folds, fold_bounds, history

DAY = 24 * HOUR


def grid(spark, n, step=HOUR, entity="X"):
    return spark.createDataFrame([(entity, T0 + i * step) for i in range(n)], "entity_id string, ts_utc timestamp_ntz")


def direct(first, last, plan):
    """Bounds of the kept folds by definition."""
    span, gap = dt.timedelta(days=plan.test_days), dt.timedelta(hours=plan.gap_hours)
    out = {}
    for k in range(plan.n_folds):
        end = last - (plan.n_folds - 1 - k) * span
        if end - span - gap - first >= dt.timedelta(days=plan.min_train_days):
            out[k] = (end - span - gap, end - span, end)
    return out


PLANS = [
    FoldPlan(),
    FoldPlan(n_folds=5, test_days=7, gap_hours=39, min_train_days=300),
    FoldPlan(n_folds=4, test_days=1, gap_hours=100, min_train_days=10),
    FoldPlan(n_folds=12, test_days=30, gap_hours=0, min_train_days=100),
]


@pytest.mark.parametrize("plan", PLANS)
def test_assignment_equals_the_definition(spark, plan):
    df = grid(spark, 400 * 24 + 5)
    ends = history(df)
    first, last = ends.first()["first_ts"], ends.first()["last_ts"]
    bounds = direct(first, last, plan)
    got = {r["fold"]: (r["train_end"], r["test_start"], r["test_end"]) for r in fold_bounds(ends, plan).collect()}
    assert got == bounds
    for r in assign_folds(df, ends, plan).collect():
        t = r["ts_utc"]
        tests = [k for k, (_, s, e) in bounds.items() if s < t <= e]
        trains = [k for k, (end, _, _) in bounds.items() if t <= end]
        assert r["test_fold"] == (tests[0] if tests else None)
        assert r["first_train_fold"] == (min(trains) if trains else None)


def test_folds_never_leak(spark):
    plan = FoldPlan(n_folds=6, test_days=10, min_train_days=30)
    df = grid(spark, 200 * 24)
    placed = assign_folds(df, history(df), plan).toPandas()
    gap = dt.timedelta(hours=plan.gap_hours)
    sizes = []
    for k in range(plan.n_folds):
        test = placed[placed["test_fold"] == k]["ts_utc"]
        train = placed[placed["first_train_fold"] <= k]["ts_utc"]
        assert train.max() + gap < test.min()
        assert len(test) == 240
        sizes.append(len(train))
    assert sizes == sorted(sizes) and len(set(sizes)) == plan.n_folds


def test_edges(spark):
    plan = FoldPlan(n_folds=3, test_days=10, min_train_days=365)
    df = grid(spark, 400 * 24)
    ends = history(df)
    bounds = {r["fold"]: r for r in fold_bounds(ends, plan).collect()}
    at = {r["ts_utc"]: r for r in assign_folds(df, ends, plan).collect()}
    assert at[bounds[2]["test_start"]]["test_fold"] == 1
    assert at[bounds[2]["test_end"]]["test_fold"] == 2
    assert at[bounds[1]["train_end"]]["first_train_fold"] == 1
    assert at[bounds[1]["train_end"] + HOUR]["first_train_fold"] == 2


def test_short_history_has_no_folds(spark):
    df = grid(spark, 300, DAY)
    assert fold_bounds(history(df)).count() == 0
    placed = assign_folds(df, history(df))
    assert placed.where("test_fold is not null or first_train_fold is not null").count() == 0
