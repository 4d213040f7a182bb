"""The bracketed quantiles agree with numpy on awkward distributions."""

import numpy as np
import pytest

from loadpanel.functions.quantiles import exact_quantiles

PROBS = {"lo": 0.0, "p1": 0.001, "med": 0.5, "p9": 0.9, "p999": 0.999, "hi": 1.0}

RNG = np.random.default_rng(7)
SHAPES = {
    "spread": RNG.normal(24_000, 3_000, 4_001),
    "sentinels": np.concatenate([RNG.normal(24_000, 3_000, 3_000), [15.3e9, 2_147_483_647.0, -6_813.0]]),
    "ties": np.concatenate([np.zeros(2_500), np.full(1_500, 7.0), RNG.integers(0, 9, 500).astype(float)]),
    "negative": -np.exp(RNG.normal(0, 8, 2_001)),
    "constant": np.full(1_000, 3.25),
    "tiny": np.array([2.0, 1.0]),
    "huge": np.concatenate([[-1.7e308, 1.7e308], RNG.normal(0, 1, 999)]),
}


@pytest.fixture(scope="module")
def values(spark):
    rows = [(k, float(v)) for k, vs in SHAPES.items() for v in vs]
    return spark.createDataFrame(rows + [("spread", None), ("nothing", None)], "k string, v double")


@pytest.mark.parametrize("group_rows, bins", [(10_000, 8), (200, 8), (1, 64)])
def test_equal_to_numpy(values, group_rows, bins):
    got = {r["k"]: r for r in exact_quantiles(values, ["k"], "v", PROBS, group_rows, bins).collect()}
    assert set(got) == {*SHAPES, "nothing"}
    assert all(got["nothing"][name] is None for name in PROBS)
    for k, vs in SHAPES.items():
        ordered = np.sort(vs)
        for name, p in PROBS.items():
            at = p * (len(vs) - 1)
            lo, hi = int(np.floor(at)), int(np.ceil(at))
            want = ordered[lo] if lo == hi else (hi - at) * ordered[lo] + (at - lo) * ordered[hi]
            assert got[k][name] == pytest.approx(want, rel=1e-12, abs=1e-300), (k, name)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", PROBS).count() == 0


@pytest.mark.parametrize("group_rows, bins", [(10_000, 8), (1, 8), (1, 64)])
def test_infinite_and_nan_values(spark, group_rows, bins):
    inf, nan = float("inf"), float("nan")
    groups = {
        "both ends": [-inf, -inf, *map(float, range(50)), inf],
        "one": [*map(float, range(100)), inf],
        "only": [inf, inf, -inf],
        "subnormal": [5e-324, 1e-323, 0.0, 5e-324],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", nan), ("one", nan), ("nothing", nan)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in exact_quantiles(frame, ["k"], "v", PROBS, group_rows, bins).collect()}
    assert set(got) == {*groups, "nothing"} and got["nothing"]["med"] is None
    for k, vs in groups.items():
        ordered = sorted(vs)
        for name, p in PROBS.items():
            at = p * (len(vs) - 1)
            lo, hi = int(np.floor(at)), int(np.ceil(at))
            if lo == hi or ordered[lo] == ordered[hi]:
                assert got[k][name] == ordered[lo], (k, name)
            elif np.isinf(ordered[lo]) or np.isinf(ordered[hi]):
                assert not np.isfinite(got[k][name])
