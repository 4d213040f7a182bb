"""Coverage by bitmaps equals coverage by rows, and shuffles bitmaps."""

import datetime as dt
import random

import pytest
from frames import HOUR, OBS, T0, rows

from loadpanel.operators.bitmaps import coverage_by_bitmaps, hour_bitmaps, missing_by_bitmaps
from loadpanel.operators.quality import coverage, missing_hours


@pytest.fixture(scope="module")
def panel(spark):
    """Gaps both ways, repeated rows, a series alone, hours before 1970 and across the bounds of bitmaps."""
    rng, data = random.Random(8), []
    starts = {"a": T0, "old": dt.datetime(1965, 1, 1), "long": dt.datetime(2000, 1, 1)}
    for entity, start in starts.items():
        for i in range(600):
            t = start + i * HOUR * (150 if entity == "long" else 1)
            for series in ("D", "DF", "other"):
                data += [(entity, t, series, 1.0)] * rng.choice((0, 1, 1, 1, 2))
    data += [("only", T0 + i * HOUR, "D", None) for i in range(5)]
    return spark.createDataFrame(data, OBS)


def test_same_counts_and_bounds(panel):
    columns = coverage(panel).columns
    assert rows(coverage_by_bitmaps(panel).na.fill(-1), *columns[:7]) == rows(coverage(panel).na.fill(-1), *columns[:7])
    by = lambda df: {r["entity_id"]: tuple(r[c] for c in columns) for r in df.collect()}
    assert by(coverage_by_bitmaps(panel)) == by(coverage(panel))


@pytest.mark.parametrize("have, lack", [("D", "DF"), ("DF", "D"), ("D", "other")])
def test_same_missing_hours(panel, have, lack):
    assert rows(missing_by_bitmaps(panel, have, lack), "entity_id", "ts_utc") == rows(missing_hours(panel, have, lack), "entity_id", "ts_utc")


def test_one_bitmap_for_many_rows(panel):
    found = hour_bitmaps(panel)
    assert {len(r["hours"]) for r in found.select("hours").collect()} == {4096}
    assert found.count() == 2 * (1 + 1 + 3) + 1 and found.count() < panel.count() / 100


def test_other_times_than_whole_hours_raise(spark):
    with pytest.raises(ValueError, match="whole hours"):
        hour_bitmaps(spark.createDataFrame([("X", T0 + dt.timedelta(minutes=30), "D", 1.0)], OBS))
    assert coverage_by_bitmaps(spark.createDataFrame([], OBS)).count() == 0
