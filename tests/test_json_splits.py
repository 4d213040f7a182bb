"""One JSON document over many tasks equals the whole-document reader."""

import json
import random

import pytest
from frames import rows

from loadpanel.session import setting
from loadpanel.sources import read_rowwise
from loadpanel.sources.json_splits import read_rowwise_split, split_records

COLUMNS = ("entity_id", "ts_utc", "series_type", "value")


def made(n, seed=1, odd=0.3):
    """Records whose texts hold braces, quotes, backslashes and nested objects."""
    rng, out = random.Random(seed), []
    for i in range(n):
        r = {"period": f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}T{i % 24:02d}", "respondent": f"r{i}", "type": "D", "value": str(i / 4)}
        if rng.random() < odd:
            r["respondent"] += rng.choice(['}', '{', '"}', '\\', '\\"}{', '}}', ' {"a": "}"}', "ü}字", "\\\\"])
        if rng.random() < odd:
            r["more"] = rng.choice([{"a": {"b": "}"}}, [{"x": 1}, {"y": "{"}], {}, "}{", None, {"q": '"'}])
        if rng.random() < odd:
            r = dict(reversed(r.items()))
        out.append(r)
    return out


@pytest.mark.parametrize("size", ["120", "1000", "128m"])
@pytest.mark.parametrize("indent", [None, 1])
def test_any_cut_gives_the_same_rows(spark, tmp_path, size, indent):
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps(made(40, k), indent=indent, ensure_ascii=k == 0))
    (tmp_path / "2.json").write_text("[]")
    want = rows(read_rowwise(spark, str(tmp_path)), *COLUMNS)
    with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "1"):
        assert rows(read_rowwise_split(spark, str(tmp_path)), *COLUMNS) == want
    assert len(want) == 80


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    file = tmp_path / "large.json"
    with file.open("w") as out:
        out.write("[" + ",".join(json.dumps(r) for r in made(150_000, 5, 0.02)) + "]")
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1m"):
        texts = spark.read.option("lineSep", "}").text(str(file))
        assert texts.rdd.getNumPartitions() > 8
        got = read_rowwise_split(spark, str(file))
        assert got.count() == 150_000 and got.exceptAll(read_rowwise(spark, str(file))).count() == 0


def test_objects_side_by_side_and_broken_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": "}"},\n{"a": {}}')
    assert rows(split_records(spark, str(tmp_path / "a.json")), "text") == [('{"a": "}"}',), ('{"a": 1}',), ('{"a": {}}',)]
    (tmp_path / "b.json").write_text('[{"period": "2024-01-01T00", "respondent": "r", "type": "D", "value": "1"}, {"period": "2024')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_rowwise_split(spark, str(tmp_path / "b.json")).collect()
