import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from cases import ROWS, docs, rows

from loadpanel.llm import mixing
from loadpanel.llm.queries import all_queries


def wanted(sizes):
    """Targets by resharing what a full source cannot take."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= weight[s] * unit}
        if not full:
            return {**out, **{s: weight[s] * unit for s in open_}}
        out.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(got, table):
    """``got`` rows of (doc_id, size, source_size, target, taken) against (doc_id, text, source)."""
    sizes = defaultdict(int)
    for _, t, s in table:
        sizes[s] += words(t)
    target, largest, source = wanted(sizes), defaultdict(int), {}
    for d, t, s in table:
        largest[s] = max(largest[s], words(t))
        source[d] = s
    taken = Counter()
    for d, size, source_size, goal, n in got:
        s = source[d]
        assert source_size == sizes[s] and goal == pytest.approx(target[s])
        assert 0 <= n <= 2 * size and (size == 0 or n % size == 0)
        taken[s] += n
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1, s
    return taken, target


def test_rates_are_the_least_entropy_ones(spark):
    table = [(i, "w " * n, s) for i, (n, s) in enumerate((n, s) for s in "abcd" for n in (1, 2, 3, 5, 8, 13, 21))]
    frame = spark.createDataFrame(table, "doc_id long, text string, source string")
    out = mixing.mix(frame).select("row.doc_id", "row.source", "size", "target", "rate").collect()
    for s in "abcd":
        mine = [r for r in out if r["source"] == s]
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"], rel=1e-6)
        # log(rate) is a line through 0 in size wherever the cap does not bind.
        slopes = [math.log(r["rate"]) / r["size"] for r in mine if r["rate"] < 2]
        assert not slopes or max(slopes) - min(slopes) < 1e-6


def test_query_against_its_contract(spark, sf_dir):
    table = duckdb.sql(f"select doc_id, text, source from '{sf_dir}/documents.parquet'").fetchall()
    run = lambda: rows(all_queries()["op10_mixing"](spark, sf_dir), "doc_id", "size", "source_size", "target", "taken")
    got = run()
    assert len(got) == len(table)
    taken, target = check(got, table)
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 2 for s in target)
    assert run() == got


def test_awkward_rows(spark):
    table = docs(spark)
    out = mixing.mix(table)
    got = rows(out.select("row.doc_id", "size", "source_size", "target", "taken"))
    assert len(got) == len(ROWS)
    by_source = defaultdict(lambda: [0, 0, 0.0])
    for r in out.select("row.source", "size", "taken", "target").collect():
        by_source[r["source"]][0] += r["size"]
        by_source[r["source"]][1] += r["taken"]
        by_source[r["source"]][2] = r["target"]
    goal = wanted({s: v[0] for s, v in by_source.items()})
    for s, (_, _, target) in by_source.items():
        assert target == pytest.approx(goal[s])
    assert mixing.mixed_rows(table).columns == table.columns


@pytest.mark.parametrize("ranked", [mixing.RANKED, 7])
def test_a_thousand_equal_rows(spark, ranked):
    table = [(i % 900, "w " * 10, "hot") for i in range(1000)] + [(5000 + i, "w " * 10, "b") for i in range(400)]
    frame = spark.createDataFrame(table, "doc_id long, text string, source string")
    out = mixing.mix(frame, ranked=ranked).select("row.source", "target", "taken", "copies")
    for s, n in (("hot", 1000), ("b", 400)):
        mine = [r for r in out.collect() if r["source"] == s]
        assert len(mine) == n and abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 10


def test_no_rows(spark):
    assert rows(mixing.mix(docs(spark, []))) == []
    assert rows(mixing.mixed_rows(docs(spark, []))) == []


def test_rates_that_do_not_settle_raise(spark, monkeypatch):
    """Nothing unsettled is used silently."""
    table = [(i, "word " * (1 + i % 7), "ab"[i % 2]) for i in range(40)]
    frame = spark.createDataFrame(table, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="settle"):
        mixing.mix(frame)
