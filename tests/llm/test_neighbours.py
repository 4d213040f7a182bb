import math

import duckdb
import numpy as np
import pytest
from cases import rows
from pyspark.sql import functions as F

from loadpanel.llm import neighbours as nn
from loadpanel.llm.queries import all_queries

SCHEMA = "vec_id long, embedding array<float>, point string, cell int"


def brute(table, asked, k):
    good = [(i, np.array(v, np.float64)) for i, v, *_ in table if i is not None and v and len(v) == 4]
    good = [(i, v) for i, v in good if not any(x is None for x in v) and np.isfinite(v).all() and v.any()]
    out = {}
    for i, v in sorted(((i, v) for i, v in good if asked(i)), key=lambda q: (q[0], q[1].tolist()), reverse=True):
        near = sorted((math.dist(v, w), j) for j, w in good if j != i)[:k]
        out[i] = [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(r for part in out.values() for r in part)


def test_chi_square():
    assert nn.chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-4)
    assert nn.chi_square_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-4)


@pytest.mark.parametrize("block_rows", [nn.BLOCK_ROWS, 3])
def test_awkward_vectors(spark, monkeypatch, block_rows):
    monkeypatch.setattr(nn, "BLOCK_ROWS", block_rows)
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 4, [1.0, nan, 0.0, 0.0], [inf, 0.0, 0.0, 1.0], [1.0, None, 1.0, 1.0], [1.0, 2.0]]
    table = [(i, [1.0, 2.0, 3.0, float(i % 5)], "p", 1) for i in range(12)]
    table += [(20 + i, [1.0, 1.0, 1.0, 1.0], "p", 1) for i in range(6)] + [(11, [9.0, 9.0, 9.0, 9.0], "p", 1)]
    table += [(100 + 10 * i, v, None, None) for i, v in enumerate(bad)] + [(None, [1.0] * 4, None, None)]
    frame = spark.createDataFrame(table, SCHEMA)
    got = nn.nearest_neighbours(frame, F.col("vec_id") % 10 == 0, k=7, confidence=0.999999999)
    mine = sorted(tuple(r) for r in got.collect())
    want = brute(table, lambda i: i % 10 == 0, 7)
    assert [r[:3] for r in mine] == [r[:3] for r in want]
    assert [r[3] for r in mine] == pytest.approx([r[3] for r in want], rel=1e-12)


def test_few_or_no_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], None, None), (1, [0.0, 1.0], None, None)], SCHEMA)
    assert rows(nn.nearest_neighbours(frame, F.col("vec_id") == 0), "query_id", "rank", "vec_id") == [(0, 1, 1)]
    assert rows(nn.nearest_neighbours(frame, F.col("vec_id") == 9)) == []
    assert rows(nn.nearest_neighbours(frame.filter("false"), F.lit(True))) == []


def test_recall_of_the_query_with_many_cells(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(nn, "CELL_ROWS", 32)
    monkeypatch.setattr(nn, "BLOCK_ROWS", 40)
    table = duckdb.sql(f"select vec_id, embedding from '{sf_dir}/embeddings.parquet'").fetchall()
    ids, x = np.array([i for i, _ in table]), np.array([v for _, v in table], np.float64)
    got = {}
    for r in all_queries()["op4_neighbours"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hits, total = hits + len(set(best.tolist()) & set(got[q])), total + 10
        assert all(s == pytest.approx(d[ids == v][0], rel=1e-12) for v, s in got[q].items())
    assert hits / total >= 0.9


@pytest.mark.parametrize("sample", [64, nn.SAMPLE_ROWS])
def test_vectors_with_structure_visit_few_cells(spark, monkeypatch, sample):
    """Clusters in 32 dimensions, with cells from a small sample and lower trees, or from the upper tree alone."""
    for name, value in (("CELL_ROWS", 40), ("BLOCK_ROWS", 60), ("SAMPLE_ROWS", sample), ("CELL_SAMPLE", 600)):
        monkeypatch.setattr(nn, name, value)
    kept, written = {}, nn.materialize

    def counted(df, label):
        out = written(df, label)
        kept.setdefault(label, []).append(nn.row_bound(out))
        return out

    monkeypatch.setattr(nn, "materialize", counted)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (40, 32))
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(0, 0.05, (3000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    boxes = []
    allowed = nn._allowed
    monkeypatch.setattr(nn, "_allowed", lambda found, *rest, **more: boxes.append(found) or allowed(found, *rest, **more))
    got = {}
    for r in nn.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 3000, 50):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & got[q])
    assert hits / 600 >= 0.9
    assert len(boxes[0]) > 40 and (len({r["cell"] for r in boxes[0]}) <= 4) == (sample == 64)
    assert sum(kept["neighbour-visits"]) <= 60 * len(boxes[0]) / 4
