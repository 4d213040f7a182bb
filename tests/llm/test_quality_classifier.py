import zlib

import duckdb
import numpy as np
import pytest
from cases import ROWS, docs, rows

from loadpanel.llm import quality
from loadpanel.llm.queries import all_queries

LABELS = "doc_id long, quality int, toxic int, x string"


def test_scores_follow_from_the_two_densities(spark):
    rng = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    x = np.concatenate([rng.normal(0, 1, (80, d)), rng.normal(1, 2, (50, d))])
    y = [0] * 80 + [1] * 50
    model = quality.fit(spark.createDataFrame([(v.tolist(), c) for v, c in zip(x, y)], "x array<double>, quality int"))
    covs = {c: np.cov(x[np.array(y) == c].T, bias=True) for c in (0, 1)}
    pooled = (80 * covs[0] + 50 * covs[1]) / 130
    log = []
    for c, n in ((0, 80), (1, 50)):
        s = 0.7 * covs[c] + 0.3 * pooled
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 1e-4 * np.eye(d)
        gap = x - x[np.array(y) == c].mean(axis=0)
        far = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(s), gap)
        log.append(np.log(n / 130) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * far)
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-8)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0, "a"), (7, 1, 0, "a"), (3, 0, 1, "a"), (3, 0, 1, "a"), (9, 2, 0, "a"), (None, 1, 0, "a"), (50, 0, 0, "a")], LABELS)
    got = quality.quality_scores(docs(spark), labels).collect()
    assert len(got) == len(ROWS)
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    empty = {r["score"] for r in got if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1
    assert quality.accepted_rows(docs(spark), labels).columns == docs(spark).columns


def test_labels_of_one_class_or_none(spark):
    for known, score in (([], 1.0), ([(1, 1, 0, "a")], 1.0), ([(1, 0, 0, "a")], 0.0)):
        got = quality.quality_scores(docs(spark), spark.createDataFrame(known, LABELS)).collect()
        assert {r["score"] for r in got} == {score}
    assert rows(quality.quality_scores(docs(spark, []), spark.createDataFrame([], LABELS))) == []


def test_held_out_accuracy(spark, sf_dir):
    marks = dict(duckdb.sql(f"select doc_id, quality from '{sf_dir}/labels.parquet'").fetchall())
    out = [(r["predicted"], marks[r["doc_id"]]) for r in all_queries()["op7_quality"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in marks]
    assert len(out) > 50 and np.mean([p == m for p, m in out]) >= 0.95
    assert np.mean([p for p, m in out if m == 1]) >= 0.97


def test_labels_of_held_out_documents_change_nothing(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    assert rows(quality.quality_scores(table, labels)) == rows(quality.quality_scores(table, flipped))
