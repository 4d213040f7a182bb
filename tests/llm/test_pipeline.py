import importlib

import pytest
from cases import docs

cp = importlib.import_module("corpus_pipeline")
from loadpanel.llm import exact_dedup, mixing, ngram_join, quality, stages  # noqa: E402
from loadpanel.llm.common import table  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    folder, frames = tmp_path_factory.mktemp("stages"), [table(spark, sf_dir, "documents")]
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, frames[-1], sf_dir).write.parquet(f"{folder}/{i}")
        frames.append(spark.read.parquet(f"{folder}/{i}"))
    return frames


def test_all_but_the_last_stage_return_documents(steps):
    assert [f.columns for f in steps[:-1]] == [steps[0].columns] * len(cp.STAGES)
    assert {"doc_id", "ids", "n_tokens"} == set(steps[-1].columns)


def test_each_decision_takes_effect(spark, sf_dir, steps):
    raw, good, single, apart, mixed, tokens = steps
    scores = quality.quality_scores(raw, table(spark, sf_dir, "labels"))
    assert {r[0] for r in scores.filter("predicted = 1").select("doc_id").collect()} == {r[0] for r in good.select("doc_id").collect()}
    kept = exact_dedup.exact_duplicates(good).filter("kept")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in single.select("doc_id").collect())
    groups = ngram_join.near_duplicates(single, 5, 80)
    assert groups.select("component_id").distinct().count() == apart.count()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(apart).select("row.doc_id", "copies").collect() if r["copies"]}
    assert copies == {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert tokens.count() == mixed.count() and tokens.filter("size(ids) != n_tokens").count() == 0


def test_stages_take_awkward_and_no_rows(spark, sf_dir):
    for frame in (docs(spark), docs(spark, [])):
        for stage in (f for _, f in cp.STAGES):
            out = stage(spark, frame, sf_dir)
            out.collect()
            assert stage is stages.encode or out.columns == frame.columns
