"""The registered tree queries fit the reference's trees, and skill has all three rungs."""

from loadpanel.models import BoostedTreesForecaster
from loadpanel.plans import catalog


def test_trees_have_the_settings_of_the_reference():
    trees = catalog.boosted_trees()
    assert (trees.n_trees, trees.learning_rate, trees.depth, trees.min_rows) == (400, 0.05, 6, 50)


def test_skill_has_trees_beside_mean_and_ridge(spark, monkeypatch):
    monkeypatch.setattr(catalog, "boosted_trees", lambda: BoostedTreesForecaster(n_trees=1, depth=2))
    for name in ("skill_vs_baseline_gbt", "ladder_vs_baseline_gbt"):
        found = catalog.all_queries()[name](spark, "/root/testdata/sf0.001")
        assert {"mean", "ridge", "boosted_trees"} <= {r["model"] for r in found.select("model").collect()}
