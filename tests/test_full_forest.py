"""The registered forest queries fit the configured forest."""

import pytest

from indipanel import rules as R
from indipanel.catalog import spark_queries
from indipanel.operators import forest


@pytest.mark.parametrize("name", ["rf_fit_predict", "model_roundtrip", "train_job"])
def test_queries_fit_the_configured_forest(spark, name, monkeypatch):
    class Seen(Exception):
        pass

    def fit(*args, **how):
        raise Seen(next(x for x in [*args, *how.values()] if isinstance(x, forest.Forest)))

    monkeypatch.setattr(forest, "fit_forest", fit)
    monkeypatch.setattr("indipanel.plans.model_jobs.fit_forest", fit, raising=False)
    with pytest.raises(Seen) as seen:
        getattr(spark_queries, name)(spark, "/root/testdata/sf0.001").count()
    used = seen.value.args[0]
    assert used == forest.Forest() and (used.trees, used.depth) == (R.FOREST_TREES, 30) == (200, 30)


def test_rows_keep_their_nodes_and_the_trees_are_the_same(spark):
    """Without it each level of a tree walks all trees from the root for every row."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.sql import functions as F

    rows = spark.range(0, 600, 1, 3).select(
        (F.col("id") % 7).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("b"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0, "x").otherwise("y").alias("income_level"))
    small = forest.Forest(trees=4, depth=8)
    model = forest.fit_forest(rows, ["a", "b"], forest=small).stages[2]
    assert model.getCacheNodeIds()
    plain = RandomForestClassifier.fit

    def uncached(self, table):
        return plain(self.setCacheNodeIds(False), table)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(RandomForestClassifier, "fit", uncached)
        other = forest.fit_forest(rows, ["a", "b"], forest=small).stages[2]
    assert not other.getCacheNodeIds()
    trees = [m.toDebugString.split("\n", 1)[1] for m in (model, other)]
    assert trees[0] == trees[1] and "If" in trees[0]
