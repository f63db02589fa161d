"""Forests of many rows: merged by the bins of their features, with the bootstrap of all rows."""

import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from indipanel.operators import bagging, forest

SMALL = forest.Forest(trees=6, depth=6)


def _rows(spark, n):
    """``n`` rows, the class told by a wide feature and, half of the time, by a narrow one."""
    noise = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000))
    return spark.range(0, n, 1, 3).select(
        (noise(1) + F.col("id") / n).alias("wide"),
        F.when(noise(2) >= 100, F.when(noise(3) < 500, F.floor(noise(1) / 250)).otherwise(noise(4) % 4).cast("double")).alias("narrow"),
        F.element_at(F.array(*[F.lit(c) for c in "abcd"]), (F.floor(noise(1) / 250) + 1).cast("int")).alias("income_level"))


def _passed(spark, monkeypatch, n):
    """Rows and weight that reach the fits of a forest over ``n`` rows, and the forest."""
    seen, plain = [], RandomForestClassifier.fit

    def fit(self, table):
        seen.append(table.agg(F.count("*"), F.sum("_weight")).first())
        return plain(self, table)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    model = forest.fit_forest(_rows(spark, n), ["wide", "narrow"], forest=SMALL)
    monkeypatch.setattr(RandomForestClassifier, "fit", plain)
    return seen, model


def test_trees_pass_over_what_bins_tell_apart_and_bags_hold_all_rows(spark, monkeypatch):
    """Five times the rows were five times the work of every level; now there are no more merged rows than bins and classes."""
    monkeypatch.setattr(bagging, "MANY_ROWS", 1000)
    for n in (4000, 20_000):
        seen, model = _passed(spark, monkeypatch, n)
        assert len(seen) == model.stages[2].getNumTrees == 6
        assert all(rows <= 32 * 4 * 4 for rows, _ in seen)
        # the weights of a bag sum to the rows, with the spread of a bootstrap over all rows
        assert all(abs(weight - n) < 6 * math.sqrt(n) for _, weight in seen) and len({w for _, w in seen}) > 1


def test_merged_forest_learns_takes_gaps_and_survives_saving(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(bagging, "MANY_ROWS", 1000)
    model = forest.fit_forest(_rows(spark, 8000), ["wide", "narrow"], forest=SMALL)
    trees = model.stages[2]
    assert trees.getNumTrees == 6 and trees.numClasses == 4 and trees.numFeatures == 2
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees.trees}) > 1     # bags and features differ
    new = _rows(spark, 9000).filter("wide is not null").unionByName(
        spark.createDataFrame([(None, None, "a"), (float("nan"), 3.0, "d"), (-1e300, 0.0, "a"), (float("inf"), 3.0, "d")],
                              "wide double, narrow double, income_level string"))
    scored = forest.score(model, new, "before")
    assert scored.filter("before = income_level").count() > 0.95 * 9004
    edges = {r["wide"]: r["before"] for r in scored.filter("abs(wide) > 1e6 or isnan(wide)").collect()}
    assert edges[-1e300] == "a" and edges[float("inf")] == "d"
    forest.save_model(model, str(tmp_path / "m"))
    again = forest.score(forest.load_model(str(tmp_path / "m")), scored, "after")
    assert again.filter("before <> after or after is null").isEmpty() and again.count() == 9004


def test_bags_are_poisson_and_the_same_wherever_rows_lie(spark):
    rows = spark.range(400).select("id", F.lit(40).cast("bigint").alias("_n"))
    drawn = [sorted(map(tuple, bagging.bags(rows.repartition(k), 50, 7).collect())) for k in (1, 5)]
    assert drawn[0] == drawn[1]
    counts = [c for r in drawn[0] for c in r[2:]]
    mean = sum(counts) / len(counts)
    spread = sum((c - mean) ** 2 for c in counts) / len(counts)
    assert len(counts) == 20_000 and abs(mean - 40) < 0.3 and abs(spread - 40) < 2.5
    assert drawn[0] != sorted(map(tuple, bagging.bags(rows, 50, 8).collect()))


def test_a_bag_without_a_class_and_columns_of_one_value(spark, monkeypatch):
    monkeypatch.setattr(bagging, "MANY_ROWS", 1)
    rows = spark.createDataFrame([(float(i % 50), 1.0, "z" if i == 0 else "y") for i in range(200)], "a double, b double, income_level string")
    model = forest.fit_forest(rows, ["a", "b"], forest=SMALL)
    assert {t.numClasses for t in model.stages[2].trees} == {2}
    assert forest.score(model, rows).filter("income_level_predit = 'y'").count() >= 190


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0], [5.0] * 40])
def test_few_values_are_their_own_bins(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x double")
    assert bagging.bounds(table, ["x"], 32) == {}
