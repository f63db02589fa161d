"""Random forests over many rows, fitted on rows that are merged by the bins of their features.

A tree sees nothing of a feature but its bin, so to a tree rows of one class in the same bins are one row that weighs
as much as all of them. Spark's forest draws a bootstrap count for every row and tree, Poisson with mean 1. For n merged
rows only the sum of their counts matters, which is Poisson with mean n: that is drawn here, so the bags have the
distribution of a bootstrap over all rows. Each tree is then fitted on the merged rows, several at a time. A fit passes
over the rows that bins can tell apart, at worst all rows, not over all rows times all trees at once.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch
from ..sources.tables import drop, stored

# Rows of the training table from which on rows are merged; below, one fit of Spark's forest is about as fast.
MANY_ROWS = 500_000

# Merged rows that all fits running together may hold.
FITTED_TOGETHER = 2_000_000


def bounds(table: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """Inclusive upper bounds of the bins of each column with more than ``bins`` different values, the last bin left out.

    Quantiles of all rows. A column with fewer different values has no entry: its values are the bins.
    """
    several = table.select(*columns).unpivot([], [F.col(c) for c in columns], "column", "value").distinct().groupBy("column").agg(
        F.count("*").alias("n")).filter(F.col("n") > bins)
    wide = sorted(r["column"] for r in several.collect())
    if not wide:
        return {}
    at = [i / bins for i in range(1, bins)]
    found = table.agg(*[F.percentile_approx(c, at, 10_000).alias(c) for c in wide]).first()
    return {c: sorted({t for t in found[c] if not math.isnan(t)}) for c in wide}


def bin_of(value: str, upper: list[float]) -> str:
    """SQL for the number of the bin of a value; NaN is above all bounds, as in Spark's trees."""
    cases = " ".join(f"WHEN {value} <= double('{t!r}') THEN {i}D" for i, t in enumerate(upper))
    return f"CASE {cases} ELSE {len(upper)}D END" if upper else "0D"


def merged(table: DataFrame, keys: list[str]) -> DataFrame:
    """One row for all rows that agree in the keys, with their number ``_n``."""
    return table.groupBy(*keys).agg(F.count("*").alias("_n"))


def bags(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """Merged rows with the sum of their bootstrap counts for each tree in ``_in_bag_<tree>``.

    The sum of n counts with mean 1 has the Poisson distribution with mean n. The draws depend on the seed and the
    row itself, not on where it lies.
    """
    names = [f"_in_bag_{t}" for t in range(trees)]
    schema = T.StructType([*rows.schema, *[T.StructField(c, T.LongType()) for c in names]])

    def draw(batches):
        import numpy as np

        for batch in batches:
            counts = np.zeros((trees, batch.num_rows), dtype=np.int64)
            for i, (n, at) in enumerate(zip(batch["_n"].to_pylist(), batch["_at"].to_pylist())):
                counts[:, i] = np.random.default_rng([seed % 2**32, at % 2**64]).poisson(n, trees)
            kept = [c for c in batch.schema.names if c != "_at"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *[pa.array(c) for c in counts]], [*kept, *names])

    return rows.withColumn("_at", F.xxhash64(*rows.columns)).mapInArrow(draw, schema)


def fit_merged(table: DataFrame, assembler: VectorAssembler, label: str, weight: str, classes: list[str],
               forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """The forest that ``forest`` describes, of a table of binned inputs with a numbered class and its weight."""
    spark, inputs = table.sparkSession, assembler.getInputCols()
    named = {"ml_attr": {"type": "nominal", "name": label, "vals": classes}}   # a bag need not hold every class
    workspace = scratch(spark, "bags")

    def tree(number: int):
        count = F.col(f"_in_bag_{number}")
        bag = assembler.transform(rows.filter(count > 0)).select(
            forest.getFeaturesCol(), F.col(label).alias(label, metadata=named), (count * F.col(weight)).alias(weight))
        one = forest.copy().setParams(numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", cacheNodeIds=False,
                                      seed=forest.getSeed() + number)
        # every fit needs properties of its own, which the wrapper copies when it is made
        return inheritable_thread_target(spark)(lambda: one.fit(bag))

    try:
        rows = stored(bags(merged(table, [*inputs, label, weight]), forest.getNumTrees(), forest.getSeed()), workspace)
        together = min(spark.sparkContext.defaultParallelism, FITTED_TOGETHER // max(rows.count(), 1))
        with ThreadPoolExecutor(max(together, 1)) as pool:
            fitted = [*pool.map(lambda fit: fit(), [tree(n) for n in range(forest.getNumTrees())])]
    finally:
        drop(spark, workspace)
    return _joined(spark, fitted, forest, len(classes))


def _joined(spark: SparkSession, fitted: list[RandomForestClassificationModel], forest: RandomForestClassifier,
            n_classes: int) -> RandomForestClassificationModel:
    """One model of the trees of several, with the settings of ``forest``."""
    context = spark.sparkContext
    java = spark._jvm.org.apache.spark.ml.classification
    trees = context._gateway.new_array(java.DecisionTreeClassificationModel, len(fitted))
    for i, model in enumerate(fitted):
        trees[i] = model._java_obj.trees()[0]
    joined = RandomForestClassificationModel(
        java.RandomForestClassificationModel(trees, fitted[0].numFeatures, n_classes))
    joined._set(**{p.name: v for p, v in forest.extractParamMap().items() if joined.hasParam(p.name)})
    joined._transfer_params_to_java()
    return joined
