"""Scores of a classification, all from the counts per (actual, predicted) pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n): at most classes^2 rows, combined before the shuffle."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    """Division with 0 for an empty denominator, as score reports use it."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    hits = F.count_if(F.col(actual) == F.col(predicted))
    return df.agg(_ratio(hits, F.count("*")).alias("accuracy"), F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: list) -> DataFrame:
    """Rows: actual class, columns: predicted class, over all given labels in order."""
    counts = pair_counts(df, actual, predicted)
    cells = [F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(p), F.col("n"))), F.lit(0)).alias(f"predicted_{p}")
             for p in labels]
    rows = counts.groupBy("actual").agg(*cells)
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(p) for p in labels])).alias("actual"))
    filled = every.join(rows, "actual", "left").fillna(0)
    return filled.select("actual", *[f"predicted_{p}" for p in labels]).orderBy("actual")


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy and both averages.

    A class counts when it occurs as actual or as predicted.
    """
    n, hit = F.col("n"), F.col("actual") == F.col("predicted")
    as_actual = F.struct(F.col("actual").cast("string").alias("label"), n.alias("support"),
                         F.when(hit, n).otherwise(0).alias("right"), F.lit(0).cast("bigint").alias("claimed"))
    as_predicted = F.struct(F.col("predicted").cast("string").alias("label"), F.lit(0).cast("bigint").alias("support"),
                            F.lit(0).cast("bigint").alias("right"), n.alias("claimed"))
    per_class = (
        pair_counts(df, actual, predicted)
        .select(F.explode(F.array(as_actual, as_predicted)).alias("_c")).select("_c.*")
        .groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "right", "claimed")])
        .withColumns({"precision": _ratio(F.col("right"), F.col("claimed")),
                      "recall": _ratio(F.col("right"), F.col("support"))})
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    scores = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    right = _ratio(F.sum("right"), F.sum("support"))
    weight = F.sum("support")
    mean_rows = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *[right.alias(s) for s in scores], total),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores], total),
            F.struct(F.lit("weighted avg").alias("label"),
                     *[_ratio(F.sum(F.col(s) * F.col("support")), weight).alias(s) for s in scores], total),
        ).alias("_m")).select(F.explode("_m").alias("_m")).select("_m.*")
    return per_class.select("label", *scores, "support").unionByName(mean_rows)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class), unlabelled rows left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    return counts.select(
        label, "n",
        (F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))).alias("weight"))
