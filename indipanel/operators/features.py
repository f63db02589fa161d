"""Wide features per entity and period, and the per-period threshold class."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import classify
from ..rules import Panel


def pivot_features(fact: DataFrame, codes: dict[str, str], keys: list[str],
                   code: str = "indicator_code", value: str = "valeur") -> DataFrame:
    """One column per named code: a single aggregation, combined before the shuffle."""
    return fact.groupBy(*keys).agg(*[
        F.max(F.when(F.col(code) == wanted, F.col(value))).alias(name) for name, wanted in codes.items()])


def bounds_table(spark: SparkSession, bounds: dict[int, tuple], period: str = "annee") -> DataFrame:
    """The class bounds as a table: one row per period that has bounds."""
    periods = sorted(bounds)
    columns = {period: pa.array(periods, pa.int64())}
    for i in range(len(next(iter(bounds.values())))):
        columns[f"bound_{i + 1}"] = pa.array([float(bounds[p][i]) for p in periods], pa.float64())
    return spark.createDataFrame(pa.table(columns))


def classify_by_period(df: DataFrame, value: str, bounds: dict[int, tuple], classes=R.INCOME_CLASSES,
                       period: str = "annee", name: str = "income_level") -> DataFrame:
    """Class of a value by the inclusive upper bounds of its period.

    NULL without a value or without bounds for the period. The bounds come as a
    Python dict of rules, so their broadcast is as large as the configuration.
    """
    table = bounds_table(df.sparkSession, bounds, period)
    bound_cols = [c for c in table.columns if c != period]
    labelled = df.join(F.broadcast(table), period, "left").withColumn(
        name, classify(value, [F.col(c) for c in bound_cols], classes))
    return labelled.select(*[c for c in df.columns if c != name], name)


def with_entity(features: DataFrame, entity: DataFrame, key: str = "countryiso3code") -> DataFrame:
    """Name and region of the entity; entities outside the dimension are dropped."""
    return features.join(entity.select(key, "country_name", "region"), key)


def feature_mart(fact: DataFrame, entity: DataFrame, panel: Panel = Panel(),
                 features: dict[str, str] = R.FEATURE_CODES, class_code: str = R.CLASS_SOURCE_CODE,
                 bounds: dict[int, tuple] = R.INCOME_BOUNDS, classes=R.INCOME_CLASSES,
                 first_period: int = R.FIRST_FEATURE_YEAR) -> DataFrame:
    """Entity x period rows with features and class; the class source is no feature.

    Filter and pivot come before the join with the dimension, so the join sees one
    row per entity and period.
    """
    keys = [panel.entity, panel.period]
    recent = fact.filter(F.col(panel.period) >= first_period)
    wide = pivot_features(recent, {**features, "_class_source": class_code}, keys, panel.indicator, panel.value)
    labelled = classify_by_period(with_entity(wide, entity, panel.entity), "_class_source", bounds, classes, panel.period)
    return labelled.select(panel.entity, "country_name", "region", panel.period, *features, "income_level")
