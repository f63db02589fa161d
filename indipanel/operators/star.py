"""Dimensions and the star join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import dictionary


def entities_only(df: DataFrame, key: str = "countryiso3code") -> DataFrame:
    """Rows of real entities with a code."""
    return df.filter((F.col("type_entite") == R.ENTITY_COUNTRY) & F.col(key).isNotNull())


def dim_entity(staging: DataFrame) -> DataFrame:
    return (entities_only(staging).filter(F.col("country_name").isNotNull())
            .select("countryiso3code", "country_code", "country_name", "region", "income_level").distinct())


def dim_period(staging: DataFrame, period: str = "annee") -> DataFrame:
    return staging.filter(F.col(period).isNotNull()).select(period).distinct()


def label(code: Column | str, name: Column | str, labels: dict[str, str]) -> Column:
    """Report label of a code, or its name when the dictionary has none."""
    name = F.col(name) if isinstance(name, str) else name
    return F.coalesce(dictionary(code, labels), name)


def dim_indicator(staging: DataFrame, labels: dict[str, str] = R.INDICATOR_LABELS) -> DataFrame:
    """One row per code. min() skips NULL and is the same on every run."""
    named = (staging.filter(F.col("indicator_code").isNotNull()).groupBy("indicator_code")
             .agg(F.min("indicator_name").alias("indicator_name"), F.min("unit").alias("unit")))
    return named.select(
        "indicator_code", "indicator_name",
        label("indicator_code", "indicator_name", labels).alias("indicator_label_fr"), "unit")


def star(fact: DataFrame, entity: DataFrame, period: DataFrame, indicator: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their dimensions.

    The dimensions carry no broadcast hint; Spark decides by their measured size.
    """
    return (fact.join(entity, "countryiso3code")
            .join(period, "annee")
            .join(indicator.drop("unit"), "indicator_code"))


def slice_star(rows: DataFrame, countries=None, years: tuple[int, int] | None = None,
               regions=None, indicators=None) -> DataFrame:
    """Report filters; every one is optional and reaches the scan."""
    if countries is not None:
        rows = rows.filter(F.col("countryiso3code").isin(list(countries)))
    if years is not None:
        rows = rows.filter(F.col("annee").between(*years))
    if regions is not None:
        rows = rows.filter(F.col("region").isin(list(regions)))
    if indicators is not None:
        rows = rows.filter(F.col("indicator_code").isin(list(indicators)))
    return rows
