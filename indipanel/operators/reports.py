"""Report queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..rules import Panel
from .series import neighbours


def region_overview(star: DataFrame, group: list[str], value: str = "valeur") -> DataFrame:
    """Count, sum and mean of the values per group, e.g. region x year x indicator."""
    v = F.col(value)
    return star.groupBy(*group).agg(
        F.count(v).alias("n_values"), F.sum(v).alias("total"), F.avg(v).alias("mean"))


def evolution(df: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Previous row of the series and the change since then, absolute and relative."""
    order = [panel.period] + ([panel.tie] if panel.tie else [])
    seen = neighbours(df, panel.series, order, [panel.value, panel.period], found=F.lit(True))
    before = F.col(f"previous_{panel.value}")
    change = F.col(panel.value) - before
    return seen.select(
        *df.columns, f"previous_{panel.period}", f"previous_{panel.value}",
        change.alias("change"), F.try_divide(change, before).alias("change_rate"))


def factor_relation(features: DataFrame, factors: list[str], target: str, digits: int = 6) -> DataFrame:
    """Correlation of every factor with the target: (factor, n, correlation)."""
    def pair(c: str):
        both = F.col(c).isNotNull() & F.col(target).isNotNull()
        return F.struct(F.lit(c).alias("factor"), F.count_if(both).alias("n"),
                        F.round(F.corr(F.col(c).cast("double"), F.col(target).cast("double")), digits).alias("correlation"))
    one = features.agg(F.array(*[pair(c) for c in factors]).alias("_f"))
    return one.select(F.explode("_f").alias("_f")).select("_f.*")


def factor_by_class(features: DataFrame, factors: list[str], label: str, digits: int = 6) -> DataFrame:
    """Mean of every factor per class: (class, n, mean_<factor>...)."""
    return features.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count("*").alias("n"),
        *[F.round(F.avg(F.col(c).cast("double")), digits).alias(f"mean_{c}") for c in factors])


def predictions_by_entity(ledger: DataFrame) -> DataFrame:
    """Actual against predicted, entity by entity and run type: how many predictions are right, wrong
    or wait for the actual class, and the classes of the newest period.

    Of rows of one period the one with the largest classes is shown; a null period is older than any other.
    """
    newest = F.max(F.struct("annee", "country_name", "region", "income_level", "income_level_predit")).alias("_newest")

    def counted(outcome: str, name: str):
        return F.count_if(F.col("prediction_correcte") == outcome).alias(name)

    return ledger.groupBy("countryiso3code", "type_prediction").agg(
        F.count("*").alias("n_predictions"), counted(R.OUTCOME_RIGHT, "n_right"), counted(R.OUTCOME_WRONG, "n_wrong"),
        counted(R.OUTCOME_PENDING, "n_waiting"), newest).select("*", "_newest.*").drop("_newest")
