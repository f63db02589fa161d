"""Gap treatment: published value beside final value, with the method recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import safe_divide
from ..rules import GapRules, Panel
from .ranks import exact_median
from .series import neighbours
from .skew import join_per_group


def _order(panel: Panel) -> list[str]:
    return [panel.period] + ([panel.tie] if panel.tie else [])


def _published(panel: Panel, as_of: int | None) -> Column:
    known = F.col(panel.value).isNotNull()
    return known if as_of is None else known & (F.col(panel.period) <= as_of)


def published_neighbours(df: DataFrame, panel: Panel = Panel(), as_of: int | None = None) -> DataFrame:
    """previous/next published value and period of every row.

    as_of  values of later periods are not known yet and serve no row
    """
    return neighbours(df, panel.series, _order(panel), [panel.value, panel.period],
                      found=_published(panel, as_of))


def _between(panel: Panel) -> Column:
    """Straight line between the neighbours; NULL unless they span time."""
    pv, nv = F.col(f"previous_{panel.value}"), F.col(f"next_{panel.value}")
    pt, nt = F.col(f"previous_{panel.period}"), F.col(f"next_{panel.period}")
    share = safe_divide(F.col(panel.period) - pt, nt - pt)
    return F.when(nt > pt, pv + (nv - pv) * share)


def interpolate(df: DataFrame, panel: Panel = Panel(), name: str = "interpolated") -> DataFrame:
    """Add the line value for missing rows that have published rows on both sides."""
    seen = published_neighbours(df, panel)
    return seen.withColumn(name, F.when(F.col(panel.value).isNull(), _between(panel)))


def series_median(df: DataFrame, panel: Panel = Panel(), name: str = "median", as_of: int | None = None) -> DataFrame:
    """Exact median of the published values of each series, over all periods."""
    return exact_median(df.filter(_published(panel, as_of)), panel.series, panel.value, name)


def median_fill(df: DataFrame, panel: Panel = Panel(), name: str = "median", as_of: int | None = None) -> DataFrame:
    """Add the series median to the missing rows."""
    medians = series_median(df, panel, name, as_of)
    return join_per_group(df.filter(F.col(panel.value).isNull()), medians, panel.series, _order(panel))


def treat_gaps(df: DataFrame, panel: Panel = Panel(), rules: GapRules = GapRules(),
               keep: list[str] | None = None, as_of: int | None = None) -> DataFrame:
    """Fact rows: published value, final value, method, imputed flag, kept columns.

    Published rows and indicators without a rule are a pure projection; only the
    series of the rules' indicators are shuffled. ``df`` should be a stored table,
    partitioned by indicator: every rule then reads its own folders.

    A missing row with neighbours that do not span time (two rows of one period)
    stays NULL but is labelled interpolated.

    as_of  by default later periods count too, also for gaps of earlier ones; with a
           period here, only values up to it are used to fill gaps
    """
    code, value = F.col(panel.indicator), F.col(panel.value)
    keep = [] if keep is None else keep
    treated = [*rules.interpolate, *rules.median]
    missing = value.isNull()

    def fact(rows: DataFrame, final: Column, method: Column) -> DataFrame:
        return rows.select(
            F.col(panel.entity), F.col(panel.period), F.col(panel.indicator),
            value.alias("valeur_originale"), final.alias("valeur"),
            method.alias("methode_traitement"),
            method.isin(*R.IMPUTING_METHODS).alias("est_imputee"),
            *[F.col(c) for c in keep])

    has_rule = F.coalesce(code.isin(treated), F.lit(False))
    as_is = fact(df.filter(~missing | ~has_rule), value,
                 F.when(~missing, R.METHOD_PUBLISHED).otherwise(R.METHOD_MISSING))

    line = _between(panel)
    line = F.when(code.isin(list(rules.rounded)), F.round(line)).otherwise(line)
    both = F.col(f"previous_{panel.value}").isNotNull() & F.col(f"next_{panel.value}").isNotNull()
    between = fact(
        published_neighbours(df.filter(code.isin(list(rules.interpolate))), panel, as_of).filter(missing),
        line, F.when(both, R.METHOD_INTERPOLATED).otherwise(R.METHOD_MISSING))

    filled = fact(
        median_fill(df.filter(code.isin(list(rules.median))), panel, "_median", as_of),
        F.col("_median"),
        F.when(F.col("_median").isNotNull(), R.METHOD_MEDIAN).otherwise(R.METHOD_MISSING))

    return as_is.unionByName(between).unionByName(filled)


def build_fact(staging: DataFrame, panel: Panel = Panel(), rules: GapRules = GapRules(),
               as_of: int | None = None) -> DataFrame:
    """Fact table over the staged rows of real entities."""
    base = staging.filter((F.col("type_entite") == R.ENTITY_COUNTRY) & F.col(panel.entity).isNotNull())
    return treat_gaps(base, panel, rules, keep=["obs_status", "decimal_places", "inserted_at"], as_of=as_of)
