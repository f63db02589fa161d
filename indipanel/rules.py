"""Configuration that the operators take as data.

Everything below the "fixed values" comment has to be spelled exactly like this
for results to match; operators accept other rules through their parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- fixed values

# indicator code -> report label
INDICATOR_LABELS = {
    "NY.GDP.MKTP.CD": "PIB",
    "NY.GDP.PCAP.CD": "PIB_par_habitant",
    "NY.GNP.PCAP.CD": "RNB_par_habitant_Atlas",
    "NY.GDP.MKTP.KD.ZG": "Croissance_PIB",
    "SP.POP.TOTL": "Population",
    "SP.DYN.LE00.IN": "Esperance_vie",
    "SL.UEM.TOTL.ZS": "Chomage",
    "FP.CPI.TOTL.ZG": "Inflation",
    "EG.ELC.ACCS.ZS": "Acces_electricite",
    "EN.GHG.CO2.PC.CE.AR5": "CO2_par_habitant",
    "SP.DYN.CBRT.IN": "Taux_natalite",
    "SE.SEC.ENRR": "Scolarisation_secondaire",
    "SE.TER.ENRR": "Scolarisation_superieur",
    "SE.PRM.CMPT.ZS": "Achevement_primaire",
    "SH.XPD.CHEX.GD.ZS": "Depense_de_sante",
    "SE.XPD.TOTL.GD.ZS": "Depense_publique_education",
    "SE.ADT.LITR.ZS": "Alphabetisation_adultes",
}

# model features, in mart column order
FEATURE_NAMES = (
    "Esperance_vie",
    "Depense_de_sante",
    "Scolarisation_secondaire",
    "Depense_publique_education",
    "Taux_natalite",
    "CO2_par_habitant",
    "Acces_electricite",
)

# the indicator that decides the class and is never a feature
CLASS_SOURCE = "RNB_par_habitant_Atlas"

# year -> inclusive upper bounds of the first three classes
INCOME_BOUNDS = {
    2015: (1025, 4035, 12475),
    2016: (1005, 3955, 12235),
    2017: (995, 3895, 12055),
    2018: (1025, 3995, 12375),
    2019: (1035, 4045, 12535),
    2020: (1045, 4095, 12695),
    2021: (1085, 4255, 13205),
    2022: (1135, 4465, 13845),
    2023: (1145, 4515, 14005),
    2024: (1135, 4495, 13935),
    2025: (1175, 4635, 14375),
}

INCOME_CLASSES = (
    "Low income",
    "Lower middle income",
    "Upper middle income",
    "High income",
)

AGGREGATES_REGION = "Aggregates"
ENTITY_COUNTRY = "pays_ou_territoire"
ENTITY_AGGREGATE = "agregat"
ENTITY_UNKNOWN = "inconnu"

METHOD_PUBLISHED = "originale"
METHOD_INTERPOLATED = "interpolation_temporelle"
METHOD_MEDIAN = "mediane_pays"
METHOD_MISSING = "non_disponible"

OUTCOME_PENDING = "En attente"
OUTCOME_RIGHT = "Juste"
OUTCOME_WRONG = "Faux"

RUN_TEST = "Test"
RUN_PRODUCTION = "Production"

FIRST_FEATURE_YEAR = 2015
TRAIN_YEARS = (2015, 2021)
TEST_YEAR = 2022
FINAL_YEARS = (2015, 2022)
SCORE_FROM_YEAR = 2023

FOREST_TREES = 200
FOREST_SEED = 42

# ------------------------------------------------------------ end fixed values

IMPUTING_METHODS = (METHOD_INTERPOLATED, METHOD_MEDIAN)
METHODS = (METHOD_PUBLISHED, METHOD_INTERPOLATED, METHOD_MEDIAN, METHOD_MISSING)


@dataclass(frozen=True)
class Panel:
    """Column roles of a long panel. ``tie`` orders rows of one period."""

    entity: str = "countryiso3code"
    period: str = "annee"
    indicator: str = "indicator_code"
    value: str = "valeur"
    tie: str | None = "row_hash"

    @property
    def series(self) -> list[str]:
        return [self.entity, self.indicator]


@dataclass(frozen=True)
class GapRules:
    """Which indicators are interpolated, median-filled, and rounded."""

    interpolate: tuple[str, ...] = ("SP.POP.TOTL", "SP.DYN.LE00.IN", "SP.DYN.CBRT.IN")
    median: tuple[str, ...] = ("NY.GDP.MKTP.CD", "NY.GDP.PCAP.CD")
    rounded: tuple[str, ...] = ("SP.POP.TOTL",)

    def __post_init__(self):
        both = set(self.interpolate) & set(self.median)
        if both:
            raise ValueError(f"an indicator has one rule, not two: {sorted(both)}")


def codes_by_label(labels: dict[str, str], names) -> dict[str, str]:
    """Column name -> indicator code, for the given label names."""
    by_label = {label: code for code, label in labels.items()}
    return {name: by_label[name] for name in names}


FEATURE_CODES = codes_by_label(INDICATOR_LABELS, FEATURE_NAMES)
CLASS_SOURCE_CODE = codes_by_label(INDICATOR_LABELS, [CLASS_SOURCE])[CLASS_SOURCE]
