import random

import pytest
from pyspark.sql import functions as F

from indipanel.operators.gaps import build_fact, interpolate, series_median, treat_gaps
from indipanel.rules import GapRules, Panel

PANEL = Panel("e", "t", "i", "v", "h")
RULES = GapRules(interpolate=("pop", "life"), median=("gdp",), rounded=("pop",))
SCHEMA = "e string, i string, t bigint, v double, h string"


def fact(spark, data):
    df = treat_gaps(spark.createDataFrame(data, SCHEMA), PANEL, RULES)
    return {(r["e"], r["i"], r["t"], r["valeur_originale"]): (r["valeur"], r["methode_traitement"], r["est_imputee"])
            for r in df.collect()}


def test_each_rule(spark):
    got = fact(spark, [
        ("X", "pop", 2000, 10.0, "a"), ("X", "pop", 2001, None, "b"), ("X", "pop", 2002, 13.0, "c"), ("X", "pop", 2003, None, "d"),
        ("X", "life", 1999, None, "a"), ("X", "life", 2000, 1.0, "b"), ("X", "life", 2003, None, "c"), ("X", "life", 2004, 2.0, "d"),
        ("X", "gdp", 2000, 1.0, "a"), ("X", "gdp", 2001, 4.0, "b"), ("X", "gdp", 2002, None, "c"),
        ("Y", "gdp", 2000, None, "a"),
        ("X", "other", 2000, None, "a"), ("X", "other", 2001, 3.0, "b"), ("X", None, 2000, None, "a")])
    assert got[("X", "pop", 2001, None)] == (12.0, "interpolation_temporelle", True)   # 11.5, half away from zero
    assert got[("X", "pop", 2003, None)] == (None, "non_disponible", False)             # no extrapolation
    assert got[("X", "life", 1999, None)] == (None, "non_disponible", False)
    assert got[("X", "life", 2003, None)] == (1.75, "interpolation_temporelle", True)
    assert got[("X", "gdp", 2002, None)] == (2.5, "mediane_pays", True)
    assert got[("Y", "gdp", 2000, None)] == (None, "non_disponible", False)             # nothing to take the median of
    assert got[("X", "other", 2000, None)] == (None, "non_disponible", False)
    assert got[("X", "other", 2001, 3.0)] == (3.0, "originale", False)
    assert got[("X", None, 2000, None)] == (None, "non_disponible", False)
    assert len(got) == 15


def test_two_rows_of_one_period_keep_null_but_say_interpolated(spark):
    got = fact(spark, [("X", "life", 2000, 5.0, "a"), ("X", "life", 2000, None, "b"), ("X", "life", 2000, 7.0, "c")])
    assert got[("X", "life", 2000, None)] == (None, "interpolation_temporelle", True)


def test_properties_of_a_random_panel(spark):
    rnd = random.Random(1)
    data = [(e, i, t, None if rnd.random() < 0.4 else round(rnd.uniform(0, 100), 2), f"{t}")
            for e in "ABC" for i in ("pop", "life", "gdp", "other") for t in range(1990, 2020)]
    df = treat_gaps(spark.createDataFrame(data, SCHEMA), PANEL, RULES)
    assert df.count() == len(data)
    assert df.groupBy("e", "i", "t").count().filter("count > 1").isEmpty()
    assert df.filter("valeur_originale is not null and valeur <> valeur_originale").isEmpty()
    assert df.filter("est_imputee <> (methode_traitement in ('interpolation_temporelle', 'mediane_pays'))").isEmpty()
    seen = interpolate(spark.createDataFrame(data, SCHEMA), PANEL).filter("interpolated is not null")
    assert seen.count() > 0
    assert seen.filter("interpolated < least(previous_v, next_v) or interpolated > greatest(previous_v, next_v)").isEmpty()


def test_median_uses_all_periods(spark):
    data = [("X", "gdp", t, float(t), "h") for t in (1960, 1961, 2020)]
    assert series_median(spark.createDataFrame(data, SCHEMA), PANEL).first()["median"] == 1961.0


def test_build_fact_leaves_out_aggregates_and_blank_codes(spark):
    data = [("X", "pays_ou_territoire", 1.0), ("Y", "agregat", 2.0), (None, "pays_ou_territoire", 3.0), ("Z", "inconnu", 4.0)]
    staged = spark.createDataFrame(data, "countryiso3code string, type_entite string, valeur double").select(
        "*", F.lit("SP.POP.TOTL").alias("indicator_code"), F.lit(2000).cast("bigint").alias("annee"),
        F.lit(None).cast("string").alias("obs_status"), F.lit(0).cast("bigint").alias("decimal_places"),
        F.current_timestamp().alias("inserted_at"), F.lit("h").alias("row_hash"))
    got = build_fact(staged)
    assert [r["countryiso3code"] for r in got.collect()] == ["X"]
    assert got.columns == ["countryiso3code", "annee", "indicator_code", "valeur_originale", "valeur",
                           "methode_traitement", "est_imputee", "obs_status", "decimal_places", "inserted_at"]


def test_as_of_hides_later_values(spark):
    data = [("X", "life", 2000, 1.0, "a"), ("X", "life", 2001, None, "b"), ("X", "life", 2002, 3.0, "c"),
            ("X", "gdp", 2000, 1.0, "a"), ("X", "gdp", 2001, None, "b"), ("X", "gdp", 2002, 9.0, "c")]
    df = treat_gaps(spark.createDataFrame(data, SCHEMA), PANEL, RULES, as_of=2001)
    got = {r["i"]: (r["valeur"], r["methode_traitement"]) for r in df.filter("t = 2001").collect()}
    assert got == {"life": (None, "non_disponible"), "gdp": (1.0, "mediane_pays")}
    assert df.filter("t = 2002 and methode_traitement = 'originale'").count() == 2


def test_an_indicator_has_one_rule():
    with pytest.raises(ValueError, match="pop"):
        GapRules(interpolate=("pop",), median=("pop",))
