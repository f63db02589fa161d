from datetime import datetime

import pytest
from pyspark.sql import functions as F

from indipanel import rules as R
from indipanel.operators import evaluate, features, profile, quality, staging, star
from indipanel.operators.forest import feature_medians
from indipanel.operators.reports import factor_by_class, factor_relation
from indipanel.schemas import METADATA, RAW, STAGING

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def raw(spark, *rows):
    """(code, name, iso3, date, value, hash, time)"""
    return spark.createDataFrame(
        [((c, c), (n[:2], n), iso, d, v, " u ", "", 1, h, t, "b") for c, n, iso, d, v, h, t in rows], RAW)


def metadata(spark):
    return spark.createDataFrame([
        ("AAA", "Aland", "North", "High", R.ENTITY_COUNTRY), ("WLD", "World", R.AGGREGATES_REGION, None, R.ENTITY_AGGREGATE)],
        METADATA)


def test_stage(spark):
    got = staging.stage(raw(
        spark,
        ("P", "Aland", " AAA ", "2020", 1.0, "a", T1), ("P", "Aland", "AAA", "2020", 2.0, "a", T2),
        ("P", "Aland", "AAA", "2020", 3.0, "b", T2), ("P", "Aland", "AAA", "2020.5", 9.0, "c", T2),
        ("P", "Aland", "AAA", "x", 9.0, "d", T2), ("P", "World", "WLD", "2020", 4.0, "e", T1),
        ("P", "Europe", "\t ", "2020", 5.0, "f", T1), ("P", "Nowhere", "NNN", "2020", None, "g", T1)), metadata(spark))
    assert got.columns == STAGING.fieldNames()
    found = {r["country_name"]: r for r in got.collect()}
    assert len(found) == got.count() == 4
    assert (found["Aland"]["valeur"], found["Aland"]["countryiso3code"], found["Aland"]["region"]) == (3.0, "AAA", "North")
    assert {n: r["type_entite"] for n, r in found.items()} == {
        "Aland": "pays_ou_territoire", "World": "agregat", "Europe": "agregat", "Nowhere": "inconnu"}
    assert found["Europe"]["countryiso3code"] is None and found["Aland"]["unit"] == "u"
    assert found["Aland"]["obs_status"] is None


def test_versions_are_kept_per_name_so_a_renamed_entity_breaks_the_grain(spark):
    staged = staging.stage(raw(spark, ("P", "Old", "AAA", "2020", 1.0, "a", T1), ("P", "New", "AAA", "2020", 2.0, "b", T2)),
                           metadata(spark))
    assert staged.count() == 2
    assert quality.grain(staged, ["countryiso3code", "annee", "indicator_code"]).first()["n"] == 2
    assert quality.unique(star.dim_entity(staged), "countryiso3code").count() == 1


def test_one_per_entity(spark):
    twice = metadata(spark).unionByName(metadata(spark).withColumn("region", F.lit("Z"))).unionByName(
        metadata(spark).withColumn("countryiso3code", F.lit(None).cast("string")))
    got = staging.one_per_entity(twice)
    assert got.columns == METADATA.fieldNames() and got.count() == 2
    assert {r["region"] for r in got.collect()} == {"North", "Aggregates"}


def test_dimensions(spark, rows):
    staged = staging.stage(raw(
        spark, ("SP.POP.TOTL", "Aland", "AAA", "2020", 1.0, "a", T1), ("SP.POP.TOTL", "World", "WLD", "2021", 1.0, "b", T1),
        ("other", "Aland", "AAA", "2020", None, "c", T1)), metadata(spark))
    assert rows(star.dim_entity(staged), "countryiso3code", "region") == [("AAA", "North")]
    assert rows(star.dim_period(staged)) == [(2020,), (2021,)]       # years known only for aggregates count too
    assert rows(star.dim_indicator(staged), "indicator_code", "indicator_label_fr", "unit") == [
        ("SP.POP.TOTL", "Population", "u"), ("other", "other", "u")]


def test_label_dictionary_is_complete():
    assert len(R.INDICATOR_LABELS) == 17 and len(R.FEATURE_CODES) == 7 and R.CLASS_SOURCE_CODE == "NY.GNP.PCAP.CD"
    assert sorted(R.INCOME_BOUNDS) == list(range(2015, 2026))


def long_fact(spark, *rows):
    return spark.createDataFrame(rows, "countryiso3code string, annee bigint, indicator_code string, valeur double")


def test_feature_mart(spark):
    fact = long_fact(
        spark, ("AAA", 2015, "SP.DYN.LE00.IN", 70.0), ("AAA", 2015, "NY.GNP.PCAP.CD", 1025.0),
        ("AAA", 2016, "NY.GNP.PCAP.CD", 1005.01), ("AAA", 2014, "SP.DYN.LE00.IN", 60.0),
        ("AAA", 2026, "NY.GNP.PCAP.CD", 5000.0), ("AAA", 2017, "SP.POP.TOTL", 1.0),
        ("AAA", 2025, "NY.GNP.PCAP.CD", 14375.5), ("ZZZ", 2015, "SP.DYN.LE00.IN", 1.0))
    entity = spark.createDataFrame([("AAA", "Aland", "North")], "countryiso3code string, country_name string, region string")
    got = {r["annee"]: r for r in features.feature_mart(fact, entity).collect()}
    assert sorted(got) == [2015, 2016, 2017, 2025, 2026]
    assert {y: r["income_level"] for y, r in got.items()} == {
        2015: "Low income", 2016: "Lower middle income", 2017: None, 2025: "High income", 2026: None}
    assert got[2015]["Esperance_vie"] == 70.0 and got[2015]["country_name"] == "Aland"
    assert R.CLASS_SOURCE not in features.feature_mart(fact, entity).columns


@pytest.mark.parametrize("year", sorted(R.INCOME_BOUNDS))
def test_every_bound_of_every_year(spark, year):
    bounds = R.INCOME_BOUNDS[year]
    data = [(year, float(b) + d) for b in bounds for d in (0.0, 0.01)]
    got = features.classify_by_period(spark.createDataFrame(data, "annee bigint, v double"), "v", R.INCOME_BOUNDS)
    want = [c for i in range(3) for c in (R.INCOME_CLASSES[i], R.INCOME_CLASSES[i + 1])]
    assert [r["income_level"] for r in got.orderBy("v").collect()] == want


def test_star_and_slices(spark, rows):
    fact = long_fact(spark, ("AAA", 2020, "P", 1.0), ("AAA", 2021, "P", 2.0), ("ZZZ", 2020, "P", 3.0))
    entity = spark.createDataFrame([("AAA", "North"), ("BBB", "South")], "countryiso3code string, region string")
    period = spark.createDataFrame([(2020,), (2021,)], "annee bigint")
    indicator = spark.createDataFrame([("P", "Pop", "u")], "indicator_code string, indicator_name string, unit string")
    joined = star.star(fact, entity, period, indicator)
    assert rows(joined, "annee", "valeur", "indicator_name") == [(2020, 1.0, "Pop"), (2021, 2.0, "Pop")]
    assert rows(star.slice_star(joined, countries=["AAA"], years=(2021, 2030), regions=["North"], indicators=["P"]), "valeur") == [(2.0,)]


def test_profiles(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None), (None, 4)], "c string, n int")
    assert [tuple(r) for r in profile.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert rows(profile.missing_profile(df)) == [("c", 1), ("n", 2)]
    assert profile.dataset_profile(df, "n").first().asDict() == {
        "n_rows": 4, "n_columns": 2, "first_period": 1, "last_period": 4}
    assert rows(profile.column_list(df)) == [(1, "c", "string"), (2, "n", "int")]


JUDGED = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] * 2


def test_scores(spark):
    df = spark.createDataFrame(JUDGED, "y string, p string")
    assert evaluate.accuracy(df, "y", "p").first()["accuracy"] == 5 / 8
    report = {r["label"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["a"]["support"]) == (3 / 5, 3 / 4, 4)
    assert (report["c"]["precision"], report["c"]["recall"], report["c"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["accuracy"]["f1"] == 5 / 8 and report["accuracy"]["support"] == 8
    assert report["macro avg"]["recall"] == pytest.approx((3 / 4 + 1 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(5 / 8)
    matrix = {r["actual"]: tuple(r)[1:] for r in evaluate.confusion_matrix(df, "y", "p", ["a", "b", "c", "d"]).collect()}
    assert matrix == {"a": (3, 1, 0, 0), "b": (0, 2, 0, 0), "c": (2, 0, 0, 0), "d": (0, 0, 0, 0)}


def test_class_weights_and_medians(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, None), (None, 99.0, None)],
                               "y string, f double, g double")
    weights = {r["y"]: r["weight"] for r in evaluate.class_weights(df, "y").collect()}
    assert weights == {"a": 3 / 4, "b": 3 / 2}
    medians = {r["feature"]: r["median"] for r in feature_medians(df.filter("y is not null"), ["f", "g"]).collect()}
    assert medians == {"f": 2.0}


def test_factors(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, 4.0, "a"), (3.0, 6.0, "b"), (None, 1.0, None)], "f double, t double, c string")
    assert factor_relation(df, ["f"], "t").first().asDict() == {"factor": "f", "n": 3, "correlation": 1.0}
    assert {r["c"]: r["mean_f"] for r in factor_by_class(df, ["f"], "c").collect()} == {"a": 1.5, "b": 3.0}


def test_quality_rules(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert quality.not_null(df, "v").count() == 1
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert rows(quality.grain(df, ["k", "v"])) == [("a", 1, 2)]
    assert rows(quality.accepted_values(df, "k", ["a"])) == [("b", 1)]
    assert rows(quality.relationships(df, "k", parent)) == [("b", 1)]
    report = quality.run_suite({"child": df, "parent": parent}, {"child": quality.Rules(
        not_null=("k", "v"), unique=("k",), accepted={"k": ("a",)}, parents={"k": "parent"}, grain=("k", "v"))})
    got = {(r["rule"], r["column_name"]): (r["failures"], r["status"]) for r in report.collect()}
    assert got == {("not_null", "k"): (1, "fail"), ("not_null", "v"): (1, "fail"), ("unique", "k"): (1, "fail"),
                   ("accepted_values", "k"): (1, "fail"), ("relationships", "k"): (1, "fail"), ("grain", "k,v"): (1, "fail")}
