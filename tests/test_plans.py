"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from indipanel.catalog import inputs as I
from indipanel.catalog.spark_queries import QUERIES
from indipanel.operators import features, gaps, ingest, staging, star
from indipanel.rules import GapRules, Panel
from indipanel.schemas import RAW, STAGING
from indipanel.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in (
    "rf_fit_predict", "forest_certain", "model_roundtrip", "train_job", "ingest_two_batches", "ingest_stream", "dq_suite",
    "ingest_incremental", "stream_broken_landing", "registered_views")])
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_versions_are_limited_before_the_shuffle(spark):
    text = plan(staging.stage(tables.scan(spark, "/nowhere", RAW).unionByName(I.raw_events(spark, SF)), _metadata(spark)))
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)


def _metadata(spark):
    from indipanel.sources.pages import entity_metadata
    return entity_metadata(I.entities(spark, SF))


def test_neighbours_shuffle_the_rows_once(spark):
    df = spark.range(10).selectExpr(
        "id % 3 as e", "cast(id % 2 as string) as i", "id as t", "cast(id as double) as v", "uuid() as payload")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # as with large inputs
    try:
        text = plan(gaps.published_neighbours(df, Panel("e", "t", "i", "v", None)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # hot series: the rows by series and block once; their edges by block, twice
    keys = [re.sub(r"#\w+", "", e) for e in exchanges(text)]
    assert sum(k.startswith("e, i, _block1") for k in keys) == 3
    ordinary = text.split("Union")[1].split("LeftSemi")[0]
    assert len(exchanges(ordinary.split("LeftAnti")[0])) == 1
    assert "partial_max" in text and "partial_count" in text            # edges and counts are combined first
    hints = re.findall(r"BroadcastHashJoin .* (Left\w+),", text)
    assert sorted(hints) == ["LeftAnti", "LeftSemi", "LeftSemi"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("staged"))
    rows = staging.stage(I.raw_events(spark, SF), _metadata(spark))
    tables.replace_table(rows, path, ["indicator_code"])
    return path


def test_gap_treatment_reads_only_the_partitions_of_its_rules(spark, staged):
    rules = GapRules(interpolate=("click",), median=("view",), rounded=())
    text = plan(gaps.build_fact(tables.scan(spark, staged, STAGING), rules=rules))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert sum("click" in f and "view" not in f for f in filters) >= 2
    assert sum("view" in f and "click" not in f for f in filters) >= 2
    # rows without a rule are never shuffled: one scan is read straight into the union
    assert len(filters) >= 5


def test_projection_and_filter_reach_the_scan(spark, staged):
    scan = tables.scan(spark, staged, STAGING)
    text = plan(star.slice_star(scan, years=(20240101, 20240110), indicators=["click"]).select("valeur"))
    assert "PushedFilters: [IsNotNull(annee), GreaterThanOrEqual(annee,20240101)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"annee", "valeur"}
    assert "indicator_code" in re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)


def test_pivot_is_one_shuffle_with_partial_aggregation(spark, staged):
    fact = tables.scan(spark, staged, STAGING)
    text = plan(features.pivot_features(fact, {"a": "click", "b": "view"}, ["countryiso3code", "annee"]))
    assert len(exchanges(text)) == 1 and "partial_max" in text


def test_only_rules_are_broadcast_by_hint(spark, staged):
    fact = tables.scan(spark, staged, STAGING)
    hinted = features.classify_by_period(fact, "valeur", {2020: (1.0, 2.0, 3.0)})
    logical = hinted._jdf.queryExecution().analyzed().toString()
    assert logical.count("ResolvedHint (strategy=broadcast)") == 1
    joined = star.star(fact, fact.select("countryiso3code", "region"), fact.select("annee"), fact.select("indicator_code", "unit"))
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()


def test_ingest_counts_hashes_before_the_shuffle(spark):
    first, second = I.two_batches(I.copied_events(spark, SF))
    text = plan(ingest.only_new(second, ingest.recent_hashes(first)))
    assert "partial_sum(_copy" in text and "LeftSemi" in text and "LeftAnti" in text


def test_dictionary_labels_need_no_join(spark):
    df = spark.range(3).select(F.lit("SP.POP.TOTL").alias("c"), F.lit("n").alias("n"))
    text = plan(df.select(star.label("c", "n", {"SP.POP.TOTL": "Population"})))
    assert "Join" not in text and "Exchange" not in text


def test_a_load_reads_only_the_hash_folders_of_its_batch(spark, tmp_path):
    from indipanel.plans.ingest_job import ingest
    from indipanel.schemas import OBSERVATION
    from indipanel.sources.hash_index import known_hashes

    rows = I.event_rows(spark, SF).select(*OBSERVATION.fieldNames())
    raw = str(tmp_path / "raw")
    first = ingest(spark, rows, raw)
    batch = rows.filter("indicator.id = 'click'").limit(5)
    known = known_hashes(spark, raw, batch)
    scans = [line for line in plan(known).splitlines() if "ReadSchema: struct<hash:binary" in line]
    assert scans and all("dynamicpruningexpression" in line for line in scans)
    assert "row_hash" not in re.search(r"ReadSchema: struct<([^>]*)>", scans[0]).group(1)
    known.collect()
    read = re.search(r"number of partitions read: ([\d,]+)", known._jdf.queryExecution().executedPlan().toString())
    assert first["inserted"] == rows.count() and (read is None or int(read.group(1).replace(",", "")) < 3)
    again = ingest(spark, rows, raw)
    assert again["inserted"] == 0


def test_mart_readers_skip_years(spark, tmp_path):
    from indipanel.catalog.spark_queries import _mart
    from indipanel.schemas import feature_mart

    path = str(tmp_path / "mart")
    tables.replace_table(_mart(spark, SF), path, ["annee"], ["countryiso3code"])
    mart = tables.scan(spark, path, feature_mart(list(I.YEARLY_FEATURES)))
    text = plan(mart.filter("annee >= 1998"))
    assert re.search(r"PartitionFilters: \[[^\]]*annee[^\]]*1998", text)


def test_suite_scans_every_table_once_and_shuffles_counts(spark, staged):
    from indipanel.operators import quality
    df = tables.scan(spark, staged, STAGING)
    rules = {"staging": quality.Rules(not_null=("annee", "valeur"), unique=("row_hash",), grain=("country_name", "annee"),
                                      accepted={"type_entite": ("x",)})}
    text = plan(quality.run_suite({"staging": df}, rules))
    assert text.count("Scan parquet") == 1 and len(exchanges(text)) <= 3 and "partial_sum(n" in text
