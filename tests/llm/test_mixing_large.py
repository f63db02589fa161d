"""One very large text among small ones does not keep a source from its target."""

import random

import pytest
from pyspark.sql import functions as F

from indipanel.llm import mixing


@pytest.mark.parametrize("share", [0.1, 0.456, 0.9])
def test_words_near_the_target_with_one_large_text(spark, share):
    rnd = random.Random(4)
    rows = [(f"s{n}" if n else None, n * 1000 + k, 20_000.0 if k == 0 else float(rnd.randint(50, 500)), 1.0, share)
            for n in range(40) for k in range(500)]
    units = spark.createDataFrame(rows, "source string, _key long, _x double, _y double, _p double")
    done = mixing.balanced_sample(mixing.draw_large(units))
    got = done.groupBy("source").agg(F.sum(F.col("_p") * F.col("_x")).alias("taken"), F.count("*").alias("n")).collect()
    words = {s: sum(x for t, _, x, *_ in rows if t == s) for s in {r[0] for r in rows}}
    assert len(got) == 40 and all(r["n"] == 500 for r in got)
    assert all(abs(r["taken"] - share * words[r["source"]]) < 0.01 * share * words[r["source"]] for r in got)
    large = done.filter("_x = 20000").agg(F.avg("_p")).first()[0]
    assert abs(large - share) < 0.25 and done.filter("_p > 0 and _p < 1").isEmpty()


def test_every_source_of_the_table_is_near_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert max(abs(r["taken"] - r["target"]) / r["target"] for r in got) < 0.01


def test_equal_keys_of_different_sources_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(mixing, "unit_key", lambda: F.lit(1).cast("long"))
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c d e", "y"), (3, "f", None)], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3]
