import random
import statistics

import pytest
from pyspark.sql import functions as F

from indipanel.operators.ranks import exact_median, newest_hashes


def values(kind):
    rnd = random.Random(3)
    return {
        "mixed signs": lambda: [rnd.gauss(0, 100) for _ in range(999)],
        "one octave": lambda: [64 + rnd.random() for _ in range(500)],
        "heavy tail": lambda: [10 ** rnd.uniform(-300, 300) for _ in range(301)],
        "copies": lambda: [5.0] * 400 + [1.0] * 100 + [9.0] * 300,
        "around zero": lambda: [0.0, -0.0, 5e-324, -5e-324, 1e-310, 0.0],
        "powers of two": lambda: [2.0 ** e for e in range(-60, 60)],
        "single": lambda: [3.25],
    }[kind]()


@pytest.mark.parametrize("hot_rows", [0, 10 ** 6], ids=["by histogram", "plain"])
@pytest.mark.parametrize("kind", ["mixed signs", "one octave", "heavy tail", "copies", "around zero", "powers of two", "single"])
def test_exact_median(spark, kind, hot_rows):
    data = values(kind)
    df = spark.createDataFrame([("k", v) for v in data] + [("k", None), ("empty", None)], "k string, v double")
    got = [tuple(r) for r in exact_median(df, ["k"], "v", hot_rows=hot_rows).collect()]
    ordered = sorted(data)
    n = len(ordered)
    assert got == [("k", ordered[(n - 1) // 2] * 0.5 + ordered[n // 2] * 0.5)]
    assert got[0][1] == pytest.approx(statistics.median(data))


def test_exact_median_of_a_hot_key_beside_small_ones(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") < 19000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 10007 / 100).alias("v"))
    got = {r["k"]: r["median"] for r in exact_median(df, ["k"], "v", hot_rows=1000).collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got == want


@pytest.mark.parametrize("limit", [0, 1, 100, 333, 334, 500, 667, 999, 1000, 5000])
def test_newest_hashes(spark, limit):
    df = spark.range(1000).select(
        F.sha2((F.col("id") % 900).cast("string"), 256).alias("row_hash"), (F.col("id") % 3).alias("inserted_at"))
    ordered = sorted(((r["inserted_at"], r["row_hash"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    got = [r[0] for r in newest_hashes(df, limit).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {h for _, h in ordered[:limit]}


def test_newest_hashes_skips_rows_without_hash(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 0)], "row_hash string, inserted_at int")
    assert {r[0] for r in newest_hashes(df, 1).collect()} == {"a"}
