"""Size switches give equal results for odd values, and failures lose no stored row."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from indipanel.operators.ranks import exact_median
from indipanel.operators.series import neighbours
from indipanel.plans.ingest_job import ingest
from indipanel.schemas import RAW
from indipanel.sources.tables import replace_table, scan

NAN, INF = math.nan, math.inf


@pytest.mark.parametrize("data", [
    [1.0, 2.0, NAN, 3.0, 4.0], [1.0, 2.0, INF, 3.0], [-INF, -INF, 1.0], [NAN, NAN, 1.0], [INF, -INF], [NAN],
    [-0.0, 0.0, 1.0], [1e9 + k / 1e7 for k in range(3001)]], ids=str)
def test_median_paths_agree(spark, data):
    df = spark.createDataFrame([("k", v) for v in data], "k string, v double")
    plain, hot = (exact_median(df, ["k"], "v", hot_rows=h).collect()[0]["median"] for h in (10 ** 6, 0))
    assert plain == pytest.approx(hot, rel=1e-15, nan_ok=True)


def test_neighbours_paths_agree_without_period(spark, rows):
    data = [("a", p, v) for p, v in [(None, 5.0), (1, 9.0), (5000, None), (9000, 2.0), (9001, None)]]
    df = spark.createDataFrame(data, "k string, p long, v double")
    paths = [rows(neighbours(df, ["k"], ["p"], ["v"], hot_rows=h)) for h in (0, 10 ** 6)]
    assert paths[0] == paths[1]
    assert ("a", None, 5.0, None, 9.0) in paths[0]


def test_failing_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    good = spark.range(5).select(F.col("id").cast("string").alias("x"))
    replace_table(good, path)
    with pytest.raises(Exception):
        replace_table(good.select(F.raise_error(F.lit("lost")).cast("string").alias("x")), path)
    assert scan(spark, path, good.schema).count() == 5
    replace_table(good.limit(2), path)
    assert scan(spark, path, good.schema).count() == 2
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]


def test_used_stamp_loses_nothing(spark, tmp_path):
    stamp, path = datetime(2024, 1, 2), str(tmp_path / "raw")
    fields = [f for f in RAW if f.name not in ("row_hash", "inserted_at", "batch_id")]

    def load(date, broken=False):
        columns = [F.lit(date).cast(f.dataType).alias(f.name) if f.name == "date" else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        rows = spark.range(1).select(*columns)
        return ingest(spark, rows.withColumn("date", F.raise_error(F.lit("lost")).cast("string")) if broken else rows, path, stamp)

    first, second = load("2001"), load("2002")
    assert (first["inserted"], second["inserted"]) == (1, 1) and first["batch_id"] != second["batch_id"]
    with pytest.raises(Exception):
        load("2003", broken=True)
    assert scan(spark, path, RAW).count() == 2
