from datetime import datetime

import pytest
from pyspark.sql import functions as F

from indipanel.operators import ingest as G
from indipanel.plans import ingest_job
from indipanel.plans.ingest_job import ingest
from indipanel.schemas import OBSERVATION, RAW
from indipanel.sources import tables


def observation(value, date="2020", code="A"):
    return ((code, code.lower()), ("x", "X"), "XXX", date, value, "", "", 0)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), OBSERVATION)


def stamp(day):
    return datetime(2024, 1, day, 6, 30, 0, 123)


def stored_values(spark, path):
    return sorted((r["batch_id"][:8], r["value"]) for r in tables.scan(spark, path, RAW).collect())


def test_twice_is_once_and_copies_in_a_batch_stay(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = batch(spark, observation(1.0), observation(1.0), observation(2.0))
    first = ingest(spark, rows, path, stamp(1))
    assert (first["received"], first["inserted"], first["batch_id"]) == (3, 3, "20240101_063000_000123")
    assert ingest(spark, rows, path, stamp(2))["inserted"] == 0
    assert stored_values(spark, path) == [("20240101", 1.0), ("20240101", 1.0), ("20240101", 2.0)]


def test_a_value_that_returns_is_known_unless_compared_with_the_latest(spark, tmp_path):
    seen, latest = str(tmp_path / "seen"), str(tmp_path / "latest")
    for day, value in ((1, 1.0), (2, 2.0), (3, 1.0)):
        ingest(spark, batch(spark, observation(value)), seen, stamp(day))
        ingest(spark, batch(spark, observation(value)), latest, stamp(day), compare_to="latest")
    assert [v for _, v in stored_values(spark, seen)] == [1.0, 2.0]
    assert [v for _, v in stored_values(spark, latest)] == [1.0, 2.0, 1.0]


def test_lookback_forgets_old_hashes(spark, tmp_path):
    path = str(tmp_path / "raw")
    ingest(spark, batch(spark, observation(1.0)), path, stamp(1))
    ingest(spark, batch(spark, observation(2.0)), path, stamp(2))
    assert ingest(spark, batch(spark, observation(1.0)), path, stamp(3), lookback=1)["inserted"] == 1


@pytest.mark.parametrize("batch_rows", [None, 11])
@pytest.mark.parametrize("hot", [1, 2, 3, 10 ** 6])
def test_only_new_is_the_same_for_every_hot_limit(spark, rows, hot, batch_rows):
    new = spark.createDataFrame([(h, n) for h, k in (("a", 5), ("b", 2), ("c", 1), ("d", 3)) for n in range(k)],
                                "row_hash string, n int")
    seen = spark.createDataFrame([("b",), ("b",), ("d",), ("z",)], "row_hash string")
    got = rows(G.only_new(new, seen, hot_copies=hot, batch_rows=batch_rows))
    assert got == [("a", n) for n in range(5)] + [("c", 0)]


def test_failed_write_leaves_no_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    ingest(spark, batch(spark, observation(1.0)), path, stamp(1))

    def half_written(df, where):
        tables.append_batch(df, where)
        raise OSError("disk gone")

    monkeypatch.setattr(ingest_job, "append_batch", half_written)
    with pytest.raises(OSError):
        ingest(spark, batch(spark, observation(2.0)), path, stamp(2))
    assert stored_values(spark, path) == [("20240101", 1.0)]


def test_rollback_is_the_inverse_of_append(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = batch(spark, observation(1.0)).select("*", F.lit("h").alias("row_hash"), F.current_timestamp().alias("inserted_at"))
    for name in ("one", "two"):
        tables.append_batch(df.withColumn("batch_id", F.lit(name)), path)
    assert tables.rollback_batch(spark, path, "two") and not tables.rollback_batch(spark, path, "two")
    left = tables.scan(spark, path, RAW)
    assert [r["batch_id"] for r in left.collect()] == ["one"]
    assert tables.without_batch(left, "one").isEmpty()


def test_latest_version_breaks_ties_by_hash(spark, rows):
    df = spark.createDataFrame([("X", 1, "a"), ("X", 2, "a"), ("X", 2, "b"), ("Y", 1, "c"), (None, 1, "d")],
                               "k string, inserted_at int, row_hash string")
    assert rows(G.latest_version(df, ["k"], ["inserted_at", "row_hash"])) == [("X", 2, "b"), ("Y", 1, "c"), (None, 1, "d")]


def test_replace_partitions_keeps_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    tables.replace_table(df, path, ["p"])
    tables.replace_partitions(spark.createDataFrame([("b", 3)], "p string, v int"), path, ["p"])
    assert rows(tables.scan(spark, path, df.schema)) == [("a", 1), ("b", 3)]
    tables.replace_table(spark.createDataFrame([("c", 4)], "p string, v int"), path, ["p"])
    assert rows(tables.scan(spark, path, df.schema)) == [("c", 4)]


def test_scan_of_nothing_is_empty(spark, tmp_path):
    assert tables.scan(spark, str(tmp_path / "no"), RAW).isEmpty()


def test_an_empty_first_batch(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert ingest(spark, batch(spark), path, stamp(1))["inserted"] == 0
    assert ingest(spark, batch(spark, observation(1.0)), path, stamp(2))["inserted"] == 1


def test_load_times_are_utc_in_any_session_zone(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        ingest(spark, batch(spark, observation(1.0)), path, stamp(1))
        micros = tables.scan(spark, path, RAW).select(F.unix_micros("inserted_at")).first()[0]
        name = spark.range(1).select(G.batch_id_of(F.timestamp_micros(F.lit(micros)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == int((stamp(1) - datetime(1970, 1, 1)).total_seconds()) * 10 ** 6 + 123
    assert name == "20240101_063000_000123"
