"""Replaced tables: interrupted writes, partitions that stay, hash index after a crash, builds of what was touched."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from indipanel.catalog import inputs as I
from indipanel.catalog.spark_queries import _house
from indipanel.plans import ingest_job
from indipanel.plans.ingest_job import ingest
from indipanel.schemas import OBSERVATION, RAW
from indipanel.sources import hash_index, tables

SF = "/root/testdata/sf0.001"
SCHEMA = "x long, p string"


def table(spark, n, parts=3):
    return spark.range(n).select(F.col("id").alias("x"), F.concat(F.lit("p"), F.col("id") % parts).alias("p"))


def count(spark, path):
    return tables.scan(spark, path, table(spark, 0).schema).count()


@pytest.mark.parametrize("step", ["create", "rename", "after"])
def test_a_crash_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    tables.replace_table(table(spark, 5), path, ["p"])
    real = tables._folder

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == step or (step == "after" and name == "delete"):
                raise OSError("crashed")
            return getattr(self.fs, name)

    def folder(spark_, p):
        fs, hadoop = real(spark_, p)
        return (Broken(fs) if "_commits/" in p or (step == "after" and "version=" in p) else fs), hadoop

    monkeypatch.setattr(tables, "_folder", folder)
    try:
        for n in (7, 8, 9):
            tables.replace_table(table(spark, n), path, ["p"])
    except OSError:
        pass
    monkeypatch.undo()
    assert count(spark, path) == {"create": 5, "rename": 5, "after": 9}.get(step) or step == "after" and count(spark, path) in (7, 8, 9)
    tables.replace_table(table(spark, 2), path)
    assert count(spark, path) == 2


def test_the_first_write_that_fails_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception):
        tables.replace_table(table(spark, 3).withColumn("x", F.raise_error(F.lit("lost")).cast("long")), path)
    assert count(spark, path) == 0 and not os.path.exists(path)


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")

    def files():
        return {f.split("/p=")[1]: f for f in glob.glob(f"{path}/version=*/p=*/*.parquet")}

    tables.replace_table(table(spark, 9), path, ["p"])
    before = set(glob.glob(f"{path}/version=*/p=p[02]/*.parquet"))
    new = spark.createDataFrame([(100, "p1"), (101, "p9")], SCHEMA)
    tables.replace_partitions(new, path, ["p"])
    got = {r["p"]: r["n"] for r in tables.scan(spark, path, new.schema).groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert got == {"p0": 3, "p1": 1, "p2": 3, "p9": 1}
    assert before <= set(glob.glob(f"{path}/version=*/p=p[02]/*.parquet"))
    tables.replace_partitions(spark.createDataFrame([(7, "p0")], SCHEMA), path, ["p"])
    assert count(spark, path) == 6
    old = tables.folders(spark, path, tables.commits(spark, path)[0])        # a reader of the last state finds its files
    assert all(os.path.isdir(f"{path}/{f}") for f in old)


def rows(spark):
    return I.event_rows(spark, SF).select(*OBSERVATION.fieldNames())


def test_index_is_mended_after_a_crash_and_forgets_rolled_back_batches(spark, tmp_path, monkeypatch):
    raw, events = str(tmp_path / "raw"), rows(spark)
    monkeypatch.setattr(ingest_job, "index_batches", lambda *a: None)        # the load ends before it indexes
    first = ingest(spark, events, raw, datetime(2024, 1, 1))
    monkeypatch.undo()
    assert hash_index._marked(spark, raw) == set()
    assert ingest(spark, events, raw, datetime(2024, 1, 2))["inserted"] == 0
    assert hash_index._marked(spark, raw) >= {first["batch_id"]}
    tables.rollback_batch(spark, raw, first["batch_id"])
    again = ingest(spark, events, raw, datetime(2024, 1, 1))
    assert again["inserted"] == first["inserted"] and again["batch_id"] != first["batch_id"]
    assert tables.scan(spark, raw, RAW).count() == events.count()


def test_a_load_renews_only_what_it_touches(spark):
    house, events = _house(spark, SF), rows(spark)

    def load(part, day):
        done = ingest(spark, part, house.path("raw"), datetime(2024, 3, day))
        return house.refresh(done["batch_id"], metadata_changed=False)

    def files(name):
        return {f.rsplit("indicator_code=")[1].split("/")[0]: f for f in map(
            lambda r: r[0], house.table(name).select(F.input_file_name()).distinct().collect())}

    late = F.col("date") >= "20240120"
    assert load(events.filter(~late), 1) is None                             # nothing was there: all is built
    before = {n: files(n) for n in ("staging", "fact")}
    assert load(events.filter(late & (F.col("indicator.id") == "click")), 2) == ["click"]
    for name, old in before.items():
        now = files(name)
        assert now["click"] != old["click"] and {k: v for k, v in now.items() if k != "click"} == {
            k: v for k, v in old.items() if k != "click"}
    assert load(events.filter(late & (F.col("indicator.id") == "click")), 3) == []
    load(events, 4)
    parts = {n: house.table(n).exceptAll(house.table(n).limit(0)).collect() for n in ("staging", "fact", "mart", "dim_period")}
    house.build()
    for name, got in parts.items():
        assert sorted(map(str, got)) == sorted(map(str, house.table(name).collect())), name
