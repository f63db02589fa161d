"""Pages that land in bundles: many pages a file, beside folders of one page."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from indipanel.catalog import spark_queries
from indipanel.schemas import RAW
from indipanel.sources import pages as P
from indipanel.sources import tables
from indipanel.streaming import ingest_stream

ROW = {"indicator": {"id": "A", "value": "a"}, "country": {"id": "x", "value": "X"}, "countryiso3code": "XXX",
       "date": "2020", "value": 1, "unit": "", "obs_status": "", "decimal": 0}


def body(page, pages, *values):
    return json.dumps([{"page": page, "pages": pages, "total": len(values)}, [ROW | {"value": v} for v in values]], indent=1)


def frame(spark, *pages):
    return spark.createDataFrame(list(pages), "code string, page int, body string")


def files(path):
    return [f for f in glob.glob(f"{path}/code=*/page=*/*") if not os.path.basename(f).startswith((".", "_"))]


def test_many_pages_land_in_few_files_and_come_back(spark, tmp_path, rows):
    """Each page was a folder and a file."""
    texts = ['line\nnext\r\n', "", '[{"a":"ü\\n\\"\t"}', "[{"]
    landed = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B.C").alias("code"), F.col("id").cast("int").alias("page"),
        F.concat(F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 4 + 1).cast("int")), F.lit("x")).alias("body"))
    P.land_bundles(landed, str(tmp_path), most=100)
    assert 10 <= len(files(tmp_path)) <= 20
    assert rows(P.read_landing(spark, str(tmp_path)), "code", "page", "body") == rows(landed, "code", "page", "body")


def test_of_a_page_in_both_layouts_the_newest_counts(spark, tmp_path):
    P.land_bundles(frame(spark, ("A", 1, "old"), ("A", 2, "kept"), ("A", 3, "old")), str(tmp_path))
    for f in files(tmp_path):
        os.utime(f, (1_000_000_000, 1_000_000_000))
    where = tmp_path / "code=A" / "page=1"
    where.mkdir(parents=True)
    (where / "0.json").write_text("new\nnext")
    P.land_bundles(frame(spark, ("A", 3, "new")), str(tmp_path))
    got = {r["page"]: r["body"] for r in P.read_landing(spark, str(tmp_path)).collect()}
    assert got == {1: "new\nnext", 2: "kept", 3: "new"}


def test_a_broken_line_spoils_its_own_page_only(spark, tmp_path, rows):
    P.land_bundles(frame(spark, ("A", 1, body(1, 2, 1.0)), ("A", 2, body(2, 2, 2.0))), str(tmp_path))
    (tmp_path / "code=A" / "page=__HIVE_DEFAULT_PARTITION__" / "more").write_text('{"page": 2, "bo\n\n')
    parsed = P.parse_pages(P.read_landing(spark, str(tmp_path)))
    accepted = P.accepted_pages(parsed, P.page_policy(parsed))
    assert rows(P.explode_rows(accepted), "value") == [(1.0,), (2.0,)]


def test_the_stream_takes_bundles(spark, tmp_path, rows):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "checkpoint"))

    def take(*pages):
        P.land_bundles(frame(spark, *pages), landing)
        ingest_stream(spark, landing, raw, checkpoint).awaitTermination()
        return rows(tables.scan(spark, raw, RAW), "value")

    assert take(("A", 1, body(1, 2, 1.0)), ("B", 1, body(1, 1, 5.0))) == [(5.0,)]      # A waits for its second page
    assert take(("A", 2, "[{")) == [(5.0,)]
    assert take(("A", 2, body(2, 2, 2.0, 3.0))) == [(1.0,), (2.0,), (3.0,), (5.0,)]
    assert take(("B", 1, body(1, 1, 5.0, 6.0))) == [(1.0,), (2.0,), (3.0,), (5.0,), (6.0,)]


def _landed_files(spark, name):
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/stream-*"))
    assert spark_queries.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
    new = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/stream-*")) - before
    return [f for folder in new for f in files(f"{folder}/landing")]


@pytest.mark.parametrize("name", ["stream_broken_landing", "ingest_stream"])
def test_queries_land_bundles(spark, name):
    """Both landings of five event types: 100 pages and more of them once were as many folders."""
    assert 0 < len(_landed_files(spark, name)) <= 20
