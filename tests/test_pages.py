import json
import os

import pytest

from indipanel.plans.ingest_job import IncompleteIndicator, NoData, accepted_rows
from indipanel.sources import pages as P

ROW = {"indicator": {"id": "A", "value": "a"}, "country": {"id": "x", "value": "X"}, "countryiso3code": "XXX",
       "date": "2020", "value": 1, "unit": "", "obs_status": "", "decimal": 0}


def about(page=1, pages=1, total=1):
    return {"page": page, "pages": pages, "per_page": 20000, "total": total}


def frame(spark, *pages):
    return spark.createDataFrame(
        [(c, n, b if isinstance(b, str) else json.dumps(b)) for c, n, b in pages], "code string, page int, body string")


@pytest.mark.parametrize("body", [
    "not json", "", "{}", "[]", "[{}]", "[1, []]", "[null, []]", "[[1], []]", '[{"total": 1}, null]', '"text"', "null",
    '[{}, {}]', '[{}, "x"]', "[{}, [5]]", '[{}, [{}, "x"]]', "[{}, [{}, null]]"])
def test_unusable_bodies(spark, body):
    parsed = P.parse_pages(frame(spark, ("A", 1, body))).first()
    assert parsed["is_valid"] is False and parsed["rows"] is None
    assert P.page_policy(P.parse_pages(frame(spark, ("A", 1, body)))).first()["status"] == "skipped"


def test_rows_keep_their_types_and_unknown_fields_are_ignored(spark):
    row = ROW | {"value": 1.25, "obs_status": None, "extra": [1]}
    got = P.explode_rows(P.parse_pages(frame(spark, ("A", 1, [about(), [row, ROW | {"value": None}]])))).collect()
    assert [r["value"] for r in got] == [1.25, None]
    assert got[0]["indicator"]["id"] == "A" and got[0]["obs_status"] is None and got[0]["decimal"] == 0


def test_missing_totals_fall_back(spark):
    parsed = P.parse_pages(frame(spark, ("A", 1, [{}, [ROW, ROW]]))).first()
    assert (parsed["announced"], parsed["page_count"]) == (2, 1)


def test_policy(spark):
    landed = frame(
        spark,
        ("fine", 1, [about(pages=2, total=2), [ROW]]), ("fine", 2, [about(2, 2, 2), [ROW]]),
        ("skip", 1, "x"), ("skip", 2, [about(2, 2), [ROW]]),
        ("late", 1, [about(pages=3), [ROW]]), ("late", 2, [about(2, 3), [ROW]]), ("late", 3, "x"),
        ("gone", 1, [about(pages=2), [ROW]]),
        ("more", 1, [about(pages=1), [ROW]]), ("more", 2, "x"))
    got = {r["code"]: r["status"] for r in P.page_policy(P.parse_pages(landed)).collect()}
    assert got == {"fine": "accepted", "skip": "skipped", "late": "failed", "gone": "failed", "more": "accepted"}


def test_completeness(spark):
    landed = frame(spark, ("A", 1, [about(pages=2, total=3), [ROW]]), ("A", 2, [about(2, 2, 3), [ROW, ROW]]),
                   ("B", 1, [about(total=5), [ROW]]))
    got = {r["code"]: (r["announced"], r["received"], r["complete"])
           for r in P.completeness(P.parse_pages(landed)).collect()}
    assert got == {"A": (3, 3, True), "B": (5, 1, False)}


def test_accepted_rows(spark):
    landed = frame(spark, ("A", 1, [about(total=4), [ROW]]), ("A", 2, [about(2), [ROW, ROW]]),
                   ("S", 1, "x"), ("S", 2, [about(2), [ROW]]), ("B", 1, [about(), [ROW]]))
    rows, notes = accepted_rows(spark, landed)
    assert rows.count() == 2                     # page 2 of A was not announced, S is skipped
    assert notes == {"skipped": ["S"], "incomplete": ["A"]}


def test_a_missing_later_page_stops_the_run(spark):
    with pytest.raises(IncompleteIndicator, match="A"):
        accepted_rows(spark, frame(spark, ("A", 1, [about(pages=2), [ROW]])))


def test_no_rows_at_all(spark):
    with pytest.raises(NoData):
        accepted_rows(spark, frame(spark, ("A", 1, "x")))


def test_entities(spark, rows):
    body = [about(), [
        {"id": "AAA", "name": "A", "region": {"id": "r", "value": "Aggregates"}, "incomeLevel": {"id": "x", "value": "agg"}},
        {"id": "BBB", "name": "B", "region": None, "incomeLevel": None},
        {"id": "CCC", "name": "C", "region": {"id": "r", "value": "Asia"}}]]
    assert rows(P.read_entities(frame(spark, ("e", 1, body)))) == [
        ("AAA", "A", "Aggregates", "agg", "agregat"),
        ("BBB", "B", None, None, "pays_ou_territoire"),
        ("CCC", "C", "Asia", None, "pays_ou_territoire")]


def test_landing_folder(spark, tmp_path):
    folder = tmp_path / "code=A.B" / "page=2"
    folder.mkdir(parents=True)
    (folder / "f.json").write_text(json.dumps([about(2), [ROW]], indent=1))
    got = P.read_landing(spark, str(tmp_path)).first()
    assert (got["code"], got["page"]) == ("A.B", 2) and json.loads(got["body"])[0]["page"] == 2


def test_an_empty_page_is_usable(spark):
    parsed = P.parse_pages(frame(spark, ("A", 1, [about(total=0), []]))).first()
    assert parsed["is_valid"] is True and parsed["rows"] == []


def test_of_a_page_landed_twice_the_newest_counts(spark, tmp_path):
    folder = tmp_path / "code=A" / "page=1"
    folder.mkdir(parents=True)
    for name, total, changed in (("a", 1, 2_000_000_000), ("b", 2, 1_000_000_000), ("c", 3, 1_500_000_000)):
        (folder / name).write_text(json.dumps([about(total=total), [ROW] * total]))
        os.utime(folder / name, (changed, changed))
    parsed = P.parse_pages(P.read_landing(spark, str(tmp_path)))
    assert [r["announced"] for r in parsed.collect()] == [1] and P.explode_rows(parsed).count() == 1


def test_many_page_folders_are_listed_by_few_tasks(spark, tmp_path):
    """Folders and not cores decided on the number of listing tasks; starting them took most of the time."""
    from pyspark.sql import functions as F

    landed = spark.range(90).select(F.lit("[{},[]]").alias("body"), F.lit("A").alias("code"), F.col("id").cast("int").alias("page"))
    landed.repartition("page").write.partitionBy("code", "page").text(str(tmp_path / "landing"))
    limit = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    had, cores, sc = spark.conf.get(limit, None), spark.sparkContext.defaultParallelism, spark.sparkContext
    spark.conf.unset(limit)
    try:
        sc.setJobGroup("listing", "folders")
        pages = P.read_landing(spark, str(tmp_path / "landing"))
        P.stream_landing(spark, str(tmp_path / "landing"))
        sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        tasks = [tracker.getStageInfo(s).numTasks for s in stages]
        assert tasks and max(tasks) <= 4 * cores
        assert pages.count() == 90
        spark.conf.set(limit, "7")
        P.read_landing(spark, str(tmp_path / "landing"))
        assert spark.conf.get(limit) == "7"      # what the session has set stays
    finally:
        spark.conf.unset(limit)
        if had is not None:
            spark.conf.set(limit, had)
