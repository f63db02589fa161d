"""Forest, jobs, stream and the whole warehouse on hand-made data."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from indipanel import rules as R
from indipanel.__main__ import main
from indipanel.operators import forest
from indipanel.operators.forest import Forest
from indipanel.plans import model_jobs
from indipanel.plans.ingest_job import ingest
from indipanel.plans.warehouse import Warehouse
from indipanel.schemas import LEDGER, RAW, feature_mart
from indipanel.sources import tables
from indipanel.sources.pages import explode_rows, parse_pages, read_landing
from indipanel.streaming import ingest_stream

SMALL = Forest(trees=10, depth=5)


def land(folder, code, page, rows, pages=1, total=None):
    where = folder / f"code={code}" / f"page={page}"
    where.mkdir(parents=True, exist_ok=True)
    about = {"page": page, "pages": pages, "total": len(rows) if total is None else total}
    (where / f"{len(list(where.iterdir()))}.json").write_text(json.dumps([about, rows]))


def obs(code, name, iso, year, value):
    return {"indicator": {"id": code, "value": code.lower()}, "country": {"id": iso[:2], "value": name}, "countryiso3code": iso,
            "date": str(year), "value": value, "unit": "", "obs_status": "", "decimal": 0}


def leftovers(spark, kind):
    import glob
    return glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/{kind}-*")


def separable_mart(spark, features, years=range(2015, 2026), per_class=25):
    """Every class has its own range of the first feature; some features are missing."""
    rnd = random.Random(5)
    rows = []
    for n, name in enumerate(R.INCOME_CLASSES):
        for i in range(per_class):
            for y in years:
                values = [10.0 * n + rnd.random()] + [rnd.random() if rnd.random() < 0.9 else None for _ in features[2:]] + [None]
                rows.append((f"{n}{i}", f"E{n}{i}", "r", y, *values, name if y < 2025 else None))
    return spark.createDataFrame(rows, feature_mart(features))


def test_forest_learns_what_is_learnable_and_survives_saving(spark, tmp_path):
    features = list(R.FEATURE_NAMES)
    mart = separable_mart(spark, features).cache()
    train = forest.labelled_between(mart, *R.TRAIN_YEARS)
    model = forest.fit_forest(train, features, forest=SMALL)
    assert "_in_" + features[-1] not in model.stages[0].getStatement()      # never any value: no median, no input
    scored = forest.score(model, forest.to_score(mart))
    assert scored.filter(F.col("income_level").isNull()).count() == 100      # unlabelled rows are scored too
    known = scored.filter(F.col("income_level").isNotNull())
    assert known.filter("income_level = income_level_predit").count() / known.count() > 0.95
    forest.save_model(model, str(tmp_path / "m"))
    before = scored.withColumnRenamed("income_level_predit", "before")
    again = forest.score(forest.load_model(str(tmp_path / "m")), before)
    assert again.count() == 300 and again.filter("before <> income_level_predit").isEmpty()
    mart.unpersist()


def test_training_and_scoring_jobs(spark, tmp_path):
    features = list(R.FEATURE_NAMES)
    mart, ledger, model = (str(tmp_path / n) for n in ("mart", "ledger", "model"))
    tables.replace_table(separable_mart(spark, features, per_class=8), mart)

    def rows_per_run():
        return {r["type_prediction"]: r["count"] for r in tables.scan(spark, ledger, LEDGER).groupBy("type_prediction").count().collect()}

    scores = model_jobs.train(spark, mart, ledger, model, forest=SMALL, stamp=datetime(2024, 1, 1),
                              evaluation_path=str(tmp_path / "evaluated"))
    assert rows_per_run() == {"Test": 32}
    assert scores["accuracy"].first()["accuracy"] > 0.95
    assert scores["confusion"].count() == 4 and scores["report"].count() == 7
    assert forest.load_model(str(tmp_path / "evaluated")).stages

    assert model_jobs.predict(spark, mart, ledger, model, stamp=datetime(2024, 1, 2)) == 96
    assert model_jobs.predict(spark, mart, ledger, model, stamp=datetime(2024, 1, 3)) == 96
    assert rows_per_run() == {"Test": 32, "Production": 96}
    stored = tables.scan(spark, ledger, LEDGER)
    assert {r[0] for r in stored.filter("type_prediction = 'Production'").select("date_prediction").distinct().collect()} == {datetime(2024, 1, 3)}
    assert stored.filter("prediction_correcte = 'En attente'").count() == 32     # 2025 has no class

    assert model_jobs.predict(spark, mart, ledger, model, score_from=2030) == 0   # nothing to score: untouched
    assert rows_per_run() == {"Test": 32, "Production": 96}

    model_jobs.train(spark, mart, ledger, model, forest=SMALL, reset=False)
    assert rows_per_run() == {"Test": 32, "Production": 96}
    model_jobs.train(spark, mart, ledger, model, forest=SMALL)
    assert rows_per_run() == {"Test": 32}


def test_command_line(spark, tmp_path, landed, capsys):
    base = str(tmp_path / "cli")
    main(["run", base, *landed], spark)
    main(["train", base, "--trees", "5", "--depth", "4"], spark)
    main(["predict", base], spark)
    main(["check", base], spark)
    out = capsys.readouterr().out
    assert "inserted: 960" in out and "accuracy" in out and "predicted: 6" in out and "relationships" in out


def test_stream_equals_batch(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    land(landing, "A", 1, [obs("A", "X", "XXX", 2000 + i, float(i)) for i in range(5)], pages=2, total=8)
    land(landing, "A", 2, [obs("A", "Y", "YYY", 2000 + i, float(i)) for i in range(3)], pages=2, total=8)
    streamed, batched, checkpoint = (str(tmp_path / n) for n in ("streamed", "batched", "checkpoint"))

    def take():
        ingest_stream(spark, str(landing), streamed, checkpoint).awaitTermination()
        ingest(spark, explode_rows(parse_pages(read_landing(spark, str(landing)))), batched)

    def content(path):
        return rows(tables.scan(spark, path, RAW), "indicator.id", "country.value", "date", "value", "row_hash")

    take()
    assert content(streamed) == content(batched) and len(content(streamed)) == 8
    take()                                                              # nothing new landed
    assert len(content(streamed)) == 8
    land(landing, "A", 2, [obs("A", "Y", "YYY", 2000, 0.0), obs("A", "Y", "YYY", 2001, 7.0)], pages=2)
    take()                                                              # one known row, one revision
    assert content(streamed) == content(batched) and len(content(streamed)) == 9


@pytest.fixture
def landed(tmp_path):
    """Three countries and an aggregate, with gaps for each rule."""
    observations, entities = tmp_path / "observations", tmp_path / "entities"
    names = {"AAA": "Aland", "BBB": "Borduria", "CCC": "Cagli", "WLD": "World"}
    for label, code in {v: k for k, v in R.INDICATOR_LABELS.items()}.items():
        if label == "Chomage":
            continue                                                    # never landed
        land(observations, code, 1, [
            obs(code, name, iso, y, None if (y + n + len(code)) % 4 == 0 else 1000.0 * (n + 1) + y - 2000 + len(code))
            for n, (iso, name) in enumerate(names.items()) for y in range(2010, 2025)])
    where = entities / "code=entities" / "page=1"
    where.mkdir(parents=True)
    (where / "0.json").write_text(json.dumps([{"page": 1, "pages": 1, "total": 4}, [
        {"id": iso, "name": name, "region": {"id": "x", "value": "Aggregates" if iso == "WLD" else "Syldavia"},
         "incomeLevel": {"id": "y", "value": "High income"}} for iso, name in names.items()]]))
    return str(observations), str(entities)


def test_warehouse_end_to_end(spark, tmp_path, landed):
    house = Warehouse(spark, str(tmp_path / "house"))
    first = house.run(*landed, stamp=datetime(2024, 1, 1))
    assert (first["inserted"], first["failed_rules"], first["predicted"]) == (16 * 4 * 15, 0, 0)
    assert first["skipped"] == [] and first["incomplete"] == [] and first["entities_complete"]
    assert house.table("staging").count() == 960 and house.table("fact").count() == 720
    assert house.table("dim_entity").count() == 3 and house.table("dim_period").count() == 15
    assert house.table("mart").count() == 3 * 10
    methods = {r[0]: r[1] for r in house.table("fact").groupBy("methode_traitement").count().collect()}
    assert set(methods) == set(R.METHODS)
    assert house.table("fact").filter(
        "indicator_code = 'SP.POP.TOTL' and est_imputee and valeur <> round(valeur)").isEmpty()
    assert house.star().count() == 720
    house.register_views("wh_")
    assert spark.sql("SELECT count(*) FROM wh_fact JOIN wh_dim_period USING (annee)").first()[0] == 720
    assert house.check().filter("status = 'pass'").count() == 32

    assert leftovers(spark, "run") == []                                 # the work folders are gone
    second = house.run(*landed, stamp=datetime(2024, 1, 2))
    assert second["inserted"] == 0 and house.table("fact").count() == 720

    model_jobs.train(spark, house.path("mart"), house.path("ledger"), house.path("model"), forest=SMALL)
    shown = model_jobs.describe(spark, house.path("mart"))
    assert shown["profile"].first()["n_rows"] == 30 and shown["columns"].count() == 12
    assert shown["missing"].count() == 12 and shown["classes"].count() >= 1
    ordered = [(r["countryiso3code"], r["annee"]) for r in model_jobs.dataset(spark, house.path("mart")).collect()]
    assert ordered == sorted(ordered)
    third = house.run(*landed, stamp=datetime(2024, 1, 3))
    assert third["predicted"] == 3 * 2                                   # 2023 and 2024
