"""One registered query per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import blank_to_null, outcome, safe_divide, safe_float, safe_int
from ..operators import evaluate, features, forest, gaps, ingest, ledger, profile, quality, reports, staging, star
from ..plans import ingest_job, model_jobs
from ..plans.warehouse import Settings, Warehouse
from ..schemas import OBSERVATION, RAW
from ..schemas import LEDGER
from ..schemas import feature_mart as feature_mart_schema
from ..session import scratch
from ..sources import pages, tables
from ..streaming import ingest_stream
from . import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FOREST = forest.Forest()


def query(f, name: str | None = None):
    QUERIES[name or f.__name__] = f
    return f


def named(name: str):
    """Register under a name that an import of this module already has."""
    return lambda f: query(f, name)


def _text(c: str) -> Column:
    """Timestamps compare as text, whatever the session time zone."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def _observation(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        F.col("indicator.id").alias("indicator_code"), F.col("indicator.value").alias("indicator_name"),
        F.col("country.id").alias("country_code"), F.col("country.value").alias("country_name"),
        "countryiso3code", "date", "value", "unit", "obs_status", "decimal", *more)


# --------------------------------------------------------------- sources, sinks

@query
def page_explode(spark, sf):
    """Landed pages give back the plain table."""
    return _observation(pages.explode_rows(pages.parse_pages(I.event_pages(spark, sf))))


@query
def completeness_check(spark, sf):
    """One event type announces seven rows more than it delivers."""
    landed = I.event_pages(spark, sf, surplus=F.when(F.col("code") == "error", 7).otherwise(0))
    return pages.completeness(pages.parse_pages(landed))


@query
def page_policy(spark, sf):
    """One type has an unusable first page, one an unusable second page."""
    landed = I.event_pages(spark, sf)
    first = (F.col("code") == "click") & (F.col("page") == 1)
    later = (F.col("code") == "view") & (F.col("page") == 2)
    broken = landed.withColumn("body", F.when(first, "no json").when(later, '{"a":1}').otherwise(F.col("body")))
    return pages.page_policy(pages.parse_pages(broken))


@query
def entity_metadata(spark, sf):
    return pages.read_entities(I.entity_pages(spark, sf))


@query
def ingest_append(spark, sf):
    """Every day's events appended as its own batch, read back."""
    path = scratch(spark, "append")
    tables.append_batch(I.raw_events(spark, sf), path)
    return _observation(tables.scan(spark, path, RAW), "row_hash", _text("inserted_at"), "batch_id")


@query
def rollback_batch(spark, sf):
    """Two batches appended, the second rolled back."""
    path = scratch(spark, "rollback")
    for name, part in zip(("first", "second"), I.two_batches(I.event_rows(spark, sf))):
        rows = part.select(*OBSERVATION.fieldNames(), F.col("event_id").cast("string").alias("row_hash"),
                           F.col("ts").cast("timestamp").alias("inserted_at"), F.lit(name).alias("batch_id"))
        tables.append_batch(rows, path)
    tables.rollback_batch(spark, path, "second")
    return tables.scan(spark, path, RAW).select(F.col("row_hash").alias("event_id"), "batch_id")


@query
def rollback_filter(spark, sf):
    """The same as a view: rows that survive without one day's batch."""
    return tables.without_batch(I.raw_events(spark, sf), "20240110").select("row_hash", "batch_id")


@query
def replace_table(spark, sf):
    """A stored table replaced by another one."""
    path = scratch(spark, "replace")
    metadata = pages.entity_metadata(I.entities(spark, sf))
    tables.replace_table(metadata.filter("type_entite = 'agregat'"), path)
    tables.replace_table(metadata, path)
    return tables.scan(spark, path, metadata.schema)


# ----------------------------------------------------------- incremental ingest

@query
def row_hash(spark, sf):
    events = I.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", I.cents("value").alias("cents"), "props")
    return ingest.with_row_hash(events).select("event_id", "row_hash")


@query
def recent_hashes(spark, sf):
    """Distinct hashes of the newest 4,000 rows."""
    return ingest.recent_hashes(I.copied_events(spark, sf), I.LOOKBACK)


@query
def ingest_new_rows(spark, sf):
    """Rows of the second delivery whose hash the first has not; copies stay."""
    first, second = I.two_batches(I.copied_events(spark, sf))
    return ingest.only_new(second, first.select("row_hash")).select("event_id", "row_hash")


@query
def stamp_batch(spark, sf):
    rows = I.table(spark, sf, "events").select("event_id")
    return ingest.stamp_batch(rows, F.lit(I.STAMP + "Z").cast("timestamp")).select(
        "event_id", "batch_id", F.unix_micros("inserted_at").alias("inserted_at"))


def _stamp(n: int) -> datetime:
    return datetime(2024, 2, 1) + timedelta(days=n)


@query
def ingest_two_batches(spark, sf):
    """The ingest job over two overlapping deliveries."""
    path = scratch(spark, "raw")
    for n, part in enumerate(I.two_batches(I.event_rows(spark, sf))):
        ingest_job.ingest(spark, part.select(*OBSERVATION.fieldNames()), path, _stamp(n))
    return _observation(tables.scan(spark, path, RAW), "batch_id")


@named("ingest_stream")
def ingest_stream_two_landings(spark, sf):
    """The same deliveries as landed files, each taken in by a run of the stream."""
    base = scratch(spark, "stream")
    for n, part in enumerate(I.two_batches(I.event_rows(spark, sf))):
        landed = I.event_pages(spark, sf, part)
        pages.land_bundles(landed, f"{base}/landing")
        ingest_stream(spark, f"{base}/landing", f"{base}/raw", f"{base}/checkpoint",
                      lambda epoch, n=n: _stamp(n)).awaitTermination()
    return _observation(tables.scan(spark, f"{base}/raw", RAW), "batch_id")


# ------------------------------------------- projections, filters, scalar functions

@query
def stage_clean(spark, sf):
    staged = staging.stage(I.raw_events(spark, sf), pages.entity_metadata(I.entities(spark, sf)))
    return staged.withColumn("inserted_at", _text("inserted_at"))


@named("blank_to_null")
def blank_to_null_text(spark, sf):
    padded = F.when(I._k() < 20, "  \t ").when(I._k() < 60, F.concat(F.lit(" \t"), "event_type", F.lit("  "))).otherwise(
        F.col("event_type"))
    return I.table(spark, sf, "events").select("event_id", blank_to_null(padded).alias("cleaned"))


@query
def safe_cast(spark, sf):
    rows = I.event_rows(spark, sf)
    return rows.select("event_id", safe_int("date").alias("as_int"), safe_float("date").alias("as_float"))


@query
def classify_entity(spark, sf):
    return _enriched(spark, sf).select("event_id", "type_entite")


def _enriched(spark, sf) -> DataFrame:
    rows = I.event_rows(spark, sf).withColumn("countryiso3code", blank_to_null("countryiso3code"))
    known = pages.entity_metadata(I.entities(spark, sf)).filter(~F.col("income_level").eqNullSafe(F.lit("HOUSEHOLD")))
    return staging.enrich(rows, known)


@query
def filter_entities(spark, sf):
    return star.entities_only(_enriched(spark, sf)).select("event_id", "countryiso3code")


@query
def enrich_left(spark, sf):
    return _enriched(spark, sf).select("event_id", "countryiso3code", "region", "income_level", "type_entite")


def _classed(spark, sf) -> DataFrame:
    return features.classify_by_period(I.yearly_totals(spark, sf), "total", I.YEARLY_BOUNDS)


@query
def period_filter(spark, sf):
    """Training span with a class, and everything to score."""
    classed = _classed(spark, sf)
    train = forest.labelled_between(classed, *I.YEARLY_SPLIT["train"])
    later = forest.to_score(classed, I.YEARLY_SCORE_FROM)
    return train.withColumn("part", F.lit("train")).unionByName(later.withColumn("part", F.lit("score")))


@query
def label_lookup(spark, sf):
    labels = {"1-URGENT": "Urgente", "2-HIGH": "Haute", "5-LOW": "Basse"}
    orders = I.table(spark, sf, "orders")
    return orders.select("o_orderkey", star.label("o_orderpriority", "o_orderpriority", labels).alias("label"))


@named("safe_divide")
def safe_divide_lines(spark, sf):
    lines = I.table(spark, sf, "lineitem")
    share = safe_divide(F.col("l_quantity").cast("bigint"), F.col("l_linenumber") - 1)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", share.alias("share"))


@query
def outcome_label(spark, sf):
    """Long documents are predicted good; documents without a label are pending."""
    documents, labels = I.table(spark, sf, "documents").select("doc_id", "n_chars"), I.table(spark, sf, "labels")
    rows = documents.join(labels, "doc_id", "left")
    predicted = F.when(F.col("n_chars") > 500, 1).otherwise(0)
    return rows.select("doc_id", outcome(F.col("quality"), predicted).alias("prediction_correcte"))


# ------------------------------------------------------------- versions, windows

@query
def latest_version(spark, sf):
    events = I.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("event_day"), "ts", I.cents("value").alias("cents"))
    current = ingest.latest_version(events, ["user_id", "event_type", "event_day"], ["ts", "event_id"])
    return current.select("event_id", "user_id", "event_type", F.date_format("event_day", "yyyy-MM-dd").alias("event_day"), "cents")


@query
def neighbors(spark, sf):
    return gaps.published_neighbours(I.gap_panel(spark, sf), I.GAP_PANEL)


@query
def entity_median(spark, sf):
    return gaps.series_median(I.gap_panel(spark, sf), I.GAP_PANEL)


@query
def interpolate(spark, sf):
    rows = I.gap_panel(spark, sf).filter(F.col("indicator_code").isin(*I.GAP_RULES.interpolate))
    return gaps.interpolate(rows, I.GAP_PANEL).select("entity_id", "period", "indicator_code", "value", "interpolated")


@query
def median_fill(spark, sf):
    rows = I.gap_panel(spark, sf).filter(F.col("indicator_code").isin(*I.GAP_RULES.median))
    return gaps.median_fill(rows, I.GAP_PANEL).select("entity_id", "period", "indicator_code", "median")


@query
def gap_treatment(spark, sf):
    """As in the warehouse, the panel is stored by indicator before it is treated."""
    panel = tables.stored(I.gap_panel(spark, sf), scratch(spark, "panel"), ["indicator_code"])
    return gaps.treat_gaps(panel, I.GAP_PANEL, I.GAP_RULES)


# ------------------------------------------------------------- dimensions, star

def _staged(spark, sf) -> DataFrame:
    return staging.stage(I.raw_events(spark, sf), pages.entity_metadata(I.entities(spark, sf)))


@query
def dim_entity(spark, sf):
    return star.dim_entity(_staged(spark, sf))


@query
def dim_period(spark, sf):
    return star.dim_period(_staged(spark, sf))


@query
def dim_indicator(spark, sf):
    return star.dim_indicator(_staged(spark, sf), {"click": "Clics", "view": "Vues"})


@query
def star_report(spark, sf):
    joined = star.star(*I.star_tables(spark, sf))
    return star.slice_star(joined, years=(1997 * 12, 1999 * 12 + 11), regions=["ASIA", "EUROPE"],
                           indicators=["1-URGENT", "3-MEDIUM"])


@query
def region_overview(spark, sf):
    joined = star.star(*I.star_tables(spark, sf)).withColumn("year", F.floor(F.col("annee") / 12))
    return reports.region_overview(joined, ["region", "year", "indicator_code"], "cents")


@query
def evolution(spark, sf):
    return reports.evolution(I.gap_panel(spark, sf), I.GAP_PANEL)


# ------------------------------------------------------------- features, classes

def _mart(spark, sf, first_period: int = 1995, dim=I.customer_dim) -> DataFrame:
    return features.feature_mart(
        I.yearly_fact(spark, sf), dim(spark, sf), I.YEARLY, I.YEARLY_FEATURES, I.YEARLY_TOTAL,
        I.YEARLY_BOUNDS, I.CLASSES, first_period)


@query
def pivot_features(spark, sf):
    return features.pivot_features(I.yearly_fact(spark, sf), I.YEARLY_FEATURES, ["countryiso3code", "annee"])


@query
def features_with_entity(spark, sf):
    wide = features.pivot_features(I.yearly_fact(spark, sf), {"total": I.YEARLY_TOTAL}, ["countryiso3code", "annee"])
    return features.with_entity(wide, I.known_customer_dim(spark, sf))


@query
def classify_by_year(spark, sf):
    return _classed(spark, sf)


@query
def feature_mart(spark, sf):
    return _mart(spark, sf, 1996, I.known_customer_dim)


@query
def factor_relation(spark, sf):
    wide = features.pivot_features(
        I.yearly_fact(spark, sf), {**I.YEARLY_FEATURES, "total": I.YEARLY_TOTAL}, ["countryiso3code", "annee"])
    return reports.factor_relation(wide, list(I.YEARLY_FEATURES), "total")


@query
def factor_by_class(spark, sf):
    counts = [f for f in I.YEARLY_FEATURES if f != "balance"]
    return reports.factor_by_class(_mart(spark, sf), counts, "income_level")


# ------------------------------------------------------------- profiles

@query
def value_counts(spark, sf):
    return profile.value_counts(_classed(spark, sf), "income_level")


@query
def missing_profile(spark, sf):
    return profile.missing_profile(_mart(spark, sf))


@query
def dataset_profile(spark, sf):
    return profile.dataset_profile(_mart(spark, sf), "annee")


# ------------------------------------------------------------- model

@query
def temporal_split(spark, sf):
    """Rows per split and class."""
    mart = _mart(spark, sf)
    # every row belongs to several splits, so it names them and is counted once
    split = F.filter(F.array(*[
        F.when(F.col("annee").between(*span) & F.col("income_level").isNotNull(), name)
        for name, span in I.YEARLY_SPLIT.items()],
        F.when(F.col("annee") >= I.YEARLY_SCORE_FROM, "score")), lambda s: s.isNotNull())
    return mart.select(F.explode(split).alias("split"), "income_level").groupBy("split", "income_level").agg(
        F.count("*").alias("n"))


def _train(spark, sf) -> DataFrame:
    return forest.labelled_between(_mart(spark, sf), *I.YEARLY_SPLIT["train"])


@query
def train_medians(spark, sf):
    return forest.feature_medians(_train(spark, sf), list(I.YEARLY_FEATURES))


@query
def class_weights(spark, sf):
    return evaluate.class_weights(_train(spark, sf), "income_level")


def _stored_mart(spark, sf) -> tuple[DataFrame, str]:
    path = scratch(spark, "mart")
    return tables.stored(_mart(spark, sf), path), path


@query
def rf_fit_predict(spark, sf):
    mart, _ = _stored_mart(spark, sf)
    train = forest.labelled_between(mart, *I.YEARLY_SPLIT["train"])
    model = forest.fit_forest(train, list(I.YEARLY_FEATURES), forest=FOREST)
    return forest.score(model, forest.to_score(mart, I.YEARLY_SCORE_FROM)).select(
        "countryiso3code", "annee", "income_level", "income_level_predit")


@query
def forest_certain(spark, sf):
    """Held-out predictions where every feature tells the class: each class has its own range of values."""
    mart, _ = _stored_mart(spark, sf)
    place = F.array_position(F.array(*[F.lit(c) for c in I.CLASSES]), F.col("income_level"))
    noise = lambda c: F.pmod(F.xxhash64("countryiso3code", "annee", F.lit(c)), F.lit(1000)) / 1000
    told = mart.filter(F.col("income_level").isNotNull()).withColumns(
        {c: (10 * place + noise(c)).cast("double") for c in I.YEARLY_FEATURES})
    told = tables.stored(told, scratch(spark, "told"))
    model = forest.fit_forest(forest.labelled_between(told, *I.YEARLY_SPLIT["train"]), list(I.YEARLY_FEATURES), forest=FOREST)
    return forest.score(model, forest.to_score(told, I.YEARLY_SCORE_FROM)).select(
        "countryiso3code", "annee", "income_level", "income_level_predit")


@query
def model_roundtrip(spark, sf):
    """A saved and loaded model predicts every row as the fitted one does."""
    mart, _ = _stored_mart(spark, sf)
    train = forest.labelled_between(mart, *I.YEARLY_SPLIT["train"])
    model = forest.fit_forest(train, list(I.YEARLY_FEATURES), forest=FOREST)
    path = scratch(spark, "model")
    forest.save_model(model, path)
    both = forest.score(forest.load_model(path), forest.score(model, mart, "fitted"), "loaded")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("fitted") == F.col("loaded")).alias("n_equal"),
                    F.count_if(F.col("loaded").isin(*I.CLASSES)).alias("n_classes_known"))


@query
def train_job(spark, sf):
    """The training job's ledger: every test row, a known class, the right outcome."""
    _, mart_path = _stored_mart(spark, sf)
    base = scratch(spark, "training")
    model_jobs.train(spark, mart_path, f"{base}/ledger", f"{base}/model", tuple(I.YEARLY_FEATURES),
                     I.YEARLY_SPLIT["train"], I.YEARLY_SPLIT["test"][0], I.YEARLY_SPLIT["final"], FOREST,
                     datetime(2024, 2, 1))
    rows = tables.scan(spark, f"{base}/ledger", LEDGER)
    return rows.select(
        "countryiso3code", "country_name", "region", "annee", "income_level", "type_prediction",
        F.col("income_level_predit").isin(*I.CLASSES).alias("class_known"),
        (F.col("prediction_correcte") == F.when(
            F.col("income_level") == F.col("income_level_predit"), "Juste").otherwise("Faux")).alias("outcome_right"),
        F.unix_micros("date_prediction").alias("date_prediction"))


@query
def prediction_ledger(spark, sf):
    """Fixed predictions: test rows stay, stale production rows are replaced."""
    mart = _mart(spark, sf)
    urgent = F.coalesce(F.col("n_urgent"), F.lit(0))
    by_rule = F.when(urgent == 0, I.CLASSES[0]).when(urgent == 1, I.CLASSES[1]).when(urgent == 2, I.CLASSES[2]).otherwise(
        I.CLASSES[3])
    predicted = mart.withColumn("income_level_predit", by_rule)

    def rows(part: DataFrame, run: str, stamp: str) -> DataFrame:
        return ledger.ledger_rows(part, run, F.lit(stamp))

    path = scratch(spark, "ledger")
    test = rows(forest.labelled_between(predicted, *I.YEARLY_SPLIT["test"]), R.RUN_TEST, "2024-02-01 00:00:00")
    stale = rows(predicted.filter("annee = 2000"), R.RUN_PRODUCTION, "2024-02-02 00:00:00")
    tables.replace_table(test.unionByName(stale), path, ["type_prediction"])
    new = rows(forest.to_score(predicted, I.YEARLY_SCORE_FROM), R.RUN_PRODUCTION, "2024-02-03 00:00:00")
    tables.replace_partitions(new, path, ["type_prediction"])
    return tables.scan(spark, path, LEDGER).withColumn("date_prediction", _text("date_prediction"))


@query
def ledger_renewal(spark, sf):
    """The same renewal as a view: kept test rows and new production rows."""
    mart = _mart(spark, sf).withColumn("income_level_predit", F.lit(I.CLASSES[1]))
    old = ledger.ledger_rows(forest.labelled_between(mart, *I.YEARLY_SPLIT["final"]), R.RUN_TEST, F.lit("2024-02-01"))
    stale = ledger.ledger_rows(forest.to_score(mart, 1998), R.RUN_PRODUCTION, F.lit("2024-02-02"))
    new = ledger.ledger_rows(forest.to_score(mart, I.YEARLY_SCORE_FROM), R.RUN_PRODUCTION, F.lit("2024-02-03"))
    return ledger.renew(old.unionByName(stale), new).withColumn("date_prediction", _text("date_prediction"))


@query
def predictions_by_entity(spark, sf):
    """Actual against predicted class of every customer over a ledger of fixed predictions."""
    mart = _mart(spark, sf)
    by_rule = F.when(F.col("n_urgent").isNull(), I.CLASSES[0]).when(F.col("n_urgent") == 1, I.CLASSES[1]).otherwise(I.CLASSES[2])
    predicted = mart.withColumn("income_level_predit", by_rule)
    test = ledger.ledger_rows(forest.labelled_between(predicted, *I.YEARLY_SPLIT["train"]), R.RUN_TEST, F.lit("2024-02-01"))
    new = ledger.ledger_rows(forest.to_score(predicted, I.YEARLY_SCORE_FROM), R.RUN_PRODUCTION, F.lit("2024-02-03"))
    return reports.predictions_by_entity(test.unionByName(new))


def _judged(spark, sf) -> DataFrame:
    return I.table(spark, sf, "labels").select(F.col("quality").alias("actual"), F.col("toxic").alias("predicted"))


@query
def accuracy(spark, sf):
    return evaluate.accuracy(_judged(spark, sf), "actual", "predicted")


@query
def classification_report(spark, sf):
    return evaluate.classification_report(_judged(spark, sf), "actual", "predicted")


@query
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_judged(spark, sf), "actual", "predicted", [0, 1])


# ------------------------------------------------------------- data quality

@query
def dq_not_null(spark, sf):
    return quality.not_null(staging.clean(I.raw_events(spark, sf)), "annee").select("row_hash", "indicator_code")


@query
def dq_unique(spark, sf):
    return quality.unique(I.table(spark, sf, "orders"), "o_custkey")


@query
def dq_accepted_values(spark, sf):
    return quality.accepted_values(_enriched(spark, sf), "type_entite", [R.ENTITY_COUNTRY, R.ENTITY_AGGREGATE])


@query
def dq_relationships(spark, sf):
    orders = I.table(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("countryiso3code"))
    return quality.relationships(orders, "countryiso3code", I.known_customer_dim(spark, sf))


@query
def dq_grain(spark, sf):
    events = I.table(spark, sf, "events").withColumn("event_day", F.date_format("ts", "yyyy-MM-dd"))
    return quality.grain(events, ["user_id", "event_type", "event_day"])


@query
def dq_suite(spark, sf):
    """All standard rules over a warehouse built from the events."""
    base = scratch(spark, "suite")
    known = pages.entity_metadata(I.entities(spark, sf)).filter(~F.col("income_level").eqNullSafe(F.lit("HOUSEHOLD")))
    built = {"raw": I.raw_events(spark, sf), "metadata": known}
    built["staging"] = tables.stored(staging.stage(built["raw"], known), f"{base}/staging", ["indicator_code"])
    built["dim_entity"] = tables.stored(star.dim_entity(built["staging"]), f"{base}/dim_entity")
    built["dim_period"] = tables.stored(star.dim_period(built["staging"]), f"{base}/dim_period")
    built["dim_indicator"] = tables.stored(
        star.dim_indicator(built["staging"], {"click": "Clics"}), f"{base}/dim_indicator")
    built["fact"] = tables.stored(gaps.build_fact(built["staging"], rules=EVENT_GAPS), f"{base}/fact", ["indicator_code"])
    return quality.run_suite(built)


# ------------------------------------------------------- facts, loads, stored tables

EVENT_GAPS = gaps.GapRules(interpolate=("click", "view"), median=("error",), rounded=("view",))
_FACT_COLUMNS = ["countryiso3code", "annee", "indicator_code", "valeur_originale", "valeur", "methode_traitement",
                 "est_imputee", "obs_status", "decimal_places"]


@query
def build_fact(spark, sf):
    """The published fact by value, from the stored staging table."""
    staged = tables.stored(_staged(spark, sf), scratch(spark, "staging"), ["indicator_code"])
    return gaps.build_fact(staged, rules=EVENT_GAPS).select(*_FACT_COLUMNS, _text("inserted_at"))


def _house(spark, sf) -> Warehouse:
    """A warehouse of event types; entities are the customers."""
    rules = Settings(labels={"click": "Clics"}, gaps=EVENT_GAPS, features={"clicks": "click", "views": "view"},
                     class_code="error", bounds={20240101: (1, 2, 3)}, first_period=0)
    house = Warehouse(spark, scratch(spark, "house"), rules)
    tables.replace_table(staging.one_per_entity(pages.entity_metadata(I.entities(spark, sf))), house.path("metadata"))
    return house


@query
def ingest_incremental(spark, sf):
    """The fact after three loads, each of which renews only the indicators it touches."""
    house = _house(spark, sf)
    last = ingest.latest_version(I.event_rows(spark, sf).withColumn("_day", F.to_date("ts")),
                                 ["user_id", "event_type", "_day"], ["ts", "event_id"])
    first, later = I.two_batches(last)
    loads = [first, later.filter("event_type <> 'view'"), later.filter("event_type = 'view'")]
    for n, part in enumerate(loads):
        done = ingest_job.ingest(spark, part.select(*OBSERVATION.fieldNames()), house.path("raw"), _stamp(n))
        house.refresh(done["batch_id"], metadata_changed=False)
    return house.table("fact").select(*_FACT_COLUMNS)


@query
def stream_broken_landing(spark, sf):
    """A landing with a missing, a broken and later repeated pages: the stream ends with every row once."""
    base = scratch(spark, "stream")
    landed = I.event_pages(spark, sf)
    code, page = F.col("code"), F.col("page")
    broken = landed.filter(~((code == "click") & (page == 2))).withColumn(
        "body", F.when((code == "view") & (page == 1), "[{").otherwise(F.col("body")))
    mended = landed.filter(((code == "click") & (page == 2)) | ((code == "view") & (page == 1)) | (code == "error"))
    for n, part in enumerate([broken, mended]):
        pages.land_bundles(part, f"{base}/landing")
        ingest_stream(spark, f"{base}/landing", f"{base}/raw", f"{base}/checkpoint",
                      lambda epoch, n=n: _stamp(n)).awaitTermination()
    return _observation(tables.scan(spark, f"{base}/raw", RAW))


@query
def registered_views(spark, sf):
    """SQL over the views of a warehouse's stored tables."""
    house = _house(spark, sf)
    house.register_views("before_")
    staged = tables.stored(_staged(spark, sf), house.path("staging"), ["indicator_code"])
    tables.replace_table(star.dim_entity(staged), house.path("dim_entity"))
    tables.replace_table(gaps.build_fact(staged, rules=EVENT_GAPS), house.path("fact"), ["indicator_code"])
    house.register_views("house_")
    return spark.sql("""
        SELECT e.region, f.indicator_code, f.methode_traitement, count(*) AS n,
               (SELECT count(*) FROM before_fact) AS n_before
        FROM house_fact f JOIN house_dim_entity e ON f.countryiso3code = e.countryiso3code
        GROUP BY e.region, f.indicator_code, f.methode_traitement""")


def _year_mart(spark, sf) -> str:
    path = scratch(spark, "mart")
    tables.replace_table(_mart(spark, sf), path, ["annee"], ["countryiso3code"])
    return path


@query
def dataset(spark, sf):
    """The stored mart in reading order."""
    return model_jobs.dataset(spark, _year_mart(spark, sf), tuple(I.YEARLY_FEATURES)).withColumn(
        "annee", F.col("annee").cast("bigint"))


@query
def empty_scoring(spark, sf):
    """A scoring run without rows to score leaves the ledger as it is."""
    mart, path = _year_mart(spark, sf), scratch(spark, "ledger")
    rows = tables.scan(spark, mart, feature_mart_schema(list(I.YEARLY_FEATURES)))
    judged = rows.withColumn("income_level_predit", F.col("income_level"))
    tables.replace_table(ledger.ledger_rows(judged, R.RUN_TEST, F.lit("2024-02-01 00:00:00")), path, ["type_prediction"])
    scored = model_jobs.predict(spark, mart, path, f"{path}-no-model", tuple(I.YEARLY_FEATURES), 9999)
    return tables.scan(spark, path, LEDGER).select(
        "countryiso3code", F.col("annee").cast("bigint").alias("annee"), "income_level", "prediction_correcte", F.lit(scored).alias("scored"))
