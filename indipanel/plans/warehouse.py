"""The whole path: landed pages to staging, star schema, mart, checks, predictions."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..operators import quality
from ..operators.features import feature_mart as build_mart
from ..operators.gaps import build_fact
from ..operators.staging import stage
from ..operators.star import dim_entity, dim_indicator, dim_period, star
from ..rules import GapRules
from ..schemas import (
    DIM_ENTITY, DIM_INDICATOR, DIM_PERIOD, ENTITY, FACT, METADATA, RAW, STAGING, feature_mart)
from ..session import scratch
from ..sources.pages import completeness, parse_pages, read_landing
from ..sources.tables import commits, drop, exists, replace_partitions, replace_table, scan
from .ingest_job import accepted_rows, ingest, replace_metadata
from .model_jobs import predict


@dataclass(frozen=True)
class Settings:
    """Rules of one warehouse; the defaults are the standard configuration."""

    labels: dict = field(default_factory=lambda: R.INDICATOR_LABELS)
    gaps: GapRules = GapRules()
    features: dict = field(default_factory=lambda: R.FEATURE_CODES)
    class_code: str = R.CLASS_SOURCE_CODE
    bounds: dict = field(default_factory=lambda: R.INCOME_BOUNDS)
    classes: tuple = R.INCOME_CLASSES
    first_period: int = R.FIRST_FEATURE_YEAR
    score_from: int = R.SCORE_FROM_YEAR


class Warehouse:
    """Stored tables below one folder."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings = Settings()):
        self.spark, self.settings = spark, settings
        self.base = path.rstrip("/")
        self.schemas = {
            "raw": RAW, "metadata": METADATA, "staging": STAGING, "dim_entity": DIM_ENTITY,
            "dim_period": DIM_PERIOD, "dim_indicator": DIM_INDICATOR, "fact": FACT,
            "mart": feature_mart(settings.features)}

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, self.path(name), self.schemas[name])

    def _replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None, sort_by: list[str] = (),
                 only_its_partitions: bool = False) -> None:
        df = df.select(*self.schemas[name].fieldNames())
        if only_its_partitions:
            replace_partitions(df, self.path(name), partition_by)
        else:
            replace_table(df, self.path(name), partition_by, sort_by)

    def build(self, touched: list[str | None] | None = None) -> None:
        """All models from the raw table. Each is stored before the next one reads it.

        Staging and fact are partitioned by indicator: gap rules and reports that
        name indicators then read only their folders. The mart is partitioned by year and in
        the order of entities.

        touched  indicators with new observations, if nothing else has changed: only their partitions of
                 staging and fact are written, the mart only if one of them is a feature or decides the class
        """
        s, partly = self.settings, touched is not None
        raw = self.table("raw")
        if partly:
            raw = raw.filter(self._among("indicator.id", touched))
        self._replace("staging", stage(raw, self.table("metadata")), ["indicator_code"], only_its_partitions=partly)
        staging = self.table("staging")
        self._replace("dim_entity", dim_entity(staging))
        self._replace("dim_period", dim_period(staging))
        self._replace("dim_indicator", dim_indicator(staging, s.labels))
        changed = staging.filter(self._among("indicator_code", touched)) if partly else staging
        self._replace("fact", build_fact(changed, rules=s.gaps), ["indicator_code"], only_its_partitions=partly)
        if not partly or {*s.features.values(), s.class_code} & set(touched):
            self._replace("mart", build_mart(
                self.table("fact"), self.table("dim_entity"), features=s.features, class_code=s.class_code,
                bounds=s.bounds, classes=s.classes, first_period=s.first_period), ["annee"], ["countryiso3code"])

    @staticmethod
    def _among(column: str, codes: list[str | None]) -> Column:
        named = F.col(column).isin([c for c in codes if c is not None])
        return F.coalesce(named, F.lit(False)) | (F.col(column).isNull() if None in codes else F.lit(False))

    def refresh(self, batch_id: str, metadata_changed: bool) -> list[str | None] | None:
        """Bring the models up to date after a load; the indicators it touched, or None if all was built."""
        if metadata_changed or not commits(self.spark, self.path("mart")):
            self.build()
            return None
        batch = self.table("raw").filter(F.col("batch_id") == batch_id)
        touched = [r[0] for r in batch.select("indicator.id").distinct().collect()]
        if touched:
            self.build(touched)
        return touched

    def register_views(self, prefix: str = "") -> None:
        """Every stored table as a temporary view, for SQL users."""
        for name in self.schemas:
            self.table(name).createOrReplaceTempView(prefix + name)

    def star(self) -> DataFrame:
        return star(*[self.table(t) for t in ("fact", "dim_entity", "dim_period", "dim_indicator")])

    def check(self) -> DataFrame:
        return quality.run_suite({t: self.table(t) for t in quality.STANDARD_RULES})

    def run(self, observations: str, entities: str, stamp: datetime | None = None,
            lookback: int | None = None) -> dict:
        """Daily run over two landing folders: ingest, build what the load touches, check, predict.

        As in a scheduled run, a model is used when one is stored but never trained.
        """
        spark, workspace = self.spark, scratch(self.spark, "run")
        entity_pages = read_landing(spark, entities)
        try:
            rows, notes = accepted_rows(spark, read_landing(spark, observations), workspace)
            changed = replace_metadata(spark, entity_pages, self.path("metadata"))
            counts = ingest(spark, rows, self.path("raw"), stamp, lookback)
        finally:
            drop(spark, workspace)
        short = completeness(parse_pages(entity_pages, ENTITY)).filter("not complete")
        notes["entities_complete"] = short.isEmpty()
        self.refresh(counts["batch_id"], changed)
        failed = self.check().filter("status = 'fail'").count()
        predicted = 0
        if exists(self.spark, self.path("model")):
            predicted = predict(self.spark, self.path("mart"), self.path("ledger"), self.path("model"),
                                tuple(self.settings.features), self.settings.score_from, stamp)
        return {**counts, **notes, "failed_rules": failed, "predicted": predicted}
