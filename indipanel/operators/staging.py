"""Cleaning, typing, versioning and enrichment of the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, entity_type, safe_float, safe_int
from ..schemas import METADATA, STAGING
from .ingest import latest_version

VERSION_KEYS = ["country_name", "annee", "indicator_code"]


def clean(raw: DataFrame) -> DataFrame:
    """Flat, trimmed and typed columns; unreadable numbers become NULL."""
    return raw.select(
        F.col("indicator.id").alias("indicator_code"),
        F.col("indicator.value").alias("indicator_name"),
        F.col("country.id").alias("country_code"),
        F.col("country.value").alias("country_name"),
        blank_to_null("countryiso3code").alias("countryiso3code"),
        safe_int("date").alias("annee"),
        safe_float("value").alias("valeur"),
        blank_to_null("unit").alias("unit"),
        blank_to_null("obs_status").alias("obs_status"),
        safe_int("decimal").alias("decimal_places"),
        "row_hash", "inserted_at",
    )


def one_per_entity(metadata: DataFrame) -> DataFrame:
    """Metadata with one row per code, so that enrichment can never multiply rows."""
    rest = [c for c in METADATA.fieldNames() if c != "countryiso3code"]
    return (metadata.filter(F.col("countryiso3code").isNotNull())
            .groupBy("countryiso3code").agg(F.min(F.struct(*rest)).alias("_m"))
            .select("countryiso3code", "_m.*"))


def enrich(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add region, income level and entity type by entity code.

    No hint: Spark broadcasts the metadata while it is below its size threshold
    and otherwise joins by shuffle, splitting hot codes.
    """
    known = metadata.select("countryiso3code", "region", "income_level", F.col("type_entite").alias("_type"))
    return rows.join(known, "countryiso3code", "left").withColumn(
        "type_entite", entity_type("_type", "countryiso3code")).drop("_type")


def stage(raw: DataFrame, metadata: DataFrame, version_keys: list[str] = VERSION_KEYS) -> DataFrame:
    """Current version of every observation, cleaned and enriched.

    ``metadata`` holds one row per code (see one_per_entity). Versions can then be
    settled before the join: the result is the same and the join sees fewer rows.
    """
    readable = clean(raw).filter(F.col("annee").isNotNull())
    current = latest_version(readable, version_keys, ["inserted_at", "row_hash"])
    return enrich(current, metadata).select(*STAGING.fieldNames())
