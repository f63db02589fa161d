"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

_CODE_AND_NAME = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("value", T.StringType()),
])

# one observation as the source publishes it
OBSERVATION = T.StructType([
    T.StructField("indicator", _CODE_AND_NAME),
    T.StructField("country", _CODE_AND_NAME),
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("obs_status", T.StringType()),
    T.StructField("decimal", T.LongType()),
])

# one entity as the source publishes it
ENTITY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("region", _CODE_AND_NAME),
    T.StructField("incomeLevel", _CODE_AND_NAME),
])

RAW = T.StructType(OBSERVATION.fields + [
    T.StructField("row_hash", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("income_level", T.StringType()),
    T.StructField("type_entite", T.StringType()),
])

STAGING = T.StructType([
    T.StructField("indicator_code", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("income_level", T.StringType()),
    T.StructField("type_entite", T.StringType()),
    T.StructField("annee", T.LongType()),
    T.StructField("valeur", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("obs_status", T.StringType()),
    T.StructField("decimal_places", T.LongType()),
    T.StructField("row_hash", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
])

DIM_ENTITY = T.StructType([
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("income_level", T.StringType()),
])

DIM_PERIOD = T.StructType([T.StructField("annee", T.LongType())])

DIM_INDICATOR = T.StructType([
    T.StructField("indicator_code", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("indicator_label_fr", T.StringType()),
    T.StructField("unit", T.StringType()),
])

FACT = T.StructType([
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("annee", T.LongType()),
    T.StructField("indicator_code", T.StringType()),
    T.StructField("valeur_originale", T.DoubleType()),
    T.StructField("valeur", T.DoubleType()),
    T.StructField("methode_traitement", T.StringType()),
    T.StructField("est_imputee", T.BooleanType()),
    T.StructField("obs_status", T.StringType()),
    T.StructField("decimal_places", T.LongType()),
    T.StructField("inserted_at", T.TimestampType()),
])

LEDGER = T.StructType([
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("annee", T.LongType()),
    T.StructField("income_level", T.StringType()),
    T.StructField("income_level_predit", T.StringType()),
    T.StructField("type_prediction", T.StringType()),
    T.StructField("prediction_correcte", T.StringType()),
    T.StructField("date_prediction", T.TimestampType()),
])


def feature_mart(features) -> T.StructType:
    return T.StructType(
        [T.StructField("countryiso3code", T.StringType()),
         T.StructField("country_name", T.StringType()),
         T.StructField("region", T.StringType()),
         T.StructField("annee", T.LongType())]
        + [T.StructField(name, T.DoubleType()) for name in features]
        + [T.StructField("income_level", T.StringType())]
    )
