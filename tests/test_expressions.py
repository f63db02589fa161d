import hashlib
import json

from pyspark.sql import functions as F

from indipanel.functions import (
    blank_to_null, classify, content_hash, dictionary, entity_type, outcome, safe_divide, safe_float, safe_int)
from indipanel.rules import INCOME_CLASSES
from indipanel.schemas import OBSERVATION


def one(spark, expr, schema, *values):
    return [r[0] for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
            .select(expr).collect()]


def test_blank_to_null_strips_every_white_space(spark):
    got = one(spark, blank_to_null("t"), "t string", "  ", "\t", "", " a b\t", "x", None, " y ")
    assert got == [None, None, None, "a b", "x", None, "y"]


def test_safe_casts_give_null_for_unreadable_text(spark):
    assert one(spark, safe_int("t"), "t string", "2020", "2020.5", "x", "", None) == [2020, None, None, None, None]
    assert one(spark, safe_float("t"), "t string", "2020.5", "x", "", "-1e3") == [2020.5, None, None, -1000.0]


def test_safe_divide(spark):
    assert one(spark, safe_divide("a", "b"), "a int, b int", (1, 2), (1, 0), (0, 0), (None, 1)) == [0.5, None, None, None]


def test_entity_type_ladder(spark):
    got = one(spark, entity_type("k", "c"), "k string, c string", ("agregat", "AAA"), (None, None), (None, "AAA"))
    assert got == ["agregat", "agregat", "inconnu"]


def test_dictionary_has_no_entry_for_other_codes(spark):
    assert one(spark, dictionary("c", {"a": "A"}), "c string", "a", "b", None) == ["A", None, None]


def test_class_bounds_are_inclusive(spark):
    bounds = [F.lit(10.0), F.lit(20.0), F.lit(30.0)]
    got = one(spark, classify("v", bounds, INCOME_CLASSES), "v double", 10.0, 10.5, 20.0, 30.0, 30.01, None)
    assert got == [INCOME_CLASSES[0], INCOME_CLASSES[1], INCOME_CLASSES[1], INCOME_CLASSES[2], INCOME_CLASSES[3], None]
    assert one(spark, classify("v", [F.lit(None).cast("double")] * 3, INCOME_CLASSES), "v double", 1.0) == [None]


def test_outcome(spark):
    got = one(spark, outcome("a", "p"), "a string, p string", (None, "x"), ("x", "x"), ("y", "x"))
    assert got == ["En attente", "Juste", "Faux"]


def test_content_hash_is_sorted_json_and_ignores_load_columns(spark):
    row = {"indicator": {"id": "A.B", "value": "été"}, "country": {"id": "x", "value": None}, "countryiso3code": "XXX",
           "date": "2020", "value": 1.5, "unit": "", "obs_status": None, "decimal": 0}
    df = spark.createDataFrame([row], OBSERVATION)
    text = json.dumps(row, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    want = hashlib.sha256(text.encode()).hexdigest()
    assert df.select(content_hash(OBSERVATION)).first()[0] == want
    stamped = df.withColumn("batch_id", F.lit("b"))
    assert stamped.select(content_hash(stamped.schema, OBSERVATION.fieldNames())).first()[0] == want


def test_content_hash_of_missing_struct(spark):
    df = spark.createDataFrame([(None, None, "a", None, None, None, None, None)], OBSERVATION)
    assert len(df.select(content_hash(OBSERVATION)).first()[0]) == 64
