"""Index of the row hashes of a raw table, in folders by indicator and year.

A load needs the stored hashes of the rows it may repeat, and equal rows have the same indicator and
date. So it reads only the folders that its batch touches, 32 bytes a row, however long the history is.
A batch is in the index when its mark is there; batches without one, as after a crash between the two
writes, are indexed before the next load, and what is marked but no longer stored does not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW
from .tables import _children, _folder, scan

INDEX = T.StructType([T.StructField("hash", T.BinaryType()), T.StructField("of_batch", T.StringType()),
                      T.StructField("code", T.StringType()), T.StructField("year", T.StringType())])


def index_path(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_hashes"


def _place(name: str):
    """The folder of an observation; all that is unreadable shares one."""
    column = {"code": F.trim("indicator.id"), "year": F.regexp_extract("date", r"^\s*([0-9]{4})", 1)}[name]
    return F.coalesce(F.nullif(column, F.lit("")), F.lit("none")).alias(name)


def _stored_batches(spark: SparkSession, raw_path: str) -> set[str]:
    return {c.split("=", 1)[1] for c in _children(spark, raw_path) if c.startswith("batch_id=")}


def _marked(spark: SparkSession, raw_path: str) -> set[str]:
    return {c for c in _children(spark, f"{index_path(raw_path)}/_indexed") if not c.startswith(".")}


def index_batches(spark: SparkSession, raw_path: str) -> list[str]:
    """Bring the index up to date; gives the batches it took in. Taking one in again changes nothing."""
    missing = sorted(_stored_batches(spark, raw_path) - _marked(spark, raw_path))
    if missing:
        rows = scan(spark, raw_path, RAW).filter(F.col("batch_id").isin(missing) & F.col("row_hash").isNotNull())
        entries = rows.select(F.unhex("row_hash").alias("hash"), F.col("batch_id").alias("of_batch"), _place("code"), _place("year"))
        entries.hint("rebalance", F.col("code"), F.col("year")).write.partitionBy("code", "year").mode("append").parquet(
            index_path(raw_path))
        for batch in missing:
            fs, mark = _folder(spark, f"{index_path(raw_path)}/_indexed/{batch}")
            fs.create(mark, True).close()
    return missing


def known_hashes(spark: SparkSession, raw_path: str, batch: DataFrame) -> DataFrame:
    """(row_hash) of the stored rows in the folders that the batch touches; copies are possible."""
    index_batches(spark, raw_path)
    gone = sorted(_marked(spark, raw_path) - _stored_batches(spark, raw_path))
    # one row per folder, as many as the driver lists anyway; the comparison makes Spark prune folders by the join
    touched = batch.select(_place("code"), _place("year")).filter(F.col("year") > "").distinct()
    entries = scan(spark, index_path(raw_path), INDEX).filter(~F.col("of_batch").isin(gone))
    return entries.join(F.broadcast(touched), ["code", "year"], "left_semi").select(F.lower(F.hex("hash")).alias("row_hash"))
