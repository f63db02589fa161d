"""Incremental ingest: hash the rows, keep the unseen ones, stamp the batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import content_hash
from .ranks import newest_hashes

# Copies of one hash in a batch from which on its rows are kept out of the shuffle.
HOT_COPIES = 1_000_000

# Rows of a batch up to which its hashes are broadcast, about 100 bytes each.
SMALL_BATCH = 1_000_000


def with_row_hash(rows: DataFrame, columns: list[str] | None = None, name: str = "row_hash") -> DataFrame:
    return rows.withColumn(name, content_hash(rows.schema, columns))


def recent_hashes(table: DataFrame, lookback: int | None = None) -> DataFrame:
    """Set of stored hashes; ``lookback`` limits it to those of the newest rows."""
    if lookback is not None:
        return newest_hashes(table, lookback)
    return table.filter(F.col("row_hash").isNotNull()).select("row_hash").distinct()


def latest_hashes(table: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes of the current version per key, for ``compare_to='latest'`` ingest."""
    newest = F.max(F.struct("inserted_at", "row_hash")).getField("row_hash")
    return table.groupBy(*keys).agg(newest.alias("row_hash")).select("row_hash")


def only_new(batch: DataFrame, seen: DataFrame, hash_col: str = "row_hash",
             hot_copies: int = HOT_COPIES, batch_rows: int | None = None) -> DataFrame:
    """Rows of the batch whose hash is not known yet. ``seen`` need not be distinct.

    The known set does not grow inside a batch: copies within it all stay, and one
    hash may make up much of a batch or of the table. So both sides are first
    reduced to counts per hash, combined before the shuffle. Hashes with at least
    ``hot_copies`` copies, at most (batch rows / hot_copies) of them, are decided by
    a broadcast join and never shuffled as rows; the rest is a shuffle join in which
    no hash has more copies than that.

    batch_rows  row count of the batch, where the caller knows it. A small batch is
                broadcast to the stored hashes, so that of a long history only the
                hashes of the batch are shuffled.
    """
    if batch_rows is not None and batch_rows <= SMALL_BATCH:
        seen = seen.join(F.broadcast(batch.select(hash_col).distinct()), hash_col, "left_semi")
    tagged = batch.select(hash_col, F.lit(1).alias("_copy")).unionByName(
        seen.select(hash_col, F.lit(0).alias("_copy")))
    tally = tagged.groupBy(hash_col).agg(
        F.sum("_copy").alias("_copies"), (F.min("_copy") == 0).alias("_known"))
    hot = tally.filter(F.col("_copies") >= hot_copies)
    fresh = tally.filter((F.col("_copies") > 0) & (F.col("_copies") < hot_copies) & ~F.col("_known"))

    hot_new = batch.join(F.broadcast(hot.filter(~F.col("_known")).select(hash_col)), hash_col, "left_semi")
    cold = batch.join(F.broadcast(hot.select(hash_col)), hash_col, "left_anti")
    return cold.join(fresh.select(hash_col), hash_col, "left_semi").unionByName(hot_new)


def batch_id_of(stamp: Column) -> Column:
    """The load time in UTC as text, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyyMMdd_HHmmss_SSSSSS")


def stamp_batch(rows: DataFrame, stamp: Column, batch_id: Column | None = None) -> DataFrame:
    """One load time and one batch id on every row."""
    return rows.withColumns({
        "inserted_at": stamp.cast("timestamp"),
        "batch_id": batch_id_of(stamp) if batch_id is None else batch_id,
    })


def latest_version(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """Current version per key: the first row by the given columns, descending.

    The filter on the rank lets Spark keep one row per key and task before the
    shuffle, so a key with very many versions does not travel.
    """
    order = [F.desc(c) for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
