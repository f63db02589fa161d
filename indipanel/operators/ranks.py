"""Exact rank selection without gathering a group in one task.

Equal values are counted first (combined before the shuffle). The wanted rank is
then located in the counts of blocks of the order, and only the block that holds it is looked
at more closely. A task orders the blocks of a group or the distinct values of one
block, however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cuts import with_block
from .skew import HOT_ROWS, split_hot

# Leading hash characters used as histogram buckets: 16 ** 4 of them.
_PREFIX = 4


def _rows_before(order: Column, group: list[str] = ()) -> Column:
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(w), F.lit(0))


def _holds(rank: str) -> Column:
    return (F.col("_below") <= F.col(rank)) & (F.col(rank) < F.col("_below") + F.col("_n"))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Interpolated median of the non-null values: one row per key (keys not NULL).

    Groups of up to ``hot_rows`` rows are aggregated as they are; the values of longer ones
    never meet in one task, however they are distributed.
    """
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"))
    hot, rest = split_hot(values, keys, ["_value"], hot_rows)
    plain = rest.groupBy(*keys).agg(F.percentile("_value", F.lit(0.5)).alias(name))
    counted = hot.groupBy(*keys, "_value").agg(F.count("*").alias("_n"))
    return plain.unionByName(_median_by_blocks(
        with_block(counted, values, [*keys, "_value"], hot_rows, "_block"), keys, name))


def _median_by_blocks(values: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Selection by blocks of values: the rows per block tell which one holds the middle ranks, and only
    the different values of that block are put in order."""
    path = [*keys, "_block"]
    total = F.sum("_n").over(Window.partitionBy(*keys))
    middle = (
        values.groupBy(*path).agg(F.sum("_n").alias("_n"))
        .withColumns({"_lo": F.floor((total - 1) / 2), "_hi": F.floor(total / 2),
                      "_below": _rows_before(F.col("_block"), keys)})
        .filter(_holds("_lo") | _holds("_hi")).drop("_n")
    )
    below = F.col("_below") + _rows_before(F.col("_value"), path)
    ordered = values.join(middle, path).withColumn("_below", below)
    return ordered.groupBy(*keys).agg(
        (F.max(F.when(_holds("_lo"), F.col("_value"))) * 0.5
         + F.max(F.when(_holds("_hi"), F.col("_value"))) * 0.5).alias(name))


def newest_hashes(df: DataFrame, limit: int, hash_col: str = "row_hash",
                  time_col: str = "inserted_at") -> DataFrame:
    """Distinct hashes among the ``limit`` newest rows; ties go by hash.

    All rows of a batch share one load time, so the limit falls inside one batch.
    That batch, then the leading hash characters, then the hash at which it falls
    are found from counts; the result is one filter with these three values. A
    global top-n of this size would end in a single task.
    """
    h, t, prefix = F.col(hash_col), F.col(time_col), F.substring(hash_col, 1, _PREFIX)
    rows = df.filter(h.isNotNull())
    if limit <= 0:
        return rows.select(hash_col).limit(0)

    def counted(frame: DataFrame, key: Column) -> DataFrame:
        return frame.groupBy(key.alias("_key")).agg(F.count("*").alias("_n"))

    def used_up(counts: DataFrame, order: Column, room: Column) -> Column:
        """(key, room) of the bucket in which the room is used up; NULL if it never is."""
        left = counts.withColumn("_room", room - _rows_before(order))
        at = left.filter((F.col("_room") > 0) & (F.col("_n") >= F.col("_room")))
        return at.select(F.struct("_key", "_room")).scalar()

    at_time = used_up(counted(rows, t), F.desc("_key"), F.lit(limit))
    cut_time = at_time.getField("_key")
    batch = rows.filter(t == cut_time)
    at_prefix = used_up(counted(batch, prefix), F.asc("_key"), at_time.getField("_room"))
    cut_prefix = at_prefix.getField("_key")
    hashes = counted(batch.filter(prefix == cut_prefix), h)
    cut_hash = used_up(hashes, F.asc("_key"), at_prefix.getField("_room")).getField("_key")

    in_batch = (prefix < cut_prefix) | ((prefix == cut_prefix) & (h <= cut_hash))
    newest = F.when(cut_time.isNull(), F.lit(True)).otherwise((t > cut_time) | ((t == cut_time) & in_batch))
    return rows.filter(newest).select(hash_col).distinct()
