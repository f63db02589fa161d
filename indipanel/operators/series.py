"""Nearest published rows before and after each row of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cuts import with_block
from .skew import HOT_ROWS, split_hot


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    carry: list[str],
    found: Column | None = None,
    prefix: tuple[str, str] = ("previous", "next"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``<previous>_<c>`` and ``<next>_<c>`` for each carried column.

    keys    series key, not NULL
    order   order columns of any type that can be compared; they fix ties as well
    found   which rows may serve as neighbours (default: the first carried column is set)

    A series of up to ``hot_rows`` rows is ordered in one task. A longer one is scanned in blocks
    of its order, and each block takes the nearest row of the blocks before and after it.
    Either way the rows are shuffled once, for both directions.
    """
    found = F.col(carry[0]).isNotNull() if found is None else found
    columns = [*order, *[c for c in carry if c not in order]]
    row = F.when(found, F.struct(*[F.col(c) for c in columns]))
    hot, rest = split_hot(df, keys, order, hot_rows)
    cut = with_block(hot, df, [*keys, *order], hot_rows, "_block1")
    seen = _ordered(rest, keys, order, row).unionByName(_by_blocks(cut, keys, order, row))
    return seen.select(
        *df.columns,
        *[F.col("_prev").getField(c).alias(f"{prefix[0]}_{c}") for c in carry],
        *[F.col("_next").getField(c).alias(f"{prefix[1]}_{c}") for c in carry],
    )


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _ordered(df: DataFrame, group: list[str], order: list[str], row: Column) -> DataFrame:
    """_prev and _next for groups that fit a task.

    The row after is looked up as the row before in descending order: a frame that
    starts behind the current row is re-evaluated per row and grows quadratic.
    """
    w = Window.partitionBy(*group)
    return df.withColumn("_row", row).withColumns({
        "_prev": F.last("_row", ignorenulls=True).over(_before(w.orderBy(*[F.asc(c) for c in order]))),
        "_next": F.last("_row", ignorenulls=True).over(_before(w.orderBy(*[F.desc(c) for c in order]))),
    }).drop("_row")


def _by_blocks(cut: DataFrame, group: list[str], order: list[str], row: Column) -> DataFrame:
    """The same for groups that no task should hold: a prefix scan over blocks of their order.

    Every block is reduced to its first and last published row, combined before the shuffle, and
    only these edges are ordered along the group. A row whose neighbour lies outside its block takes
    the edge; the join finds the rows where the window left them.
    """
    path = [*group, "_block1"]
    edges = cut.groupBy(*path).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    along = Window.partitionBy(*group)
    edges = edges.select(
        *path,
        F.last("_last", ignorenulls=True).over(_before(along.orderBy(F.asc("_block1")))).alias("_edge_prev"),
        F.last("_first", ignorenulls=True).over(_before(along.orderBy(F.desc("_block1")))).alias("_edge_next"))
    return _ordered(cut, path, order, row).join(edges, path, "left").select(
        *[c for c in cut.columns if c != "_block1"],
        F.coalesce("_prev", "_edge_prev").alias("_prev"),
        F.coalesce("_next", "_edge_next").alias("_next"))
