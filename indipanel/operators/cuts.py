"""Cutting long groups into blocks of an order, by bounds drawn from the rows themselves.

A hash of the ordered columns decides which rows are bounds, so whatever the values look like,
and however often one of them repeats, the gaps between bounds have the same distribution: a
block of c times the mean size has probability exp(-c). The bounds are one sorted list of limited
length, a scalar subquery. Rows find their block by binary search in it, first among the first
bounds of its parts, then in one part, without a join and before any shuffle. Blocks change only the plan: every draw gives the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks into which the rows that one task may hold are cut: a group just too long is spread over so many tasks.
BLOCKS = 128

# Binary digits of a step of the search: parts have 2**6 - 1 bounds, and so many parts there are. 3,969 bounds at
# most; a block has about this share of all rows at least. The list of a step is copied for every row.
_DIGITS = 6


def with_block(df: DataFrame, drawn_from: DataFrame, columns: list[str], task_rows: int, name: str) -> DataFrame:
    """Add the number of the block of each row; it never decreases in the order of the columns (ascending,
    missing values first).

    drawn_from  the rows whose hash decides on the bounds; those of ``df`` or more
    columns     keys of the groups, then their order; rows that are equal in all of them are in one block
    task_rows   rows of a group that one task may hold
    """
    here = F.struct(*[F.col(c) for c in columns])
    draw = F.xxhash64(*columns, F.lit("bound"))
    drawn = drawn_from.filter(F.pmod(draw, F.lit(max(task_rows // BLOCKS, 1))) == 0)
    # of very many the smallest draws stay: every row's chance is the same again
    fan = (1 << _DIGITS) - 1
    drawn = drawn.select(here.alias("_here"), draw.alias("_draw")).orderBy("_draw").limit(fan * fan)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / fan).cast("int")),
                        lambda i: F.slice("_all", i * fan + 1, fan))
    bounds = (drawn.agg(F.array_sort(F.collect_set("_here")).alias("_all")).select(parts.alias("parts"))
              .select(F.struct(F.transform("parts", lambda p: F.get(p, 0)).alias("firsts"), "parts")).scalar())
    steps = F.array(*[F.lit(1 << d) for d in reversed(range(_DIGITS))])
    # how many bounds of a short list are not above the row
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get("_bounds", at + step - 1) <= F.col("_here"), at + step).otherwise(at))

    found = df.select("*", bounds.getField("firsts").alias("_bounds"), here.alias("_here"))
    found = found.withColumn("_part", reached)
    found = found.withColumn("_bounds", F.get(bounds.getField("parts"), F.col("_part") - 1))
    return found.withColumn(name, F.when(F.col("_part") > 0, (F.col("_part") - 1) * fan + reached).otherwise(0)).drop(
        "_bounds", "_here", "_part")
