"""Hot groups: found by a count, treated apart.

One group may hold a large part of all rows. Its rows must not meet in one task, but
the many ordinary groups are cheapest with a plain window, aggregation or join. So
the few hot groups are found first and handled on a path of their own. Both paths
give the same result for any group; which one a group takes only decides the speed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one group up to which a single task may hold the group.
HOT_ROWS = 1_000_000

# Counted rows that are enough to tell that a group is hot.
_EVIDENCE = 1_000

# Hot groups that are treated apart, the longest ones. All others have less than this share of the rows.
MAX_HOT = 10_000


def hot_keys(df: DataFrame, keys: list[str], spread: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than about ``hot_rows`` rows: at most MAX_HOT of them, those with most rows.

    spread  columns that differ between the rows of a group

    To find them it is enough to count a fixed share of the rows, chosen by the hash of
    key and spread columns, so the count adds next to nothing to the shuffle. Small
    limits are counted in full. Where more keys are hot, a key that is left out has at most
    1 / MAX_HOT of all rows, no more than a task's usual share of so many rows.
    """
    share = max(hot_rows // _EVIDENCE, 1)
    counted = df if share == 1 else df.filter(F.pmod(F.xxhash64(*keys, *spread), F.lit(share)) == 0)
    return (counted.groupBy(*keys).agg(F.count("*").alias("_n"))
            .filter(F.col("_n") > hot_rows // share).orderBy(F.desc("_n"), *keys).limit(MAX_HOT).select(*keys))


def split_hot(df: DataFrame, keys: list[str], spread: list[str],
              hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of the hot groups, all other rows), without a shuffle of the rows.

    The number of hot keys is bounded, which is what makes them fit a broadcast. When there
    are none, Spark sees the empty broadcast at run time and drops the hot path.
    """
    hot = F.broadcast(hot_keys(df, keys, spread, hot_rows))
    return (df.join(hot, keys, "left_semi").select(*df.columns),
            df.join(hot, keys, "left_anti").select(*df.columns))


def join_per_group(df: DataFrame, per_group: DataFrame, keys: list[str], spread: list[str],
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of one row per group to the rows of the groups.

    The rows of hot groups take theirs from a broadcast of just these groups' rows;
    in the shuffle join no group has many more than ``hot_rows`` rows.
    """
    names = [*df.columns, *[c for c in per_group.columns if c not in keys]]
    hot, rest = split_hot(df, keys, spread, hot_rows)
    of_hot = per_group.join(F.broadcast(hot_keys(df, keys, spread, hot_rows)), keys, "left_semi")
    return (rest.join(per_group, keys, "left").select(*names)
            .unionByName(hot.join(F.broadcast(of_hot), keys, "left").select(*names)))
