"""How filters interact: what each removes alone, first, and after others, from sorted posting lists."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import join_per_group
from .common import kept_table, map_texts, text_buffer

# Rows numbered alike up to these low bits are one id range: the longest posting list.
RANGE_BITS = 16

# The registered filters, by letter.
LETTERS = "ABCDE"

_MARKED = np.isin(np.arange(256), list(b"#$%&*|"))


# ------------------------------------------------------------------ the lists

def posting_lists(rows: DataFrame, part: str, flags: list[str], range_bits: int = RANGE_BITS) -> DataFrame:
    """(part, id_range, n_rows, and one sorted list of row ids per flag, named like it).

    rows  a stored table, in which every row has a number of its own; repeated rows are rows
    """
    numbered = rows.select(F.col(part).alias("part"), *flags, F.monotonically_increasing_id().alias("_id"))
    id_range = F.shiftright("_id", range_bits).alias("id_range")
    return numbered.groupBy("part", id_range).agg(
        F.count("*").alias("n_rows"),
        *[F.sort_array(F.collect_list(F.when(F.col(f), F.col("_id")))).alias(f) for f in flags])


def _gallop(ids: list[int], at: int, bound: int) -> int:
    """First place from ``at`` on whose id is not below the bound: steps double, then halve."""
    step = 1
    while at + step < len(ids) and ids[at + step] < bound:
        step *= 2
    return bisect_left(ids, bound, at, min(at + step + 1, len(ids)))


def exclusive_sizes(lists: list[list[int]]) -> list[int]:
    """For every set of lists, as bits, how many ids are in these and in no other: one galloping merge of all.

    An id range that only one list holds, up to the next id of any other, is passed in one leap.
    The size of a union or difference of the lists is the sum of the sizes of its sets.
    """
    sizes = [0] * (1 << len(lists))
    at, live = [0] * len(lists), [k for k, ids in enumerate(lists) if ids]
    while live:
        heads = [lists[k][at[k]] for k in live]
        low = min(heads)
        first = [k for k, head in zip(live, heads) if head == low]
        if len(first) == 1:
            k, others = first[0], [head for head in heads if head != low]
            to = _gallop(lists[k], at[k], min(others)) if others else len(lists[k])
            sizes[1 << k] += to - at[k]
            at[k] = to
        else:
            sizes[sum(1 << k for k in first)] += 1
            for k in first:
                at[k] += 1
        live = [k for k in live if at[k] < len(lists[k])]
    return sizes


def overlaps(lists: DataFrame, flags: list[str]) -> DataFrame:
    """(part, flags as bits, n): rows by the exact set of their flags, summed over the id ranges; without
    the rows that have none."""
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("flags", T.IntegerType()),
                           T.StructField("n", T.LongType())])

    def merge(batches):
        for batch in batches:
            columns = [batch.column(k + 1) for k in range(len(flags))]
            parts, sets, sizes = [], [], []
            for row, part in enumerate(batch.column(0).to_pylist()):
                for flag_set, n in enumerate(exclusive_sizes([c[row].values.to_pylist() for c in columns])):
                    if n:
                        parts.append(part)
                        sets.append(flag_set)
                        sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.string()), pa.array(sets, pa.int32()), pa.array(sizes, pa.int64())],
                names=schema.fieldNames())

    return lists.select("part", *flags).mapInArrow(merge, schema).groupBy("part", "flags").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the audit

def audit(rows: DataFrame, part: str, filters: list[str], marks: dict[str, str], range_bits: int = RANGE_BITS) -> DataFrame:
    """Per part, order of all filters and step: kept, removed, redundant, unique_fails, one count per mark, shapley.

    rows     a stored table with a text column ``part`` (null: empty) and boolean columns (null: false)
    filters  columns that say that a filter rejects the row, named by one letter each
    marks    name of a count -> boolean column: how many rows with it a step removes

    shapley is what a filter removes at its place, summed over all orders. A row that fails m of k filters is
    removed by each of them in k! / m orders. An empty table has no parts and gives no rows. The lists of a part
    are cut into id ranges of at most 2**range_bits rows, so a part may hold any share of all rows.
    """
    flags = [*filters, *marks.values()]
    lists = kept_table(posting_lists(rows.withColumn(part, F.coalesce(part, F.lit(""))), part, flags, range_bits), "postings")
    sets = overlaps(lists, flags).groupBy("part").agg(F.collect_list(F.struct("flags", "n")).alias("_sets"))
    totals = lists.groupBy("part").agg(F.sum("n_rows").alias("_rows"))
    per_part = totals.join(sets, "part", "left").withColumn(
        "_sets", F.coalesce("_sets", F.array().cast("array<struct<flags:int,n:bigint>>")))

    k = len(filters)
    steps = [F.struct(F.lit("".join(order)).alias("order"), F.lit(s + 1).alias("step"),
                      F.lit(1 << filters.index(order[s])).alias("own"),
                      F.lit(sum(1 << filters.index(f) for f in order[:s])).alias("before"))
             for order in permutations(filters) for s in range(k)]
    own, before = F.col("_at.own"), F.col("_at.before")

    def total(which, weight=lambda failing: F.lit(1)) -> Column:
        """Sum over the sets of flags that satisfy a condition."""
        return F.aggregate("_sets", F.lit(0).cast("long"), lambda done, s: done + F.when(
            which(s["flags"]), s["n"] * weight(s["flags"])).otherwise(0))

    def has(flag_set: Column, bits: Column) -> Column:
        return flag_set.bitwiseAND(bits) != 0

    def removed(s: Column) -> Column:
        return has(s, own) & ~has(s, before)

    every = F.lit((1 << k) - 1)
    in_orders = F.array(*[F.lit(0), *[F.lit(factorial(k) // m) for m in range(1, k + 1)]])
    return per_part.select("part", "_rows", "_sets", F.explode(F.array(*steps)).alias("_at")).select(
        "part", F.col("_at.order").alias("filter_order"), F.col("_at.step").alias("step"),
        (F.col("_rows") - total(lambda s: has(s, own.bitwiseOR(before)))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda s: has(s, own) & has(s, before)).alias("redundant"),
        total(lambda s: s.bitwiseAND(every) == own).alias("unique_fails"),
        *[total(lambda s, bit=1 << (k + j): removed(s) & has(s, F.lit(bit))).alias(name)
          for j, name in enumerate(marks)],
        total(lambda s: has(s, own), lambda s: F.get(in_orders, F.bit_count(s.bitwiseAND(every)))).alias("shapley"))


# ------------------------------------------------------------------ the filters of texts

def text_failures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, A to D (the filter rejects the text) and text_hash, of whole texts (null: empty)."""
    fields = [*[T.StructField(c, T.BooleanType()) for c in LETTERS[:4]], T.StructField("text_hash", T.BinaryType())]

    def fill(texts: pa.Array) -> list[pa.Array]:
        data, bounds = text_buffer(texts)

        def count(which: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(which, dtype=np.int64))[bounds])

        raw = [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        words = np.array([(len(w), len(set(w))) for w in (r.split() for r in raw)], np.int64).reshape(-1, 2)
        capitals, characters = count((data >= 65) & (data <= 90)), count((data & 0xC0) != 0x80)
        return [pa.array(words[:, 0] < 200), pa.array(100 * words[:, 1] < 50 * words[:, 0]),
                pa.array(100 * capitals > 2 * characters), pa.array(count(_MARKED[data]) > 0),
                pa.array([hashlib.sha256(r).digest() for r in raw], pa.large_binary())]

    return map_texts(docs, text, fields, lambda: fill, keep)


def audited_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A stored table: part, doc_id, A to E, good and toxic of every document.

    E rejects a text that some smaller doc_id has too; a missing doc_id is never rejected by it, has no labels, and
    is smaller than none. A document is good or toxic if any label row of its doc_id says so.
    """
    measured = kept_table(text_failures(docs.select("doc_id", "source", "text"), ["doc_id", "source"]), "measured")
    # only texts that more than one id has can be rejected
    firsts = measured.groupBy("text_hash").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    firsts = firsts.filter(F.col("_first") < F.col("_last")).select("text_hash", "_first")
    seen = join_per_group(measured, firsts, ["text_hash"], ["doc_id"])
    said = labels.groupBy("doc_id").agg(
        F.bool_or(F.col("quality") == 1).alias("_good"), F.bool_or(F.col("toxic") == 1).alias("_toxic"))
    seen = seen.withColumn(LETTERS[4], F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)))
    known = join_per_group(seen.filter(F.col("doc_id").isNotNull()), said, ["doc_id"], ["text_hash"])
    unknown = seen.filter(F.col("doc_id").isNull()).withColumns(
        {c: F.lit(None).cast("boolean") for c in ("_good", "_toxic")})
    return kept_table(known.unionByName(unknown).select(
        F.coalesce("source", F.lit("")).alias("part"), "doc_id", *LETTERS,
        *[F.coalesce(f"_{c}", F.lit(False)).alias(c) for c in ("good", "toxic")]), "audited")


def text_filter_audit(docs: DataFrame, labels: DataFrame, range_bits: int = RANGE_BITS) -> DataFrame:
    """The audit of the text filters A to E by source; nothing but named columns is read."""
    return audit(audited_documents(docs, labels), "part", list(LETTERS),
                 {"good_lost": "good", "toxic_lost": "toxic"}, range_bits)
