"""SimHash near-duplicates: fingerprints of word shingles, linked through pigeonring filtering."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept_table, map_texts
from .components import components

# Different fingerprints in one bucket up to which they are compared pair by pair.
BUCKET = 256

_BYTE_AT = np.arange(8) * 256
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """64 bits; bit i is 1 if it is set in over half of the shingles' hashes; no word: 0."""
    words = text.lower().split()  # of bytes: lowers A-Z, splits at blank and \t..\r
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = list(map(len, words))
    starts = list(accumulate(lengths[:-1], lambda at, n: at + n + 1, initial=0))
    ends = [a + n for a, n in zip(starts, lengths)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[min(width, len(words)) - 1:])]
    seen = np.bincount((np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BITS).ravel() * 2 > len(hashes)
    return int.from_bytes(np.packbits(ones, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """The columns ``keep`` and fp, the 64-bit SimHash of the text as a signed long."""
    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            raw = texts.cast(pa.binary()).to_pylist()
            return [pa.array(np.array([fingerprint(x or b"", width, seed) for x in raw], "u8").view("i8"))]
        return fill

    return map_texts(df, text, [T.StructField("fp", T.LongType())], make, keep)


def ring(segments: int) -> list[list[int]]:
    """For each start, the bits of the segments that follow it around the ring, as masks."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    return [masks[i:] + masks[:i] for i in range(segments)]


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def close_pairs(fps: DataFrame, max_bits: int, segments: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between fingerprints, from which all those within max_bits are connected.

    fps  one column fp, each value once

    If two fingerprints differ by at most t bits in m segments on a ring, then from some
    segment on every chain of l consecutive segments differs by at most l t / m bits. The first
    chains have a budget below one bit, so their segments are equal: they are the bucket.
    Inside a bucket the longer chains are checked, then the whole distance. A
    bucket with more than ``bucket`` fingerprints emits no pairs: all of its members meet
    at the values half of max_bits away from them, where no more can meet than there
    are such values, and any two that meet there at an even max_bits are close.
    """
    if not 0 <= max_bits < segments:
        raise ValueError("pigeonring filtering needs more segments than differing bits")
    chains = ring(segments)
    equal = max(n for n in range(1, segments + 1) if n * max_bits < segments)  # chain length with budget 0
    keys = [sum(c[:equal]) for c in chains]
    start = F.explode(F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(_long(k)).alias("part"))
                                for i, k in enumerate(keys)]))
    cells = fps.select("fp", start.alias("_c")).select("fp", "_c.start", "_c.part")
    sizes = cells.groupBy("start", "part").agg(F.count("*").alias("members")).filter("members > 1")
    sized = kept_table(cells.join(kept_table(sizes, "buckets"), ["start", "part"]), "cells")

    small = sized.filter(F.col("members") <= bucket)
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    fits = F.bit_count(differ) <= max_bits
    for n in range(equal + 1, segments):
        masks = F.element_at(F.array(*[_long(sum(c[:n])) for c in chains]), F.col("x.start") + 1)
        fits = (F.bit_count(differ.bitwiseAND(masks)) <= n * max_bits // segments) & fits
    same = (F.col("x.start") == F.col("y.start")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.fp") < F.col("y.fp"))
    pairs = small.alias("x").join(small.alias("y"), same & fits).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    crowded = sized.filter(F.col("members") > bucket).select("fp").distinct()

    def around(bits: int) -> DataFrame:
        flips = [sum(1 << b for b in at) for n in range(bits + 1) for at in combinations(range(64), n)]
        return crowded.select("fp", F.explode(F.transform(
            F.array(*[_long(x) for x in flips]), lambda x: F.col("fp").bitwiseXOR(x))).alias("meet"))

    if max_bits % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("meet"))
        met = around(max_bits // 2).select(F.col("fp").alias("a"), least.alias("b")).filter("a <> b").distinct()
    else:
        met = around(max_bits // 2).alias("x").join(around(max_bits // 2 + 1).alias("y"), "meet").filter(
            "x.fp <> y.fp").select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()
    return pairs.unionByName(met)


def near_duplicates(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", width: int = 3, seed: int = 42,
                    max_bits: int = 2, segments: int = 5, bucket: int = BUCKET) -> DataFrame:
    """The columns ``keep`` (doc_id first), fingerprint (16 hex digits) and component_id, one row per document.

    Two documents are linked if their fingerprints differ by max_bits bits at most;
    component_id is the smallest doc_id reachable. A text without words, null or
    empty, has fingerprint zero and is linked like any other. Documents with equal fingerprints are
    one node, so copies are never paired. Rows that repeat an id stay rows of their own;
    a null id is never the smallest, and a component of null ids alone has component_id NULL.
    Columns not named are not read.
    """
    return _placed(df, keep, text, width, seed, max_bits, segments, bucket).drop("_root")


def _placed(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", width: int = 3, seed: int = 42,
            max_bits: int = 2, segments: int = 5, bucket: int = BUCKET) -> DataFrame:
    """near_duplicates with one column more, _root: the smallest fingerprint of the component, which tells it from all others."""
    doc_id = keep[0]
    docs = kept_table(fingerprints(df, list(keep), text, width, seed), "fingerprints")
    nodes = kept_table(docs.groupBy("fp").agg(F.min(doc_id).alias("first_id")), "nodes")
    parts = components(close_pairs(nodes.select("fp"), max_bits, segments, bucket))
    placed = nodes.join(kept_table(parts, "parts"), F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root"))
    placed = kept_table(placed, "placed")
    least = kept_table(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    of_fp = kept_table(placed.join(least, "root").select("fp", "component_id", "root"), "component_ids")
    digits = F.lower(F.lpad(F.hex("d.fp"), 16, "0"))
    return docs.alias("d").join(of_fp.alias("c"), F.col("d.fp") == F.col("c.fp")).select(
        *[F.col(f"d.`{c}`") for c in keep], digits.alias("fingerprint"), "c.component_id", F.col("c.root").alias("_root"))


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One document of each component with all its columns: the one whose id names it.

    Of a component's rows that repeat this id the one with the smallest text hash stays; of equal rows one.
    Components that the same id names, or that hold null ids alone, keep one document each.
    """
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_hash"))
    found = _placed(rows, ["doc_id", "_hash"], **how).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = found.groupBy("_root", "doc_id").agg(F.min("_hash").alias("_hash"))
    hit = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r._hash") == F.col("c._hash"))
    kept = rows.alias("r").join(chosen.alias("c"), hit, "left_semi").select("_row", "doc_id", "_hash")
    first = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(F.xxhash64("_row")))
    return kept.withColumn("_n", first).filter("_n = 1").select("_row.*")
