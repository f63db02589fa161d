"""Mixing sources to target weights by the cube method of balanced sampling."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, kept_table

# Units that one flight takes in; at most two of them are left undecided.
CHUNK = 2048

# Units kept for the landing, in which all ways to decide them are compared.
LANDING = 13

# A unit is large if it has more than this share of its source's words, and than the units of a landing can even out.
_LARGE = 0.0005

# What a document too many counts in the landing, in words of a document of mean size.
_NUMBER_WEIGHT = 0.02

# A probability this close to 0 or 1 has arrived.
_NEAR = 1e-9


def unit_key() -> Column:
    """Names a document by all that a draw may look at; equal rows share it."""
    return F.xxhash64("doc_id", "text", "source", F.isnull("text"), F.isnull("source"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target: the total of all sizes shared among the sources by weight.

    sizes  one row per source, with source and source_size

    Sources take the weights in the order of their code points, null last, over and over. No
    target is above ``most`` times its source's size: sources are full in the order of size
    by weight, and what they leave is shared by the weight of the others.
    """
    # One row per source, which is a name that people give: a window over all of them is small.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("_weight"))
    full = F.col("source_size") * F.lit(most)
    order = Window.orderBy("_at", F.asc_nulls_last("source"))
    everyone, fuller = Window.partitionBy(), order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", full / F.col("_weight")).withColumn("_order", F.row_number().over(order))
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum(full).over(fuller), F.lit(0.0))) / (
        F.sum("_weight").over(everyone) - F.coalesce(F.sum("_weight").over(fuller), F.lit(0.0)))
    rows = rows.withColumn("_level", level).withColumn("_full", F.col("_at") <= F.col("_level"))
    last = F.min(F.when(~F.col("_full"), F.struct("_order", "_level"))).over(everyone).getField("_level")
    target = F.when(F.col("_full") | last.isNull(), full).otherwise(last * F.col("_weight"))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def _move(members: list[int], direction: list[float], p: list[float], rng: random.Random) -> list[int]:
    """A step along or against the direction until some probability arrives; gives the others."""
    far = []
    for sign in (1, -1):
        far.append(min(((1 - p[k]) if sign * u > 0 else p[k]) / abs(u) for k, u in zip(members, direction) if u))
    step = far[0] if rng.random() * (far[0] + far[1]) < far[1] else -far[1]
    for k, u in zip(members, direction):
        p[k] += step * u
        p[k] = 0.0 if p[k] < _NEAR else 1.0 if p[k] > 1 - _NEAR else p[k]
    return [k for k in members if 0 < p[k] < 1]


def flight(units: list[int], p: list[float], x: list[float], y: list[float], rng: random.Random) -> list[int]:
    """Moves the units' probabilities to 0 or 1 in place; gives those still between.

    Every step lies in the null space of the two constraints, so sum(p x) and sum(p y)
    stay as they are: of three units the cross product of their rows, of two with
    proportional rows the one direction there is.
    """
    rest: list[int] = []
    for k in units:
        if 0 < p[k] < 1:
            rest.append(k)
        if len(rest) == 3:
            a, b, c = rest
            u = [x[b] * y[c] - x[c] * y[b], x[c] * y[a] - x[a] * y[c], x[a] * y[b] - x[b] * y[a]]
            rest = _move(rest, u, p, rng) if any(u) else [*_move([a, b], [y[b], -y[a]], p, rng), c]
    if len(rest) == 2 and x[rest[0]] * y[rest[1]] == x[rest[1]] * y[rest[0]]:
        rest = _move(rest, [y[rest[1]], -y[rest[0]]], p, rng)
    return rest


def landing(rest: list[int], p: list[float], x: list[float], y: list[float]) -> None:
    """Decides the last units, of all ways by the one that changes the totals least; x weighs most."""
    ways = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1).astype(float)
    by_x, by_y = (np.abs((ways - [p[k] for k in rest]) @ np.array([v[k] for k in rest])) for v in (x, y))
    best = ways[np.argmin(by_x + _NUMBER_WEIGHT * np.mean([x[k] for k in rest]) * by_y)]
    for w, k in zip(best.tolist(), rest):
        p[k] = w


def _fly(units: DataFrame, level: int, land: bool, seed: int) -> DataFrame:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_key")
        rng = random.Random(f"{seed} {level} {part['source'].iloc[0]} {part['_chunk'].iloc[0]}")
        order = list(range(len(part)))
        rng.shuffle(order)
        p, x, y = ([float(part[c].iloc[k]) for k in order] for c in ("_p", "_x", "_y"))
        fly = sorted(range(len(p)), key=lambda k: -x[k])
        # The units that wait for the landing are of all sizes, so that their sums reach any total.
        wait = fly[:: -(-len(fly) // LANDING)] if land else []
        rest = flight([k for k in fly if k not in set(wait)], p, x, y, rng)
        if land:
            landing(rest + wait, p, x, y)
        back = dict(zip(order, p))
        return part.assign(_p=[back[k] for k in range(len(part))])

    return units.groupBy("source", "_chunk").applyInPandas(run, units.schema)


def balanced_sample(units: DataFrame, seed: int = 7, chunk: int = CHUNK) -> DataFrame:
    """Units with their inclusion probability _p moved to 0 or 1.

    Within each source the totals of _x and _y keep their expectation but for the two units
    that land. Flights run on hashed chunks of a source; the few units that a chunk leaves
    fly again together, until a single chunk per source is left, which lands.
    """
    schema, done, level = units.schema, [], 0
    while True:
        per_source = units.groupBy("source").agg(F.ceil(F.count("*") / chunk).alias("_chunks"))
        cut = units.alias("u").join(per_source.alias("s"), F.col("u.source").eqNullSafe(F.col("s.source"))).select(
            "u.*", F.pmod(F.xxhash64("u._key", F.lit(seed), F.lit(level)), F.col("s._chunks"))
            .cast("long").alias("_chunk"))
        most = per_source.agg(F.max("_chunks")).first()[0] or 0
        flown = kept_table(_fly(cut, level, most <= 1, seed), "flight").select(*schema.fieldNames())
        done.append(flown.filter("_p <= 0 or _p >= 1"))
        if most <= 1:
            break
        units, level = flown.filter("_p > 0 and _p < 1"), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def draw_large(units: DataFrame, seed: int = 7) -> DataFrame:
    """Units with the large ones decided, and the others' probabilities at what is left of each source's words.

    Units of about mean size cannot even out a text that is larger than many of them, whenever it is
    decided. So large units, fewer than 1 / _LARGE of a source, are decided first, the largest first: each with
    the share of the words still wanted in those still open, and surely where the others could not do with or without
    it. The number of documents is not balanced for them.
    """
    sums = units.groupBy("source").agg(F.sum("_x").alias("_open"), F.avg("_x").alias("_mean"))
    known = units.alias("u").join(sums.alias("s"), F.col("u.source").eqNullSafe(F.col("s.source"))).select("u.*", "_open", "_mean")
    large = F.col("_x") > F.greatest(F.col("_open") * _LARGE, F.col("_mean") * (LANDING / 2))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_x", "_key"], ascending=[False, True])
        rng = random.Random(f"{seed} large {part['source'].iloc[0]}")
        still, wanted, taken = float(part["_open"].iloc[0]), float(part["_open"].iloc[0] * part["_p"].iloc[0]), []
        for x in part["_x"]:
            still -= x
            chance = 1.0 if wanted > still else 0.0 if wanted < x else wanted / (still + x)
            taken.append(float(rng.random() < chance))
            wanted -= taken[-1] * x
        return part.assign(_p=taken)

    decided = kept_table(known.filter(large).groupBy("source").applyInPandas(run, known.schema), "large")
    used = decided.groupBy("source").agg(F.sum(F.col("_p") * F.col("_x")).alias("_used"), F.sum("_x").alias("_big"))
    left = (F.col("k._open") * F.col("k._p") - F.col("_used")) / (F.col("k._open") - F.col("_big"))
    small = known.filter(~large).alias("k").join(used.alias("d"), F.col("k.source").eqNullSafe(F.col("d.source")), "left")
    p = F.when(F.col("_used").isNull(), F.col("k._p")).otherwise(F.least(F.greatest(left, F.lit(0.0)), F.lit(1.0)))
    columns = units.columns
    return small.select(*[p.alias("_p") if c == "_p" else F.col(f"k.{c}") for c in columns]).unionByName(
        decided.select(*columns))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7,
        chunk: int = CHUNK) -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies, taken: how often the mix takes each document.

    size is the number of words, null text none. A source whose target is t times its size
    takes each document floor(t) times; the cube method decides which documents it takes once
    more, balancing words and documents; texts that are too large for that are drawn before (draw_large).
    So ``taken`` = copies x size is near the target of the source up to what a choice among its last fifteen documents
    can even out, and the draw is fixed by ``seed``.
    Documents without words are taken floor(t) times. A null source is a source of its own;
    rows with equal id, text and source have one key and are taken together, equally
    often. Other columns are not read. An empty table gives an empty result.
    """
    rows = kept_table(docs.select("doc_id", "source", unit_key().alias("key"), word_count(F.col("text")).alias("size")), "sizes")
    shares = kept_table(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = rows.groupBy("source", F.col("key").alias("_key")).agg(
        F.count("*").cast("double").alias("_y"), F.sum("size").cast("double").alias("_x"))
    units = units.alias("u").join(shares.alias("s"), F.col("u.source").eqNullSafe(F.col("s.source"))).select(
        "u.*", F.floor(ratio).alias("_whole"), (ratio - F.floor(ratio)).alias("_p"))
    open_ = (F.col("_p") > _NEAR) & (F.col("_p") < 1 - _NEAR) & (F.col("_x") > 0)
    units = kept_table(units.select("*", open_.alias("_open")), "units")
    drawn = balanced_sample(kept_table(draw_large(units.filter("_open").drop("_open"), seed), "drawn"), seed, chunk)
    decided = drawn.unionByName(units.filter("not _open").drop("_open")).select("source", "_key", (
        F.col("_whole") + F.when((F.col("_p") >= 1 - _NEAR) & (F.col("_x") > 0), 1).otherwise(0)).alias("copies"))
    out = rows.alias("r").join(decided.alias("d"), (F.col("r.key") == F.col("d._key")) & F.col("r.source").eqNullSafe(
        F.col("d.source")))
    out = out.join(shares.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    return out.select("r.doc_id", "r.source", "r.key", "r.size", "s.source_size", "s.target",
                      F.col("d.copies").cast("long").alias("copies"),
                      (F.col("d.copies") * F.col("r.size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix with all their columns, repeated as often as they are taken."""
    taken = mix(docs, **how).filter("copies > 0").select("key", "copies").distinct()
    rows = docs.select(F.struct("*").alias("_row"), unit_key().alias("_key"))
    return (rows.join(taken, F.col("_key") == F.col("key"))
            .select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*"))
