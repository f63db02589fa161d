"""Embedding near-duplicates by lattice hashing: random projections decoded to E8 lattice points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_table
from .components import components

# Length of a projected unit vector's coordinate, in which the shortest lattice vectors measure 1.41; cells probed
# in a table, the own one included; vectors of a cell that one task compares at a time.
SCALE, PROBES, TILE = 0.33, 4, 512

# E8 blocks and tables for so many vectors at most. A further block parts unrelated vectors into some 24 times
# as many cells and halves the share of linked pairs that meet in one table, so twice the tables go with it and
# 12 times the vectors: an unrelated vector is then compared with a bounded number of others, 800 at most.
BLOCKS, TABLES, VECTORS, MORE = 2, 8, 25_000, 12

# Lengths whose projections a task holds at a time, and lone lengths, the largest first, left out beforehand; only the speed depends on them.
HASHERS, LONE = 8, 1000


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of the E8 lattice to each row of 8 numbers, doubled so that it is whole.

    E8 is D8 (whole numbers with an even sum) and D8 moved by one half: the nearer of both.
    """
    def nearest_d8(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        odd = np.flatnonzero(whole.sum(1) % 2)
        off = y[odd] - whole[odd]
        worst = np.abs(off).argmax(1)
        whole[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        return whole

    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.rint(2 * np.where(nearer[:, None], a, b)).astype(np.int64)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: the steps to the neighbouring cells."""
    pairs = [s for i in range(8) for j in range(i) for s in (
        [(i, a), (j, b)] for a in (2, -2) for b in (2, -2))]
    whole = np.zeros((len(pairs), 8), np.int64)
    for row, steps in enumerate(pairs):
        for i, v in steps:
            whole[row, i] = v
    signs = 1 - 2 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.concatenate([whole, signs[signs.prod(1) == 1]])


def grid(vectors: int) -> tuple[int, int]:
    """Blocks and tables for a number of vectors."""
    steps = 0
    while vectors > VECTORS * MORE ** steps:
        steps += 1
    return BLOCKS + steps, TABLES << steps


class Hasher:
    """The random projections of all tables, and the cells of vectors in them."""

    def __init__(self, width: int, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tables, self.blocks = tables, blocks
        self.matrix = rng.normal(size=(width, tables * blocks * 8)) * scale
        self.shift = rng.uniform(size=tables * blocks * 8)
        self.mix = rng.integers(1, 1 << 62, size=8 * blocks, dtype=np.int64) * 2 + 1
        self.steps = minimal_vectors()

    def keys(self, points: np.ndarray) -> np.ndarray:
        """A 64-bit name for each doubled lattice point of all blocks of a table."""
        with np.errstate(over="ignore"):
            return (points * self.mix).sum(1)

    def cells(self, units: np.ndarray, probes: int) -> np.ndarray:
        """(rows, tables, probes): the own cell, then the neighbouring cells nearest to the projection."""
        projected = units @ self.matrix + self.shift
        out = np.empty((len(units), self.tables, probes), np.int64)
        for t in range(self.tables):
            own, near = [], []
            for b in range(self.blocks):
                x = projected[:, (t * self.blocks + b) * 8:][:, :8]
                point = nearest_e8(x)
                # |x - (p + s)|^2 - |x - p|^2 for a step s: how much farther the neighbouring point is
                gap = (self.steps ** 2).sum(1) / 4 - 2 * (x - point / 2) @ (self.steps.T / 2)
                first = np.argpartition(gap, probes, axis=1)[:, :probes]
                own.append(point)
                near.append((np.take_along_axis(gap, first, 1), first))
            base = np.concatenate(own, axis=1)
            out[:, t, 0] = self.keys(base)
            gaps = np.concatenate([g for g, _ in near], axis=1)
            best = np.argsort(gaps, axis=1, kind="stable")[:, : probes - 1]
            for k in range(probes - 1):
                block, place = np.divmod(best[:, k], near[0][1].shape[1])
                moved = base.copy()
                for b in range(self.blocks):
                    rows = np.flatnonzero(block == b)
                    moved[rows, b * 8: b * 8 + 8] += self.steps[near[b][1][rows, place[rows]]]
                out[:, t, k + 1] = self.keys(moved)
        return out


def unit_vectors(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors in double precision, whether a row has one); all rows need one length."""
    lists = rows.to_pylist()
    width = max((len(v) for v in lists if v is not None), default=0)
    x = np.array([v if v is not None and len(v) == width and None not in v else [np.nan] * width for v in lists],
                 np.float64).reshape(len(lists), width)
    largest = np.abs(x).max(1) if width else np.zeros(len(lists))
    good = np.isfinite(largest) & (largest > 0)
    # by the largest component first, so that no square over- or underflows; exact, as it is a power of two
    x = np.ldexp(x, -np.frexp(np.where(good, largest, 1.0))[1][:, None])
    norms = np.sqrt((x * x).sum(1))
    return np.divide(x, norms[:, None], out=np.zeros_like(x), where=good[:, None]), good


def _entries(vectors: DataFrame, probes: int, **how) -> DataFrame:
    """One row per vector that has a direction: its length, its unit vector's source and all its cells.

    Each length has projections of its own.
    """
    def run(batches):
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                lengths = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                for width in np.unique(lengths[lengths > 0]).tolist():
                    same = part.take(pa.array(np.flatnonzero(lengths == width)))
                    units, good = unit_vectors(same.column(1))
                    rows = np.flatnonzero(good)
                    if not len(rows):
                        continue
                    if width not in hashers:
                        if len(hashers) >= HASHERS:
                            hashers.clear()
                        hashers[width] = Hasher(width, **how)
                    cells = hashers[width].cells(units[rows], probes).reshape(len(rows), -1)
                    yield pa.RecordBatch.from_arrays(
                        [same.column(0).take(pa.array(rows)), pa.array([width] * len(rows), pa.int32()),
                         pa.array([units[r].tobytes() for r in rows], pa.binary()),
                         pa.array(list(cells), pa.list_(pa.int64()))], names=["node", "width", "unit", "cells"])

    return vectors.mapInArrow(run, "node long, width int, unit binary, cells array<long>")


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the links i, j."""
    root = np.arange(n)
    while len(i):
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            break
    return root


def _links(table: int, nodes: np.ndarray, owner: np.ndarray, units: np.ndarray, cells: np.ndarray,
           least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the owners and the probers of one pair of tiles of a cell.

    Gives each linked node, how many links it has here, and one node that it reaches by them.
    """
    left, right = np.flatnonzero(owner), np.flatnonzero(~owner)
    a, b, ids_a, ids_b = units[left], units[right], nodes[left], nodes[right]
    i, j = np.nonzero(a @ b.T >= least - 1e-9)
    # The last digits depend on how a product is summed up: near the limit, sum again in one fixed way.
    exact = ((a[i] * b[j]).sum(1) >= least) & (ids_a[i] != ids_b[j])
    i, j = i[exact], j[exact]
    # A pair counts where it is met first: in the first table where the cell of one is probed by the
    # other, and there, if each probes the other's cell, with the smaller node as the owner.
    ca, cb = cells[left], cells[right]
    fresh = np.ones(len(i), bool)
    for t in range(table):
        fresh &= ~((cb[j, t] == ca[i, t, :1]).any(1) | (ca[i, t] == cb[j, t, :1]).any(1))
    fresh &= ~(ca[i, table] == cb[j, table, :1]).any(1) | (ids_a[i] < ids_b[j])
    ends = np.concatenate([ids_a[i[fresh]], ids_b[j[fresh]]])
    found, at, n = np.unique(ends, return_inverse=True, return_counts=True)
    root = _roots(*np.split(at, 2), len(found)) if len(found) else at
    return found, n, found[root]


def _link_rows(probes: int, tables: int, least: float):
    """Over rows sorted by length, table, cell and tiles: the links of each such group, which is bounded by its tiles."""
    names, n_keys = ["node", "n", "partner"], 5

    def run(batches):
        carry = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            keys = np.column_stack([rows.column(k).to_numpy() for k in range(n_keys)])
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            if len(edges):
                yield from groups(rows.slice(0, int(edges[-1])), keys[: edges[-1]], [0, *edges.tolist()])
                carry = rows.slice(int(edges[-1]))
            else:
                carry = rows
        if carry is not None and carry.num_rows:
            yield from groups(carry, np.column_stack([carry.column(k).to_numpy() for k in range(n_keys)]), [0, carry.num_rows])

    def groups(rows, keys, edges):
        if not rows.num_rows:
            return
        rows = rows.combine_chunks()
        nodes, owner = rows.column("node").to_numpy(), rows.column("side").to_numpy() == 0
        raw = rows.column("unit").to_pylist()
        cells = rows.column("cells").combine_chunks().flatten().to_numpy().reshape(len(nodes), tables, probes)
        out = []
        for lo, hi in zip(edges, edges[1:]):
            if hi - lo > 1:
                units = np.frombuffer(b"".join(raw[lo:hi]), np.float64).reshape(hi - lo, -1)
                made = _links(int(keys[lo, 1]), nodes[lo:hi], owner[lo:hi], units, cells[lo:hi], least)
                if len(made[0]):
                    out.append(made)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=names)
    return run


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9,
                    tables: int | None = None, blocks: int | None = None, probes: int = PROBES, tile: int = TILE, **how) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per vector.

    Two vectors are compared if in some table the cell of one is among the cells that the other
    probes; they are linked if their cosine, in double precision, is ``least`` or more. A
    cell is cut into tiles that meet pair by pair, so no task holds a large cell, and a task
    gives a count and one vector that it reaches per vector instead of pairs. ``blocks`` and ``tables`` follow
    the number of vectors (``grid``), so cells shrink as the rows grow; with each choice over 0.99 of the pairs at a
    cosine of just 0.9 are found, of closer ones more. component_id is the smallest
    vec_id reachable, and kept marks the vector that has it.

    Only vectors of equal length are compared. A vector that is null, empty or zero, that is alone of its length,
    or that holds a null or a value that is not finite links with nothing. Rows that repeat an id are vectors of their own: their ids appear
    once each. A null id reaches no other by being the smallest. An empty table gives an empty result.
    """
    rows = kept_table(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")
                                ).withColumn("node", F.monotonically_increasing_id()), "vectors")
    lengths = kept_table(rows.filter("size(v) > 0").groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")), "lengths")
    # A length that a single vector has, such as that of a malformed row, needs no projections.
    alone = [r["width"] for r in lengths.filter("n = 1").orderBy(F.desc("width")).limit(LONE).collect()]
    comparable = rows.filter(~F.size("v").isin(alone)) if alone else rows
    fitting = grid(lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])
    blocks, tables = blocks or fitting[0], tables or fitting[1]
    vectors = kept_table(_entries(comparable.select("node", "v"), probes, tables=tables, blocks=blocks, **how), "cells")
    cell = ["width", "at_table", "cell"]
    entries = vectors.select("node", "width", F.posexplode("cells").alias("_at", "cell")).select(
        "node", "width", F.floor(F.col("_at") / probes).cast("int").alias("at_table"), "cell", (F.col("_at") % probes == 0).alias("own"))
    sizes = entries.groupBy(*cell).agg(F.sum(F.col("own").cast("int")).alias("owners"), F.count("*").alias("probers"))
    sizes = kept_table(sizes.filter("owners > 0 and probers > 1").select(
        *cell, F.ceil(F.col("owners") / tile).alias("left_tiles"), F.ceil(F.col("probers") / tile).alias("right_tiles")), "sizes")
    sized = kept_table(entries.join(sizes, cell), "entries").join(vectors.drop("width"), "node")

    def spread(side: int, rows: DataFrame, mine: str, others: str):
        own_tile = F.pmod(F.xxhash64("node"), F.col(mine)).cast("int").alias(mine[:-1])
        other_tile = F.explode(F.sequence(F.lit(0), F.col(others).cast("int") - 1)).alias(others[:-1])
        return rows.select(*cell, "node", "cells", "unit", F.lit(side).alias("side"), own_tile, other_tile).select(
            *cell, "left_tile", "right_tile", "side", "node", "cells", "unit")

    meet = spread(0, sized.filter("own"), "left_tiles", "right_tiles").unionByName(
        spread(1, sized, "right_tiles", "left_tiles"))
    keys = [*cell, "left_tile", "right_tile"]
    found = kept_table(meet.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _link_rows(probes, tables, least), "node long, n long, partner long"), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("node").alias("a"), F.col("partner").alias("b")))
    placed = kept_table(
        rows.select("vec_id", "node").join(parts, "node", "left").join(counts, "node", "left").select(
            "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("component", "node").alias("root")), "placed")
    least_id = kept_table(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")), "component_ids")
    return placed.join(least_id, "root").select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
