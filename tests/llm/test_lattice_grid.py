"""Cells that shrink as vectors grow in number, their recall, vectors of extreme size, and the registered query."""

import numpy as np
import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import lattice  # noqa: E402
from indipanel.llm.queries import op8_lattice_dedup  # noqa: E402


def units(rng, n, width=64):
    x = rng.normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute(x, least=0.9):
    """Links and smallest reachable row of vectors."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([root[k], *root[close[k]]]) for k in range(len(x))])
        if (new == root).all():
            break
        root = new
    return close.sum(1), root


def test_grid_follows_the_rows():
    assert [lattice.grid(n) for n in (0, 25_000, 25_001, 300_000, 300_001, 3_600_001)] == [
        (2, 8), (2, 8), (3, 16), (3, 16), (4, 32), (5, 64)]


@pytest.mark.parametrize("vectors", [1, 30_000, 400_000])
def test_recall_and_strangers_met(vectors):
    rng = np.random.default_rng(1)
    x = units(rng, 1500)
    z = units(rng, 1500)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9005 * x + np.sqrt(1 - 0.9005 ** 2) * z
    blocks, tables = lattice.grid(vectors)
    hasher = lattice.Hasher(64, tables=tables, blocks=blocks)
    a, b = hasher.cells(x, lattice.PROBES), hasher.cells(y, lattice.PROBES)
    met = ((a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)).any(1)
    assert met.mean() > 0.985
    strangers = 0
    for t in range(tables):
        own, n_own = np.unique(a[:, t, 0], return_counts=True)
        probed, n_probed = np.unique(a[:, t].ravel(), return_counts=True)
        _, i, j = np.intersect1d(own, probed, return_indices=True)
        strangers += int((n_own[i] * n_probed[j]).sum()) - len(x)
    most = lattice.VECTORS * lattice.MORE ** (blocks - lattice.BLOCKS)
    assert strangers / len(x) / (len(x) - 1) * most < 1600


@pytest.mark.parametrize("blocks, tables", [(2, 8), (3, 16), (4, 32)])
def test_links_with_every_grid(spark, blocks, tables):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 32))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.02, 0.1, 0.15)])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in lattice.near_duplicates(df, blocks=blocks, tables=tables).collect()}
    n, root = brute(x)
    assert [got[k]["n_links"] for k in range(len(x))] == n.tolist()
    assert [got[k]["component_id"] for k in range(len(x))] == root.tolist()


def test_extreme_sizes(spark):
    v = [1.0, 2.0, -0.5, 0.25]
    scaled = [1.0, 1e200, 1e-200, 1e307, 5e-320, -1e200]
    df = spark.createDataFrame([(k, [s * c for c in v]) for k, s in enumerate(scaled)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in lattice.near_duplicates(df).collect()}
    assert [got[k]["n_links"] for k in range(6)] == [4, 4, 4, 4, 4, 0]
    assert [got[k]["component_id"] for k in range(6)] == [0, 0, 0, 0, 0, 5]


def test_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(80, 24))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.05, np.tile(base[3], (25, 1))])
    rows = [(k, v.tolist(), "a") for k, v in enumerate(x)]
    rows += [(1000, None, "a"), (1001, [], None), (1002, [0.0] * 24, "a"), (1003, [None, *[1.0] * 23], "a"), (1004, [float("inf")] * 24, "b")]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in op8_lattice_dedup(spark, str(tmp_path)).collect()}
    n, root = brute(x)
    assert len(got) == len(rows)
    for k in range(len(x)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (n[k], root[k], root[k] == k)
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(1000, 1005))
