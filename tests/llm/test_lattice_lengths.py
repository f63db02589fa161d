"""Vectors of one length are linked with each other, whatever other lengths there are."""

import numpy as np
import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import lattice  # noqa: E402


def test_lengths(spark):
    rng = np.random.default_rng(12)
    base, short = rng.normal(size=(10, 16)), rng.normal(size=(4, 12))
    rows = [(k, base[k % 10].tolist()) for k in range(20)] + [(20, rng.normal(size=40).tolist()), (21, [])]
    rows += [(30 + k, short[k % 4].tolist()) for k in range(8)]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [(got[k]["n_links"], got[k]["component_id"]) for k in range(20)] == [(1, k % 10) for k in range(20)]
    assert [(got[k]["n_links"], got[k]["component_id"]) for k in range(30, 38)] == [(1, 30 + (k - 30) % 4) for k in range(30, 38)]
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in (20, 21)) and len(got) == len(rows)
