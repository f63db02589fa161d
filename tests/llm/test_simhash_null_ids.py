"""Near-dedup keeps one document of each component, also where ids do not tell components apart."""

import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import simhash  # noqa: E402


def test_one_document_per_component(spark):
    unlike = [" ".join(f"{w}{k}" for k in range(40)) for w in ("river", "stone", "cloud", "light")]
    rows = [(None, unlike[0]), (None, unlike[0]), (None, unlike[1]), (5, unlike[2]), (5, unlike[3]), (9, unlike[2]), (None, unlike[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, simhash.without_near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, unlike[0]), (None, unlike[1]), (5, unlike[2]), (5, unlike[3])], key=str)
