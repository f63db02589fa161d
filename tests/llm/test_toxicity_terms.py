"""Every term of the labelled examples counts, and either label has its share of them."""

import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import toxicity  # noqa: E402


def usable(n):
    import zlib
    return [k for k in range(n) if zlib.crc32(str(k).encode()) % 5]


def test_equal_text_is_the_nearest_whatever_its_words(spark):
    ids = usable(900)[:600]
    rows = [(k, f"common filler text only{k} rare{k}") for k in ids] + [(2000, f"only{ids[7]} rare{ids[7]}"), (2001, f"rare{ids[9]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in ids], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(df, toxicity.fit(df, labels)).collect()}
    for k in ids:
        assert got[k]["evidence"][0]["doc_id"] == k and got[k]["evidence"][0]["cosine"] == pytest.approx(1)
    assert got[2000]["evidence"][0]["doc_id"] == ids[7] and got[2001]["evidence"][0]["doc_id"] == ids[9]


def test_scripts_without_blanks(spark):
    bad, good = "他说坏话骂人", "天气很好出去"
    ids = usable(120)
    rows = [(k, "".join(chr(0x4e00 + 37 * k + j) for j in range(5)) + (bad if k % 2 else good)) for k in ids]
    df = spark.createDataFrame(rows + [(900, "昨天" + bad + "了"), (901, "昨天" + good + "了")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(df, toxicity.fit(df, labels)).collect()}
    assert (got[900], got[901]) == (1, 0)


def test_rare_label_is_sampled_whole(spark):
    ids = usable(1000)
    df = spark.createDataFrame([(k, f"some text word{k}") for k in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 40 == 0)) for k in ids], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, examples=100)
    toxic = sum(k % 40 == 0 for k in ids)
    assert len(model.labels) == 100 and model.labels.sum() == toxic and model.base == pytest.approx((toxic + 0.5) / (len(ids) + 1))


@pytest.mark.parametrize("short", [0, 10 ** 9])
def test_bounds_change_no_neighbour(monkeypatch, short):
    import numpy as np
    monkeypatch.setattr(toxicity, "_SHORT", short)
    rng, terms = np.random.default_rng(3), 300

    def vector():
        ids = np.unique(rng.zipf(1.3, 60).clip(1, terms) - 1)
        weights = rng.random(len(ids)) ** 4
        return ids, weights / np.sqrt((weights ** 2).sum())

    rows = [vector() for _ in range(700)]
    rows += rows[:50]                                                   # ties
    index = toxicity.Index.of(rows, terms)
    dense = np.zeros((len(rows), terms))
    for k, (ids, weights) in enumerate(rows):
        dense[k, ids] = weights
    for leave in [-1] * 60 + list(range(60)):
        ids, weights = rows[leave] if leave >= 0 else vector()
        asked = np.zeros(terms)
        asked[ids] = weights
        cosines = dense @ asked
        order = [k for k in np.lexsort((np.arange(len(rows)), -cosines.round(12))) if k != leave][:15]
        near, found = index.nearest(ids, weights, 15, leave)
        assert np.allclose(found, cosines[order]) and np.allclose(cosines[near], cosines[order]) and leave not in near
