"""The registered query: its fit against counts made by hand, letters by Unicode category, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import language  # noqa: E402
from indipanel.llm.queries import op5_language_id  # noqa: E402

SYLLABLES = {"aa": "ka lo mi ne pu".split(), "bb": "sch ert ung ich ein".split(), "cc": "ção lhe nha por que".split()}


def say(lang, seed, n=30):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    names = sorted(SYLLABLES)
    made = [(k, say(names[k % 3], k), names[k % 3], "s", 0) for k in range(240)]
    odd = ["½ ² ① Ⅷ 7_", "١٢٣", "", None, "12 – !", "名"]
    return made + [(1000 + k, t, None, "s", 0) for k, t in enumerate(odd)] + [(None, say("aa", 5), "bb", "s", 0), made[7], made[7]]


def test_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = op5_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for k in range(240):
        assert by[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert by[k]["lang_pred"] == sorted(SYLLABLES)[k % 3] and 0.5 < by[k]["score"] <= 1
    assert by[None]["lang_pred"] == "aa" and not by[None]["held_out"]
    assert [(by[1000 + k]["lang_pred"] == "und", by[1000 + k]["score"] == 0) for k in range(6)] == [(True, True)] * 5 + [(False, False)]


def test_fit_counts_like_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    model = language.fit(df)
    counts = np.zeros((3, language.SLOTS))
    for doc_id, text, lang, *_ in rows:
        if doc_id is not None and text is not None and lang and zlib.crc32(str(doc_id).encode()) % 5:
            slots = language.gram_slots(np.frombuffer(text.encode(), np.uint8))
            np.add.at(counts[sorted(SYLLABLES).index(lang)], slots, 1)
    shared = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * language.SLOTS)
    smooth = counts + 200.0 * shared + 1e-3
    assert model.languages == sorted(SYLLABLES)
    np.testing.assert_allclose(model.loglik, np.log(smooth / smooth.sum(1, keepdims=True)).T, rtol=1e-5)
