"""Periodic runs against comparing all words at all distances."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from indipanel.llm import queries
from indipanel.llm.periodic_runs import SquareCatchers, find_runs, runs_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def all_runs(words):
    """{(start, end): smallest period} of all runs of two periods or more."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s >= q:
                out.setdefault((s, i + q), q)
            i += 1
    return out


def some_words(rnd, longest=80):
    words, letters = [], rnd.choice([1, 2, 2, 3, 5])
    while len(words) < rnd.randint(0, longest):
        one = [rnd.randrange(letters) for _ in range(rnd.randint(1, 12))]
        words += one * rnd.choice([1, 1, 2, 3, 6])
    return words


def caught(catchers):
    return {(s, e): q for s, e, q in catchers.runs().T.tolist()}


def test_catchers_equal_brute_force_however_words_are_appended():
    rnd = random.Random(1)
    for _ in range(400):
        words = some_words(rnd)
        catchers, at, step = SquareCatchers(), 0, rnd.choice([1, 3, 20, 1000])
        while at < len(words):
            to = at + rnd.randint(1, step)
            catchers.append(np.array(words[at:to]))
            at = to
            if rnd.random() < 0.05:
                assert caught(catchers) == all_runs(words[:at])
        assert caught(catchers) == all_runs(words)


def test_a_square_is_reported_by_the_word_that_completes_it():
    catchers, squares = SquareCatchers(), []
    for n, word in enumerate([7, 1, 2, 3, 1, 2, 3, 1, 9]):
        squares += [(n, p) for s, e, p in catchers.append(np.array([word])).T.tolist() if e == n + 1]
    assert squares == [(6, 3), (7, 3)]


def test_equal_fingerprints_alone_are_no_square():
    words = [0]
    for _ in range(13):                               # sums of powers modulo 2**64 cannot tell these blocks apart
        words += [1 - w for w in words]
    catchers = SquareCatchers()
    catchers.append(np.array(words))
    got = caught(catchers)
    assert got == {k: q for k, q in all_runs(words[:2048]).items() if k[1] < 2048} | {
        k: q for k, q in got.items() if k[1] >= 2048}
    for (s, e), q in got.items():
        assert words[s: e - q] == words[s + q: e] and e - s == 2 * q      # no overlaps in this sequence


def test_runs_of_several_sequences_do_not_touch():
    a, b = [1, 2, 1, 2, 1, 2, 1, 2], [1, 2] * 4
    found, bounds = runs_of([np.array(a), np.zeros(0, int), np.array(b), np.array([5])])
    assert found.T.tolist() == [[0, 8, 2], [0, 8, 2]] and bounds.tolist() == [0, 1, 1, 2, 2]
    assert runs_of([])[1].tolist() == [0] and runs_of([np.zeros(0, int)])[0].shape == (3, 0)


def expected(doc_id, text):
    """The contract, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted((s, e - s, q) for (s, e), q in all_runs(words).items() if e - s >= max(6, 4 * q))
    dropped = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n_},{q}\n" for s, n_, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def hand_made():
    rnd = random.Random(3)
    docs = [(n, " ".join(map(str, some_words(rnd))), "en", "s", 1) for n in range(300)]
    docs += [(None, "x " * 9, None, None, None), (400, None, "en", "s", 1), (401, "", "en", "s", 1), (402, " \t\n", "en", "s", 1),
             (403, "a\x0bb\x0ca\x0db a b\ta  b a b a b", "en", "s", 1), (404, "é è " * 5 + "  " * 7, "en", "s", 1),
             (5, "w " * 6, "en", "s", 1), (5, "w " * 6, "en", "s", 1), (406, "ab " * 5000 + "c", "en", "s", 1)]
    return docs


def test_query_equals_brute_force(spark, tmp_path):
    docs = hand_made()
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(d, t) for d, t, *_ in docs), key=key)
    assert any(zlib.crc32(str(d[0]).encode()) % 10 == 0 and d[1] for d in docs)


@pytest.mark.parametrize("exponent, least", [(2, 2), (3, 6)])
def test_other_limits_and_clashing_names(spark, exponent, least):
    docs = spark.createDataFrame(hand_made()[:60], DOCS).withColumn("runs", F.lit(1)).withColumn("_text", F.lit("x"))
    for row in find_runs(docs, ["doc_id", "text"], min_exponent=exponent, min_words=least).collect():
        words = row.text.split()
        want = sorted((s, e - s, q) for (s, e), q in all_runs(words).items() if e - s >= max(least, exponent * q))
        assert [tuple(r) for r in row.runs] == want and row.n_words == len(words)


def test_empty_table(spark):
    assert find_runs(spark.createDataFrame([], DOCS)).count() == 0
