"""Labels that change inside a text, the fit behind them, and the registered query against brute force."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

pytest.importorskip("indipanel.llm")

from indipanel.llm import lines  # noqa: E402
from indipanel.llm.queries import op9_line_quality  # noqa: E402

MENU = ["Home", "About us", "Log in", "Contact", "Terms of use", "Click here", "Products", "News", "Search", "Cart"]


def prose(seed, n=14):
    rng = random.Random(seed)
    said = " ".join("".join(rng.choice("ka lo mi ne pu ta so".split()) for _ in range(rng.randint(1, 4))) for _ in range(n))
    return said.capitalize() + "."


def junk(seed):
    return " ".join(w + "###" for w in prose(seed).split())


@pytest.fixture(scope="module")
def tables(spark):
    rows, quality = [], []
    for k in range(160):
        good = k % 4 > 0
        body = [prose(100 * k + j) if good else junk(100 * k + j) for j in range(4 + k % 5)]
        rows.append((k, "\n".join([*body, *(MENU[:3] if k % 2 else [])]), "s", "en", 0))
        quality.append((k, int(good), 0))
    long = "\n".join(prose(10 ** 6 + j) for j in range(3 * lines.CHAIN + 5))
    rows += [(900, None, None, None, 0), (901, "", "s", "en", 0), (902, long, "s", "en", 0), (902, long, "s", "en", 0),
             (None, "\n".join([*MENU, *[prose(-j) for j in range(1, 11)]]), "s", "en", 0)]
    quality += [(902, 1, 0), (901, 1, 0), (None, 0, 0), (3, None, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int"),
            spark.createDataFrame(quality, "doc_id long, quality int, toxic int"))


def test_labels_change_inside_a_text(tables):
    field = lines.fit(*tables)
    mixed = lines.counts_of("\n".join([*MENU, *[prose(-50 - j) for j in range(10)]]))
    assert field.viterbi(mixed.features).tolist() == [0] * 10 + [1] * 10
    assert field.content_share(mixed) == pytest.approx(mixed.sizes[10:].sum() / mixed.sizes.sum())
    turned = lines.counts_of("\n".join([*[prose(-80 - j) for j in range(5)], *[junk(j) for j in range(5)], *[prose(-90 - j) for j in range(5)]]))
    assert field.viterbi(turned.features).tolist() == [1] * 5 + [0] * 5 + [1] * 5
    assert 0 < field.content_share(turned) < 1


def test_fit_sees_every_line(tables):
    docs, labels = tables
    whole = next(r["text"] for r in docs.collect() if r["doc_id"] == 902)
    found = lines.counts_of(whole, hashed=True)
    example = lines.Example(found.features, found.sizes, np.zeros(len(found.sizes), bool), 1)
    chains = lines.Chains([example, lines.Example(found.features[:2], found.sizes[:2], np.zeros(2, bool), 0)])
    assert len(chains.flat) == 3 * lines.CHAIN + 5 + 2 and chains.opens.sum() == 2
    assert sorted(chains.sizes[chains.doc == 0].tolist()) == sorted(found.sizes.tolist())


def test_expected_labels_like_all_labellings():
    rng = np.random.default_rng(3)
    f = rng.random((5, lines.N_FEATURES))
    field = lines.Field(rng.normal(size=lines.N_FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2))
    chains = lines.Chains([lines.Example(f, np.ones(5), np.zeros(5, bool), 1), lines.Example(f[:1], np.ones(1), np.zeros(1, bool), 0)])
    single, pair = chains.expected(field)
    weight = {}
    for m in range(32):
        y = [m >> k & 1 for k in range(5)]
        weight[tuple(y)] = np.exp(field.begin[y[0]] + sum(f[k] @ field.emit * y[k] for k in range(5))
                                  + sum(field.move[a, b] for a, b in zip(y, y[1:])))
    total = sum(weight.values())
    for k in range(5):
        assert single[k, 1] == pytest.approx(sum(w for y, w in weight.items() if y[k]) / total)
    for k in range(4):
        assert pair[k, 1, 0] == pytest.approx(sum(w for y, w in weight.items() if y[k] and not y[k + 1]) / total)


def test_document_labels_bound_the_share():
    odds = np.array([2.0, -2.0, -2.0, -2.0] * 2 + [2.0, -2.0])
    flat = np.zeros((4, lines.N_FEATURES))
    make = lambda n, label: lines.Example(flat[:n], np.ones(n), np.zeros(n, bool), label)
    chains = lines.Chains([make(4, 1), make(4, 0), make(2, 0)])
    got = chains.held_to_labels(odds)
    share = np.bincount(chains.doc, got * chains.sizes) / np.bincount(chains.doc, chains.sizes)
    free = 1 / (1 + np.exp(-odds))
    assert share[0] == pytest.approx(lines.GOOD_SHARE, abs=1e-6)          # too little: raised to the bound
    assert share[2] == pytest.approx(lines.BAD_SHARE, abs=1e-6)           # too much: lowered
    assert got[chains.doc == 1].tolist() == pytest.approx(np.minimum(free[4:8], got[chains.doc == 1]).tolist())
    assert (np.diff(got[chains.doc == 0])[:1] < 0).all()                  # the order of the lines stays


def test_common_lines_like_brute_force(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["", " \t", *MENU, prose(rng.randint(0, 40))]) for _ in range(rng.randint(0, 12))) for _ in range(120)]
    texts += ["copied\nthrice\nover"] * 60 + [None, "", "lone"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    before, behind = defaultdict(set), defaultdict(set)
    for t in texts:
        said = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        for a, b in zip([None, *said], [*said, None]):
            before[b].add(a)
            behind[a].add(b)
    name = {x: xxhash.xxh64_intdigest(x.encode(), 42) for x in {*before, *behind} - {None}}
    for least in (2, 8):
        brute = {h for x, h in name.items() if max(len(before[x]), len(behind[x])) >= least}
        hashes = spark.createDataFrame([(int(np.uint64(h).astype(np.int64)),) for h in name.values()], "line long")
        got = {r["line"] % (1 << 64) for r in lines.common_lines(df, hashes, least).collect()}
        assert got == brute
        assert name["copied"] not in got


def test_query_like_brute_force(spark, tables, tmp_path):
    docs, labels = tables
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = op9_line_quality(spark, str(tmp_path)).collect()
    assert len(got) == docs.count()
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]])
        said = [x for x in text[r["doc_id"]].split("\n") if x.split()]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        times = defaultdict(int)
        for w in windows:
            times[w] += 1
        inside = {i + d for i, w in enumerate(windows) if times[w] > 1 for d in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(said) - len(set(said)), len(inside))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text[r["doc_id"]])
        assert r["base_failed"] == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
        assert r["kept"] == (not r["base_failed"] and r["content_share"] >= lines.CONTENT_SHARE)
    out = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 160 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert out and all((r["content_share"] >= 0.5) == (r["doc_id"] % 4 > 0) for r in out)
    assert any(0 < r["content_share"] < 1 for r in got)
