"""The filter audit against counting by hand."""

import random
import re
from itertools import permutations

import pytest

from indipanel.llm import filter_audit, queries
from indipanel.llm.filter_audit import LETTERS, exclusive_sizes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def failing(doc_id, text, docs):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    same = [d for d, t, *_ in docs if (t or "") == text and d is not None and doc_id is not None and d < doc_id]
    return out + ("E" if same else "")


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [(s or "", d, set(failing(d, t, docs))) for d, t, _, s, _ in docs]
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        share = dict.fromkeys(LETTERS, 0)
        for order in permutations(LETTERS):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                share[f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in r[1] and bool(r[1] & set(order[: step - 1])) for r in mine),
                    sum(r[1] == {f} for r in mine), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f)
        for key in [k for k in out if k[0] == part]:
            out[key] = (*out[key][:6], share[out[key][6]])
    return out


def hand_made():
    rnd = random.Random(5)
    texts = [None, "", " \t", "one word", "SHOUT", "a # b", "the " * 300, " ".join(f"w{n}" for n in range(250)),
             " ".join(f"W{n}" for n in range(250)), " ".join(f"w{n}" for n in range(210)) + " | end", "é" * 50 + "A"]
    docs = [(n // 2 if n % 7 == 0 else n, rnd.choice(texts), "en", rnd.choice(["hot", "hot", "b", None, ""]), 1)
            for n in range(160)]
    docs += [(None, "one word", "en", "hot", 1), (None, "one word", None, "b", None), (3, "one word", "en", "hot", 1),
             (3, "one word", "en", "hot", 1), (10 ** 12, "a # b", "en", "far", 1)]
    labels = [(n, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for n in range(0, 160, 2)]
    return docs, labels + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]


def written(spark, folder, docs, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_query_equals_counting(spark, tmp_path):
    docs, labels = hand_made()
    got = queries.op11_filter_audit(spark, written(spark, str(tmp_path), docs, labels)).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute(docs, labels) and len(got) == 600 * 4


@pytest.mark.parametrize("range_bits", [0, 2, 5])
def test_id_ranges_change_nothing(spark, range_bits):
    docs, labels = hand_made()
    got = filter_audit.text_filter_audit(spark.createDataFrame(docs, DOCS).repartition(3),
                                         spark.createDataFrame(labels, LABELS), range_bits)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == brute(docs, labels)


def test_lists_are_sorted_and_no_longer_than_a_range(spark, tmp_path):
    rows = spark.range(1000).selectExpr("'p' AS part", "id % 3 = 0 AS A", "true AS B")
    rows.write.parquet(str(tmp_path / "rows"))
    lists = filter_audit.posting_lists(spark.read.parquet(str(tmp_path / "rows")), "part", ["A", "B"], 4).collect()
    assert sum(r.n_rows for r in lists) == 1000 == sum(len(r.B) for r in lists)
    assert all(r.n_rows <= 16 and r.A == sorted(r.A) and set(r.A) <= set(r.B) for r in lists)


def test_exclusive_sizes_equal_sets():
    rnd = random.Random(2)
    for _ in range(400):
        lists = [sorted(rnd.sample(range(60), rnd.choice([0, 1, 5, 30, 60]))) for _ in range(rnd.randint(1, 5))]
        want = [0] * (1 << len(lists))
        for i in range(60):
            want[sum(1 << k for k, ids in enumerate(lists) if i in ids)] += 1
        assert exclusive_sizes(lists)[1:] == want[1:]


def test_a_leap_passes_a_range_of_one_list():
    class Counted(list):
        looks = 0

        def __getitem__(self, i):
            Counted.looks += 1
            return super().__getitem__(i)

    sizes = exclusive_sizes([Counted(range(100_000)), [99_999]])
    assert sizes == [0, 99_999, 0, 1] and Counted.looks < 100


def test_empty_tables_and_clashing_names(spark):
    docs, labels = hand_made()
    none = spark.createDataFrame([], DOCS)
    said = spark.createDataFrame(labels, LABELS)
    assert filter_audit.text_filter_audit(none, said).count() == 0
    more = spark.createDataFrame(docs, DOCS)
    for c in ("A", "part", "good", "text_hash", "_id", "_text", "_first", "flags", "a.b"):
        more = more.withColumn(c, more["lang"])
    got = filter_audit.text_filter_audit(more, spark.createDataFrame([], LABELS)).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute(docs, [])
