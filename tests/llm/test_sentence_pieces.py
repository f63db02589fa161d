"""SentencePiece encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from indipanel.llm import queries, sentence_pieces
from indipanel.llm.common import Remembered
from indipanel.llm.sentence_pieces import MODEL, Model, SentencePieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return SentencePieces(Model.read(PATH))


def some_text(rnd, pieces):
    odd = ["a", " ", "  ", "\n", "the", "▁", "é", "漢字", "\U0001F600", "\t", "<s>", "</s>", "<0x0A>", "<unk>", "\0", "1",
           "23", "ing", "�", " ⁇ ", "é", "//", "=====", "    ", "\r\n"]
    kind = rnd.random()
    if kind < 0.3:
        return "".join(rnd.choice(odd) for _ in range(rnd.randint(0, 40)))
    if kind < 0.7:
        return "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))
    if kind < 0.8:
        return " " * rnd.randint(0, 120) + rnd.choice(["", "x", " the"])
    if kind < 0.9:
        return "".join(rnd.choice("abeinrst_=.- ") for _ in range(rnd.randint(0, 80)))
    return "".join(chr(rnd.choice([rnd.randint(1, 0x500), rnd.randint(0x4E00, 0x4FFF), rnd.randint(0x10000, 0x10FFFF)]))
                   for _ in range(rnd.randint(0, 20)))


def texts(n, seed=3):
    rnd, pieces = random.Random(seed), [p.replace("▁", " ") for p in Model.read(PATH).pieces[259:]]
    return [some_text(rnd, pieces) for _ in range(n)]


def test_ids_and_decoded_text_are_the_library_s(coder, library):
    said = [None, "", " ", "", *texts(3000), "x" * 5000, "", " " * 4000, "漢" * 999, "word " * 900]
    ids, at = coder.encode(pa.array(said, pa.string()))
    data, bounds = coder.decode(ids, at)
    want = library.encode([t or "" for t in said], add_bos=True, add_eos=True)
    for k, ids_of in enumerate(want):
        assert ids[at[k]: at[k + 1]].tolist() == ids_of, said[k]
        assert data[bounds[k]: bounds[k + 1]].tobytes().decode() == library.decode(ids_of), said[k]


def test_any_ids_decode_as_in_the_library(coder, library):
    rnd = random.Random(1)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), rnd.randrange(3), 3 + 0xE6, 3 + 0xBC, 3 + 0xA2, 28705])
               for _ in range(rnd.randint(0, 12))]
        got = coder.decode(np.array(ids, np.uint32), np.array([0, len(ids)]))[0].tobytes().decode()
        assert got == library.decode(ids), ids


def test_each_prefix_has_the_last_piece_of_its_own_encoding(coder, library):
    for text in texts(150, seed=8):
        text = text.replace(" ", "▁").replace("\n", "")
        table = coder.encoder.prefix_table("▁" + text)
        for n in range(len(text) + 1):
            ids = library.encode(text[:n].replace("▁", " ")) if n else [28705]
            if table[n + 1] >= 0:
                assert table[n + 1] == ids[-1], text[:n]


def test_one_piece_at_most_fits_behind_a_prefix(coder):
    encoder = coder.encoder
    for text in texts(100, seed=9):
        text = "▁" + text.replace(" ", "▁").replace("\n", "")
        last = encoder.prefix_table(text)
        fits = {}
        for end, (i, size) in encoder.matches.iter(text):
            before = last[end + 1 - size]
            ok = encoder.merges(i) is not None if before < 0 else encoder.compatible(before, i)
            fits[end] = fits.get(end, 0) + ok
        assert set(fits.values()) <= {1}


def test_remembered_results_stay_within_the_limit():
    memory = Remembered(10)
    for n in range(1000):
        assert memory.get(b"%d" % n, lambda k: k + b"!", 64) == b"%d!" % n and len(memory) <= 10
        assert memory.get(b"often", lambda k: b"x", 64) == b"x"
    assert memory.get(b"y" * 65, lambda k: b"long", 64) == b"long" and memory.find(b"y" * 65) is None
    assert memory.find(b"often") == b"x"


def test_query_equals_the_library(spark, tmp_path, library):
    docs = [(n, t, "en", "s", 1) for n, t in enumerate(texts(300, seed=4))]
    docs += [(None, "null id", None, None, None), (1000, None, "en", "s", 1), (7, docs[7][1], "en", "s", 1), (1001, "a b " * 20000, "", "", 1)]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")

    def digest(doc_id, text):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    got = queries.op13_sentence_pieces(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted((digest(d, t) for d, t, *_ in docs), key=key)


def test_round_trip_of_the_operators_and_clashing_names(spark):
    docs = spark.createDataFrame([(n, t, "en", "s", 1) for n, t in enumerate(texts(50, seed=5))], DOCS)
    docs = docs.withColumn("ids", F.lit(1)).withColumn("_text", F.lit("x"))
    coded = sentence_pieces.encode(docs, ["doc_id", "text"])
    back = sentence_pieces.decode(coded.select("doc_id", "ids", F.col("decoded").alias("want")), keep=["doc_id", "want"])
    assert all(r.decoded == r.want for r in back.collect())
    assert all(r.decoded == r.text.replace("▁", " ") for r in coded.collect())
    assert sentence_pieces.encode(spark.createDataFrame([], DOCS)).count() == 0
