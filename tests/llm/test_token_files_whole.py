"""Ids are those of the library for whole texts: special strings, and capitals that compose with marks."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("indipanel.llm")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from indipanel.llm import token_files  # noqa: E402
from indipanel.llm.common import text_buffer  # noqa: E402
from indipanel.llm.subwords import PieceEncoder  # noqa: E402

TEXTS = ["one<|endoftext|>two Three<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|> <|endof", "text|> x <|endoftext|><|endoftext|>.",
         "a H̱ T̈b W̊ Y̊Z J̌ É é", "<|endoftext|≯ ≠ A", "H", "̱ plain", "ÀÉ Ünder PLAIN", "", None]


def test_ids_of_whole_texts():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert 49407 in want[0] and 49406 in want[0]
    encoder = PieceEncoder(Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY)), fold_ascii=True, special=True)
    ids, at = encoder.encode(*text_buffer(pa.array(TEXTS)))
    assert [x.tolist() for x in np.split(ids, at[1:-1])] == want


def test_written_ids(spark):
    import zlib
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids_crc32"] for r in token_files.read_token_files(token_files.write_token_files(docs)).collect()}
    for k, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[k] == zlib.crc32(np.array(ids, "<u4").tobytes())
