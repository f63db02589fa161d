"""Byte-level BPE: encoding with the tokenizers library, decoding through the byte table."""

from __future__ import annotations

import base64
import codecs
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import map_texts, text_buffer
from .subwords import PieceEncoder

RANKS = "byte_bpe_multi_50k.tiktoken"

# Bytes of text worked on at once, and ids decoded at once: the work arrays take 20 to 30 times as much.
SLICE_BYTES = 1 << 20
STEP_IDS = 1 << 18


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizer of the tokenizers library for ranks of byte strings.

    Two neighbours may merge if their bytes together are a token, the lowest token first; so
    every split of a token into two tokens is a merge with the token's rank. A whole match that
    is a token is taken as it is.
    """
    to = byte_characters()
    name = {token: "".join(to[b] for b in token) for token in ranks}
    merges = [(rank, i, token) for token, rank in ranks.items() for i in range(1, len(token))
              if token[:i] in ranks and token[i:] in ranks]
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level]}, "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {name[token]: rank for token, rank in ranks.items()},
                  "merges": [[name[t[:i]], name[t[i:]]] for _, i, t in sorted(merges)]}})


class ByteTable:
    """The bytes of each id, from the vocabulary's characters."""

    def __init__(self, vocab: dict[str, int]):
        back = {c: b for b, c in enumerate(byte_characters())}
        tokens = [b""] * (max(vocab.values(), default=-1) + 1)
        for name, i in vocab.items():
            tokens[i] = bytes(back[c] for c in name)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """All bytes of the ids, one after the other."""
        parts = [np.zeros(0, np.uint8)]
        for i in range(0, len(ids), STEP_IDS):
            some = ids[i: i + STEP_IDS]
            counts = self.sizes[some]
            ends = np.cumsum(counts)
            parts.append(self.flat[np.repeat(self.firsts[some] - (ends - counts), counts) + np.arange(ends[-1])])
        return np.concatenate(parts)

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text piece by piece; a character whose bytes are in several ids comes with the last of them."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield decoder.decode(self.decode(np.array([i])).tobytes())
        yield decoder.decode(b"", True)


def offsets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of tokens in code points, from a text's bytes and the tokens' last bytes + 1.

    A token that holds part of a character covers the whole character.
    """
    begun = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # characters begun before each byte
    starts = np.append(0, ends)[:-1]
    inside = np.append((data & 0xC0) == 0x80, False)
    return begun[starts] - inside[starts], begun[ends]


def encode(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", path: str | None = None,
           pattern: str | None = None, with_offsets: bool = False, with_decoded: bool = True) -> DataFrame:
    """The columns ``keep``, ids (little-endian unsigned 32-bit integers), and what is asked for of
    decoded (the bytes of the ids) and offsets (start and end of each id in code points).

    A null text is empty and has no ids. Special tokens do not exist. Repeated rows repeat
    their result; columns not named are not read.
    """
    path = path or public_tokenizers.path(RANKS)
    definition = tokenizer_json(read_ranks(path), pattern or public_tokenizers.PATTERN)
    fields = [T.StructField("ids", T.BinaryType())]
    if with_decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    if with_offsets:
        fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "ends")]

    def make():
        tokenizer = Tokenizer.from_str(definition)
        encoder, table = PieceEncoder(tokenizer), ByteTable(tokenizer.get_vocab())

        def binary(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
            return pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1,
                [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(flat))])

        def fill(texts: pa.Array) -> list[pa.Array]:
            data, bounds = text_buffer(texts)
            ids, at = encoder.encode(data, bounds)
            out = [binary(ids.astype("<u4"), at * 4)]
            if with_decoded:
                sizes = np.append(0, np.cumsum(table.sizes[ids]))
                out.append(binary(table.decode(ids), sizes[at]))
            if with_offsets:
                spans = [offsets(data[a:b], np.cumsum(table.sizes[ids[i:j]]))
                         for a, b, i, j in zip(bounds, bounds[1:], at, at[1:])]
                out += [pa.array([s[k].astype(np.int32) for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
            return out
        return fill

    return map_texts(df, text, fields, make, list(keep), SLICE_BYTES)


def decode(df: DataFrame, ids: str = "ids", keep: list[str] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The columns ``keep`` and decoded, the bytes of a binary column of ids; null ids are empty."""
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    to = byte_characters()
    vocab = {"".join(to[b] for b in token): rank for token, rank in ranks.items()}

    def run(batches):
        table = ByteTable(vocab)
        for batch in batches:
            done = [table.decode(np.frombuffer(x or b"", "<u4")).tobytes() for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(done, pa.binary())],
                                             names=[*keep, "decoded"])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("decoded", T.BinaryType())])
    return df.select(*keep, ids).mapInArrow(run, schema)
