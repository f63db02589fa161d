"""Token-id output: checksummed blocks of range-coded ids, each readable on its own.

A block: magic "TIB1", then as little-endian unsigned integers the number of ids (32 bits), of
entries (32 bits), the largest id allowed (32 bits), the crc32 of the ids (32 bits) and of
the entries (32 bits), the entries, and the code. An entry is a document that
ends in this block: its id (64 bits signed), whether it has one (8 bits), and how many ids
it has in all blocks (64 bits). Blocks lie in Parquet files, whose commits survive lost tasks.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import small_batches
from .common import kept_table, slices, text_buffer
from .range_coder import BLOCK_IDS, LANES, decode_blocks, encode_blocks
from .subwords import PieceEncoder

VOCABULARY = "word_bpe_49k.json"

# Bytes of text cut into pieces and written at once: the work arrays take 20 to 30 times as much.
SLICE_BYTES = 1 << 20

# Bytes of text whose different pieces are looked up together: they are held as pieces, about four times as much.
GROUP_BYTES = 16 << 20

# Pieces a worker remembers: rare words make up most of a text's different pieces, and their encoding most of its time.
REMEMBERED = 600_000

BLOCKS = "shard int, block long, payload binary"

_HEAD = "<4sIIIII"
_ENTRY = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("n_ids", "<u8")])


def pack(blocks: list[tuple[np.ndarray, np.ndarray]], max_id: int) -> list[bytes]:
    """Payloads of (ids, entries)."""
    out = []
    for (ids, entries), code in zip(blocks, encode_blocks([ids for ids, _ in blocks], max_id)):
        table = entries.tobytes()
        out.append(struct.pack(_HEAD, b"TIB1", len(ids), len(entries), max_id, zlib.crc32(ids.astype("<u4").tobytes()),
                              zlib.crc32(table)) + table + code)
    return out


def unpack(payloads: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, entries) of payloads; ValueError if one is damaged."""
    heads = [struct.unpack_from(_HEAD, p) for p in payloads]
    tables = [p[struct.calcsize(_HEAD): struct.calcsize(_HEAD) + h[2] * _ENTRY.itemsize] for p, h in zip(payloads, heads)]
    if any(h[0] != b"TIB1" or zlib.crc32(t) != h[5] for h, t in zip(heads, tables)):
        raise ValueError("damaged block of token ids")
    out: list = [None] * len(payloads)
    for max_id in {h[3] for h in heads}:
        at = [k for k, h in enumerate(heads) if h[3] == max_id]
        made = decode_blocks([payloads[k][struct.calcsize(_HEAD) + len(tables[k]):] for k in at], [heads[k][1] for k in at], max_id)
        for k, ids in zip(at, made):
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[k][4]:
                raise ValueError("damaged block of token ids")
            out[k] = ids, np.frombuffer(tables[k], _ENTRY)
    return out


def blocks_of(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Sets of up to LANES blocks from consecutive (ids, entries whose n_ids add up to them)."""
    ids, entries, before = np.zeros(0, np.uint32), np.zeros(0, _ENTRY), 0  # before: ids of the first entry already out

    def take(n_blocks: int):
        nonlocal ids, entries, before
        ends = np.cumsum(entries["n_ids"].astype(np.int64)) - before
        out, done = [], 0
        for b in range(n_blocks):
            upto = int(np.searchsorted(ends, min((b + 1) * BLOCK_IDS, len(ids)), side="right"))
            out.append((ids[b * BLOCK_IDS: (b + 1) * BLOCK_IDS], entries[done:upto]))
            done = upto
        used = min(n_blocks * BLOCK_IDS, len(ids))
        before = used - (int(ends[done - 1]) if done else -before)
        ids, entries = ids[used:], entries[done:]
        return out

    for more_ids, more in parts:
        ids, entries = np.concatenate([ids, more_ids]), np.concatenate([entries, more])
        while len(ids) >= LANES * BLOCK_IDS:
            yield take(LANES)
    if len(entries):
        yield take(max(-(-len(ids) // BLOCK_IDS), 1))


_encoders: dict[tuple, tuple[PieceEncoder, int]] = {}


def encoder_of(path: str) -> tuple[PieceEncoder, int]:
    """The encoder of a tokenizer's file and its largest id; a worker keeps it for its next tasks, one file at a time."""
    state = os.stat(path)
    key = path, state.st_mtime_ns, state.st_size
    if key not in _encoders:
        _encoders.clear()
        tokenizer = Tokenizer.from_file(path)
        _encoders[key] = PieceEncoder(tokenizer, fold_ascii=True, remembered=REMEMBERED, special=True), tokenizer.get_vocab_size() - 1
    return _encoders[key]


def write_token_files(df: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text",
                      end_id: int = 2, name: str = "token_files") -> DataFrame:
    """Writes the ids of all texts, an end id behind each, in the order of doc_id; gives the stored blocks.

    Shards follow each other in doc_id order, and so do blocks within a shard. A null text is
    empty and has the end id alone; a null doc_id comes first; rows with equal doc_id go
    by text. The ids are those of the file's tokenizer without its post-processor: a special token's string in a
    text is that token, and no other special tokens are made. Columns not named are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        encoder, largest = encoder_of(path)
        max_id, shard = max(largest, end_id), TaskContext.get().partitionId()

        def encoded(cuts, tables):
            for (ids, at), entries in zip(encoder.encode_all(cuts), tables):
                entries["n_ids"] = np.diff(at) + 1
                yield np.insert(ids, at[1:], np.uint32(end_id)), entries

        def parts():
            cuts, tables, held = [], [], 0
            for batch in batches:
                for part in slices(batch.column(1), SLICE_BYTES):
                    rows = batch.slice(part.start, part.stop - part.start)
                    entries = np.zeros(rows.num_rows, _ENTRY)
                    entries["doc_id"] = rows.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                    entries["named"] = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
                    data, bounds = text_buffer(rows.column(1))
                    cuts.append(encoder.cut(data, bounds))
                    tables.append(entries)
                    held += len(data)
                    if held >= GROUP_BYTES:
                        yield from encoded(cuts, tables)
                        cuts, tables, held = [], [], 0
            if cuts:
                yield from encoded(cuts, tables)

        block = 0
        for some in blocks_of(parts()):
            payloads = pack(some, max_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(payloads), pa.int32()), pa.array(range(block, block + len(payloads)), pa.int64()),
                 pa.array(payloads, pa.binary())], names=["shard", "block", "payload"])
            block += len(payloads)

    small_batches(df.sparkSession)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return kept_table(ordered.mapInArrow(run, BLOCKS), name)


def read_token_files(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the blocks.

    The blocks of a shard are decoded in their order, LANES of them at a time.
    """
    def run(batches):
        crc, so_far, at, current = 0, 0, 0, None

        def decoded(rows):
            nonlocal crc, so_far, at
            out = []
            for (_, _), (ids, entries) in zip(rows, unpack([p for _, p in rows])):
                raw, place = ids.astype("<u4").tobytes(), 0
                for entry in entries:
                    n, rest = int(entry["n_ids"]), int(entry["n_ids"]) - so_far
                    crc = zlib.crc32(raw[place * 4: (place + rest) * 4], crc)
                    out.append((current, int(entry["doc_id"]) if entry["named"] else None, at, n, crc))
                    place, at, so_far, crc = place + rest, at + n, 0, 0
                crc, so_far = zlib.crc32(raw[place * 4:], crc), so_far + len(ids) - place
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=names)

        names = ["shard", "doc_id", "place", "n_tokens", "ids_crc32"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        waiting: list = []
        for batch in batches:
            for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if waiting and (shard != current or len(waiting) == LANES):
                    yield decoded(waiting)
                    waiting = []
                if shard != current:
                    crc, so_far, at, current = 0, 0, 0, shard
                waiting.append((shard, payload))
        if waiting:
            yield decoded(waiting)

    small_batches(blocks.sparkSession)
    ordered = blocks.repartition("shard").sortWithinPartitions("shard", "block").select("shard", "payload")
    docs = kept_table(ordered.mapInArrow(run, "shard int, doc_id long, place long, n_tokens long, ids_crc32 long"), "read_ids")
    # One row per shard: the window over all of them is small.
    totals = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("shard", before.alias("base"))
    return docs.join(bases, "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
