"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch, small_batches

# A word: a run of characters that are neither blank nor \t..\r.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that one step of a task works on; a longer text is a step of its own.
SLICE_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read from there.

    Cuts the lineage at files that outlive any executor; used where a result is read
    more than once. The schema is given, so that an empty result can be read too.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[slice]:
    """Consecutive parts of a column of texts with about ``limit`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield slice(a, b)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the n + 1 bounds of the texts (null: empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]: bounds[-1]], bounds - bounds[0]


def map_texts(df: DataFrame, text: str, fields: list[T.StructField],
              make: Callable[[], Callable[[pa.Array], list[pa.Array]]], keep: list[str],
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` and ``fields``, which a function of Arrow text batches fills.

    make  called once in each task; gives the function from a slice of the text column to
          one array per field

    Neither the rows of a task nor a whole Arrow batch are worked on at once, only
    slices of it, so that memory is bounded by the longest text. A text that is kept too is sent once.
    """
    small_batches(df.sparkSession)
    schema = T.StructType([*[df.schema[c] for c in keep], *fields])
    arrow = to_arrow_schema(schema)
    n_kept = len(keep)
    sent = text in keep and df.schema[text].dataType == T.StringType()
    place = keep.index(text) if sent else n_kept

    def run(batches):
        fill = make()
        for batch in batches:
            texts, kept = batch.column(place), batch.select(list(range(n_kept)))
            for part in slices(texts, slice_bytes):
                rows = kept.slice(part.start, part.stop - part.start)
                made = fill(texts.slice(part.start, part.stop - part.start))
                columns = [c.cast(f.type) for c, f in zip([*rows.columns, *made], arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            # what a batch needed goes back to the system, as workers live on and share their executor's memory
            del batch, texts, kept
            pa.default_memory_pool().release_unused()

    picked = [F.col(f"`{c}`") for c in keep] + ([] if sent else [F.col(text).cast("string").alias("_text")])
    return df.select(*picked).mapInArrow(run, schema)


class Remembered:
    """Results of a function of byte strings, at most ``limit`` of them at any time.

    Half of the limit is for new results; when it is full, the older half is forgotten. Results
    that are asked for again move to the new half, so that frequent strings stay.
    """

    def __init__(self, limit: int):
        self.half = max(limit // 2, 1)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def find(self, key: bytes) -> bytes | None:
        value = self.new.get(key)
        if value is None:
            value = self.old.pop(key, None)
            if value is not None:
                self.add(key, value)
        return value

    def find_all(self, keys: list[bytes]) -> list[bytes | None]:
        found = list(map(self.new.get, keys))
        for k, value in enumerate(found):
            if value is None:
                found[k] = self.find(keys[k])
        return found

    def add(self, key: bytes, value: bytes) -> None:
        if len(self.new) >= self.half:
            self.new, self.old = {}, self.new
        self.new[key] = value

    def get(self, key: bytes, make: Callable[[bytes], bytes], longest: int) -> bytes:
        """The result for a key, remembered unless the key has more than ``longest`` bytes."""
        value = self.find(key)
        if value is None:
            value = make(key)
            if len(key) <= longest:
                self.add(key, value)
        return value


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; false for a missing id, which is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_ids(rows: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """At most ``limit`` different ids, those with the smallest hashes: the bounded sample of a fit."""
    ids = rows.filter(F.col(key).isNotNull()).select(key).distinct()
    return ids.orderBy(F.xxhash64(F.col(key), F.lit("sample")), key).limit(limit)
