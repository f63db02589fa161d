"""The code of a block is that of stored blocks, whatever the arithmetic behind it; pieces are looked up together."""

import zlib

import numpy as np
import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import range_coder, token_files  # noqa: E402
from indipanel.llm.common import Remembered  # noqa: E402


@pytest.mark.parametrize("max_id, crc", [(511, 3342789542), (49407, 1881269443), (1_300_000, 2549375476)])
def test_codes_of_stored_blocks(max_id, crc):
    n = np.arange(1500, dtype=np.int64)
    blocks = [b.astype(np.uint32) for b in (n[:700] ** 2 * 7919 % (max_id + 1), n % 5, n[:0], np.minimum(n[:90] ** 3, max_id),
                                            n * 31 % 17 * (max_id // 17))]
    codes = range_coder.encode_blocks(blocks, max_id)
    assert zlib.crc32(b"".join(codes)) == crc
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(codes, [len(b) for b in blocks], max_id)))


def test_counts_of_ranges_are_small_tables():
    # A step adds to one row of a group and to one number a group, not to a number of every range.
    model = range_coder._Model(4, 49407)
    assert model.starts.shape[0] + model.inner.shape[1] < 30
    for ids in (np.array([0, 511, 512, 49407]), np.array([5, 40000, 512, 49407])):
        model.predict()
        model.learn(ids)
    want = [np.bincount([i >> 9 for i in ids], minlength=97) * 24 + 1 for ids in ((0, 5), (511, 40000), (512, 512), (49407, 49407))]
    model.predict()
    for bucket in range(97):
        low, each = model.order0(np.full(4, bucket << 9))
        assert [(int(a), int(b)) for a, b in zip(low, each)] == [(int(w[:bucket].sum()) << 9, int(w[bucket])) for w in want]


def test_pieces_are_found_together():
    known = Remembered(4)
    for k in (b"a", b"b", b"c"):  # a and b are in the older half
        known.add(k, k * 2)
    assert known.find_all([b"c", b"a", b"x", b"c"]) == [b"cc", b"aa", None, b"cc"]
    assert b"a" in known.new and len(known) <= 4


def test_token_files_ask_for_small_batches(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    blocks = token_files.write_token_files(docs)
    assert spark.conf.get(limit, None) == "1000k"
    spark.conf.unset(limit)
    assert token_files.read_token_files(blocks).count() == 2
    assert spark.conf.get(limit, None) == "1000k"
