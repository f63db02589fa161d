"""Pieces are looked up once for many slices, plain words go to the library together, and a worker keeps its encoder."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("indipanel.llm")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from indipanel.llm import range_coder, token_files  # noqa: E402
from indipanel.llm.common import text_buffer  # noqa: E402
from indipanel.llm.subwords import PieceEncoder, WordTokenizer  # noqa: E402

PATH = public_tokenizers.path(token_files.VOCABULARY)
TEXTS = ["plain words\tin   ROWS", "straße über ÿ÷ö Ärger  naïve", "don't we'll <|endoftext|>x 12ab ab12", "", None,
         "été İstanbul ﬁn ΣΑΣ ª º µ", " \n\x0b\x0c\r ", " wide　gap \u0085next", "word" * 400]


def encoder(**more):
    return PieceEncoder(Tokenizer.from_file(PATH), fold_ascii=True, special=True, **more)


def test_parts_together_have_the_ids_of_the_library():
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    many = encoder(remembered=6)
    for _ in range(2):
        cuts = [many.cut(*text_buffer(pa.array(TEXTS[a:b], pa.string()))) for a, b in ((0, 3), (3, 3), (3, 5), (5, len(TEXTS)))]
        got = [x.tolist() for ids, at in many.encode_all(cuts) for x in np.split(ids, at[1:-1]) if len(at) > 1]
        assert got == want


def test_nothing_to_encode():
    empty = encoder()
    for texts in ([], [None, ""], [" ", None, "\n\t"]):
        [(ids, at)] = empty.encode_all([empty.cut(*text_buffer(pa.array(texts, pa.string())))])
        assert len(ids) == 0 and at.tolist() == [0] * (len(texts) + 1)


def test_plain_words_are_sent_together():
    words = WordTokenizer(Tokenizer.from_file(PATH))
    pieces = [" einpflichst", "\nüberall", "x", " 12", "don't", " Äpfel", "á", " ab "]
    pieces, ids = [p.encode() for p in pieces], [None] * len(pieces)
    words.fill(pieces, ids)
    assert [k for k, found in enumerate(ids) if found is not None] == [0, 1, 2]
    tokenizer = Tokenizer.from_file(PATH)
    for piece, found in zip(pieces[:3], ids):
        assert np.frombuffer(found, np.uint32).tolist() == tokenizer.encode(piece.decode(), add_special_tokens=False).ids


def test_other_tokenizers_get_whole_pieces():
    other = Tokenizer.from_file(PATH)
    other.normalizer = None
    assert not WordTokenizer.known(other) and WordTokenizer.known(Tokenizer.from_file(PATH))
    assert PieceEncoder(other, fold_ascii=True).words is None


def test_an_encoder_is_kept_for_the_next_tasks():
    assert token_files.encoder_of(PATH)[0] is token_files.encoder_of(PATH)[0]


@pytest.mark.parametrize("max_id", [511, 49407, 1_300_000])
def test_counts_of_many_steps_are_those_of_single_steps(max_id):
    # Blocks of unlike lengths, so that lanes end within the steps that are prepared together.
    k = np.arange(700, dtype=np.int64)
    blocks = [(k[:n] * 7919 % 13 * (max_id // 13) + k[:n] % 3).astype(np.uint32) for n in (700, 300, 257, 64, 1)]
    ids = np.zeros((700, len(blocks)), np.int64)
    for lane, b in enumerate(blocks):
        ids[: len(b), lane] = b
    together, single = range_coder._Known(ids, max_id), range_coder._Model(len(blocks), max_id)
    for step, n in enumerate(range_coder._lanes_left(np.array([len(b) for b in blocks]))):
        if n < len(single.lane):
            single.cut(n)
        x = ids[step, :n]
        single.predict()
        want = single.interval(x.astype(np.int32), *single.order0(x))
        got = together.next(n)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and (together.total == single.total).all()
        single.learn(x)
