"""Encoding a column of texts with the tokenizers library, each distinct piece of text once."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .common import Remembered

# Pieces a task remembers, with their ids, and the bytes of the longest of them. Only the speed depends on it.
REMEMBERED = 100_000
LONGEST = 64

_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_ALNUM = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)])
_MARK = np.isin(np.arange(256), [*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
# Last bytes of the characters beyond ASCII that are white space in Unicode.
_SPACE_END = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places at which every split into words of letters, digits, marks and white space begins a new word.

    These are where white space follows something else, and where a mark other than the apostrophe
    follows a letter or digit of ASCII or of Latin-1. Encoding the pieces between them gives
    the same ids as encoding the whole text.
    """
    before = np.concatenate([[32], data[:-1]]).astype(np.uint8)
    latin = np.concatenate([[0, 0], data[:-2]])[: len(data)] == 0xC3
    cut = _SPACE[data] & ~_SPACE[before] & (latin | ~_SPACE_END[before] | (before < 0x80))
    letter = _ALNUM[before] | (latin & (before >= 0x80) & (before != 0x97) & (before != 0xB7))
    cut |= _MARK[data] & letter
    inner = bounds[:-1][bounds[:-1] < len(data)]
    cut[inner] = True
    return np.flatnonzero(cut)


class WordTokenizer:
    """A tokenizer's own model for pieces that are one word, lower-cased, of a-z or Latin-1, behind white space.

    Of these its normalizer and splitting leave just the word. Words are joined by blanks and sent
    in one call; a token with the model's suffix ends a word.
    """

    NORMALIZER = 'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\\s+"), content=" "), Lowercase()])'
    SPLITTING = ('Sequence(pretokenizers=[Split(pattern=Regex("\'s|\'t|\'re|\'ve|\'m|\'ll|\'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"), '
                 'behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])')
    WORDS = (r"^[ \t-\r]*[a-z]+$", r"^[ \t-\r]*[a-zß-öø-ÿ]+$")

    @classmethod
    def known(cls, tokenizer: Tokenizer) -> bool:
        """Whether the tokenizer's normalizer and splitting are known to leave such words whole."""
        tokens = tokenizer.get_added_tokens_decoder().values()
        return (repr(tokenizer.normalizer) == cls.NORMALIZER and repr(tokenizer.pre_tokenizer) == cls.SPLITTING
                and bool(getattr(tokenizer.model, "end_of_word_suffix", None))
                and all("<" in t.content and not t.normalized for t in tokens))

    def __init__(self, tokenizer: Tokenizer):
        blank, as_bytes = pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(False, use_regex=False)
        self.tokenizers = []
        for split in (blank, pre_tokenizers.Sequence([blank, as_bytes])):  # letters of a-z are their own bytes
            words = Tokenizer(tokenizer.model)
            words.normalizer, words.pre_tokenizer = normalizers.Sequence([]), split
            self.tokenizers.append(words)
        vocabulary, suffix = tokenizer.get_vocab(), tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, tokenizer: Tokenizer, words: list[str]) -> list[bytes] | None:
        [done] = tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(done.ids, np.uint32)
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) != len(words) or ends[-1] != len(ids):
            return None
        raw = memoryview(ids).cast("B")
        return [bytes(raw[4 * a: 4 * b]) for a, b in zip([0, *ends], ends)]

    def fill(self, pieces: list[bytes], ids: list[bytes | None]) -> None:
        """Sets the ids that are None of those pieces that are such words."""
        missing = np.array([k for k, found in enumerate(ids) if found is None], np.int64)
        for tokenizer, pattern in zip(self.tokenizers, self.WORDS):
            left = pa.array([pieces[k] for k in missing], pa.binary()).cast(pa.string())
            fits = pc.match_substring_regex(left, pattern)
            words = pc.ascii_ltrim_whitespace(left.filter(fits)).to_pylist()
            at = missing[fits.to_numpy(zero_copy_only=False)].tolist()
            for i in range(0, len(words), 8192):
                for k, made in zip(at[i: i + 8192], self._ids(tokenizer, words[i: i + 8192]) or []):
                    ids[k] = made
            missing = np.array([k for k in missing.tolist() if ids[k] is None], np.int64)


class PieceEncoder:
    """Ids of texts; equal pieces of texts are encoded once."""

    def __init__(self, tokenizer: Tokenizer, fold_ascii: bool = False, remembered: int = REMEMBERED, special: bool = False):
        # One thread: a task has one core, and each thread of the library's pool would keep memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer.encode_special_tokens = not special  # False: a special token's string in a text is that token
        tokens = tokenizer.get_added_tokens_decoder().values() if special else []
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in tokens):
            raise ValueError("special tokens must stand for their plain strings")
        strings = sorted((t.content.encode() for t in tokens), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        tokenizer.no_padding()
        tokenizer.no_truncation()
        self.tokenizer = tokenizer
        self.fold = np.arange(256, dtype=np.uint8)
        if fold_ascii:
            self.fold[65:91] += 32
        self.known = Remembered(remembered)
        self.words = WordTokenizer(tokenizer) if fold_ascii and WordTokenizer.known(tokenizer) else None

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        ids = self.known.find_all(pieces)
        missing = [k for k, found in enumerate(ids) if found is None]
        if self.words and missing:
            self.words.fill(pieces, ids)
            for k in missing:
                if ids[k] is not None and len(pieces[k]) <= LONGEST:
                    self.known.add(pieces[k], ids[k])
            missing = [k for k in missing if ids[k] is None]
        for i in range(0, len(missing), 8192):
            part = missing[i: i + 8192]
            done = self.tokenizer.encode_batch_fast([pieces[k].decode() for k in part], add_special_tokens=False)
            for k, e in zip(part, done):
                ids[k] = array("I", e.ids).tobytes()
                if len(pieces[k]) <= LONGEST:
                    self.known.add(pieces[k], ids[k])
        return ids

    def _whole_specials(self, data: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The starts of pieces, with each string of a special token within a text as a piece of its own."""
        raw = data.tobytes() if self.special else b""
        spans = [m.span() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                 for m in self.special.finditer(raw, a, b)] if self.special and self.special.search(raw) else []
        if not spans:
            return starts
        begins, ends = np.array(spans, np.int64).T
        k = np.searchsorted(begins, starts, side="right") - 1
        outside = starts[(k < 0) | (starts >= ends[k])]
        return np.unique(np.concatenate([outside, begins, ends[ends < len(data)]]))

    def cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts, and the n + 1 bounds of the texts in them."""
        # A letter before a character beyond ASCII stays: they may compose, to another one than the lowered letter.
        folded = np.where(np.append(data[1:], 32) < 0x80, self.fold[data], data)
        starts = self._whole_specials(data, bounds, piece_starts(folded, bounds)) if len(data) else np.zeros(0, np.int64)
        edges = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(folded)])
        return pieces, np.searchsorted(starts, bounds)

    def encode_all(self, cuts: list[tuple[pa.Array, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each part given by cut: (ids of its texts one after the other, n + 1 bounds of the texts in them).

        Pieces are looked up and encoded once for all parts together.
        """
        held, bounds = [pieces for pieces, _ in cuts if len(pieces)], [at for _, at in cuts]
        cuts.clear()  # the bytes of the texts can go
        coded = pa.chunked_array(held, pa.large_binary()).dictionary_encode().chunks  # one a chunk that is not empty
        del held
        ids = self._ids_of(coded[0].dictionary.to_pylist()) if coded else []
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        table = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(ids))])
        del ids
        parts = iter(coded)
        for at in bounds:
            if not at[-1]:
                yield np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
                continue
            made = table.take(next(parts).indices)
            edges = np.frombuffer(made.buffers()[1], np.int64)[made.offset: made.offset + len(made) + 1] // 4
            yield np.frombuffer(made.buffers()[2], np.uint32)[edges[0]: edges[-1]], edges[at] - edges[0]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 bounds of the texts in them)."""
        return next(self.encode_all([self.cut(data, bounds)]))
