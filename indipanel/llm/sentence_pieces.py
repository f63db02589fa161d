"""SentencePiece encoding and decoding of merge-type (BPE) models by prefix tables."""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from .common import Remembered, map_texts, text_buffer

MODEL = "piece_bpe_32k.model"

# Bytes of text worked on at once, and ids decoded at once.
SLICE_BYTES = 2 << 20
STEP_IDS = 1 << 18

# Parts of texts a task remembers, and the bytes of the longest of them. They change no result.
REMEMBERED = 300_000
LONGEST = 64
PAIRS = 400_000

# ---------------------------------------------------------------- fixed values
BLANK = "▁"
UNKNOWN_TEXT = " ⁇ "
# kinds of pieces in a model file
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
# ------------------------------------------------------------ end fixed values

_WITHOUT = -1   # last piece of a prefix that ends in a character without a piece


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces by id, their scores and kinds."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    begin: int
    end: int

    @staticmethod
    def read(path: str) -> Model:
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules, kinds = proto.normalizer_spec, tuple(p.type for p in proto.pieces)
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or {USER_DEFINED, UNUSED} & set(kinds)):
            raise ValueError("only merge models with byte fallback and without rewriting of texts")
        return Model(tuple(p.piece for p in proto.pieces), tuple(p.score for p in proto.pieces), kinds,
                     proto.trainer_spec.bos_id, proto.trainer_spec.eos_id)


class PrefixEncoder:
    """Ids of a string by the last piece of each of its prefixes.

    A merge model joins, again and again, the neighbours whose joint piece has the best score, the
    leftmost first. The outcome for a prefix of a string has one last piece, and it is the only piece
    ending there that (a) is the outcome of its own characters and (b) is compatible with the last piece
    of the prefix before it: merged side by side, no merge across their border comes before the end.
    For the order of merges on both sides of a border is that of the two pieces alone.
    """

    def __init__(self, model: Model):
        self.ids = {p: i for i, (p, kind) in enumerate(zip(model.pieces, model.kinds)) if kind == NORMAL}
        if len(model.pieces) > 1 << 15:
            raise ValueError("ids of more than 15 bits")
        self.pieces, self.scores = model.pieces, model.scores
        self.sizes = [len(p) for p in model.pieces]
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(model.pieces, model.kinds)) if kind == BYTE}
        self._merges: dict[int, list | None] = {}
        self._compatible: dict[int, bool] = {}

    def merges(self, i: int) -> list[tuple[float, str, str]] | None:
        """(score, first part, last part) after each merge of the piece's own characters; None if they end as others."""
        if i not in self._merges:
            parts, done = list(self.pieces[i]), []
            while len(parts) > 1:
                joint = [self.ids.get(a + b) for a, b in zip(parts, parts[1:])]
                scores = [-np.inf if j is None else self.scores[j] for j in joint]
                best = max(scores)
                if best == -np.inf:
                    break
                at = scores.index(best)
                parts[at: at + 2] = [parts[at] + parts[at + 1]]
                done.append((best, parts[0], parts[-1]))
            self._merges[i] = done if len(parts) == 1 else None
        return self._merges[i]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces, merged from their characters side by side, stay two pieces."""
        ours, theirs = self.merges(left), self.merges(right)
        if ours is None or theirs is None:
            return False
        last, first, a, b = self.pieces[left][-1], self.pieces[right][0], 0, 0
        while True:
            across = self.ids.get(last + first)
            next_left = ours[a][0] if a < len(ours) else -np.inf
            next_right = theirs[b][0] if b < len(theirs) else -np.inf
            if across is not None and self.scores[across] > next_left and self.scores[across] >= next_right:
                return False
            if a == len(ours) and b == len(theirs):
                return True
            if next_left >= next_right and a < len(ours):
                last, a = ours[a][2], a + 1
            else:
                first, b = theirs[b][1], b + 1

    def _fits(self, before: int, i: int) -> bool:
        """Whether piece i can be the last one behind a prefix with this last piece."""
        if before == _WITHOUT:
            return self.merges(i) is not None
        if len(self._compatible) > PAIRS:
            self._compatible.clear()
        fits = self._compatible[before << 15 | i] = self.compatible(before, i)
        return fits

    def prefix_table(self, text: str) -> list[int]:
        """The id of the last piece of each prefix of the text, the empty one included."""
        last = [_WITHOUT] * (len(text) + 1)
        known = self._compatible.get
        found = -1      # last character of the longest prefix that has its last piece
        for end, (i, size) in self.matches.iter(text):
            if end != found:
                before = last[end + 1 - size]
                fits = known(before << 15 | i) if before >= 0 else None
                if fits is None:
                    fits = self._fits(before, i)
                if fits:
                    last[end + 1] = i
                    found = end
        return last

    def encode(self, text: str) -> list[int]:
        """Ids of a string in which blanks are written as in the pieces; without begin and end."""
        last, ids, at, sizes = self.prefix_table(text), [], len(text), self.sizes
        while at:
            i = last[at]
            if i >= 0:
                ids.append(i)
                at -= sizes[i]
            else:
                ids.extend(self.bytes[b] for b in reversed(text[at - 1].encode()))
                at -= 1
        ids.reverse()
        return ids


def part_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where texts can be cut: before blanks that follow something else, and around line ends.

    No piece has a blank behind another character, and none a line end.
    """
    before = np.concatenate([[32], data[:-1]]).astype(np.uint8)
    cut = ((data == 32) & (before != 32)) | (data == 10) | (before == 10)
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class SentencePieces:
    """Encodes and decodes columns of texts."""

    def __init__(self, model: Model):
        self.model, self.encoder = model, PrefixEncoder(model)
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.encoder.ids):
            raise ValueError("a piece with a blank or line end within")
        self.known = Remembered(REMEMBERED)
        texts = []
        for piece, kind in zip(model.pieces, model.kinds):
            plain = bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(BLANK, " ").encode()
            texts.append(b"" if kind == CONTROL else UNKNOWN_TEXT.encode() if kind == UNKNOWN else plain)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.kinds = np.array(model.kinds)
        self.leading = np.array([t[:1] == b" " and k == NORMAL for t, k in zip(texts, model.kinds)])

    def _ids_of(self, part: bytes) -> bytes:
        return array("I", self.encoder.encode(part.decode().replace(" ", BLANK))).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, with begin and end ids; n + 1 bounds of the texts in them)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, BLANK, " ")     # the character that stands for a blank is one
        blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        data, bounds = text_buffer(pc.if_else(
            pc.equal(texts, nothing), texts, pc.binary_join_element_wise(blank, texts, nothing)))
        starts = part_starts(data, bounds) if len(data) else np.zeros(0, np.int64)
        edges = np.append(starts, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        ids = [self.known.get(p, self._ids_of, LONGEST) for p in parts.dictionary.to_pylist()]
        codes = parts.indices.to_numpy(zero_copy_only=False)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, firsts, counts = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(sizes) - sizes, sizes[codes]
        # begin and end of a text take a place each, around those of its parts
        owner = np.searchsorted(bounds, starts, side="right") - 1
        ends = np.cumsum(counts)
        in_text = np.append(0, ends)[np.searchsorted(starts, bounds)]
        at = in_text + 2 * np.arange(len(bounds))
        out = np.empty(at[-1], np.uint32)
        out[at[:-1]], out[at[1:] - 1] = self.model.begin, self.model.end
        for a in range(0, len(codes), STEP_IDS):
            some = slice(a, a + STEP_IDS)
            n, before = counts[some], (ends - counts)[some]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(before + 2 * owner[some] + 1, n) + within] = flat[np.repeat(firsts[codes[some]], n) + within]
        return out, at

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts one after the other, n + 1 bounds of the texts in them)."""
        sizes, firsts = self.sizes[ids], self.firsts[ids]
        # the first piece that stands for text loses one leading blank, the mark of a text's beginning
        said = np.flatnonzero(self.kinds[ids] != CONTROL)
        first = np.searchsorted(said, bounds[:-1])
        has = first < len(said)
        first = said[first[has]]
        first = first[(first < bounds[1:][has]) & self.leading[ids[first]]]
        sizes[first] -= 1
        firsts[first] += 1
        ends = np.append(0, np.cumsum(sizes))
        out = np.empty(ends[-1], np.uint8)
        for a in range(0, len(ids), STEP_IDS):
            n = sizes[a: a + STEP_IDS]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[ends[a]: ends[a] + len(within)] = self.flat[np.repeat(firsts[a: a + STEP_IDS], n) + within]
        return self._whole_characters(ids, bounds, ends, out)

    def _whole_characters(self, ids: np.ndarray, bounds: np.ndarray, ends: np.ndarray,
                          out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces that make no character become replacement characters, each of its own."""
        at = ends[bounds]
        said = np.flatnonzero(self.kinds[ids] != CONTROL)
        byte = self.kinds[ids[said]] == BYTE
        try:
            out.tobytes().decode()
            inner = at[1:-1][at[1:-1] < len(out)]
            cut = (byte[1:] & byte[:-1] & (np.diff(said) > 1)).any()    # a character with a control piece within
            if not cut and not ((out[inner] & 0xC0) == 0x80).any():
                return out, at
        except UnicodeDecodeError:
            pass
        texts = []
        for i, j in zip(bounds[:-1], bounds[1:]):
            text, run = [], b""
            for k in range(i, j):
                piece = out[ends[k]: ends[k + 1]].tobytes()
                if self.kinds[ids[k]] == BYTE:
                    run += piece
                else:
                    text += [_characters(run), piece]
                    run = b""
            texts.append(b"".join([*text, _characters(run)]))
        return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))


def _characters(run: bytes) -> bytes:
    """The characters of a run of bytes; a byte that is part of none is a replacement character."""
    out = []
    while run:
        for n in range(1, min(4, len(run)) + 1):
            try:
                run[:n].decode()
            except UnicodeDecodeError:
                continue
            out.append(run[:n])
            run = run[n:]
            break
        else:
            out.append("�".encode())
            run = run[1:]
    return b"".join(out)


@lru_cache(maxsize=1)
def _coder(model: Model) -> SentencePieces:
    """One coder for all tasks of a worker, with what it remembers."""
    return SentencePieces(model)


def _binary(flat: np.ndarray, bounds: np.ndarray, kind: pa.DataType = pa.large_binary()) -> pa.Array:
    return pa.Array.from_buffers(kind, len(bounds) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(flat))])


def encode(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep`` and ids (little-endian unsigned 32-bit integers, begin and end included) and decoded.

    A null text is empty: its ids are begin and end. Strings of control pieces in a text are ordinary
    text. ``decoded`` is the text of the ids; the character U+2581 comes back as a blank. Every text is
    taken whole, however long; repeated rows repeat their result, columns not named are not read.
    """
    model = Model.read(path or public_tokenizers.path(MODEL))
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]

    def make():
        coder = _coder(model)

        def fill(texts: pa.Array) -> list[pa.Array]:
            ids, at = coder.encode(texts)
            data, bounds = coder.decode(ids, at)
            return [_binary(ids.astype("<u4").view(np.uint8), at * 4), _binary(data, bounds, pa.large_string())]
        return fill

    return map_texts(df, text, fields, make, list(keep), SLICE_BYTES)


def decode(df: DataFrame, ids: str = "ids", keep: list[str] = ("doc_id",), path: str | None = None) -> DataFrame:
    """The columns ``keep`` and decoded, the text of a binary column of ids; null ids are empty."""
    model = Model.read(path or public_tokenizers.path(MODEL))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("decoded", T.StringType())])

    def run(batches):
        coder = _coder(model)
        for batch in batches:
            done = []
            for x in batch.column(len(keep)).to_pylist():
                some = np.frombuffer(x or b"", "<u4").astype(np.uint32)
                done.append(coder.decode(some, np.array([0, len(some)]))[0].tobytes().decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(done, pa.string())],
                                             names=[*keep, "decoded"])

    return df.select(*keep, ids).mapInArrow(run, schema)
