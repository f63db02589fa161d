"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_training, kept_table, map_texts, sample_ids

# Labelled documents that a fit takes at most.
EXAMPLES = 3000

# A line that stands beside so many different lines in the corpus is common: copies of a text bring the same
# neighbours, a licence or menu line ever new ones.
COMMON = 8

# Log odds of the weak line labels; bounds of the expected content share of a document by its label.
WEAK, GOOD_SHARE, BAD_SHARE = 2.0, 0.7, 0.3

# Lines of a chain in a fit; longer texts are several chains, so that all of their lines count.
CHAIN = 64

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

# A document is kept if at least this share of its words' bytes is on content lines.
CONTENT_SHARE = 0.5

_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SHOUTS = b"!?"
_LINK = re.compile(rb"https?://|www\.|@|\.com\b|click|copyright|cookie|licen[sc]e|reserved", re.I)

N_FEATURES = 14


def line_features(words: list[bytes], line: bytes, repeated: bool, first: bool, last: bool) -> list[float]:
    """What the field looks at in a line with words; every number is between 0 and 1. The last one tells a line
    with a sign of boilerplate."""
    n, size = len(words), len(line)
    body = sum(map(len, words))
    symbols = min((size - len(line.translate(None, SYMBOLS))) / (2 * n), 1.0)
    capitals = min((size - len(line.translate(None, _CAPITALS))) / body * 2, 1.0)
    digits = (size - len(line.translate(None, _DIGITS))) / body
    shouts = min((size - len(line.translate(None, _SHOUTS))) / n, 1.0)
    ended = line.rstrip()[-1:] in (b".", b"!", b"?", b'"')
    link = _LINK.search(line) is not None
    sign = repeated or link or symbols >= 0.25 or capitals > 0.8 or digits > 0.3 or shouts > 0.5 or (n < 6 and not ended)
    return [
        1.0,
        min(n, 32) / 32,
        float(n < 4),
        symbols,
        capitals,
        digits,
        shouts,
        1 - len(set(words)) / n,
        min(body / n, 20) / 20,
        float(ended),
        float(repeated),
        float(link),
        float(first or last),
        float(sign),
    ]


@dataclass
class Counts:
    """Fixed counts of a text, and its lines with words: features, bytes in words, and, where asked for, hashes."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = set(windows)
    if len(seen) == len(windows):
        return 0
    once: set = set()
    more: set = set()
    for w in windows:
        (more if w in once else once).add(w)
    total, upto = 0, 0
    for i, w in enumerate(windows):
        if w in more:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def counts_of(text: str, hashed: bool = False) -> Counts:
    raw = text.encode()
    words = raw.split()
    lines = raw.split(b"\n")
    seen: set[bytes] = set()
    dup, features, sizes, hashes = 0, [], [], []
    blank = len(raw) - sum(map(len, words))
    for k, line in enumerate(lines):
        own = line.split()
        if own:
            repeated = line in seen
            dup += repeated
            seen.add(line)
            features.append(line_features(own, line, repeated, not features, k == len(lines) - 1))
            sizes.append(sum(map(len, own)))
            if hashed:
                hashes.append(xxhash.xxh64_intdigest(line, 42))
    return Counts(len(words), len(text) - blank, len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated_words(words),
                  np.array(features, np.float64).reshape(len(features), N_FEATURES), np.array(sizes, np.float64),
                  np.array(hashes, np.uint64).view(np.int64))


@dataclass
class Field:
    """Weights of the features for content (label 1) against boilerplate (0), of label pairs, and of the first label."""

    emit: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The most likely labels of the lines together; ties go to content."""
        n = len(features)
        score1 = features @ self.emit
        back = np.zeros((n, 2), np.int8)
        at0, at1 = self.begin[0], self.begin[1] + score1[0]
        (m00, m01), (m10, m11) = self.move.tolist()
        for k, s in enumerate(score1[1:].tolist(), 1):
            from0, from1 = (at0 + m00, at1 + m10), (at0 + m01, at1 + m11)
            back[k] = from0[1] >= from0[0], from1[1] >= from1[0]
            at0, at1 = max(from0), max(from1) + s
        labels = np.zeros(n, np.int8)
        labels[-1] = at1 >= at0
        for k in range(n - 1, 0, -1):
            labels[k - 1] = back[k, labels[k]]
        return labels

    def content_share(self, counts: Counts) -> float:
        if not len(counts.features):
            return 0.0
        return float(counts.sizes[self.viterbi(counts.features) == 1].sum() / counts.sizes.sum())


@dataclass
class Example:
    """The lines with words of a labelled document, and which of them are common in the corpus."""

    features: np.ndarray
    sizes: np.ndarray
    common: np.ndarray
    label: int


class Chains:
    """The chains of all examples side by side, longest first, for forward and backward sums over all at once."""

    def __init__(self, examples: list[Example]):
        parts = sorted(((d, at, min(CHAIN, len(e.features) - at)) for d, e in enumerate(examples)
                        for at in range(0, len(e.features), CHAIN)), key=lambda p: -p[2])
        rows = [(examples[d], slice(at, at + n)) for d, at, n in parts]
        self.flat = np.concatenate([e.features[s] for e, s in rows])
        self.sizes = np.concatenate([e.sizes[s] for e, s in rows])
        self.common = np.concatenate([e.common[s] for e, s in rows])
        self.lengths = np.array([n for _, _, n in parts])
        self.first = np.cumsum(self.lengths) - self.lengths
        self.opens = np.array([at == 0 for _, at, _ in parts])
        self.inner = np.setdiff1d(np.arange(len(self.flat)), self.first)
        self.active = [int((self.lengths > k).sum()) for k in range(int(self.lengths[0]))]
        self.doc = np.repeat([d for d, _, _ in parts], self.lengths)
        self.labels = np.array([e.label for e in examples])
        # Every document weighs alike, and both labels weigh alike.
        n_lines = np.bincount(self.doc, minlength=len(examples))
        weight = np.where(self.labels == 1, 0.5 / (self.labels == 1).sum(), 0.5 / (self.labels == 0).sum())
        self.per_line = (weight / n_lines)[self.doc]

    def expected(self, field: Field) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the labels of each line, and of the label pairs of lines that follow one another."""
        first, inner = self.first, self.inner
        emit = np.zeros((len(self.flat), 2))
        emit[:, 1] = self.flat @ field.emit
        emit = np.exp(emit - emit.max(1, keepdims=True))
        begin, move = np.exp(field.begin - field.begin.max()), np.exp(field.move - field.move.max())
        # Sums forward and backward, each line's scaled to one, as only their ratios count.
        ahead, behind = np.zeros_like(emit), np.full_like(emit, 0.5)
        ahead[first] = emit[first] * np.where(self.opens[:, None], begin, 1.0)
        ahead[first] /= ahead[first].sum(1, keepdims=True)
        for k in range(1, len(self.active)):
            at = first[: self.active[k]] + k
            one = (ahead[at - 1] @ move) * emit[at]
            ahead[at] = one / one.sum(1, keepdims=True)
        for k in range(len(self.active) - 2, -1, -1):
            at = first[: self.active[k + 1]] + k
            one = (emit[at + 1] * behind[at + 1]) @ move.T
            behind[at] = one / one.sum(1, keepdims=True)
        single = ahead * behind
        pair = ahead[inner - 1][:, :, None] * move * (emit[inner] * behind[inner])[:, None, :]
        return single / single.sum(1, keepdims=True), pair / pair.sum((1, 2), keepdims=True)

    def held_to_labels(self, odds: np.ndarray) -> np.ndarray:
        """Probabilities of content from log odds of lines. Where the expected content share of a document breaks the bound
        that its label sets, the odds of its lines are moved by one number until it holds; other documents stay."""
        n = len(self.labels)
        total = np.bincount(self.doc, self.sizes, n)

        def share(move):
            return np.bincount(self.doc, self.sizes / (1 + np.exp(-(odds + move[self.doc]))), n) / total

        low, high = np.zeros(n), np.zeros(n)
        now, good = share(low), self.labels == 1
        bound = np.where(good, GOOD_SHARE, BAD_SHARE)
        high[good & (now < bound)] = 30.0
        low[~good & (now > bound)] = -30.0
        for _ in range(30):
            middle = (low + high) / 2
            under = share(middle) < bound
            low, high = np.where(under, middle, low), np.where(under, high, middle)
        moved = np.where((now < bound) == good, (low + high) / 2, 0.0)
        return 1 / (1 + np.exp(-(odds + moved[self.doc])))


def climb(chains: Chains, field: Field, content: np.ndarray, steps: int, rate: float = 1.2, decay: float = 1e-4) -> Field:
    """Gradient steps towards the largest expected conditional likelihood of lines that are content with these probabilities."""
    inner, first, opens = chains.inner, chains.first, chains.opens
    soft = np.stack([1 - content, content], axis=1)
    soft_pair = soft[inner - 1][:, :, None] * soft[inner][:, None, :]
    weights = [field.emit.copy(), field.move.copy(), field.begin.copy()]
    speed = [np.zeros_like(w) for w in weights]
    for _ in range(steps):
        single, pair = chains.expected(Field(*weights))
        gradients = [chains.flat.T @ (chains.per_line * (content - single[:, 1])),
                     ((soft_pair - pair) * chains.per_line[inner][:, None, None]).sum(0),
                     ((soft - single)[first] * (chains.per_line[first] * opens)[:, None]).sum(0)]
        for k, g in enumerate(gradients):
            speed[k] = 0.9 * speed[k] + rate * (g - decay * weights[k])
            weights[k] = weights[k] + speed[k]
    return Field(*weights)


def train(examples: list[Example], rounds: int = 4, steps: int = 40) -> Field:
    """Expectation-maximisation over unknown line labels.

    Weak labels begin: a line with a sign of boilerplate, or common in the corpus, is doubtful, any other is likely content. In each
    round the labels are the weak ones and the field's own judgement, averaged as log odds and held to the bounds
    that the documents' labels set on their content share; then the field learns them.
    """
    field = Field(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2))
    examples = [e for e in examples if len(e.features)]
    if len({e.label for e in examples}) < 2:
        field.emit[0] = 1.0  # nothing to tell apart: every line is content
        return field
    chains = Chains(examples)
    weak = np.where((chains.flat[:, -1] > 0) | chains.common, -WEAK, WEAK)
    odds = weak
    for _ in range(rounds):
        field = climb(chains, field, chains.held_to_labels(odds), steps)
        single, _ = chains.expected(field)
        own = np.log(np.maximum(single[:, 1], 1e-9)) - np.log(np.maximum(single[:, 0], 1e-9))
        odds = (weak + own) / 2
    return field


def common_lines(docs: DataFrame, hashes: DataFrame, least: int = COMMON, text: str = "text") -> DataFrame:
    """Of the line hashes in ``hashes`` (column line) those that stand before or behind at least ``least`` different lines of all texts.

    Lines without words are passed over; begin and end of a text count as one line. Pairs of neighbours are reduced to
    different ones before they are counted, so a line that a third of all texts hold is spread over many tasks.
    """
    said = F.filter(F.split(F.col(text).cast("string"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = docs.select(F.transform(said, lambda x: F.xxhash64(x)).alias("_lines")).filter(F.size("_lines") > 0)
    edge = F.array(F.lit(0).cast("long"))
    pairs = lines.select(F.explode(F.arrays_zip(F.concat(edge, "_lines").alias("a"), F.concat("_lines", edge).alias("b"))).alias("p"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("p.a").alias("line"), F.lit(0).alias("side"), F.col("p.b").alias("other")),
        F.struct(F.col("p.b").alias("line"), F.lit(1).alias("side"), F.col("p.a").alias("other")))).alias("s")).select("s.*")
    met = sides.join(hashes.select("line"), "line", "left_semi").distinct()
    return met.groupBy("line", "side").count().filter(F.col("count") >= least).select("line").distinct()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", examples: int = EXAMPLES) -> Field:
    """Learns from all lines of at most ``examples`` labelled documents that may be learned from.

    Half of the examples at most are of either label. Features, sizes and hashes of the lines are gathered (68 bytes a
    line with words), not the texts; which of them are common is counted over all texts of ``docs``.
    """
    usable = labels.filter(in_training(F.col("doc_id")) & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = sample_ids(usable.filter("_label = 0"), examples // 2).unionByName(sample_ids(usable.filter("_label = 1"), examples // 2))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").join(usable, "doc_id")

    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            found = [counts_of(x or "", hashed=True) for x in texts.to_pylist()]
            return [pa.array([c.features.astype("<f4").tobytes() for c in found], pa.binary()),
                    pa.array([c.sizes.astype("<f4").tobytes() for c in found], pa.binary()),
                    pa.array([c.hashes for c in found], pa.list_(pa.int64()))]
        return fill

    fields = [T.StructField("features", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
              T.StructField("hashes", T.ArrayType(T.LongType()))]
    found = kept_table(map_texts(rows, "text", fields, make, ["doc_id", "_label"]), "line_examples")
    hashes = kept_table(found.select(F.explode("hashes").alias("line")).distinct(), "line_hashes")
    common = np.array([r["line"] for r in common_lines(docs, hashes).collect()], np.int64)
    return train([Example(np.frombuffer(r["features"], "<f4").astype(np.float64).reshape(-1, N_FEATURES),
                          np.frombuffer(r["sizes"], "<f4").astype(np.float64),
                          np.isin(np.array(r["hashes"], np.int64), common), r["_label"])
                  for r in found.orderBy("doc_id", F.xxhash64("hashes")).collect()])


def judge(df: DataFrame, field: Field, keep: list[str] = ("doc_id",), text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """The columns ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept.

    Words, lines and windows are those of the whole text, null as if empty. base_failed: fewer than 50
    words, or over half of the words in repeated windows. kept: not base_failed, and the lines that the
    field marks as content hold ``share`` of the words' bytes. A text without words has content share
    0. Rows are judged on their own, so repeated rows get equal verdicts.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [*[T.StructField(c, T.LongType()) for c in names], T.StructField("base_failed", T.BooleanType()),
              T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())]

    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            found = [counts_of(x or "") for x in texts.to_pylist()]
            failed = [c.n_words < 50 or 100 * c.n_repeat_words > 50 * c.n_words for c in found]
            shares = [field.content_share(c) for c in found]
            return [*[pa.array([getattr(c, name) for c in found], pa.int64()) for name in names],
                    pa.array(failed, pa.bool_()), pa.array(shares, pa.float64()),
                    pa.array([not f and s >= share for f, s in zip(failed, shares)], pa.bool_())]
        return fill

    return map_texts(df, text, fields, make, list(keep))
