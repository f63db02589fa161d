"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_training, kept_table, map_texts, sample_ids

# Labelled rows that a fit takes at most, as far as possible half of each label; examples that vote; examples per block.
EXAMPLES, VOTERS, BLOCK = 3000, 15, 16

# Bytes of text worked on at once; words whose terms are remembered.
SLICE_BYTES, REMEMBERED = 2 << 20, 100_000

# The share of the largest possible cosine that is summed before bounds are looked at, terms in falling order of
# what they can add; how few examples may be left for their own vectors to be looked at instead of postings; and
# postings up to which adding all is less work than bounds. All three change only the speed.
_PART, _FEW, _SHORT = 0.6, 64, 40_000

# Largest score of a text without evidence.
_NO_EVIDENCE = 0.49

_EDGES = re.compile(r"^\W+|\W+$")
# Runs of scripts that put no blanks between words: Thai to Tibetan, Burmese, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff]+")


def terms_of(word: str) -> list[str]:
    """A word without marks around it; where a script puts no blanks between words, the single characters and pairs
    of neighbours are terms too."""
    word = _EDGES.sub("", word)
    if not word:
        return []
    terms = [word]
    if not word.isascii():
        parts = [run[i:i + n] for run in _UNSPACED.findall(word) for n in (1, 2) for i in range(len(run) - n + 1)]
        terms += [p for p in parts if p != word]
    return terms


def term_weights(counted: dict[str, tuple[int, int]], n0: int, n1: int) -> dict[str, float]:
    """Weight of each term from the numbers of label-0 and label-1 examples that have it: its inverse document
    frequency, times how far its odds differ between the labels, so that neighbours are alike in what
    tells the labels apart rather than in their topics."""
    out = {}
    for term, (in0, in1) in sorted(counted.items()):
        idf = np.log((n0 + n1 + 1) / (in0 + in1 + 1)) + 0.1
        odds = np.log((in1 + 0.5) / (n1 + 1)) - np.log((in0 + 0.5) / (n0 + 1))
        out[term] = float(idf * abs(odds))
    return out


class Vectors:
    """Unit TF-IDF vectors of texts over a given vocabulary; equal words are looked up once."""

    def __init__(self, idf: dict[str, float]):
        self.number = {t: i for i, t in enumerate(idf)}
        self.idf = np.array(list(idf.values()))
        self.known: dict[str, tuple[int, ...]] = {}

    def _terms(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known = {}
            found = self.known[word] = tuple(self.number[t] for t in terms_of(word) if t in self.number)
        return found

    def of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term numbers, weights, n + 1 bounds of the texts in them); none for a text without a known term."""
        said = [t.lower().split() for t in texts]
        words = pa.array([w for s in said for w in s], pa.large_string()).dictionary_encode()
        found = [self._terms(w) for w in words.dictionary.to_pylist()]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), np.int64, counts.sum())
        codes = words.indices.to_numpy(zero_copy_only=False)
        firsts = (np.cumsum(counts) - counts)[codes]
        at, terms = _ranges(firsts, firsts + counts[codes])
        text = np.repeat(np.arange(len(said)), [len(s) for s in said])
        size = max(len(self.idf), 1)
        pairs, times = np.unique(np.repeat(text * size, terms) + flat[at], return_counts=True)
        owner, ids = pairs // size, pairs % size
        weights = self.idf[ids] * (1 + np.log(times)) if len(ids) else np.zeros(0)
        norms = np.sqrt(np.bincount(owner, weights ** 2, len(said)))
        weights /= np.where(norms > 0, norms, 1)[owner]
        return ids, weights, np.searchsorted(owner, np.arange(len(said) + 1))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights) of one text."""
        return self.of_all([text])[:2]


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the whole numbers of all ranges one after the other, how many each range has)."""
    counts = stops - starts
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0), counts


@dataclass
class Index:
    """Posting lists in blocks of examples, with the largest weight of each list and block.

    Cells are the pairs of a term and a block that have postings.

    cells[t]  where the cells of term t begin; block[c]  the block of a cell; first[c]  where its
    postings begin; most[c]  their largest weight; peak[t]  the largest weight of a term;
    rows  the examples' own vectors: (bounds, terms, weights)
    """

    cells: np.ndarray
    block: np.ndarray
    first: np.ndarray
    most: np.ndarray
    peak: np.ndarray
    docs: np.ndarray
    weights: np.ndarray
    rows: tuple[np.ndarray, np.ndarray, np.ndarray]
    n: int

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]], terms: int) -> Index:
        n, blocks = len(rows), max(-(-len(rows) // BLOCK), 1)
        sizes = np.array([len(i) for i, _ in rows], np.int64)
        docs = np.repeat(np.arange(n), sizes)
        ids = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int64)])
        weights = np.concatenate([w for _, w in rows] or [np.zeros(0)])
        own = np.append(0, np.cumsum(sizes)), ids.astype(np.int32), weights
        order = np.lexsort((docs, ids))
        docs, ids, weights = docs[order], ids[order], weights[order]
        cell = ids * blocks + docs // BLOCK
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        most = np.maximum.reduceat(weights, first) if len(first) else np.zeros(0)
        peak = np.zeros(terms)
        np.maximum.at(peak, ids, weights)
        cells = np.searchsorted(cell[first], np.arange(terms + 1) * blocks)
        return Index(cells, (cell[first] % blocks).astype(np.int32), np.append(first, len(docs)), most, peak,
                     docs.astype(np.int32), weights, own, n)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine above 0; equal cosines go by number.

        The postings of the terms that can add most are summed first. The other terms add at most
        the sum of weight times block maximum to an example of a block; examples that stay below the
        k-th best sum so far even with that cannot be among the nearest. If few are left, their cosines are
        taken from their own vectors, and the other postings are not read.
        """
        if not len(ids) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        share = weights * self.peak[ids]
        order = np.argsort(-share, kind="stable")
        ids, weights, reached = ids[order], weights[order], np.cumsum(share[order])
        starts, stops = self.first[self.cells[ids]], self.first[self.cells[ids + 1]]
        long = int((stops - starts).sum()) > _SHORT and self.n > k
        head = int(np.searchsorted(reached, _PART * reached[-1])) + 1 if long else len(ids)
        scores = self._sums(starts[:head], stops[:head], weights[:head])
        if leave >= 0:
            scores[leave] = -1.0
        if head < len(ids):
            cells, each = _ranges(self.cells[ids[head:]], self.cells[ids[head:] + 1])
            more = np.bincount(self.block[cells], self.most[cells] * np.repeat(weights[head:], each), -(-self.n // BLOCK))
            cut = np.partition(scores, self.n - k)[self.n - k]
            near = np.flatnonzero(scores + np.repeat(more, BLOCK)[: self.n] >= max(cut, 0) - 1e-12)
            near = near[near != leave]
            if len(near) <= _FEW:
                return self._best(near, self._cosines(near, ids, weights), k)
            scores += self._sums(starts[head:], stops[head:], weights[head:])
            if leave >= 0:
                scores[leave] = -1.0
        return self._best(np.arange(self.n), scores, k)

    def _sums(self, starts: np.ndarray, stops: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the postings of some terms add to each example."""
        at, each = _ranges(starts, stops)
        return np.bincount(self.docs[at], self.weights[at] * np.repeat(weights, each), self.n)

    def _cosines(self, near: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        bounds, terms, values = self.rows
        at, each = _ranges(bounds[near], bounds[near + 1])
        asked = np.zeros(len(self.peak))
        asked[ids] = weights
        return np.bincount(np.repeat(np.arange(len(near)), each), values[at] * asked[terms[at]], len(near))

    @staticmethod
    def _best(near: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(near) > 4 * k:
            some = scores >= np.partition(scores, len(near) - k)[len(near) - k]
            near, scores = near[some], scores[some]
        best = np.lexsort((near, -scores))[:k]
        best = best[scores[best] > 0]
        return near[best], scores[best]


def vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    """Share of the label-1 examples, each weighing by one over its distance."""
    weights = 1 / (1.02 - np.minimum(cosines, 1))
    return float((weights * labels).sum() / weights.sum())


@dataclass
class Model:
    """The index, the labels of its examples, and the curve from votes to scores."""

    idf: dict[str, float]
    index: Index
    labels: np.ndarray
    doc_ids: np.ndarray
    votes: np.ndarray
    scores: np.ndarray
    base: float

    @cached_property
    def vectors(self) -> Vectors:
        return Vectors(self.idf)

    def score(self, ids: np.ndarray, weights: np.ndarray, leave: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        near, cosines = self.index.nearest(ids, weights, VOTERS, leave)
        if not len(near):
            return self.base, near, cosines
        return float(np.interp(vote(self.labels[near], cosines), self.votes, self.scores)), near, cosines


def _calibrated(votes: np.ndarray, labels: np.ndarray, stands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising curve from votes to label shares: neighbouring groups that fall are pooled.

    stands  for how many labelled rows each example stands
    """
    groups: list[list[float]] = []
    for v in np.unique(votes):
        here = votes == v
        hit, n = (labels * stands)[here], stands[here].sum()
        groups.append([v * n, hit.sum() + 0.5 * v, n + 0.5])
        while len(groups) > 1 and groups[-2][1] / groups[-2][2] >= groups[-1][1] / groups[-1][2]:
            last = groups.pop()
            groups[-1] = [a + b for a, b in zip(groups[-1], last)]
    if not groups:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    x = np.array([g[0] / max(g[2] - 0.5, 1e-9) for g in groups])
    y = np.clip(np.array([g[1] / g[2] for g in groups]), 0, 1)
    x = np.clip(x, 0, 1)
    order = np.argsort(x, kind="stable")
    return x[order], np.maximum.accumulate(y[order])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES) -> Model:
    """Learns from at most ``examples`` labelled rows that may be learned from, half of each label if there are enough.

    Every term of these rows is in the vocabulary. The rows' terms, not their texts, are gathered. Scores are
    calibrated to the shares of the labels among all labelled rows.
    """
    usable = labels.filter(in_training(F.col("doc_id")) & F.col(label).isin(0, 1)).groupBy("doc_id").agg(
        F.max(label).alias("_label"))
    usable = kept_table(usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    all_rows = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    all0, all1 = all_rows.get(0, 0), all_rows.get(1, 0)
    take1 = min(all1, max(examples // 2, examples - all0))
    ids = sample_ids(usable.filter("_label = 1"), take1).unionByName(sample_ids(usable.filter("_label = 0"), examples - take1))
    taken = kept_table(usable.join(ids, "doc_id", "left_semi"), "examples")
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")

    def words():
        def fill(texts: pa.Array) -> list[pa.Array]:
            found = [sorted({t for w in set((x or "").lower().split()) for t in terms_of(w)}) for x in texts.to_pylist()]
            return [pa.array(found, pa.list_(pa.string()))]
        return fill

    each = map_texts(rows, "text", [T.StructField("terms", T.ArrayType(T.StringType()))], words, ["doc_id", "_label"])
    totals = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    counted = each.select("_label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("_label") == 0).alias("n0"), F.count_if(F.col("_label") == 1).alias("n1")).collect()
    idf = term_weights({r["term"]: (r["n0"], r["n1"]) for r in counted}, n0, n1)

    def vectors():
        made = Vectors(idf)

        def fill(texts: pa.Array) -> list[pa.Array]:
            ids, weights, at = made.of_all([x or "" for x in texts.to_pylist()])
            rows = [(ids[a:b], weights[a:b]) for a, b in zip(at[:-1], at[1:])]
            heaviest = [int(i[np.argmax(w)]) if len(i) else -1 for i, w in rows]
            return [pa.array([i.astype("<i4").tobytes() for i, _ in rows], pa.binary()),
                    pa.array([w.astype("<f8").tobytes() for _, w in rows], pa.binary()), pa.array(heaviest, pa.int32())]
        return fill

    found = map_texts(rows, "text", [T.StructField("ids", T.BinaryType()), T.StructField("weights", T.BinaryType()),
                                     T.StructField("heaviest", T.IntegerType())], vectors, ["doc_id", "_label"]).collect()
    # Alike examples share blocks, so that block maxima tell more: by label, then by their heaviest term.
    found.sort(key=lambda r: (r["_label"], r["heaviest"], r["doc_id"]))
    rows = [(np.frombuffer(r["ids"], "<i4").astype(np.int64), np.frombuffer(r["weights"], "<f8")) for r in found]
    model = Model(idf, Index.of(rows, max(len(idf), 1)), np.array([r["_label"] for r in found], np.float64),
                  np.array([r["doc_id"] for r in found], np.int64), np.array([0.0, 1.0]), np.array([0.0, 1.0]),
                  min((all1 + 0.5) / (all0 + all1 + 1), _NO_EVIDENCE))
    stands = np.where(model.labels == 1, all1 / max(n1, 1), all0 / max(n0, 1))
    near = [model.index.nearest(i, w, VOTERS, k) for k, (i, w) in enumerate(rows)]
    seen = np.array([k for k, (x, _) in enumerate(near) if len(x)], np.int64)
    votes = np.array([vote(model.labels[near[k][0]], near[k][1]) for k in seen])
    model.votes, model.scores = _calibrated(votes, model.labels[seen], stands[seen])
    return model


def score(df: DataFrame, model: Model, keep: list[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep``, score (0 to 1), predicted (1 from 0.5 on) and evidence (the nearest examples' ids and cosines).

    A text without a known term, such as a null or empty one, has the share of label 1 among
    the labelled rows as its score, but below 0.5, and no evidence: nothing was found that speaks for label 1.
    So has every text if there is no labelled example. Nothing but the text is looked at, so repeated rows score alike.
    """
    pair = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType())])
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
              T.StructField("evidence", T.ArrayType(pair))]
    # As a broadcast the model is read once by a worker process, not by each of its tasks.
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def fill(texts: pa.Array) -> list[pa.Array]:
            ids, weights, at = model.vectors.of_all([x or "" for x in texts.to_pylist()])
            done = [model.score(ids[a:b], weights[a:b]) for a, b in zip(at[:-1], at[1:])]
            scores = np.array([d[0] for d in done])
            shown = [[{"doc_id": int(model.doc_ids[i]), "cosine": float(c)} for i, c in zip(near[:3], cos[:3])] for _, near, cos in done]
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                    pa.array(shown, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])))]
        return fill

    return map_texts(df, text, fields, make, list(keep), SLICE_BYTES)


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), "text")
    scored = score(rows, fit(docs, labels, **how), ["_row", "text"])
    return scored.filter("predicted = 0").select("_row.*", "text").select(*docs.columns)
