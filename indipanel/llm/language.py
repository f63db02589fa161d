"""Language identification as a mixture: shares of languages by expectation-maximisation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_training, kept_table, map_texts, text_buffer

# Documents of each language that a fit takes at most; hash slots of n-grams; their length in bytes.
PER_LANGUAGE, SLOTS, GRAM = 1500, 1 << 16, 4

# Steps of expectation-maximisation for each set of languages.
STEPS = 8

# Weight of the evidence of one word: the n-grams of a word overlap and are not independent.
_EVIDENCE = 0.5

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def gram_slots(data: np.ndarray) -> np.ndarray:
    """Slot of the n-gram of bytes that begins at each byte; A-Z lowered, white space alike."""
    folded = np.where(_SPACE[data], 32, _FOLD[data]).astype(np.uint32)
    code = np.zeros(len(data), np.uint32)
    for k in range(GRAM):
        code = code * np.uint32(257) + np.concatenate([folded[k:], np.full(min(k, len(data)), 32, np.uint32)])
    return (code * np.uint32(2654435761)) >> np.uint32(32 - SLOTS.bit_length() + 1)


@dataclass
class Model:
    """Languages, and the log likelihood of each slot in each of them."""

    languages: list[str]
    loglik: np.ndarray


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Counts the n-grams of at most ``per_language`` documents with each non-null lang.

    Only documents that may be learned from count. Those with the smallest hashes of their
    ids are taken; their texts stay on the executors. A task gives its counts by language and slot, which are summed
    in that grouping, so no task holds more than the slots of its own texts; the driver gets one count per language and slot.
    """
    usable = docs.filter(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id"))
    ids = usable.select("doc_id", "lang").distinct().withColumn("_n", rank).filter(F.col("_n") <= per_language)
    # As a written table the ids have a known size, by which Spark decides on a broadcast.
    taken = kept_table(ids.select("doc_id", "lang"), "language_ids")
    rows = usable.select("doc_id", "lang", "text").join(taken, ["doc_id", "lang"])

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slots = gram_slots(np.frombuffer(text.encode(), np.uint8))
                totals[lang] = totals.get(lang, 0) + np.bincount(slots, minlength=SLOTS)
        for lang, found in totals.items():
            slots = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(found[slots])],
                names=["lang", "slot", "n"])

    counted = rows.select("lang", "text").mapInArrow(count, "lang string, slot int, n long")
    found = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(pc.unique(found["lang"]).to_pylist())
    if not languages:
        return Model([], np.zeros((SLOTS, 0), np.float32))
    counts = np.zeros((len(languages), SLOTS))
    counts[pc.index_in(found["lang"], pa.array(languages)).to_numpy(), found["slot"].to_numpy()] = found["n"].to_numpy()
    shared = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * SLOTS)
    smooth = counts + 200.0 * shared * SLOTS / SLOTS + 1e-3
    return Model(languages, np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32))


def _mixtures(likelihood: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log likelihood) of each document; both arrays hold languages in rows.

    likelihood  of each word in each language, document after document
    words  of each document, one at least

    The shares start even; a step gives every word to the languages in proportion to share times
    likelihood, and the shares are the words given.
    """
    starts = np.cumsum(words) - words
    shares = np.full((len(likelihood), len(words)), 1.0 / len(likelihood))
    for _ in range(STEPS):
        joint = likelihood * np.repeat(shares, words, axis=1)
        sums = joint.sum(0)
        joint /= sums
        shares = np.add.reduceat(joint, starts, axis=1) / words
    return shares, np.add.reduceat(np.log(sums), starts)


def shares_of(model: Model, texts: pa.Array) -> np.ndarray:
    """Language shares of each text, zero outside of the chosen set.

    Sets are the k languages with the largest shares in the mixture of all; the one with the largest
    likelihood less half the logarithm of the number of words for each share is chosen.
    """
    data, bounds = text_buffer(texts)
    docs, languages = len(bounds) - 1, len(model.languages)
    out = np.zeros((docs, languages))
    begins = ~_SPACE[data]
    inner = np.zeros(len(data), bool)
    inner[bounds[:-1][bounds[:-1] < len(data)]] = True
    begins[1:] &= ~begins[:-1] | inner[1:]
    starts = np.flatnonzero(begins)
    if not len(starts) or not languages:
        return out
    words = np.diff(np.searchsorted(starts, bounds))
    present = np.flatnonzero(words)
    words = words[present]
    # Blanks behind each text, as behind each text of the fit: no n-gram reaches into the next text.
    places = np.arange(len(data)) + (GRAM - 1) * np.repeat(np.arange(docs), np.diff(bounds))
    padded = np.full(len(data) + (GRAM - 1) * docs, 32, np.uint8)
    padded[places] = data
    slots = gram_slots(padded)[places]
    # A word reaches to the beginning of the next one or to the end of its text; blanks that begin a text are of no word.
    edges = np.union1d(starts, bounds[:-1][bounds[:-1] < len(data)])
    at = np.searchsorted(edges, starts)
    likelihood = np.stack([np.add.reduceat(column[slots], edges, dtype=np.float64)[at] for column in model.loglik.T.copy()])
    likelihood = np.maximum(np.exp((likelihood - likelihood.max(0)) * _EVIDENCE), 1e-12)
    full, loglik = _mixtures(likelihood, words)
    order = np.argsort(-full, axis=0, kind="stable")
    likelihood = np.take_along_axis(likelihood, np.repeat(order, words, axis=1), axis=0)
    penalty = 0.5 * np.log(words)
    best, chosen = loglik - penalty * (languages - 1), np.take_along_axis(full, order, axis=0)
    for k in range(1, languages):
        shares, found = _mixtures(likelihood[:k], words)
        gain = found - penalty * (k - 1)
        better = gain > best
        best = np.where(better, gain, best)
        chosen[:k, better], chosen[k:, better] = shares[:, better], 0.0
    out[present[None, :], order] = chosen
    return out


def predict(df: DataFrame, model: Model, keep: list[str] = ("doc_id",), text: str = "text",
            unknown: str = "und") -> DataFrame:
    """The columns ``keep``, lang_pred (the language with the largest share), score (that share) and languages
    (the chosen set with its shares).

    A text that is null or has no letter (Unicode category L), or a model without languages, gives ``unknown`` with score 0.
    Ties go to the first language by name. Nothing but the text is looked at.
    """
    share = T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("languages", T.ArrayType(share))]

    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            shares = shares_of(model, texts)
            letters = np.array([bool(x and _LETTER.search(x)) for x in texts.to_pylist()], bool)
            known = letters & (shares.sum(1) > 0) if len(model.languages) else np.zeros(len(texts), bool)
            top = shares.argmax(1) if len(model.languages) else np.zeros(len(texts), int)
            sets = [[{"lang": model.languages[i], "share": float(row[i])} for i in np.argsort(-row, kind="stable") if row[i] > 0]
                    if ok else [] for row, ok in zip(shares, known)]
            return [pa.array([model.languages[t] if ok else unknown for t, ok in zip(top, known)], pa.string()),
                    pa.array(np.clip([row[t] if ok else 0.0 for row, t, ok in zip(shares, top, known)], 0, 1)
                             if len(texts) else np.zeros(0)),
                    pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]
        return fill

    return map_texts(df, text, fields, make, list(keep))
