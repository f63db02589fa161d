"""Secret scans: all rules in one automaton, one pass over the bytes."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import accepted_positions, compile_rules, longest_match
from .common import map_texts, text_buffer


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    valid  whether a match, as bytes, counts; a match that does not count still uses up its place
    base   whether the kind belongs to the base digest
    head   a pattern that begins where ``pattern`` does and is shorter, to find the beginnings by
    """

    kind: str
    pattern: str
    ignore_case: bool = False
    valid: Callable[[bytes], bool] | None = None
    base: bool = False
    head: str | None = None


def _long_value(match: bytes) -> bool:
    """Whether what is assigned has six characters: what follows the first : or =, blanks and a quote."""
    value = re.split(rb"[:=]", match, maxsplit=1)[1].lstrip(b" ")
    return len(value[1:] if value[:1] in (b'"', b"'") else value) >= 6


def _at_least(n: int) -> Callable[[bytes], bool]:
    return lambda match: len(match) >= n


# The kinds of the base digest. Lengths are looked at after the match, as counters of
# several rules would multiply the states; only the run of hex digits, which may begin
# anywhere in a text, is counted by the automaton, as it is matched as a whole or not at all.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         True, _long_value, True),
    Rule("access", r"AKIA[A-Z0-9]+", valid=_at_least(20), base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
)

_PRIVATE_KEY = r"-----BEGIN ([A-Z0-9]+\x20)*PRIVATE KEY-----"

# Public formats of keys and tokens.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", valid=_at_least(40)),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", valid=_at_least(15)),
    Rule("google", r"AIza[A-Za-z0-9_-]+", valid=_at_least(39)),
    # Up to the END line; of a key that is cut off, its headers and the lines of Base64 that follow.
    Rule("private_key", _PRIVATE_KEY + r"(([A-Za-z0-9+/=:,.\\\x20\t\r\n]|-[A-Za-z0-9])*-----END ([A-Z0-9]+\x20)*PRIVATE KEY-----"
         r"|((\r|\n|\\r|\\n)+(Proc-Type|DEK-Info):[A-Za-z0-9,\x20-]*)*((\x20|\t|\r|\n|\\r|\\n)+[A-Za-z0-9+/=]{16,}"
         r"((\r|\n|\\r|\\n)+[A-Za-z0-9+/=]{1,15})?)*)", head=_PRIVATE_KEY),
)

RULES = BASE + MORE


class Scanner:
    """The rules compiled: one automaton for all of them, and one per rule for where a match ends."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.starts = compile_rules([(r.head or r.pattern, r.ignore_case) for r in rules], anywhere=True, backwards=True)
        self.ends = [compile_rules([(r.pattern, r.ignore_case)]) for r in rules]

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text the sorted (start, rule, end) in code points.

        The pass reads backwards, so that it finds where matches begin; of these, each rule
        takes the leftmost ones that do not overlap, each as long as it can be.
        """
        n = len(bounds) - 1
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        glued = np.full(len(data) + n, 0xFF, np.uint8)  # a byte that no text has behind each: no match crosses it
        glued[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(bounds))] = data
        cuts = (bounds + np.arange(n + 1)).tolist()
        at, bits = accepted_positions(self.starts, glued)
        texts: dict[int, bytes] = {}
        used: dict[tuple[int, int], int] = {}
        for place, hit in zip(at.tolist(), bits.tolist()):
            k = bisect_right(cuts, place) - 1
            text = texts.get(k)
            if text is None:
                text = texts[k] = glued[cuts[k]: cuts[k + 1] - 1].tobytes()
            start = place - cuts[k]
            for i, rule in enumerate(self.rules):
                if hit >> i & 1 and start >= used.get((k, i), 0):
                    end = longest_match(self.ends[i], text, start)
                    if end > start:
                        used[k, i] = end
                        if rule.valid is None or rule.valid(text[start:end]):
                            found[k].append((start, i, end))
        for k, text in texts.items():
            if found[k] and not text.isascii():
                before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                found[k] = [(int(before[a]), i, int(before[b])) for a, i, b in found[k]]
            found[k].sort()
        return found


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType())])


def find_secrets(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` and secrets: an array of kind, start and end (code points, end exclusive).

    Within a kind matches do not overlap; matches of different kinds may. They are in the
    order of start, then of the kind in ``rules``. A null or empty text has none. Rows are
    independent of each other, so repeated rows repeat the result; columns not named are not read.
    """
    names = [r.kind for r in rules]
    scanner = Scanner(rules)

    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            found = scanner.spans(*text_buffer(texts))
            return [pa.array([[{"kind": names[i], "start": a, "end": b} for a, i, b in spans] for spans in found],
                             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
        return fill

    return map_texts(df, text, [T.StructField("secrets", T.ArrayType(_SPAN))], make, list(keep))


def redacted(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret in ``text`` replaced by a mark; ``n_chars``, if there, is counted anew.

    Overlapping secrets share one mark. A null text stays null; columns and their order stay.
    """
    scanner = Scanner(rules)

    def make():
        def fill(texts: pa.Array) -> list[pa.Array]:
            out = texts.to_pylist()
            for k, spans in enumerate(scanner.spans(*text_buffer(texts))):
                if not spans:
                    continue
                parts, at = [], 0
                for a, _, b in spans:
                    if a >= at:
                        parts += [out[k][at:a], mark]
                    at = max(at, b)
                out[k] = "".join([*parts, out[k][at:]])
            return [pa.array(out, pa.string())]
        return fill

    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("_row"), "text")
    out = map_texts(rows, "text", [T.StructField("text", T.StringType())], make, ["_row"])
    length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in others else None
    changed = out.select("_row.*", "text")
    return (changed.withColumn("n_chars", length) if length is not None else changed).select(*docs.columns)
