"""Finite automata from a small regular-expression language, over bytes.

Rules may use literals, [...] classes with ranges and ^, escapes (\\xNN, \\d, \\w, \\s), groups,
alternatives, and the repeats ? * + {m} {m,} {m,n}. A match is the longest one at the
leftmost place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ESCAPES = {
    "d": frozenset(range(48, 58)),
    "w": frozenset([*range(48, 58), *range(65, 91), 95, *range(97, 123)]),
    "s": frozenset([9, 10, 11, 12, 13, 32]),
    "n": frozenset([10]), "t": frozenset([9]), "r": frozenset([13]),
}


def _parse(rule: str, ignore_case: bool):
    """Syntax tree: ('set', bytes), ('cat', parts), ('or', parts), ('rep', part, least, most)."""
    at = 0

    def folded(found: frozenset) -> frozenset:
        if not ignore_case:
            return found
        lower = {b + 32 for b in found if 65 <= b <= 90}
        return found | lower | {b - 32 for b in found if 97 <= b <= 122}

    def escaped() -> frozenset:
        nonlocal at
        c = rule[at]
        at += 1
        if c == "x":
            at += 2
            return frozenset([int(rule[at - 2: at], 16)])
        return _ESCAPES.get(c, frozenset([ord(c)]))

    def bracket() -> frozenset:
        nonlocal at
        negate = rule[at] == "^"
        at += negate
        found: set[int] = set()
        first = True
        while first or rule[at] != "]":
            first = False
            if rule[at] == "\\":
                at += 1
                part = escaped()
            else:
                part = frozenset([ord(rule[at])])
                at += 1
            if len(part) == 1 and rule[at] == "-" and rule[at + 1] != "]":
                at += 1
                if rule[at] == "\\":
                    at += 1
                    last = max(escaped())
                else:
                    last = ord(rule[at])
                    at += 1
                part = frozenset(range(min(part), last + 1))
            found |= part
        at += 1
        chosen = folded(frozenset(found))
        return frozenset(range(256)) - chosen if negate else chosen

    def atom():
        nonlocal at
        c = rule[at]
        at += 1
        if c == "(":
            if rule[at: at + 2] == "?:":
                at += 2
            inner = alternatives()
            at += 1
            return inner
        if c == "[":
            return ("set", bracket())
        if c == "\\":
            return ("set", folded(escaped()))
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        return ("cat", [("set", folded(frozenset([b]))) for b in c.encode()])

    def repeated():
        nonlocal at
        node = atom()
        while at < len(rule) and rule[at] in "?*+{":
            c = rule[at]
            at += 1
            if c == "{":
                end = rule.index("}", at)
                least, comma, most = rule[at:end].partition(",")
                at = end + 1
                node = ("rep", node, int(least), int(most) if most else None if comma else int(least))
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def sequence():
        parts = []
        while at < len(rule) and rule[at] not in "|)":
            parts.append(repeated())
        return ("cat", parts)

    def alternatives():
        nonlocal at
        ways = [sequence()]
        while at < len(rule) and rule[at] == "|":
            at += 1
            ways.append(sequence())
        return ways[0] if len(ways) == 1 else ("or", ways)

    tree = alternatives()
    if at != len(rule):
        raise ValueError(f"rule not understood from character {at}: {rule}")
    return tree


def _backwards(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", _backwards(tree[1]), *tree[2:])
    parts = [_backwards(x) for x in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _States:
    """A nondeterministic automaton under construction."""

    def __init__(self):
        self.free: list[list[int]] = []  # moves without a byte
        self.step: list[tuple[frozenset, int] | None] = []

    def new(self) -> int:
        self.free.append([])
        self.step.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """The state reached from ``start`` by what the tree matches."""
        kind = tree[0]
        if kind == "set":
            end, mid = self.new(), self.new()
            self.free[start].append(mid)
            self.step[mid] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.new()
            for part in tree[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.new()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        end = self.new()
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """Transition array of a minimal deterministic automaton.

    classes  class of each byte: bytes that no rule tells apart share one
    moves    next state for (state, class)
    accepts  bit i of a state: rule i has matched there
    start    state before the first byte; dead: the state that nothing leaves, -1 without one
    """

    classes: np.ndarray
    moves: np.ndarray
    accepts: np.ndarray
    start: int
    dead: int


def _byte_classes(nfa: _States) -> tuple[np.ndarray, list[int]]:
    sets = sorted({s[0] for s in nfa.step if s}, key=sorted)
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)
    return classes, [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]


def _minimal(moves: np.ndarray, accepts: np.ndarray) -> np.ndarray:
    """Group of each state: states in one group accept alike and move to the same groups."""
    groups = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        rows = np.column_stack([groups, groups[moves]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == groups.max():
            return groups
        groups = finer


def compile_rules(rules: list[tuple[str, bool]], anywhere: bool = False, backwards: bool = False) -> Automaton:
    """One automaton for all rules, given as (expression, ignore case), by subset construction.

    anywhere   a match may begin after any byte; else only at the start
    backwards  for texts read from their last byte to their first
    """
    nfa = _States()
    root = nfa.new()
    finals = {}
    for i, (rule, ignore_case) in enumerate(rules):
        tree = _parse(rule, ignore_case)
        finals[nfa.add(_backwards(tree) if backwards else tree, root)] = 1 << i
    classes, samples = _byte_classes(nfa)
    first = nfa.closure([root])
    number, todo, moves, accepts = {first: 0}, [first], [], []
    while todo:
        state = todo.pop(0)
        accepts.append(sum({finals[s] for s in state if s in finals}))
        row = []
        for b in samples:
            reached = {nfa.step[s][1] for s in state if nfa.step[s] and b in nfa.step[s][0]}
            after = nfa.closure(reached | {root} if anywhere else reached)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        moves.append(row)
    table, ends = np.array(moves), np.array(accepts)
    groups = _minimal(table, ends)
    chosen = np.unique(groups, return_index=True)[1]
    table, ends = groups[table[chosen]], ends[chosen]
    dead = [s for s in range(len(table)) if not ends[s] and (table[s] == s).all()]
    return Automaton(classes, table.astype(np.int32), ends.astype(np.int64), int(groups[0]), dead[0] if dead else -1)


def longest_match(dfa: Automaton, text: bytes, start: int) -> int:
    """End of the longest match of an anchored automaton, -1 without one."""
    moves, classes, accepts, state, end = dfa.moves, dfa.classes, dfa.accepts, dfa.start, -1
    for at in range(start, len(text)):
        state = moves[state, classes[text[at]]]
        if state == dfa.dead:
            break
        if accepts[state]:
            end = at + 1
    return end


def resetting_bytes(dfa: Automaton) -> np.ndarray:
    """Whether a byte leads from every state to the start: what follows does not depend on what was before."""
    return (dfa.moves == dfa.start).all(axis=0)[dfa.classes]


def accepted_positions(dfa: Automaton, data: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(positions, rule bits) of all bytes after which a rule has matched, reading from the last byte.

    The bytes are cut right after resetting bytes into lanes of about equal length, and
    all lanes take a step at a time. No state is lost at a cut, as the byte before it
    (the lane's last to be read belongs to the next lane) leads every state to the start.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = dfa.moves.shape[1]
    moves = (dfa.moves * width).ravel().astype(np.int32)
    accepts = np.repeat(dfa.accepts, width)
    hit = accepts != 0
    kinds = dfa.classes[data].astype(np.int32)
    resets = np.flatnonzero(resetting_bytes(dfa)[data])
    # A lane covers [begin, end) and is read from end - 1 down; the byte at ``end`` is a resetting one.
    wanted = np.arange(1, lanes) * (n // lanes)
    at = np.searchsorted(resets, wanted)
    ends = np.unique(np.append(resets[at[at < len(resets)]], n)) if n >= lanes * 16 else np.array([n])
    begins = np.append(0, ends[:-1])
    order = np.argsort(begins - ends, kind="stable")  # longest first, so that the lanes that end are the last ones
    place, left = ends[order] - 1, (ends - begins)[order]
    state = np.full(len(order), dfa.start * width, np.int32)
    places, bits = [], []
    for step in range(int(left[0])):
        active = np.searchsorted(-left, -step, side="left")
        if active < len(state):
            state, place = state[:active], place[:active]
            if active < 24:
                break
        state = moves[state + kinds[place]]
        found = np.flatnonzero(hit[state])
        if len(found):
            places.append(place[found])
            bits.append(accepts[state[found]])
        place = place - 1
    else:
        step = int(left[0])
    for lane in range(len(state) if step < left[0] else 0):  # few long lanes: byte by byte
        s, p = int(state[lane]), int(place[lane])
        rest = kinds[p - int(left[lane]) + step + 1: p + 1][::-1].tolist()
        table, flags = moves.tolist(), hit.tolist()
        for k, kind in enumerate(rest):
            s = table[s + kind]
            if flags[s]:
                places.append(np.array([p - k]))
                bits.append(accepts[s: s + 1])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, found = np.concatenate(places), np.concatenate(bits)
    order = np.argsort(at)
    return at[order], found[order]
