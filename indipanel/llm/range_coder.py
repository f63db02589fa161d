"""Context-mixing range coder for token ids; blocks are coded side by side.

A block's next id is predicted by three models that know only this block's ids so far:
order 0, counts of ranges of 512 ids; order 1 and order 2, the id that last followed
the last one or two ids. Their predictions are mixed with weights that each block adapts to how
often a prediction of its kind was right. All arithmetic is on integers, so any machine
decodes what another has encoded. Step t codes the t-th id of all blocks at once.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096  # ids of a block
LANES = 2048  # blocks coded side by side

_SHIFT = 9
_SLOTS = 4096
_GAIN = 24
_FLOOR = np.uint64(1 << 48)
_ONE = 4096
_MOST = 3584
_SIDE = 8  # ranges whose counts are cumulated together


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What follows from a miss, then from a hit: the next trust of each trust; what is added to an entry of each level,
    and whether its id is replaced; and what a range adds to the cumulated counts beside it."""
    trust, level = np.arange(_ONE), np.arange(8)
    next_trust = np.concatenate([trust - (trust >> 5), np.minimum(trust + (_ONE - trust >> 5), _MOST)])
    added = np.concatenate([(level >> 1) - level, np.minimum(level + 1, 7) - level])
    replaced = np.concatenate([level <= 1, np.zeros(8, bool)])
    beside = _GAIN * (np.arange(_SIDE + 1) > np.arange(_SIDE)[:, None])
    return next_trust.astype(np.int32), added.astype(np.int32), replaced, beside.astype(np.int32)


_ROW = np.dtype((np.void, 4 * (_SIDE + 1)))  # a row of inner counts, moved as a whole
_NEXT_TRUST, _ADDED, _REPLACED, _BESIDE = _tables()


class _Model:
    """The state of all lanes. Ids are int64 arrays; lanes drop out at the end.

    Counts of ranges are cumulated in two steps: ``starts`` has those before each group of _SIDE ranges (a row a
    group), ``inner`` those of a group before each of its ranges (a row a lane and group). What is kept by order of
    the model has a row for order 1 and one for order 2.
    """

    def __init__(self, lanes: int, max_id: int, counts: bool = True):
        self.buckets = (max_id >> _SHIFT) + 1
        self.groups = -(-self.buckets // _SIDE)
        self.small = np.uint8 if self.groups < 256 else np.int64  # holds the number of a group
        held = lanes if counts else 0
        self.starts = np.repeat(np.arange(self.groups, dtype=np.int32)[:, None] * _SIDE, held, 1)
        self.inner = np.tile(np.arange(_SIDE + 1, dtype=np.int32), (held * self.groups, 1))
        self.grid = np.arange(self.groups, dtype=np.int32)[:, None]
        self.tables = np.zeros(2 * lanes * _SLOTS, np.int32)
        self.trust = np.concatenate([np.tile(np.arange(400, 3061, 380, dtype=np.int32) + 200 * k, lanes) for k in range(2)])
        self.first_slot = np.arange(2 * lanes).reshape(2, lanes) * _SLOTS
        self.first_trust = np.arange(2 * lanes).reshape(2, lanes) * 8
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.lane = np.arange(lanes)
        self.step = 0

    def cut(self, lanes: int) -> None:
        """Keeps the first lanes."""
        for name in ("last", "before", "lane"):
            setattr(self, name, getattr(self, name)[:lanes])
        for name in ("starts", "first_slot", "first_trust"):
            setattr(self, name, getattr(self, name)[:, :lanes].copy())

    def predict(self) -> None:
        """The next ids by order 1 and 2 and the mass of each prediction, against the mass of order 0."""
        self.slots = self.first_slot.copy()
        hashed = self.last * 40503
        self.slots[0] += (hashed >> 3) & (_SLOTS - 1)
        self.slots[1] += ((hashed + self.before * 26699) >> 2) & (_SLOTS - 1)
        self._look()

    def _look(self) -> None:
        self.mass0 = (self.buckets + _GAIN * self.step) << _SHIFT
        self.entry = self.tables.take(self.slots, mode="wrap")  # all are inside; this asks less
        self.level = self.entry & 7
        self.guess = self.entry >> 3
        self.sure = self.first_trust + self.level
        self.right = self.trust.take(self.sure)
        # whole numbers below 2**53, so the division by doubles is exact when rounded down
        self.mass = (self.right * float(self.mass0) / (_ONE - self.right)).astype(np.int64)
        self.total = self.mass[0] + self.mass[1] + self.mass0

    def _counts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cumulated counts before the ranges of the ids, and the counts of these ranges."""
        group = ids >> _SHIFT + 3
        place = (self.lane * self.groups + group) * (_SIDE + 1) + ((ids >> _SHIFT) & _SIDE - 1)
        low = self.inner.ravel().take(place)
        each = self.inner.ravel().take(place + 1) - low
        return low + self.starts.ravel().take(group * len(self.lane) + self.lane).astype(np.int64), each

    def order0(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cumulated mass below the ids, and their mass."""
        low, each = self._counts(ids)
        return (low << _SHIFT) + (ids & ((1 << _SHIFT) - 1)) * each, each

    def interval(self, short: np.ndarray, below: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of ids (as int32), given theirs by order 0."""
        under, equal = self.mass * (self.guess < short), self.mass * (self.guess == short)
        return below + under[0] + under[1], each + equal[0] + equal[1]

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose interval holds the given places, with these intervals."""
        below, each = self.order0(self.guess.astype(np.int64))
        other, mass = self.guess[::-1], self.mass[::-1]
        below += mass * (other < self.guess)
        each = each + self.mass + mass * (other == self.guess)
        ends = below + each
        past = at >= ends
        inside = (at >= below) & ~past
        over = self.mass * past
        over = over[0] + over[1]
        plain = np.where(inside[0] | inside[1], 0, at - over)
        count = (plain >> _SHIFT).astype(np.int32)
        group = np.add.reduce((self.starts[1:] <= count).view(np.uint8), 0, dtype=self.small).astype(np.int64)
        start = self.starts.ravel().take(group * len(self.lane) + self.lane)
        inner, count = self.inner.ravel(), count - start
        first = (self.lane * self.groups + group) * (_SIDE + 1)
        place = first + (inner.take(first + 4) <= count) * 4
        place += (inner.take(place + 2) <= count) * 2
        place += inner.take(place + 1) <= count
        low = inner.take(place)
        each0 = inner.take(place + 1) - low
        low = (low + start).astype(np.int64) << _SHIFT
        rest = ((plain - low) / each0).astype(np.int64)  # exact, see predict
        ids, below0 = ((group * _SIDE + place - first) << _SHIFT) + rest, low + rest * each0 + over

        def chosen(a, b):
            return np.where(inside[0], a[0], np.where(inside[1], a[1], b))

        return chosen(self.guess, ids), chosen(below, below0), chosen(each, each0)

    def learn(self, ids: np.ndarray) -> None:
        short = ids.astype(np.int32)
        self._follow(short)
        group = short >> _SHIFT + 3
        self.starts += (self.grid > group) * np.int32(_GAIN)
        row = self.lane * self.groups + group
        counts = self.inner.take(row, 0) + _BESIDE.take((short >> _SHIFT) & _SIDE - 1, 0)
        self.inner.view(_ROW)[row] = counts.view(_ROW)
        self.before, self.last = self.last, ids

    def _follow(self, short: np.ndarray) -> None:
        """Order 1 and 2 learn the ids; the counts of order 0 stay."""
        hit = self.guess == short
        self.trust[self.sure] = _NEXT_TRUST.take(self.right + hit * np.int32(_ONE))
        case = self.level + hit * np.int32(8)
        self.tables[self.slots] = np.where(_REPLACED.take(case), short << 3, self.entry + _ADDED.take(case))
        self.step += 1


class _Known(_Model):
    """The state of all lanes where the ids are known beforehand: the counts of ranges and the places of
    contexts are made for some steps of all lanes at once.

    The ids of a range among a lane's earlier ones are those before these steps, from a table of counts, and those
    in these steps, each compared with all before it.
    """

    def __init__(self, ids: np.ndarray, max_id: int):
        super().__init__(ids.shape[1], max_id, counts=False)
        self.ids = ids
        self.steps = min(max(64, self.buckets // 8), 255)  # numbers below 256 count within them
        self.kind = np.uint8 if self.buckets <= 256 else np.uint32
        self.counts = np.zeros((ids.shape[1], self.buckets), np.int32)

    def _prepare(self) -> None:
        lanes, first = len(self.lane), self.step
        ids = self.ids[first: first + self.steps, :lanes]
        n = len(ids)
        ranges = (ids >> _SHIFT).astype(self.kind)
        less, same = np.zeros((2, n, lanes), np.uint8)
        found = np.empty((n, lanes), bool)
        for back in range(1, n):
            for compare, count in ((np.less, less[back:]), (np.equal, same[back:])):
                compare(ranges[:-back], ranges[back:], out=found[back:])
                count += found[back:].view(np.uint8)
        place = (ids >> _SHIFT) + self.lane * self.buckets
        counts = self.counts[:lanes]
        up_to = np.cumsum(counts, 1, dtype=np.int32).ravel().take(place)
        each = counts.ravel().take(place)
        low = up_to - each + less
        each += same
        each *= _GAIN
        each += 1
        self.each = each
        self.below = ((low.astype(np.int64) * _GAIN + (ids >> _SHIFT)) << _SHIFT) + (ids & ((1 << _SHIFT) - 1)) * each
        counts += np.bincount(place.ravel(), minlength=counts.size).reshape(counts.shape)
        before = np.zeros((n + 2, lanes), np.int64)
        before[max(2 - first, 0):] = self.ids[max(first - 2, 0): first + n, :lanes]
        hashed = before[1:-1] * 40503
        self.places = np.stack([(hashed >> 3) & (_SLOTS - 1), ((hashed + before[:-2] * 26699) >> 2) & (_SLOTS - 1)], 1)
        self.places += self.first_slot
        self.short = ids.astype(np.int32)

    def next(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the next ids of the first lanes, which are learned too; self.total has the whole mass."""
        at = self.step % self.steps
        if lanes < len(self.lane):
            self.cut(lanes)
        if at == 0:
            self._prepare()
        self.slots = self.places[at, :, :lanes]
        self._look()
        short = self.short[at, :lanes]
        below, each = self.interval(short, self.below[at, :lanes], self.each[at, :lanes])
        self._follow(short)
        return below, each


def _in_lanes(sizes: list[int]) -> list[np.ndarray]:
    """Blocks in sets of up to LANES, the longest first."""
    order = np.argsort(-np.array(sizes, np.int64), kind="stable")
    return [order[i: i + LANES] for i in range(0, len(order), LANES)]


def _lanes_left(sizes: np.ndarray) -> list[int]:
    """How many blocks have an id at each step; the longest come first."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left").tolist()


def _encode(blocks: list[np.ndarray], max_id: int) -> list[bytes]:
    sizes, lanes = np.array([len(b) for b in blocks]), len(blocks)
    ids = np.zeros((sizes[0], lanes), np.int64)
    for k, b in enumerate(blocks):
        ids[: len(b), k] = b
    model = _Known(ids, max_id)
    words = np.zeros((3 * int(sizes[0]) + 8, lanes), np.uint32)  # the words at one place of all lanes lie together
    flat, put = words.ravel(), np.arange(lanes)  # where each lane's next word goes
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    for n in _lanes_left(sizes):
        below, each = model.next(n)
        unit = width[:n] // model.total.astype(np.uint64)
        moved = low[:n] + unit * below.astype(np.uint64)
        over = np.flatnonzero(moved < low[:n])
        flat[put[over] - lanes] += 1
        low[:n], width[:n] = moved, unit * each.astype(np.uint64)
        # every lane writes a word; where the place does not move on, the next one takes its place
        small = width[:n] < _FLOOR
        flat[put[:n]] = low[:n] >> np.uint64(48)
        put[:n] += small * lanes
        shift = small * np.uint64(16)
        low[:n] <<= shift
        width[:n] <<= shift
        small = np.flatnonzero(width[:n] < _FLOOR)
        while len(small):
            flat[put[small]] = low[small] >> np.uint64(48)
            put[small] += lanes
            low[small] <<= np.uint64(16)
            width[small] <<= np.uint64(16)
            small = small[width[small] < _FLOOR]
    for _ in range(4):
        flat[put] = low >> np.uint64(48)
        put += lanes
        low <<= np.uint64(16)
    at = put // lanes
    for place in range(int(at.max()) - 1, 0, -1):  # carries, from the last word to the first
        words[place - 1] += words[place] >> 16
    words = np.ascontiguousarray(words[: int(at.max())].T.astype(">u2"))  # without the carries
    return [w[:n].tobytes() for w, n in zip(words, at)]


def _decode(codes: list[bytes], sizes: np.ndarray, max_id: int) -> list[np.ndarray]:
    lanes = len(codes)
    words = np.zeros((lanes, max(map(len, codes)) // 2 + 4), np.uint16)
    for k, c in enumerate(codes):
        words[k, : len(c) // 2] = np.frombuffer(c, ">u2")
    words = np.ascontiguousarray(words.T)  # the words at one place of all lanes lie together
    flat, get = words.ravel(), 4 * lanes + np.arange(lanes)
    code = np.zeros(lanes, np.uint64)
    for place in range(4):
        code = code << np.uint64(16) | words[place]
    width = np.full(lanes, (1 << 64) - 1, np.uint64)
    model = _Model(lanes, max_id)
    ids = np.zeros((int(sizes[0]), lanes), np.uint32)
    for step, n in enumerate(_lanes_left(sizes)):
        if n < len(model.lane):
            model.cut(n)
        model.predict()
        unit = width[:n] // model.total.astype(np.uint64)
        x, below, each = model.find(np.minimum((code[:n] // unit).astype(np.int64), model.total - 1))
        code[:n] -= unit * below.astype(np.uint64)
        width[:n] = unit * each.astype(np.uint64)
        model.learn(x)
        ids[step, :n] = x
        small = width[:n] < _FLOOR
        shift = small * np.uint64(16)
        code[:n] = code[:n] << shift | flat.take(get[:n]) * small
        get[:n] += small * lanes
        width[:n] <<= shift
        small = np.flatnonzero(width[:n] < _FLOOR)
        while len(small):
            code[small] = code[small] << np.uint64(16) | flat[get[small]]
            get[small] += lanes
            width[small] <<= np.uint64(16)
            small = small[width[small] < _FLOOR]
    ids = np.ascontiguousarray(ids.T)
    return [i[:n].copy() for i, n in zip(ids, sizes)]


def encode_blocks(blocks: list[np.ndarray], max_id: int) -> list[bytes]:
    """The code of each block; every block starts from the same fresh model."""
    out = [b""] * len(blocks)
    for lanes in _in_lanes([len(b) for b in blocks]):
        lanes = [k for k in lanes if len(blocks[k])]
        for k, code in zip(lanes, _encode([blocks[k] for k in lanes], max_id) if lanes else []):
            out[k] = code
    return out


def decode_blocks(codes: list[bytes], sizes: list[int], max_id: int) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    out = [np.zeros(0, np.uint32)] * len(codes)
    for lanes in _in_lanes(sizes):
        lanes = [k for k in lanes if sizes[k]]
        made = _decode([codes[k] for k in lanes], np.array([sizes[k] for k in lanes]), max_id) if lanes else []
        for k, ids in zip(lanes, made):
            out[k] = ids
    return out
