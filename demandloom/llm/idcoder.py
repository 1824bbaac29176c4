"""Adaptive context-mixing range coder for token ids.

A block of ids is cut into lanes of equal length that are coded in step, so one
numpy operation serves all lanes. They share one model, which both sides update
alike after every step:

* order 2: the id seen last after the two preceding ones, with a confidence;
* order 1: the same after one preceding id;
* order 0: the frequencies of all ids.

The three predictions are mixed: how often each of them was right at the present
confidences sets its share of the range, and the order-0 share is divided among
the ids by frequency. Each lane has its own range coder with 64 bits that gives
out 16 at a time. Nothing outlives a block.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"TIDB0003"
#: Lanes of a large block; a small one has a lane for every LEAST ids.
LANES, LEAST = 8192, 48
#: Slots of the order-2 table, shares of the mix (two to the power), largest sum of the order-0 counts.
SLOTS, SHARE_BITS, MOST = 1 << 19, 12, 1 << 19
SHARES = 1 << SHARE_BITS
#: Ids have to be below this, so that each gets a part of the smallest range.
MOST_IDS = 1 << 19
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_U16, _U48 = np.uint64(16), np.uint64(48)
_HEADER = np.dtype([("ids", "<u4"), ("vocabulary", "<u4"), ("lanes", "<u4"), ("words", "<u4")])


# What a wrong guess of each confidence loses.
_LOSS = np.array([s - (s >> 1) for s in range(8)], np.int32)


class _Model:
    """What both sides know before a step; a guess and its confidence of 0 to 7 share a number."""

    def __init__(self, vocabulary: int) -> None:
        self.vocabulary = vocabulary
        # the order-0 frequencies add up to a power of two, so that a range is divided by a shift
        self.bits = 19 if vocabulary <= 1 << 18 else 20
        self.shift = np.uint64(SHARE_BITS + self.bits)
        self.after2 = np.zeros(SLOTS, np.int32)
        self.after1 = np.zeros(vocabulary + 1, np.int32)
        self.frequency = np.ones(vocabulary, np.int64)
        self.outcomes = np.tile(np.array([1.0, 1.0, 2.0]), (128, 1))
        self.pending: list[np.ndarray] = []
        self.step = 0
        self._sum()
        self._mix()

    def _sum(self) -> None:
        if self.pending:
            self.frequency += 24 * np.bincount(np.concatenate(self.pending), minlength=self.vocabulary)
            self.pending = []
        total = int(self.frequency.sum())
        while total > MOST and total > 2 * self.vocabulary:
            self.frequency = (self.frequency + 1) >> 1
            total = int(self.frequency.sum())
        counted = np.concatenate([[0], np.cumsum(self.frequency)])
        # one part for every id, the others by count
        ends = counted * ((1 << self.bits) - self.vocabulary) // total + np.arange(self.vocabulary + 1)
        self.places = None
        self.below = ends.astype(np.uint64)
        self.weight = np.diff(ends).astype(np.uint64)

    def symbols(self) -> np.ndarray:
        """The id at each place of the order-0 part; the decoder asks for it, once a sum."""
        if self.places is None:
            self.places = np.repeat(np.arange(self.vocabulary, dtype=np.int32), self.weight.astype(np.int64))
        return self.places

    def _mix(self) -> None:
        """The ends of the shares of order 2 and order 1, and the unit of order 0, for each state of the confidences."""
        shares = self.outcomes / self.outcomes.sum(axis=1, keepdims=True) * (SHARES - 3)
        first, second = shares[:, 0].astype(np.int64) + 1, shares[:, 1].astype(np.int64) + 1
        second[1::2] = 0  # both guesses are the same id
        self.unit0 = (SHARES - first - second).astype(np.uint64)
        self.first, self.both = first.astype(np.uint64), (first + second).astype(np.uint64)
        self.ends2, self.ends12 = self.first << np.uint64(self.bits), self.both << np.uint64(self.bits)

    def look(self, one: np.ndarray, two: np.ndarray) -> None:
        """The guesses and shares after the ids ``one`` and, before it, ``two``."""
        self.slot = (one * 40503 + two * 668265263) & (SLOTS - 1)
        self.one = one
        self.p2, self.p1 = self.after2.take(self.slot), self.after1.take(one)
        self.g2, self.g1 = self.p2 >> 3, self.p1 >> 3
        self.s2, self.s1 = self.p2 & 7, self.p1 & 7
        self.state = (self.s2 << 4) + (self.s1 << 1) + (self.g1 == self.g2)
        self.end2, self.end12 = self.ends2.take(self.state), self.ends12.take(self.state)
        self.part0 = self.unit0.take(self.state)

    def learn(self, ids: np.ndarray, by2: np.ndarray, by1: np.ndarray) -> None:
        outcome = 2 - by1.view(np.int8) - 2 * by2.view(np.int8)
        self.outcomes += np.bincount(self.state * 3 + outcome, minlength=384).reshape(128, 3)
        fresh = (ids << 3) + 1
        self._adjust(self.after2, self.slot, self.p2, self.s2, by2, fresh)
        self._adjust(self.after1, self.one, self.p1, self.s1, ids == self.g1, fresh)
        self.pending.append(ids[outcome == 2])
        self.step += 1
        if self.step < 8 or self.step % 16 == 0:
            self._sum()
            self._mix()

    @staticmethod
    def _adjust(table: np.ndarray, at: np.ndarray, packed: np.ndarray, sure: np.ndarray, right: np.ndarray, fresh: np.ndarray) -> None:
        """A right guess gains confidence; a wrong one loses half of it, and at the last is replaced."""
        lost = np.where(sure > 1, packed - _LOSS.take(sure), fresh)
        table[at] = np.where(right, packed + (sure < 7), lost)


def _shape(count: int) -> tuple[int, int]:
    """Number of lanes and ids in each but the last ones."""
    lanes = max(1, min(LANES, count // LEAST))
    return lanes, -(-count // lanes)


def _active(count: int, length: int, step: int) -> int:
    """How many lanes have an id at this step; they are the first ones."""
    return (count - 1 - step) // length + 1


def _settled(low: np.ndarray, span: np.ndarray, at: np.ndarray | None) -> np.ndarray:
    """The lanes, among ``at``, whose highest 16 bits are fixed; a range too narrow to go on is cut so that they are."""
    a, s = (low, span) if at is None else (low.take(at), span.take(at))
    fixed = (a ^ (a + s)) < _TOP
    narrow = s < _BOTTOM
    narrow &= ~fixed
    if narrow.any():
        here = np.flatnonzero(narrow)
        cut = (~a[here] + np.uint64(1)) & (_BOTTOM - np.uint64(1))
        span[here if at is None else at[here]] = cut
        fixed |= narrow
    return np.flatnonzero(fixed) if at is None else at[fixed]


def encode_block(ids: np.ndarray) -> bytes:
    """A block of ids below ``MOST_IDS`` as bytes, readable without any other block."""
    ids = np.ascontiguousarray(ids, np.int32)
    count = len(ids)
    if count and not 0 <= int(ids.min()) <= int(ids.max()) < MOST_IDS:
        raise ValueError(f"ids have to be 0 to {MOST_IDS - 1}")
    if not count:
        return _packed(count, 0, 0, np.zeros(0, np.uint32), np.zeros(0, np.uint16))
    vocabulary = int(ids.max()) + 1
    lanes, length = _shape(count)
    table = np.zeros((lanes, length), np.int32)
    table.reshape(-1)[:count] = ids
    steps = np.ascontiguousarray(table.T)
    model = _Model(vocabulary)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    one, two = np.full(lanes, vocabulary, np.int32), np.full(lanes, vocabulary, np.int32)
    out_lane: list[np.ndarray] = []
    out_word: list[np.ndarray] = []
    for step in range(length):
        n = _active(count, length, step)
        y, a, s = steps[step, :n], low[:n], span[:n]
        model.look(one[:n], two[:n])
        by2 = y == model.g2
        by1 = (y == model.g1) & ~by2
        part0, end2, end12 = model.part0, model.end2, model.end12
        start = np.where(by2, np.uint64(0), np.where(by1, end2, end12 + part0 * model.below.take(y)))
        width = np.where(by2, end2, np.where(by1, end12 - end2, part0 * model.weight.take(y)))
        s >>= model.shift
        a += s * start
        s *= width
        at = _settled(a, s, None)
        while len(at):
            leaving = a.take(at)
            out_lane.append(at.astype(np.uint16))
            out_word.append((leaving >> _U48).astype(np.uint16))
            a[at] = leaving << _U16
            s[at] <<= _U16
            at = _settled(a, s, at)
        model.learn(y, by2, by1)
        two[:n], one[:n] = one[:n], y
    # any number inside the last range ends a lane; one with 32 zero bits takes two words
    last = (low + (_BOTTOM - np.uint64(1))) >> np.uint64(32)
    every = np.arange(lanes, dtype=np.uint16)
    out_lane += [every, every]
    out_word += [(last >> _U16).astype(np.uint16), (last & np.uint64(0xFFFF)).astype(np.uint16)]
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane, kind="stable")
    return _packed(count, vocabulary, lanes, np.bincount(lane, minlength=lanes).astype(np.uint32), word[order])


def _packed(count: int, vocabulary: int, lanes: int, sizes: np.ndarray, words: np.ndarray) -> bytes:
    header = np.array([(count, vocabulary, lanes, len(words))], _HEADER).tobytes()
    body = header + sizes.astype("<u4").tobytes() + words.astype("<u2").tobytes()
    return MAGIC + zlib.crc32(body).to_bytes(4, "little") + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if its checksum does not fit."""
    body = block[len(MAGIC) + 4 :]
    if block[: len(MAGIC)] != MAGIC or zlib.crc32(body) != int.from_bytes(block[len(MAGIC) : len(MAGIC) + 4], "little"):
        raise ValueError("damaged block of token ids")
    count, vocabulary, lanes, size = (int(x) for x in np.frombuffer(body, _HEADER, 1)[0])
    if not count:
        return np.zeros(0, np.int32)
    at_sizes = _HEADER.itemsize
    sizes = np.frombuffer(body, "<u4", lanes, at_sizes).astype(np.int64)
    # reading runs up to four words past a lane's end, where zeros stand
    words = np.zeros(size + 4 * lanes, np.uint64)
    lane = np.repeat(np.arange(lanes), sizes)
    words[np.arange(size) + 4 * lane] = np.frombuffer(body, "<u2", size, at_sizes + 4 * lanes)
    place = np.cumsum(sizes) - sizes + 4 * np.arange(lanes)
    _, length = _shape(count)
    steps = np.zeros((length, lanes), np.int32)
    model = _Model(vocabulary)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _U16) | words.take(place)
        place += 1
    one, two = np.full(lanes, vocabulary, np.int32), np.full(lanes, vocabulary, np.int32)
    whole = (np.uint64(1) << model.shift) - np.uint64(1)
    for step in range(length):
        n = _active(count, length, step)
        a, s, c = low[:n], span[:n], code[:n]
        model.look(one[:n], two[:n])
        part0, end2, end12 = model.part0, model.end2, model.end12
        s >>= model.shift
        found = np.minimum((c - a) // s, whole)
        by2 = found < end2
        by1 = (found < end12) & ~by2
        y = np.where(by2, model.g2, model.g1)
        rest = np.flatnonzero(found >= end12)
        bases, units = end12.take(rest), part0.take(rest)
        # whole numbers below 2**32, whose quotient a double rounds down right
        inside = ((found.take(rest) - bases).astype(np.float64) / units.astype(np.float64)).astype(np.int32)
        symbols = model.symbols().take(inside)
        y[rest] = symbols
        start, width = np.where(by2, np.uint64(0), end2), np.where(by2, end2, end12 - end2)
        start[rest] = bases + units * model.below.take(symbols)
        width[rest] = units * model.weight.take(symbols)
        a += s * start
        s *= width
        at = _settled(a, s, None)
        while len(at):
            where = place.take(at)
            place[at] = where + 1
            c[at] = (c.take(at) << _U16) | words.take(where)
            a[at] <<= _U16
            s[at] <<= _U16
            at = _settled(a, s, at)
        model.learn(y, by2, by1)
        two[:n], one[:n] = one[:n], y
        steps[step, :n] = y
    return np.ascontiguousarray(steps.T).reshape(-1)[:count]
