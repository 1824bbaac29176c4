"""A run-length grammar by recompression, and longest common extensions on it.

Level 0 is the sequence itself. A block pass replaces every maximal repetition of
a letter by one letter, a pair pass replaces the pairs whose first letter is of
the left and whose second is of the right half of the alphabet; the passes
alternate until little is left. Equal letters or pairs get equal names, so a name
stands for one rule of the grammar, and how a stretch is parsed depends on the
stretch and the letters next to it only.

All letters of all levels are nodes of flat arrays, numbered level by level, so a
letter's neighbours are the numbers before and after it, and many extensions are
computed at once.
"""

from __future__ import annotations

import numpy as np

#: Odd multipliers that deal names to the two halves of the alphabet anew at every level.
MIX_NAME, MIX_LEVEL = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Grammar:
    """The parse of ``letters``: int array of names from 0 on; names from ``fixed`` on are never paired.

    Names that must not match anything else (ends of texts) are given once each.
    ``few`` is the length at which the passes stop.
    """

    def __init__(self, letters: np.ndarray, fixed: int, few: int) -> None:
        letters = letters.astype(np.int64)
        self.rules = int(letters.max(initial=0)) + 1
        self.fixed = (fixed, self.rules)
        self._names, self._sizes = [letters], [np.ones(len(letters), np.int64)]
        self._firsts, self._counts, self._blocks = [], [], []
        level = idle = 0
        while len(self._names[-1]) > few and idle < 40:
            before = len(self._names[-1])
            self._block_pass()
            self._pair_pass(level)
            idle = idle + 1 if len(self._names[-1]) == before else 0
            level += 1
        self._number()

    def _block_pass(self) -> None:
        names = self._names[-1]
        starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        if len(starts) == len(names):
            return
        counts = np.diff(np.r_[starts, len(names)])
        heads = names[starts].copy()
        long = np.flatnonzero(counts > 1)
        heads[long] = self._new_names(heads[long], counts[long])
        self._push(heads, starts, counts, True)

    def _pair_pass(self, level: int) -> None:
        names = self._names[-1]
        mixed = names.astype(np.uint64) * np.uint64(MIX_NAME) + np.uint64((level + 1) * MIX_LEVEL % 2**64)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(MIX_LEVEL)
        left = (mixed >> np.uint64(40)) & np.uint64(1) == 0
        free = (names < self.fixed[0]) | (names >= self.fixed[1])
        one = left[:-1] & ~left[1:] & free[:-1] & free[1:]
        other = ~left[:-1] & left[1:] & free[:-1] & free[1:]
        paired = one if np.count_nonzero(one) >= np.count_nonzero(other) else other
        at = np.flatnonzero(paired)
        if not len(at):
            return
        kept = np.ones(len(names), bool)
        kept[at + 1] = False
        starts = np.flatnonzero(kept)
        counts = np.diff(np.r_[starts, len(names)])
        heads = names[starts].copy()
        heads[counts == 2] = self._new_names(names[at], names[at + 1])
        self._push(heads, starts, counts, False)

    def _new_names(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rules, which = np.unique((a << 32) | b, return_inverse=True)
        start = self.rules
        self.rules += len(rules)
        return which + start

    def _push(self, heads: np.ndarray, starts: np.ndarray, counts: np.ndarray, block: bool) -> None:
        self._sizes.append(np.add.reduceat(self._sizes[-1], starts))
        self._names.append(heads)
        self._firsts.append(starts)
        self._counts.append(counts)
        self._blocks.append(block)

    def _number(self) -> None:
        """Flat arrays of all nodes; ``left`` and ``right`` say how far equal letters reach in a node's block."""
        lengths = [len(n) for n in self._names]
        starts = np.r_[0, np.cumsum(lengths)]
        total = int(starts[-1])
        self.name = np.concatenate(self._names).astype(np.int32)
        self.size = np.concatenate(self._sizes)
        self.parent = np.full(total, -1, np.int32)
        self.child = np.full((2, total), -1, np.int32)
        self.edge = np.zeros((2, total), bool)
        self.reach = np.ones((2, total), np.int32)
        for level, (first, count, block) in enumerate(zip(self._firsts, self._counts, self._blocks, strict=True)):
            low, high, end = starts[level], starts[level + 1], starts[level + 2]
            owner = np.repeat(np.arange(high, end), count)
            inside = np.arange(lengths[level]) - np.repeat(first, count)
            after = np.repeat(count, count) - inside
            self.parent[low:high] = owner
            self.child[0, high:end] = low + first
            self.child[1, high:end] = low + first + count - 1
            self.edge[0, low:high] = inside == 0
            self.edge[1, low:high] = after == 1
            if block:
                self.reach[0, low:high] = after
                self.reach[1, low:high] = inside + 1
        del self._names, self._sizes, self._firsts, self._counts, self._blocks

    def extend(self, a: np.ndarray, b: np.ndarray, backward: bool = False) -> np.ndarray:
        """How many letters from positions ``a`` and ``b`` on agree (backward: up to them, both included).

        Every pair of different positions has to meet a difference before an end of the sequence.
        An extension climbs while both positions begin a letter of the next
        level, steps over equal letters, and goes down for good at the first difference.
        """
        side, step = (1, -1) if backward else (0, 1)
        edge, child, reach = self.edge[side], self.child[side], self.reach[side]
        name, size, parent = self.name, self.size, self.parent
        u, v = a.astype(np.int64), b.astype(np.int64)
        found = np.zeros(len(u), np.int64)
        rising = np.ones(len(u), bool)
        active = np.arange(len(u))
        while len(active):
            climbs = rising & edge[u] & edge[v]
            u, v = np.where(climbs, parent[u], u), np.where(climbs, parent[v], v)
            same = ~climbs & (name[u] == name[v])
            steps = np.where(same, np.minimum(reach[u], reach[v]), 0)
            found[active] += steps * size[u]
            differ = ~climbs & ~same
            lower_u, lower_v = child[u], child[v]
            u, v = np.where(differ, lower_u, u + step * steps), np.where(differ, lower_v, v + step * steps)
            rising &= ~differ
            going = u >= 0
            if not going.all():
                active, u, v, rising = active[going], u[going], v[going], rising[going]
        return found
