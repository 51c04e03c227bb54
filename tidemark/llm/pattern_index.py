"""Internal pattern matching on sequences of symbols.

Blocks of 2**k symbols get names by prefix doubling; equal blocks have equal names, and
the places of a block are an interval of the suffix array. A wavelet tree over that array
answers, for many intervals at once, how many places lie before a position and which is
the next one. Names also give the longest common extension of two places.
"""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Order statistics of ranges of an integer array, a vector of queries at a time."""

    def __init__(self, values: np.ndarray):
        self._levels = []
        bits = int(values.max()).bit_length() if len(values) else 0
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit) & 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - one, out=zeros[1:])
            self._levels.append((bit, zeros))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of ``values[low:high]`` are below ``bound``."""
        top = 1 << (self._levels[0][0] + 1) if self._levels else 1
        count = np.where(bound >= top, high - low, 0)
        low, high = low.copy(), np.where(bound >= top, low, high)
        for bit, zeros in self._levels:
            zero_low, zero_high = zeros[low], zeros[high]
            one = (bound >> bit) & 1 == 1
            count += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, zeros[-1] + low - zero_low, zero_low)
            high = np.where(one, zeros[-1] + high - zero_high, zero_high)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of ``values[low:high]``."""
        value, n, low, high = np.zeros(len(low), np.int64), n.copy(), low.copy(), high.copy()
        for bit, zeros in self._levels:
            zero_low, zero_high = zeros[low], zeros[high]
            one = n >= zero_high - zero_low
            value |= np.where(one, np.int64(1) << bit, 0)
            n -= np.where(one, zero_high - zero_low, 0)
            low = np.where(one, zeros[-1] + low - zero_low, zero_low)
            high = np.where(one, zeros[-1] + high - zero_high, zero_high)
        return value


class Blocks:
    """Names of all blocks of 2**k symbols of several sequences in a row.

    No symbol may occur in two sequences, so blocks never match across them. ``ends``
    gives for every place the end of its sequence. ``names[k][i]`` is where the interval
    of the block at i begins in ``places``, the suffix array as far as blocks of up to
    ``longest`` symbols tell suffixes apart.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, longest: int):
        n = len(symbols)
        self.places = np.argsort(symbols, kind="stable")
        in_order = symbols[self.places]
        new = np.ones(n, bool)
        new[1:] = in_order[1:] != in_order[:-1]
        name = np.full(n + 1, -1, np.int32)
        name[self.places] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.names = [name]
        open_ = self._shared(new)
        width = 1
        while len(open_) and 2 * width <= longest:
            at = self.places[open_]
            after = at + width
            inside = after < ends[at]
            # The end of a sequence sorts before every name.
            second = np.where(inside, name[np.minimum(after, n)] + 1, 0)
            key = name[at].astype(np.int64) * (n + 1) + second
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            self.places[open_] = at
            first = np.ones(len(at), bool)
            first[1:] = key[1:] != key[:-1]
            name = name.copy()
            name[at] = np.maximum.accumulate(np.where(first, open_, 0))
            self.names.append(name)
            open_ = open_[self._shared(first)]
            width *= 2

    @staticmethod
    def _shared(first: np.ndarray) -> np.ndarray:
        """Which members of groups, given by their first ones, are not alone."""
        last = np.ones(len(first), bool)
        last[:-1] = first[1:]
        return np.flatnonzero(~(first & last))

    def sizes(self, k: int) -> np.ndarray:
        """Size of every name's interval, by where it begins."""
        return np.bincount(self.names[k][:-1], minlength=len(self.places))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension to the right of places i < j."""
        n, done = len(self.places), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            while True:
                # The name at the end is -1 and equals no other.
                same = name[np.minimum(i + done, n)] == name[np.minimum(j + done, n)]
                same &= j + done < n
                done += np.where(same, 1 << k, 0)
                if k < len(self.names) - 1 or not same.any():
                    break
        return done

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension to the left of places i < j."""
        done = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            while True:
                left, right = i - done - width, j - done - width
                same = (left >= 0) & (name[np.maximum(left, 0)] == name[np.maximum(right, 0)])
                done += np.where(same, width, 0)
                if k < len(self.names) - 1 or not same.any():
                    break
        return done


_BASE = 3  # the smallest blocks have 2**3 symbols, a third of the shortest run


def cubic_runs(
    symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = 24
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, period) of all maximal runs of three periods and ``least`` >= 24 symbols or more.

    ``starts`` and ``ends`` give the bounds of every place's sequence. A run of period q
    holds a block of the size below q (or 8) that begins at a multiple of that size and
    occurs again q places on. Within a window no longer than two blocks the occurrences
    form one progression. One or two of them are tried as they are. Three or more mean
    that the block itself repeats with their difference; the stretches that do so then lie
    one period apart, so their ends or their beginnings tell the period.
    """
    n = len(symbols)
    none = np.zeros(0, np.int64)
    longest = int((ends - starts).max()) if n else 0
    if longest < least:
        return none, none, none
    blocks = Blocks(symbols, ends, max(8, longest // 3))
    if len(blocks.names) <= _BASE:
        return none, none, none
    # Only blocks that occur twice can answer, so the tree holds their places alone.
    size = blocks.sizes(_BASE)
    several = size[blocks.names[_BASE][:-1]] > 1
    if not several.any():
        return none, none, none
    slot = several[blocks.places]
    before_slot = np.concatenate([[0], np.cumsum(slot)])
    before_place = np.concatenate([[0], np.cumsum(several)])
    place_of = np.flatnonzero(several)
    tree = WaveletTree(before_place[blocks.places[slot]])
    at, period = [], []

    def occurrences(p, k, first, stop):
        """Rank of the first occurrence in [first, stop), their number, and the interval."""
        low = blocks.names[k][p]
        high = low + size[low]
        low, high = before_slot[low], before_slot[high]
        skip = tree.below(low, high, before_place[np.minimum(first, n)])
        return skip, tree.below(low, high, before_place[np.minimum(stop, n)]) - skip, low, high

    def propose(p, q):
        at.append(p)
        period.append(q)

    for k in range(_BASE, len(blocks.names)):
        width = 1 << k
        size = blocks.sizes(k)
        p = np.flatnonzero(several)
        p = p[((p - starts[p]) % width == 0) & (p + width <= ends[p])]
        p = p[size[blocks.names[k][p]] > 1]
        if not len(p):
            continue
        if k == _BASE:
            skip, count, low, high = occurrences(p, k, p + 1, p + width + 1)
            hit = count > 0
            propose(p[hit], place_of[tree.nth(low[hit], high[hit], skip[hit])] - p[hit])
        skip, count, low, high = occurrences(p, k, p + width, p + 2 * width)
        for nth in (0, 1):
            hit = count > nth
            propose(p[hit], place_of[tree.nth(low[hit], high[hit], skip[hit] + nth)] - p[hit])
        hit = count > 2
        if hit.any():
            p, low, high, skip = p[hit], low[hit], high[hit], skip[hit]
            near = place_of[tree.nth(low, high, skip)]
            step = place_of[tree.nth(low, high, skip + 1)] - near
            stop, start = p + blocks.forward(p, p + step), p - blocks.backward(p, p + step)
            propose(p, near + blocks.forward(near, near + step) - stop)
            propose(p, near - blocks.backward(near, near + step) - start)
    if not at:
        return none, none, none
    at, period = np.concatenate(at).astype(np.int64), np.concatenate(period).astype(np.int64)
    fits = (period > 0) & (at + period < ends[np.minimum(at, n - 1)])
    at, period = at[fits], period[fits]
    start = at - blocks.backward(at, at + period)
    length = at + period + blocks.forward(at, at + period) - start
    good = (length >= least) & (length >= 3 * period)
    start, length, period = start[good], length[good], period[good]
    # The same stretch may also be found with a multiple of its period.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]
