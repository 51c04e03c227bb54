"""Re-Pair grammars of token ids, a shard each.

A round replaces the most frequent pairs of neighbouring symbols by new symbols, at
once and from left to right; rounds go on until no pair is frequent or the symbols no
longer fit 16 bits. A shard keeps the rules, the length every new symbol expands to, the
remaining sequence, and how many ids stand before every ``_STEP``-th symbol of it, so
that any range of ids is decoded without the rest.
"""

from __future__ import annotations

import numpy as np

_MAGIC = b"RPG1"
_STEP = 256
_ROUNDS, _PER_ROUND, _LEAST = 5, 3200, 6
_HASH_BITS = 19


def _ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + length]``, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - ends + length, length) + np.arange(total)]


def _frequent(seq: np.ndarray, end: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, places, pair number of each place) of pairs to be replaced.

    Pairs are counted under a hash; of pairs that share one, one stands for it and the
    others wait for a later round. No pair has the ``end`` of a document in it.
    """
    key = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
    slot = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _HASH_BITS)).astype(np.intp)
    holder = np.zeros(1 << _HASH_BITS, np.uint32)
    holder[slot] = key
    count = np.bincount(slot, minlength=1 << _HASH_BITS)
    count[(holder >> np.uint32(16) == end) | (holder & np.uint32(0xFFFF) == end)] = 0
    best = np.argpartition(-count, most)[:most]
    best = best[count[best] >= _LEAST]
    number = np.full(1 << _HASH_BITS, -1, np.int32)
    number[best] = np.arange(len(best))
    number_at = number[slot]
    places = np.flatnonzero(number_at >= 0)
    number_at = number_at[places]
    same = holder[best][number_at] == key[places]
    return holder[best], places[same], number_at[same]


def compress(ids: np.ndarray, terminals: int, end: int) -> bytes:
    """The grammar of ``ids``, which are below ``terminals`` < 65,536."""
    seq = ids.astype(np.uint16)
    left, right, bounds, top = [], [], [terminals], terminals
    for _ in range(_ROUNDS):
        most = min(_PER_ROUND, 65_536 - top)
        if most <= 0 or len(seq) < 2:
            break
        pairs, places, number = _frequent(seq, end, most)
        if not len(pairs):
            break
        # Pairs that overlap form runs of neighbouring places; every second one is taken.
        new = np.ones(len(places), bool)
        new[1:] = places[1:] != places[:-1] + 1
        first = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
        take = (np.arange(len(places)) - first) % 2 == 0
        places, number = places[take], number[take]
        keep = np.ones(len(seq), bool)
        keep[places + 1] = False
        seq[places] = top + number
        seq = seq[keep]
        left.append((pairs >> np.uint32(16)).astype(np.uint16))
        right.append((pairs & np.uint32(0xFFFF)).astype(np.uint16))
        top += len(pairs)
        bounds.append(top)
    left = np.concatenate([np.zeros(0, np.uint16), *left])
    right = np.concatenate([np.zeros(0, np.uint16), *right])
    lengths = np.ones(top, np.int64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        lengths[a:b] = lengths[left[a - terminals : b - terminals]] + lengths[right[a - terminals : b - terminals]]
    before = np.concatenate([[0], np.cumsum(lengths[seq])])
    head = np.array([terminals, len(left), len(seq), len(ids), len(bounds)], "<u4")
    parts = [head, np.array(bounds, "<u4"), left.astype("<u2"), right.astype("<u2"), lengths[terminals:].astype("<u4")]
    parts += [before[:-1:_STEP].astype("<u4"), seq.astype("<u2")]
    return _MAGIC + b"".join(p.tobytes() for p in parts)


class Grammar:
    """Decodes what ``compress`` wrote."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("no grammar")
        self._data, self._at = data, 4
        self.terminals, rules, symbols, self.size, n_bounds = map(int, self._take("<u4", 5))
        bounds = self._take("<u4", n_bounds)
        left, right = self._take("<u2", rules), self._take("<u2", rules)
        self._lengths = np.concatenate([np.ones(self.terminals, np.int64), self._take("<u4", rules)])
        self._before = self._take("<u4", -(-symbols // _STEP))
        self._seq = self._take("<u2", symbols)
        # Expansions of all symbols in a row, those of a round from those of earlier ones.
        self._start = np.cumsum(self._lengths) - self._lengths
        flat = [np.arange(self.terminals, dtype=np.uint32)]
        for a, b in zip(bounds[:-1].astype(int), bounds[1:].astype(int), strict=True):
            both = np.column_stack([left[a - self.terminals : b - self.terminals], right[a - self.terminals : b - self.terminals]]).reshape(-1)
            flat = [np.concatenate([*flat, _ragged(flat[0], self._start[both], self._lengths[both])])]
        self._flat = flat[0]

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, n, self._at)
        self._at += out.nbytes
        return out

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return _ragged(self._flat, self._start[symbols], self._lengths[symbols])

    def all(self) -> np.ndarray:
        return self._expand(self._seq)

    def part(self, start: int, stop: int) -> np.ndarray:
        """The ids ``[start, stop)``, from the symbols that hold them and at most ``_STEP`` more."""
        start, stop = max(start, 0), min(stop, self.size)
        if start >= stop:
            return np.zeros(0, np.uint32)
        block = int(np.searchsorted(self._before, start, side="right")) - 1
        last = int(np.searchsorted(self._before, stop, side="left"))
        skip = start - int(self._before[block])
        return self._expand(self._seq[block * _STEP : last * _STEP])[skip : skip + stop - start]
