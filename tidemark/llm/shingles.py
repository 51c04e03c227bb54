"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

from .rolling import Roller

#: The separators of words: space, tab to carriage return.
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_CHUNK = 1 << 19


def _batches(offsets: np.ndarray):
    """Ranges of documents of about a chunk of bytes; a longer document is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, side="right")) - 1)
        yield i, j
        i = j


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, roller: Roller):
    """For ranges of documents: (first, last, distinct sorted hashes, offsets of the documents in them).

    A document with fewer words has its whole sequence as one shingle, one without
    words has none. A-Z count as a-z. A shingle is hashed as its words joined by one space.
    """
    for i, j in _batches(offsets):
        part = data[offsets[i] : offsets[j]]
        ends = offsets[i + 1 : j + 1] - offsets[i]
        gap = _GAP[part]
        # A document's first byte always begins a word or a gap of its own.
        begin = np.ones(len(part), bool)
        begin[1:] = gap[:-1]
        starts_of_docs = ends[:-1][ends[:-1] < len(part)]
        begin[starts_of_docs] = True
        start = np.flatnonzero(begin & ~gap)
        stop_mark = np.ones(len(part), bool)
        stop_mark[:-1] = gap[1:]
        inner = ends[:-1]
        stop_mark[inner[(inner > 0) & (inner <= len(part))] - 1] = True
        stop = np.flatnonzero(stop_mark & ~gap) + 1
        doc = np.searchsorted(ends, start, side="right")
        # Words joined by one space each: every word and the byte after it.
        length = stop - start + 1
        at = np.cumsum(length) - length
        source = np.repeat(start - at, length) + np.arange(int(length.sum()))
        joined = np.full(len(source), 0x20, np.uint8)
        word_byte = np.ones(len(source), bool)
        word_byte[at + length - 1] = False
        joined[word_byte] = _LOWER[part[source[word_byte]]]
        sums = roller.sums(joined)
        count = np.bincount(doc, minlength=j - i)
        first = np.cumsum(count) - count
        shingles = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
        owner = np.repeat(np.arange(j - i), shingles)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        head = first[owner] + nth
        tail = head + np.minimum(count[owner], words) - 1
        hashes = roller.of(sums, at[head], at[tail] + length[tail] - 1)
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
        owner, hashes = owner[new], hashes[new]
        yield i, j, hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=j - i))])
