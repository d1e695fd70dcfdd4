"""Repeated strings of a block of texts from its Burrows-Wheeler transform.

Common prefixes of neighbouring suffixes are derived by increasing value:
starting from the one-letter intervals, every interval of suffixes that share
a string is extended backwards by each letter in front of it, one level of
lengths at a time. The right border of a new interval of length l + 1 gets
the common prefix l unless it already has a smaller one, and only intervals
that set a border are extended further. The search stops at the minimum
length: borders that never got a value separate suffixes that share at least
that many bytes. Every level is handled with array operations.
"""

from __future__ import annotations

import numpy as np

_LETTERS = 7      # letters packed into the first sort key (9 bits each)


def suffix_order(letters: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` letters; 0 ends a text and sorts by position."""
    n = len(letters)
    padded = np.concatenate((letters, np.zeros(_LETTERS, np.int64)))
    key = letters.astype(np.int64)
    open_ = letters != 0
    for k in range(1, _LETTERS):
        ahead = padded[k:k + n]
        key <<= 9
        key |= np.where(open_, ahead, 0)
        open_ &= ahead != 0
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = (key[1:] != key[:-1]) | ~open_[order[1:]]
    rank = np.empty(n, np.int64)
    heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = heads
    length = _LETTERS
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    while length < depth and len(tied):
        at = order[tied]
        key = rank[at] * n + rank[at + length]
        by = np.argsort(key)
        order[tied] = at = at[by]
        key = key[by]
        head = np.ones(len(tied), bool)
        head[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~(head & np.append(head[1:], True))]
        length *= 2
    return order


def _explode(lefts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1], dtype=np.int64) + np.repeat(lefts - (ends - sizes), sizes)


def repeated_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Marks each byte where a string of `least` bytes starts that starts anywhere else too.

    `data` holds the texts one after another, text k from starts[k] to
    ends[k]; strings never cross texts. A mark for every byte of `data`.
    """
    marks = np.zeros(len(data), bool)
    m = len(starts)
    if not m or least < 1:
        return marks
    letters = np.insert(data.astype(np.int64) + 1, ends, 0)
    n = len(letters)
    order = suffix_order(letters, least + 1)
    before = letters[order - 1].astype(np.uint16)             # the transform
    by_letter = np.argsort(before, kind="stable")
    sorted_letters = before[by_letter]
    to_front = np.empty(n, np.int64)                          # where the suffix with its letter put in front stands
    to_front[by_letter] = np.arange(n)
    same = sorted_letters[1:] == sorted_letters[:-1]
    following, preceding = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    following[by_letter[:-1][same]] = by_letter[1:][same]
    preceding[by_letter[1:][same]] = by_letter[:-1][same]
    usable = before != 0

    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    counts = np.bincount(letters)[1:]
    lefts = np.concatenate((np.arange(m), m + np.concatenate(([0], np.cumsum(counts)[:-1]))[counts > 0]))
    rights = np.append(lefts[1:], n) - 1
    new = ~known[rights + 1]
    lefts, rights = lefts[new], rights[new]
    known[rights + 1] = True                                  # common prefix 0
    for _ in range(1, least):
        if not len(lefts):
            break
        sizes = rights - lefts + 1
        at = _explode(lefts, sizes)
        ok = usable[at]
        firsts = at[ok & (preceding[at] < np.repeat(lefts, sizes))]
        lasts = at[ok & (following[at] > np.repeat(rights, sizes))]
        # Intervals of one length are disjoint: sorted left and right ends pair up.
        lefts, rights = np.sort(to_front[firsts]), np.sort(to_front[lasts])
        new = ~known[rights + 1]
        lefts, rights = lefts[new], rights[new]
        known[rights + 1] = True
    long_ = ~known
    hit = order[long_[:-1] | long_[1:]]
    # Position in `letters` back to position in `data`: one end mark per earlier text.
    hit = hit[letters[hit] != 0]
    marks[hit - np.searchsorted(ends + np.arange(m), hit)] = True
    return marks
