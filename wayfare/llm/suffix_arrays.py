"""Suffix arrays and common prefixes of byte strings, in numpy."""

from __future__ import annotations

import numpy as np

#: Positions that one lane of the common-prefix walk visits.
LANE = 128


def byte_words(text: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros stand behind the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), kind, padded, strides=(1,)).astype(np.uint64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by Larsson-Sadakane refinement.

    Suffixes are sorted by eight bytes; then groups that are still tied are sorted
    by the group of the suffix that begins where the compared part ends, which
    doubles that part each round. Groups of one are left alone.
    """
    n = len(text)
    key = byte_words(text, ">u8")
    order = np.argsort(key)
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    # NUL bytes at the end of the text look like what stands behind it; the rounds below tell them apart
    group = np.empty(n, np.int64)
    group[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    size = 8 if n == 0 or text.min() > 0 else 1
    if size == 1:
        order = np.argsort(text, kind="stable")
        first[1:] = text[order][1:] != text[order][:-1]
        group[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(tied):
        place = order[tied]
        after = place + size
        behind = np.where(after < n, group[np.minimum(after, n - 1)] + 1, 0)
        key = (group[place] << 32) | behind
        by = np.argsort(key)
        key, place = key[by], place[by]
        order[tied] = place
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        group[place] = np.maximum.accumulate(np.where(fresh, tied, 0))
        alone = fresh & np.append(fresh[1:], True)
        tied = tied[~alone]
        size *= 2
    return order


def equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes two little-endian words have in common at their start."""
    other = a ^ b
    lowest = (other & (~other + np.uint64(1))).astype(np.float64)  # a power of two, exact as a float
    return np.where(other == 0, 8, (np.frexp(lowest)[1] - 1) // 8)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix, ``cap`` at most, of each suffix in order and the one before it (Kasai).

    A suffix shares at most one byte less with its neighbour than the suffix one
    position earlier did with its own, so the walk over positions starts each
    comparison there and goes on by words of eight bytes. Many stretches of the
    text are walked in lockstep.
    """
    n = len(text)
    words = np.concatenate([byte_words(text, "<u8"), np.zeros(cap + 8, np.uint64)])
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    by_place = np.zeros(n, np.int32)
    starts = np.arange(0, n, LANE)
    shared = np.zeros(len(starts), np.int64)
    for step in range(min(LANE, n)):
        place = starts + step
        if place[-1] >= n:
            place, shared = place[:-1], shared[:-1]
            starts = starts[:-1]
        other = before[place].astype(np.int64)
        room = n - np.maximum(place, other)
        shared = np.where(other >= 0, np.maximum(shared - 1, 0), 0)
        live = np.flatnonzero((other >= 0) & (shared < cap))
        while len(live):
            here = shared[live]
            more = equal_bytes(words[place[live] + here], words[other[live] + here])
            shared[live] = np.minimum(here + more, room[live])
            live = live[(more == 8) & (shared[live] < np.minimum(cap, room[live]))]
        by_place[place] = np.minimum(shared, cap)
        shared = np.minimum(shared, cap)
    return by_place[order]
