"""Suffix arrays of one shard: sorting, common prefixes, search.

Everything is numpy over one shard's bytes, whose size the caller bounds.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a big-endian number, with zeros after the end."""
    padded = np.concatenate((data, np.zeros(WORD, np.uint8)))
    out = np.zeros(len(data), np.uint64)
    for i in range(WORD):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places in order of their suffixes.

    Larsson and Sadakane's refinement: suffixes are sorted by their first bytes; a group of equal
    ones is numbered by its last place in the order. Then each group that is not single is sorted by
    the group of the suffix that begins where its known bytes end, which doubles what is known.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    keys = packed(data)
    order = np.argsort(keys)
    sorted_keys = keys[order]
    first = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[order] = _last_of_group(first)
    rank[n] = -1
    known = WORD
    while known < n:
        open_ = _open_places(first)
        if not len(open_):
            break
        members = order[open_]
        group = rank[members]
        after = np.minimum(members + known, n)
        # Groups stay where they are: their numbers are the major key.
        turn = np.argsort(group * (n + 1) + rank[after] + 1)
        members, group, following = members[turn], group[turn], rank[after][turn]
        order[open_] = members
        starts = np.concatenate(([True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])))
        first[open_] = starts
        # Numbers change only after all groups have been sorted by the old ones.
        lasts = np.concatenate((np.flatnonzero(starts)[1:] - 1, [len(starts) - 1]))
        rank[members] = open_[lasts][np.cumsum(starts) - 1]
        known *= 2
    return order


def _last_of_group(first: np.ndarray) -> np.ndarray:
    starts = np.flatnonzero(first)
    lasts = np.concatenate((starts[1:] - 1, [len(first) - 1]))
    return lasts[np.cumsum(first) - 1]


def _open_places(first: np.ndarray) -> np.ndarray:
    """Places in the order whose group has more than one member."""
    alone = first & np.concatenate((first[1:], [True]))
    return np.flatnonzero(~alone)


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes, 0 to 8, that pairs of packed words share."""
    differ = a ^ b
    shared = np.zeros(len(a), np.int64)
    for i in range(1, WORD + 1):
        shared += differ < (np.uint64(1) << np.uint64(64 - 8 * i) if i < WORD else np.uint64(1))
    return shared


def shared_prefix(keys: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of the places ``a`` and ``b``, up to ``most``, of which ``known`` bytes are sure."""
    out = known.copy()
    n = len(keys)
    live = np.flatnonzero(out < most)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        got = _equal_bytes(keys[x], keys[y])
        out[live] += got
        live = live[(got == WORD) & (out[live] < most)]
    return np.minimum(out, most)


def kasai(keys: np.ndarray, order: np.ndarray, lanes: np.ndarray, steps: np.ndarray, most: int) -> np.ndarray:
    """Common prefix, up to ``most``, of each suffix of ``order`` with the one before it.

    Kasai's rule: going on by one byte in the text, the common prefix with the predecessor in
    order is at least the last one less one. A lane is a run of ``steps`` places from ``lanes`` on;
    all lanes go on together. Where ``order`` leaves out the place after the predecessor, the rule
    doesn't hold and the comparison starts anew.
    """
    n = len(keys)
    where = np.full(n + 1, -1, np.int64)
    where[order] = np.arange(len(order))
    out = np.zeros(len(order), np.int64)
    last, before = np.zeros(len(lanes), np.int64), np.full(len(lanes), n, np.int64)
    for step in range(int(steps.max(initial=0))):
        live = np.flatnonzero(steps > step)
        place = lanes[live] + step
        at = where[place]
        held = where[np.minimum(before[live] + 1, n)] >= 0
        sure = np.where(held, np.maximum(last[live] - 1, 0), 0)
        some = at > 0
        other = np.where(some, order[np.maximum(at - 1, 0)], 0)
        got = np.zeros(len(live), np.int64)
        got[some] = shared_prefix(keys, place[some], other[some], sure[some], most)
        out[at] = got
        last[live], before[live] = got, np.where(some, other, n)
    return out


def words_at(keys: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes (a multiple of eight) at each place, as rows of packed words."""
    return keys[places[:, None] + np.arange(0, size, WORD)]


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, whether ``a`` comes before ``b``."""
    differ = a != b
    at = np.argmax(differ, axis=1)
    rows = np.arange(len(a))
    return differ[rows, at] & (a[rows, at] < b[rows, at])


def search(keys: np.ndarray, order: np.ndarray, wanted: np.ndarray, size: int) -> np.ndarray:
    """Whether each row of ``wanted`` is the first ``size`` bytes of a suffix of ``order``, by binary search."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
    if not len(order):
        return np.zeros(len(wanted), bool)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            break
        middle = (low[live] + high[live]) // 2
        right = _before(words_at(keys, order[middle], size), wanted[live])
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]
    found = low < len(order)
    out = np.zeros(len(wanted), bool)
    at = np.flatnonzero(found)
    out[at] = (words_at(keys, order[low[at]], size) == wanted[at]).all(axis=1)
    return out
