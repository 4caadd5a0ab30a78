"""Suffix sorting by the deep-shallow method, for many suffixes at once.

Shallow: multikey quicksort, eight bytes being one key; groups that share a prefix are split until ``shallow`` bytes are
equal. Deep: the groups that remain have long common prefixes and are ordered by blind tries. The first suffix of a group
is the trie's path; each other one hangs off it where it first differs, and only that byte is looked at: suffixes that
leave at the same place by the same byte form a smaller group. Suffixes that follow one another in one text share the
work: where they leave their paths is read off one comparison.

All groups take each step together, so the work is numpy's.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
KEY = 8
COMPARED = 2_000_000  # bytes compared in one go


def _keys(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one big-endian number; the buffer must go on for eight bytes."""
    return np.ndarray((len(raw) - KEY + 1,), ">u8", raw, strides=(1,))


def common_prefix(raw: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of the common prefixes of suffixes ``a`` and ``b``, up to ``limit``.

    Pairs on one diagonal (the same ``a - b``) whose bytes overlap are compared together: one pass finds the places that
    differ, and a pair's prefix ends at the next of them.
    """
    out = np.empty(len(a), np.int64)
    by = np.lexsort((a, a - b))
    first, second = a[by], b[by]
    lead = np.ones(len(a), bool)
    lead[1:] = (np.diff(first - second) != 0) | (np.diff(first) > limit)
    heads = np.flatnonzero(lead)
    tails = np.append(heads[1:], len(a)) - 1
    sizes = first[tails] - first[heads] + limit
    at = 0
    while at < len(heads):
        ends = np.cumsum(sizes[at:])
        stop = at + max(int(np.searchsorted(ends, COMPARED, "right")), 1)
        size = sizes[at:stop]
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        differ = raw[place + np.repeat(first[heads[at:stop]], size)] != raw[place + np.repeat(second[heads[at:stop]], size)]
        here = np.arange(len(differ) + 1)
        here[:-1][~differ] = len(differ) + limit
        here[-1] = len(differ) + limit
        ahead = np.minimum.accumulate(here[::-1])[::-1]
        members = np.arange(heads[at], tails[stop - 1] + 1)
        run = np.cumsum(lead[members]) - 1
        own = begin[run] + first[members] - first[heads[at:stop]][run]
        out[by[members]] = np.minimum(ahead[own] - own, limit)
        at = stop
    return out


def _regroup(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group numbers, whether a group has others) from where a new group begins."""
    group = np.cumsum(changed) - 1
    return group, np.bincount(group)[group] > 1


def sort_suffixes(
    text: np.ndarray, start: np.ndarray, bucket: np.ndarray, limit: int, shallow: int = 16
) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): the suffixes at ``start`` sorted by bucket, then by their first ``limit`` bytes; and for each in
    that order whether those bytes equal the one's before it in its bucket.

    Every suffix has ``limit`` bytes at least. Equal ones keep no particular order.
    """
    n = len(start)
    order = np.argsort(bucket, kind="stable")
    same = np.zeros(n, bool)
    if n < 2:
        return order, same
    raw = np.concatenate([text, np.zeros(KEY, np.uint8)])
    keys = _keys(raw)
    held = bucket[order]
    group, many = _regroup(np.concatenate([[True], held[1:] != held[:-1]]))
    slots = np.flatnonzero(many)
    group = group[slots]

    for depth in range(0, min(shallow, limit - limit % KEY), KEY):
        if not len(slots):
            return order, same
        own = order[slots]
        key = keys[start[own] + depth].astype(U64)
        by = np.lexsort((key, group))
        order[slots], key = own[by], key[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        group, many = _regroup(new)
        slots, group = slots[many], group[many]

    while len(slots):
        heads = np.concatenate([[True], group[1:] != group[:-1]])
        path = np.flatnonzero(heads)[np.cumsum(heads) - 1]  # the slot of each one's trie path
        own = order[slots]
        length = common_prefix(raw, start[own], start[own[path]], limit)
        leaves = length < limit
        place = np.minimum(length, limit - 1)
        byte = np.where(leaves, raw[start[own] + place], 0).astype(np.int64)
        side = np.where(leaves, np.where(byte < raw[start[own[path]] + place], -1, 1), 0)
        by = np.lexsort((byte, np.where(side < 0, length, -length), side, group))
        order[slots] = own[by]
        group, side, length, byte = group[by], side[by], length[by], byte[by]
        new = (group[1:] != group[:-1]) | (side[1:] != side[:-1]) | (length[1:] != length[:-1]) | (byte[1:] != byte[:-1])
        new = np.concatenate([[True], new])
        same[slots] = (side == 0) & ~new
        group, many = _regroup(new)
        many &= side != 0
        slots, group = slots[many], group[many]
    return order, same
