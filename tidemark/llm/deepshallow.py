"""Deep-shallow sorting of many strings of one buffer (suffixes cut to a length).

Shallow: multikey quicksort on characters of eight bytes. Strings are ordered by their
first character, groups of equal ones by the next, down to `SHALLOW` bytes.

Deep: what still shares that prefix is ordered by blind tries. A group's first string is
the spine of its trie; each other string leaves the spine at its longest common prefix,
by its branching byte there. Strings that leave at the same place by the same byte form a
subtrie, whose own spine is taken next; characters between branching points are skipped,
as in any blind trie. All groups advance together, one spine per round, as array
operations.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16
PAD = 8  # bytes that must follow the last string in the buffer
_BYTE_STEPS = np.array([1 << (8 * i) for i in range(1, 8)], np.uint64)
_KEEP = np.array([(((1 << 64) - 1) << (8 * (8 - i))) & ((1 << 64) - 1) for i in range(9)],
                 np.uint64)  # masks for the first i of eight bytes
_SPINE = np.int64(1) << 50  # key of strings equal to the spine's


def _characters(buf: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number; bytes beyond `left` are zero."""
    view = np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))
    inside = np.minimum(at, len(buf) - 8)
    return view[inside].astype(np.uint64) & _KEEP[np.clip(left, 0, 8)]


def _regroup(rank: np.ndarray, members: np.ndarray, key: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order the members of each rank by key and give every (rank, key) its own rank.
    Returns the sorted order, and the start, size and group number of the new groups."""
    order = np.lexsort((key, rank[members]))
    m, k = members[order], key[order]
    r = rank[m]
    old = np.r_[True, r[1:] != r[:-1]]
    new = old | np.r_[True, k[1:] != k[:-1]]
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    first = np.maximum.accumulate(np.where(old, np.arange(len(m)), 0))
    rank[m] = r + (start[group] - first)
    return order, start, np.diff(np.r_[start, len(m)]), group


def ranks(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Rank of each string `buf[start : start + length]`: equal strings share a rank, ranks
    order as the strings do. `buf` ends with at least `PAD` bytes after the last string."""
    start = np.asarray(start, np.int64)
    length = np.asarray(length, np.int64)
    rank = np.zeros(len(start), np.int64)
    members = np.arange(len(start))
    for depth in range(0, SHALLOW, 8):
        if not len(members):
            return rank
        key = _characters(buf, start[members] + depth, length[members] - depth)
        order, _, size, group = _regroup(rank, members, key)
        members = members[order][size[group] > 1]

    depth = np.full(len(start), SHALLOW, np.int64)
    while len(members):
        members = members[np.argsort(rank[members], kind="stable")]
        r = rank[members]
        head = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        spine = members[np.repeat(head, np.diff(np.r_[head, len(r)]))]
        key = np.empty(len(members), np.int64)
        at = depth[members]
        longest = np.maximum(length[members], length[spine])
        open_ = np.arange(len(members))
        while len(open_):
            m, s, d = members[open_], spine[open_], at[open_]
            mine = _characters(buf, start[m] + d, length[m] - d)
            its = _characters(buf, start[s] + d, length[s] - d)
            differ = mine != its
            if differ.any():
                x, y = mine[differ], its[differ]
                same = 7 - np.searchsorted(_BYTE_STEPS, x ^ y, "right")
                shift = (8 * (7 - same)).astype(np.uint64)
                b = ((x >> shift) & np.uint64(255)).astype(np.int64)
                o = ((y >> shift) & np.uint64(255)).astype(np.int64)
                where = open_[differ]
                lcp = d[differ] + same
                # off the spine to the left: the sooner the smaller; to the right: the later
                key[where] = np.where(b < o, lcp * 256 + b, 2 * _SPINE - lcp * 256 + b)
                at[where] = lcp + 1
            equal = open_[~differ]
            at[equal] += 8
            done = at[equal] >= longest[equal]
            over = equal[done]  # equal throughout; zero bytes at an end tell by length
            key[over] = _SPINE + length[members[over]] - length[spine[over]]
            open_ = equal[~done]
        depth[members] = at
        order, begin, size, group = _regroup(rank, members, key)
        settled = np.abs(key[order] - _SPINE) < _SPINE // 2
        members = members[order][(size[group] > 1) & ~settled]
    return rank
