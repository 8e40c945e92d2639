"""Two-stage suffix sorting of a byte string in numpy.

A suffix is S if it is smaller than its successor (the suffix one byte
later) and L if it is larger. Only S suffixes are sorted directly, by
``DEPTH`` bytes. The L suffixes are induced: going through the order from
its small end, bucket by first byte, each suffix puts its L predecessor at
the next free place of the predecessor's bucket. L suffixes stand before S
suffixes in a bucket. A whole bucket is scanned at once; a bucket whose
scan adds to itself (runs of one byte) is scanned again.
"""

from __future__ import annotations

import numpy as np

DEPTH = 104


def words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as big-endian numbers (byte order)."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    return np.ascontiguousarray(view[at]).view(">u8").ravel().astype(np.uint64)


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """S or not of every place but the last; equal bytes are as the next."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    n = len(step)
    index = np.where(step != 0, np.arange(n), n)
    index = np.minimum.accumulate(index[::-1])[::-1]
    return np.concatenate([step, [1]])[index] > 0


def _sort_directly(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places sorted by DEPTH bytes: by eight bytes, then what is tied by
    the next eight."""
    key = words(text, at)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(at) else np.zeros(0, np.int64)
    tied = np.arange(len(at))
    for depth in range(8, DEPTH, 8):
        size = np.bincount(group[tied]) if len(tied) else np.zeros(0, np.int64)
        tied = tied[size[group[tied]] > 1]
        if not len(tied):
            break
        key = words(text, at[tied] + depth)
        order = np.lexsort((key, group[tied]))
        at[tied], key = at[tied][order], key[order]
        own = group[tied]  # groups are stretches, so the sorted groups are as before
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        group[tied] = np.cumsum(new) - 1
    return at


def suffix_order(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted places (a mask over ``text``) in the order of the suffixes
    that start there. Suffixes that agree in more than DEPTH bytes may stand
    in either order."""
    n = len(text)
    if not wanted.any():
        return np.zeros(0, np.int64)
    padded = np.concatenate([text, np.array([0, 255], np.uint8), np.zeros(DEPTH + 8, np.uint8)])
    small = _smaller_than_successor(padded)[:n + 1]
    want = np.concatenate([wanted, [False]])
    # an L suffix is induced from its successor, so the chain up to the next S suffix is needed
    place = np.arange(n + 1)
    last_small = np.maximum.accumulate(np.where(small, place, -1))
    last_want = np.maximum.accumulate(np.where(want, place, -1))
    need = want.copy()
    need[1:] |= (last_want[:-1] >= 0) & (last_small[:-1] < last_want[:-1])
    induced = need & ~small
    direct = _sort_directly(padded, np.flatnonzero(need & small))

    first = padded[direct]
    starts = np.searchsorted(first, np.arange(257))
    coming: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Hand the L predecessors to their buckets; those of this bucket
        are returned."""
        before = scanned[scanned > 0] - 1
        before = before[induced[before]]
        heads = padded[before]
        by_head = np.argsort(heads, kind="stable")
        before, heads = before[by_head], heads[by_head]
        bytes_, at = np.unique(heads, return_index=True)
        mine = np.zeros(0, np.int64)
        for b, part in zip(bytes_.tolist(), np.split(before, at[1:])):
            if b == byte:
                mine = part
            else:
                coming[b].append(part)
        return mine

    for byte in range(256):
        scan = np.concatenate(coming[byte]) if coming[byte] else np.zeros(0, np.int64)
        while len(scan):
            order.append(scan)
            scan = induce(scan, byte)
        scan = direct[starts[byte]:starts[byte + 1]]
        if len(scan):
            order.append(scan)
            induce(scan, byte)
    out = np.concatenate(order)
    return out[want[out]]


def share_prefix(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in the order has ``length`` bytes in common with
    the one before it (False for the first)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    same = np.zeros(len(order), bool)
    left = np.arange(1, len(order))
    offsets = [*range(0, length - 7, 8)]
    if length % 8:
        offsets.append(length - 8)
    for off in offsets:
        if not len(left):
            break
        left = left[words(padded, order[left] + off) == words(padded, order[left - 1] + off)]
    same[left] = True
    return same
