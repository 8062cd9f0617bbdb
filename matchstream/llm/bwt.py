"""Repeated windows of a block of byte strings, from a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from matchstream.llm.common import spread


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes; its last symbol, 0, occurs only there.

    Ranks by the first symbols are doubled until all differ.
    """
    n = len(text)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(8, np.int64)])
    for k in range(6):  # six symbols of ten bits at first
        key = (key << 10) | padded[k : k + n]
    step = 6
    order = np.argsort(key, kind="stable")
    while True:
        sorted_key = key[order]
        rank_in_order = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = rank_in_order
        if rank_in_order[-1] == n - 1:
            return order
        # Only suffixes whose rank is shared need sorting again, each among its own.
        tied = np.zeros(n, bool)
        same = sorted_key[1:] == sorted_key[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        where = np.flatnonzero(tied)
        some = order[where]
        further = np.where(some + step < n, rank[np.minimum(some + step, n - 1)] + 1, 0)
        key = np.zeros(n, np.int64)
        key[order] = rank_in_order * (n + 1)
        key[some] += further
        order[where] = some[np.argsort(key[some], kind="stable")]
        step *= 2


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which of its windows of ``length`` bytes occur at another place of the block.

    Common prefixes of neighbouring suffixes are derived by increasing value.
    A boundary between two rows whose suffixes have exactly v symbols in common
    makes boundaries of value v + 1: extending the suffixes to its right by the
    symbol before them, the first row of each symbol lands on a row whose
    neighbour above comes from beyond the boundary.  The rounds stop at
    ``length``; rows without a boundary between them then share that many.
    """
    if not strings:
        return []
    parts, at = [], 0
    starts = np.zeros(len(strings), np.int64)
    for i, s in enumerate(strings):
        starts[i] = at
        parts += [np.frombuffer(s, np.uint8).astype(np.int16) + 2, np.ones(1, np.int16)]
        at += len(s) + 1
    text = np.concatenate([*parts, np.zeros(1, np.int16)])
    rows = suffix_array(text)
    n = len(rows)
    before = text[rows - 1]  # the transform; the row of position 0 has the final symbol
    by_symbol = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)  # the row after extending by the symbol before
    back[by_symbol] = np.arange(n)
    previous = np.full(n, -1, np.int64)  # the row above with the same symbol
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]

    known = np.zeros(n + 1, bool)
    first = text[rows]
    new = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    known[new] = known[n] = True
    for _ in range(length - 1):
        if not len(new):
            break
        edges = np.flatnonzero(known)
        ends = edges[np.searchsorted(edges, new) + 1]
        sizes = ends - new
        row = spread(new, sizes)
        row = row[previous[row] < np.repeat(new, sizes)]
        target = back[row]
        target = target[~known[target]]
        known[target] = True
        new = np.sort(target)
    repeated = np.zeros(n, bool)
    repeated[rows] = ~known[:n] | ~known[1 : n + 1]
    return [repeated[a : a + max(0, len(s) - length + 1)] for a, s in zip(starts.tolist(), strings)]
