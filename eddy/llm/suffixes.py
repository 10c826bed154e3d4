"""Two-stage suffix sorting of many short byte strings, with numpy.

A suffix that is smaller than its successor (type S) is sorted directly.
Every other one (type L) is induced: scanning the buckets of first bytes
in order, each suffix found puts its larger predecessor at the next free
place of that one's bucket.  A whole bucket is scanned with a few array
operations.

Suffixes are told apart to ``depth`` bytes: what lies beyond is in no
particular order.
"""

from __future__ import annotations

import numpy as np


def _next(mask: np.ndarray) -> np.ndarray:
    """For each place, the first place at or after it where mask holds (len if none)."""
    n = len(mask)
    kind = np.int32 if n < 1 << 31 else np.int64
    at = np.where(mask, np.arange(n, dtype=kind), kind(n))
    return np.minimum.accumulate(at[::-1])[::-1]


def _words(text: np.ndarray, more: int) -> np.ndarray:
    """The eight bytes from each place, as big-endian integers; zeros behind the end."""
    w = np.zeros(len(text) + more + 8, np.uint64)
    w[:len(text)] = text
    for k in (1, 2, 4):
        w = w[:-k] << np.uint64(8 * k) | w[k:]
    return w


def _direct(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Sort places by their next ``depth`` bytes, eight at a time among ties."""
    if not len(at):
        return at
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    for k in range(8, depth, 8):
        tied = np.append(group[1:] == group[:-1], False)
        tied[1:] |= tied[:-1].copy()
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        key, g = words[at[rows] + k], group[rows]
        apart = np.flatnonzero((g[1:] == g[:-1]) & (key[1:] != key[:-1]))
        if not len(apart):
            continue
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[g[apart]] = True                           # other groups stay as they are
        rows, key, g = (x[mixed[g]] for x in (rows, key, g))
        order = np.lexsort((key, g))
        at[rows] = at[rows][order]
        key = key[order]
        fresh = np.zeros(len(at), np.int64)
        fresh[rows[1:]] = (g[1:] == g[:-1]) & (key[1:] != key[:-1])
        group = group + np.cumsum(fresh)
    return at


def sort_suffixes(text: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Places of the wanted suffixes, sorted by their first ``depth`` bytes.

    ``text``: the strings, one after another; string i is
    ``text[bounds[i]:bounds[i+1]]`` and its first ``wanted[i]`` (one at
    least) suffixes are wanted, each of them ``depth`` bytes long or longer.
    """
    k = len(bounds) - 1
    # one end mark, smaller than any byte, behind each string
    first = bounds[:-1] + np.arange(k)
    ends = bounds[1:] + np.arange(k)
    is_end = np.zeros(len(text) + k, bool)
    is_end[ends] = True
    t = np.full(len(text) + k, -1, np.int16)
    t[~is_end] = text
    words = _words(np.maximum(t, 0), depth)

    differs = np.append(t[:-1] != t[1:], True)
    at = _next(differs)
    small = np.zeros(len(t), bool)                      # type S
    inside = at < len(t) - 1
    small[inside] = t[at[inside]] < t[at[inside] + 1]
    small[is_end] = False
    stop = _next(small | is_end)                        # ends of runs of type L

    last = first + wanted
    need = np.zeros(len(t) + 1, np.int64)
    np.add.at(need, first, 1)
    np.add.at(need, np.maximum(last, stop[last - 1] + 1), -1)
    need = np.cumsum(need[:-1]) > 0

    direct = _direct(words, np.flatnonzero(need & small), depth)
    cut = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(places: np.ndarray, above: int) -> None:
        before = places[places > 0] - 1
        before = before[need[before] & ~small[before] & ~is_end[before]]
        byte = t[before]
        if above >= 0:
            before, byte = before[byte > above], byte[byte > above]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        edge = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])) if len(byte) else byte
        for a, b in zip(edge, np.append(edge[1:], len(byte))):
            waiting[byte[a]].append(before[a:b])

    induce(ends[need[ends]], -1)
    out = []
    for c in range(256):
        part, front = [], waiting[c]
        front = np.concatenate(front) if front else np.empty(0, np.int64)
        while len(front):                               # runs of the byte itself
            part.append(front)
            front = front[front > 0] - 1
            front = front[need[front] & ~small[front] & (t[front] == c)]
        bucket = np.concatenate([*part, direct[cut[c]:cut[c + 1]]])
        if len(bucket):
            induce(bucket, c)
            out.append(bucket)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    string = np.searchsorted(first, order, "right") - 1
    keep = order < last[string]
    return (order - string)[keep]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each sorted suffix with the one before, ``depth`` at most."""
    words = _words(text, depth)
    out = np.zeros(len(order), np.int64)
    rows = np.arange(1, len(order))
    for k in range(0, depth, 8):
        if not len(rows):
            break
        apart = words[order[rows] + k] ^ words[order[rows - 1] + k]
        high = (apart >> np.uint64(32)).astype(np.float64)
        bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp((apart & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])
        out[rows] = np.minimum(depth, k + (64 - bits) // 8)
        rows = rows[apart == 0]
    return out
