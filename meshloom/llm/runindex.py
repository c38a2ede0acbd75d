"""A run-length index of a set of strings: run-compressed Burrows-Wheeler transform with samples at run ends.

The strings are separated by end marks that differ from each other, so no match crosses one. Of the
suffix order only the runs of the transform are kept, with the text positions of each run's first and
last suffix and the lengths of their matches with the suffixes before and after. Between samples the
length of a match falls by one with each step through the text, so the matching statistics of the
whole collection against all its other positions stream from the samples alone. Copies of a string are
one entry with a multiplicity: their suffixes would stand side by side, in the same runs, and match to
the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols packed into a key of the first sort, 9 bits each.
_PACK = 7


@dataclass(frozen=True)
class RunIndex:
    """symbols and lengths are the runs (symbol 0: an end mark, a run of its own); the samples are in text order."""

    size: int
    symbols: np.ndarray
    lengths: np.ndarray
    heads: np.ndarray
    head_match: np.ndarray
    ends: np.ndarray
    end_match: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    copies: np.ndarray


def _keys(text: np.ndarray, rest: np.ndarray) -> np.ndarray:
    out = np.zeros(len(text), np.uint64)
    wide = np.concatenate([text, np.zeros(_PACK, np.uint16)])
    for k in range(_PACK):
        out = out << np.uint64(9) | np.where(rest > k, wide[k : k + len(text)], 0).astype(np.uint64)
    return out


def _suffix_order(keys: np.ndarray, rest: np.ndarray, longest: int) -> np.ndarray:
    """All suffixes in order, by prefix doubling over the groups that are still tied."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    first = np.ones(n, bool)
    first[1:] = (keys[order[1:]] != keys[order[:-1]]) | (rest[order[1:]] < _PACK)
    at = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = at
    width = _PACK
    last = np.append(first[1:], True)
    slots = np.flatnonzero(~(first & last))
    while width <= longest and len(slots):
        suffix = order[slots]
        pair = rank[suffix].astype(np.uint64) << np.uint64(32) | rank[np.minimum(suffix + width, n - 1)].astype(np.uint64)
        by = np.argsort(pair, kind="stable")
        suffix, pair = suffix[by], pair[by]
        order[slots] = suffix
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[suffix] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots = slots[~(new & np.append(new[1:], True))]
        width *= 2
    return order


def _matches(keys: np.ndarray, text: np.ndarray, rest: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a[i] and b[i]; one below `least` may come out up to _PACK - 1 short."""
    out, live, n = np.zeros(len(a), np.int64), np.arange(len(a)), len(keys)
    most = np.minimum(rest[a], rest[b])
    while len(live):
        p, q = np.minimum(a[live] + out[live], n - 1), np.minimum(b[live] + out[live], n - 1)
        same = (keys[p] == keys[q]) & (out[live] + _PACK <= most[live])
        live = live[same]
        out[live] += _PACK
    live = np.flatnonzero(out + _PACK > least)
    while len(live):
        p, q = np.minimum(a[live] + out[live], n - 1), np.minimum(b[live] + out[live], n - 1)
        live = live[(out[live] < most[live]) & (text[p] == text[q])]
        out[live] += 1
    return out


def build(strings: list[bytes], least: int = 0, copies: list[int] | None = None) -> RunIndex:
    """The index of the strings, each in so many copies (one if not given); matches below `least` are only bounded from below."""
    sizes = np.array([len(s) for s in strings], np.int64)
    n = int(sizes.sum()) + len(strings)
    text = np.zeros(n, np.uint16)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(strings) else np.zeros(0, np.int64)
    inner = np.ones(n, bool)
    inner[starts + sizes] = False
    text[inner] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    rest = np.repeat(starts + sizes, sizes + 1) - np.arange(n)
    keys = _keys(text, rest)
    order = _suffix_order(keys, rest, int(sizes.max(initial=0)))
    before = text[order - 1]  # the last symbol is an end mark, so it may stand before the first
    cut = np.ones(n + 1, bool)
    cut[1:n] = (before[1:] != before[:-1]) | (before[1:] == 0)
    head = np.flatnonzero(cut[:-1])
    end = np.flatnonzero(cut[1:])
    up, down = head[head > 0], end[end < n - 1]
    first, last = np.zeros(len(head), np.int64), np.zeros(len(end), np.int64)
    first[head > 0] = _matches(keys, text, rest, order[up], order[up - 1], least)
    last[end < n - 1] = _matches(keys, text, rest, order[down], order[down + 1], least)
    by_head, by_end = np.argsort(order[head]), np.argsort(order[end])
    return RunIndex(n, before[head].astype(np.uint8), np.diff(np.append(head, n)), order[head][by_head], first[by_head], order[end][by_end], last[by_end], starts, sizes, np.array(copies or [1] * len(strings), np.int64))


def matching_statistics(index: RunIndex) -> np.ndarray:
    """For each text position the length of its longest match that starts at any other position."""
    at = np.arange(index.size)

    def stream(samples: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        k = np.searchsorted(samples, at, side="right") - 1
        return lengths[k] - (at - samples[k])

    rest = np.repeat(index.starts + index.sizes, index.sizes + 1) - at
    own = np.where(np.repeat(index.copies > 1, index.sizes + 1), rest, 0)  # the next suffix in order is that of a copy
    return np.maximum(np.maximum(stream(index.heads, index.head_match), stream(index.ends, index.end_match)), own)


def repeated_starts(strings: list[bytes], window: int, copies: list[int] | None = None) -> list[np.ndarray]:
    """For each string which of its windows also start somewhere else in the strings and their copies, itself included."""
    if not strings:
        return []
    index = build(strings, window, copies)
    long = matching_statistics(index) >= window
    return [long[s : s + max(0, len(t) - window + 1)] for s, t in zip(index.starts, strings, strict=True)]
