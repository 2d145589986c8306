"""Suffix arrays by induced sorting, with numpy doing each step for whole buckets at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

PAD = 0xFF
"""Stands after the end of a substring. Texts are closed by a byte smaller than all others, see ``closed``."""


def closed(text: np.ndarray) -> np.ndarray:
    """The text with all bytes (253 at most, which UTF-8 never exceeds) raised by one, and a zero at its end."""
    return np.append(text + np.uint8(1), np.uint8(0))


def heads(text: np.ndarray, reach: int) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; ``PAD`` after the end, for ``reach`` more places."""
    n = len(text)
    wide = np.full(n + reach + 8, PAD, np.uint8)
    wide[:n] = text
    out = np.zeros(n + reach, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | wide[i : i + n + reach]
    return out


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one, and the places of the leftmost of each run of those."""
    n = len(text)
    smaller = np.zeros(n, bool)
    smaller[n - 1] = True
    if n > 1:
        step = text[:-1].astype(np.int16) - text[1:]
        places = np.arange(n - 1)
        settled = np.where(step != 0, places, n)
        following = np.minimum.accumulate(settled[::-1])[::-1]  # where an equal run ends
        smaller[:-1] = step[following] < 0
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    return smaller, leftmost


def _refine(order: np.ndarray, first: np.ndarray, key: Callable[[np.ndarray], np.ndarray]) -> None:
    """Sort the ties of ``order`` by ``key``; ``first`` marks where a new value begins."""
    n = len(order)
    alone = first & np.append(first[1:], True)
    slots = np.flatnonzero(~alone)
    if not len(slots):
        return
    group = np.cumsum(first)[slots]
    items = order[slots]
    keys = key(items)
    if group[0] == group[-1]:
        by = np.argsort(keys, kind="stable")
    elif keys.dtype == np.int64:  # names below the number of suffixes
        by = np.argsort(group * (n + 2) + keys, kind="stable")
    else:
        by = np.lexsort((keys, group))
    order[slots] = items[by]
    keys = keys[by]
    fresh = np.ones(len(slots), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])
    first[slots] |= fresh


def _sorted_leftmost(word: np.ndarray, n: int, at: np.ndarray, depth: int | None) -> np.ndarray:
    """The leftmost-smaller suffixes in order, at least by their first ``depth`` bytes.

    Their substrings, each up to and with the next one's first byte, are sorted and named; the names make a
    shorter text, whose suffixes are sorted by names that reach twice as far in every round.
    """
    m = len(at)
    if not m:
        return at
    length = np.append(at[1:] + 1, n) - at

    def piece(t: int):
        def key(items):
            left = length[items] - 8 * t
            cover = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
            filler = np.where(cover >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(cover, np.uint64(63))) - np.uint64(1))
            return word[np.minimum(at[items] + 8 * t, len(word) - 1)] | filler
        return key

    order = np.arange(m)
    first = np.zeros(m, bool)
    first[0] = True
    t = 0
    while t == 0 or (length[order[~(first & np.append(first[1:], True))]] > 8 * t).any():
        _refine(order, first, piece(t))
        t += 1
    reach = 1
    while not first.all() and (depth is None or 2 * reach < depth + 2):
        name = np.empty(m + 1, np.int64)
        name[order] = np.cumsum(first)
        name[m] = 0
        _refine(order, first, lambda items: name[np.minimum(items + reach, m)])  # noqa: B023
        reach *= 2
    return at[order]


def _deal(into: list[list[np.ndarray]], places: np.ndarray, text: np.ndarray) -> None:
    """Append places, in order, to the buckets of their bytes."""
    if not len(places):
        return
    own = text[places]
    by = np.argsort(own, kind="stable")
    places, own = places[by], own[by]
    cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
    begin = 0
    for end in [*cuts.tolist(), len(own)]:
        into[own[begin]].append(places[begin:end])
        begin = end


def suffix_array(text: np.ndarray, depth: int | None = None, word: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of a ``closed`` text in ascending order, but for the closing one; with ``depth``, suffixes that
    agree in their first ``depth`` bytes may stand in any order."""
    n = len(text)
    if n == 1:
        return np.zeros(0, np.int64)
    word = heads(text, 8) if word is None else word
    smaller, at = classify(text)
    seeds: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(seeds, _sorted_leftmost(word, n, at, depth), text)
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    done: list[np.ndarray] = []
    nothing = np.zeros(0, np.int64)
    for c in range(256):
        i = 0
        while i < len(larger[c]):  # grows while runs of c are followed back
            before = larger[c][i] - 1
            before = before[before >= 0]
            _deal(larger, before[~smaller[before]], text)
            i += 1
        done.append(np.concatenate(larger[c]) if larger[c] else nothing)
        for seed in seeds[c]:
            _deal(larger, seed - 1, text)
    rising: list[list[np.ndarray]] = [[] for _ in range(256)]
    rising[0].append(np.array([n - 1]))
    out: list[np.ndarray] = []
    for c in range(255, -1, -1):
        i = 0
        while i < len(rising[c]):
            before = rising[c][i] - 1
            before = before[before >= 0]
            _deal(rising, before[smaller[before]], text)
            i += 1
        before = done[c][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        _deal(rising, before, text)
        out.append(np.concatenate(rising[c])[::-1] if rising[c] else nothing)
        out.append(done[c])
    return np.concatenate(out[::-1])[1:]


def permuted_prefixes(word: np.ndarray, order: np.ndarray, most: int, least: int = 0) -> np.ndarray:
    """For each place, how many bytes its suffix shares with the one before it in ``order``, ``most`` at most.
    Numbers below ``least`` may come out too small by less than eight."""
    shared = np.zeros(len(order), np.int32)
    if len(order) < 2:
        return shared
    here, there, rows = order[1:], order[:-1], np.arange(len(order) - 1)
    got = np.zeros(len(order) - 1, np.int32)
    for t in range(0, most, 8):
        x = word[np.minimum(here + t, len(word) - 1)] ^ word[np.minimum(there + t, len(word) - 1)]
        same = x == 0
        if t + 8 > least:
            low = np.zeros(len(x), np.int32)
            for k in range(1, 8):
                low += x < np.uint64(1 << (8 * (8 - k)))
            got[rows] = t + np.where(same, 8, low)
        else:
            got[rows[same]] = t + 8
        here, there, rows = here[same], there[same], rows[same]
        if not len(rows):
            break
    shared[order[1:]] = np.minimum(got, most)
    return shared
