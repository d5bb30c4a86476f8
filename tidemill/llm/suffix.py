"""Suffix arrays by induced sorting and permuted common prefixes, in NumPy."""

from __future__ import annotations

from array import array

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S type); the end of the string counts as smallest."""
    n = len(s)
    rise = np.empty(n, dtype=np.int8)  # 1 smaller than the next character, -1 larger, 0 equal
    rise[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    rise[-1] = -1
    # an equal neighbour has the type of the next unequal place
    place = np.where(rise != 0, np.arange(n), n)
    following = np.minimum.accumulate(place[::-1])[::-1]
    return rise[following] > 0


def _spread(targets: np.ndarray, chars: np.ndarray, heads: np.ndarray, sa: np.ndarray, step: int) -> None:
    """Put `targets` into the buckets of their characters, in order, and move the heads (step 1) or tails (step -1)."""
    order = np.argsort(chars, kind="stable")
    c, t = chars[order], targets[order]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[heads[c] + step * rank] = t
    heads[c[first]] += step * size


def _induce(s: np.ndarray, small: np.ndarray, sa: np.ndarray, bounds: np.ndarray) -> None:
    """Induce L types from the left, then S types from the right, one bucket after the other.

    Within a bucket, the entries that are known induce others at once; those that fall into the bucket itself
    (repeats of its character) form the next wave, and a bucket takes as many waves as its character repeats.
    """
    n = len(s)
    used = np.flatnonzero(np.diff(bounds))
    heads = bounds[:-1].copy()
    # the last suffix precedes all others: it induces first
    if not small[n - 1]:
        _spread(np.array([n - 1]), s[n - 1 :], heads, sa, 1)
    for c in used.tolist():
        low, top = int(bounds[c]), int(bounds[c + 1])
        done = low
        while done < heads[c]:
            wave_end = int(heads[c])
            j = sa[done:wave_end] - 1
            j = j[j >= 0]
            j = j[~small[j]]
            if len(j):
                _spread(j, s[j], heads, sa, 1)
            done = wave_end
        # the S-type seeds of the bucket, at its end
        seeds = sa[done:top]
        j = seeds[seeds > 0] - 1
        j = j[~small[j]]
        if len(j):
            _spread(j, s[j], heads, sa, 1)
    tails = bounds[1:] - 1
    for c in used[::-1].tolist():
        low, top = int(bounds[c]), int(bounds[c + 1])
        done = top - 1
        while done > tails[c]:
            wave_end = int(tails[c])
            j = sa[done:wave_end:-1] - 1 if wave_end >= 0 else sa[done::-1] - 1
            j = j[j >= 0]
            j = j[small[j]]
            if len(j):
                _spread(j, s[j], tails, sa, -1)
            done = wave_end
        # the L types of the bucket, at its start
        wave_end = int(heads[c])
        j = sa[low:wave_end][::-1] - 1
        j = j[j >= 0]
        j = j[small[j]]
        if len(j):
            _spread(j, s[j], tails, sa, -1)


def _induce_lists(s: np.ndarray, small: np.ndarray, sa: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The same for large alphabets, where buckets hold few entries: element by element.

    A table gives, for every suffix, the character before it where that one is of the type a scan induces, else -1. Its
    last place answers for -1, the empty places of the array.
    """
    n = len(s)
    before = np.full((2, n + 1), -1, dtype=np.int32)
    before[0, 1:n] = np.where(small[:-1], -1, s[:-1])
    before[1, 1:n] = np.where(small[:-1], s[:-1], -1)
    flat, heads, tails = array('q', sa.tobytes()), array('q', bounds[:-1].tobytes()), array('q', (bounds[1:] - 1).tobytes())
    if not small[n - 1]:
        c = int(s[n - 1])
        flat[heads[c]] = n - 1
        heads[c] += 1
    table = array('i', before[0].tobytes())
    for i in flat:  # the list grows while it is read, from left to right
        c = table[i]
        if c >= 0:
            at = heads[c]
            flat[at] = i - 1
            heads[c] = at + 1
    table = array('i', before[1].tobytes())
    for i in reversed(flat):  # and from right to left
        c = table[i]
        if c >= 0:
            at = tails[c]
            flat[at] = i - 1
            tails[c] = at - 1
    return np.frombuffer(flat, dtype=np.int64)


def _sorted_from(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix array induced from `seeds`, the leftmost-smaller positions in the order they stand in."""
    n, alphabet = len(s), len(bounds) - 1
    sa = np.full(n, -1, dtype=np.int64)
    back = seeds[::-1]
    tails = bounds[1:] - 1
    if len(back):
        _spread(back, s[back], tails, sa, -1)
    if alphabet <= 4096:
        # seeds are S types; what the left scan may read of a bucket is filled from its head
        _induce(s, small, sa, bounds)
        return sa
    return _induce_lists(s, small, sa, bounds)


def _names(s: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings, in order of position, and how many differ.

    Neighbours in the sorted order are compared on whole substrings, a character at a time for all pairs still equal.
    """
    n = len(s)
    following = np.append(lms[1:], n - 1)
    length = np.zeros(n, dtype=np.int64)
    length[lms] = following - lms + 1
    a, b = ranked[:-1], ranked[1:]
    differs = length[a] != length[b]
    # the last substring runs into the end of the string and equals none
    differs |= (a == lms[-1]) | (b == lms[-1])
    live = np.flatnonzero(~differs)
    depth = 0
    while len(live):
        unequal = s[a[live] + depth] != s[b[live] + depth]
        differs[live[unequal]] = True
        live = live[~unequal]
        depth += 1
        live = live[length[a[live]] > depth]
    name = np.empty(n, dtype=np.int64)
    name[ranked] = np.concatenate(([0], np.cumsum(differs)))
    return name[lms], int(differs.sum()) + 1


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """The starts of all suffixes of `s` (characters 0 to `alphabet` - 1) in order.

    Suffixes are classified as smaller or larger than the next one. The substrings between leftmost-smaller
    positions are sorted by one induction and named; if names repeat, the string of names is sorted by recursion.
    A second induction from the sorted leftmost-smaller suffixes gives the order of all.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    small = _types(s)
    bounds = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=alphabet))))
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        return _sorted_from(s, small, lms, bounds)
    first = _sorted_from(s, small, lms, bounds)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    ranked = first[is_lms[first]]
    if len(lms) > 1:
        names, count = _names(s, lms, ranked)
        ranked = lms[suffix_array(names, count)] if count < len(lms) else ranked
    return _sorted_from(s, small, ranked, bounds)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`(plcp, phi)` by position: the suffix before it in the array, and how many characters they have in common.

    Only where the characters before the two suffixes differ is the common prefix counted; everywhere else it is one less than
    that of the position before. The counted prefixes add up to at most `2 n log n`. The first suffix has phi -1.
    """
    n = len(s)
    phi = np.full(n, -1, dtype=np.int64)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    follows = np.zeros(n, dtype=bool)
    ok = (at > 0) & (phi > 0)
    follows[ok] = s[at[ok] - 1] == s[phi[ok] - 1]
    # a reducible position also needs its predecessor to be the one before: that holds by the order of the array
    plcp = np.zeros(n, dtype=np.int64)
    live = np.flatnonzero(~follows & (phi >= 0))
    room = n - np.maximum(live, phi[live])
    depth = 0
    start = live
    while len(start):
        fits = room > depth
        start, room = start[fits], room[fits]
        same = s[start + depth] == s[phi[start] + depth]
        start, room = start[same], room[same]
        depth += 1
        plcp[start] = depth
    # position i has plcp[j] - (i - j), j being the last position at or before i that was counted
    last = np.maximum.accumulate(np.where(follows, -1, at))
    return np.where(follows, plcp[last] - (at - last), plcp), phi
