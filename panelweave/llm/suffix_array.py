"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text.

All suffixes are induced from the leftmost-smaller ones, with whole buckets at a time in numpy. Those
are named by their substrings; where names tie, the string of names is sorted by doubling in numpy,
as it has a large alphabet with small buckets.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that follows it (S type); the last one is not."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    decided = np.where(step != 0, np.arange(n - 1), n)  # the next place where neighbours differ decides
    following = np.minimum.accumulate(decided[::-1])[::-1]
    out = np.zeros(n, dtype=bool)
    out[:-1] = np.append(step, -1)[np.minimum(following, n - 1)] > 0
    return out


def _induce(text: np.ndarray, small: np.ndarray, order: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order: first the larger, then the smaller types."""
    n = len(text)
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(n, dtype=np.int64)
    by_letter = order[np.argsort(text[order], kind="stable")]
    cut = np.concatenate(([0], np.cumsum(np.bincount(text[order], minlength=letters))))

    head = starts.copy()

    def forward(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        if len(before):
            letter = text[before]
            place = np.argsort(letter, kind="stable")
            counts = np.bincount(letter, minlength=letters)
            used = np.flatnonzero(counts)
            shift = head[used] - (np.cumsum(counts[used]) - counts[used])
            out[np.arange(len(before)) + np.repeat(shift, counts[used])] = before[place]
            head[used] += counts[used]

    forward(np.array([n]))  # the empty suffix comes before all
    for c in np.flatnonzero(sizes):
        at = starts[c]
        while at < head[c]:
            stop = head[c]
            forward(out[at:stop])
            at = stop
        forward(by_letter[cut[c]:cut[c + 1]])

    tail = ends.copy()

    def backward(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[small[before]]
        if len(before):
            letter = text[before]
            place = np.argsort(letter, kind="stable")
            counts = np.bincount(letter, minlength=letters)
            used = np.flatnonzero(counts)
            shift = tail[used] - 1 + (np.cumsum(counts[used]) - counts[used])
            out[np.repeat(shift, counts[used]) - np.arange(len(before))] = before[place]
            tail[used] -= counts[used]

    for c in np.flatnonzero(sizes)[::-1]:
        at = ends[c]
        while at > tail[c]:
            stop = tail[c]
            backward(out[stop:at][::-1])
            at = stop
        backward(out[starts[c]:head[c]][::-1])
    return out


def _doubled(names: np.ndarray) -> np.ndarray:
    """All suffixes of a string of numbers in order, by doubling: those that still tie are sorted by what follows the part known."""
    n, span = len(names), 1
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    place = np.arange(n)
    head = np.concatenate(([True], sorted_names[1:] != sorted_names[:-1]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))  # place of the first of those that tie
    while not head.all():
        tied = np.flatnonzero(~head | ~np.append(head[1:], True))
        mine = order[tied]
        after = np.where(mine + span < n, rank[np.minimum(mine + span, n - 1)] + 1, 0)
        by = np.lexsort((after, rank[mine]))
        mine, after = mine[by], after[by]
        order[tied] = mine
        before = rank[mine]
        head[tied[1:]] |= (before[1:] != before[:-1]) | (after[1:] != after[:-1])
        rank[mine] = tied[np.maximum.accumulate(np.where(head[tied], np.arange(len(tied)), 0))]
        span *= 2
    return order


def suffix_array(text: np.ndarray, letters: int = 256) -> np.ndarray:
    n = len(text)
    if n < 2:
        return np.arange(n)
    small = _types(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(leftmost):
        return _induce(text, small, leftmost, letters)
    rough = _induce(text, small, leftmost, letters)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    order = rough[is_leftmost[rough]]  # sorted by leftmost-smaller substring
    following = np.empty(n, dtype=np.int64)
    following[leftmost] = np.append(leftmost[1:], n)
    length = following[order] - order
    same = np.flatnonzero((length[1:] == length[:-1]) & (following[order[1:]] < n) & (following[order[:-1]] < n))
    equal = np.zeros(len(order), dtype=bool)
    k = 0
    while len(same):  # neighbours that agree so far; the substring includes the first letter of the next
        same = same[text[order[same] + k] == text[order[same + 1] + k]]
        done = length[same] == k
        equal[same[done] + 1] = True
        same = same[~done]
        k += 1
    names = np.cumsum(~equal) - 1
    if names[-1] + 1 < len(order):
        named = np.empty(n, dtype=np.int64)
        named[order] = names
        order = leftmost[_doubled(named[leftmost])]
    return _induce(text, small, order, letters)


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """By suffix: letters shared with its predecessor in the order, at most ``left`` (to the end of its piece).

    A suffix that, like its predecessor, continues the suffix before it to the left shares one
    letter less than that one. Only the others are compared, eight letters at a time.
    """
    n = len(text)
    before = np.empty(n, dtype=np.int64)
    before[suffixes[0]] = -1
    before[suffixes[1:]] = suffixes[:-1]
    own = np.ones(n, dtype=bool)
    inner = np.flatnonzero((before[1:] > 0) & (left[:-1] > 0)) + 1
    own[inner] = text[inner - 1] != text[before[inner] - 1]
    at = np.flatnonzero(own)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = text
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    shared = np.zeros(len(at), dtype=np.int64)
    open_ = np.flatnonzero((before[at] >= 0) & (left[at] > 0))
    while len(open_):
        a, b = at[open_] + shared[open_], before[at[open_]] + shared[open_]
        inside = np.maximum(a, b) <= n
        open_, a, b = open_[inside], a[inside], b[inside]
        differ = words[np.minimum(a, n)] != words[np.minimum(b, n)]
        some = differ.any(axis=1)
        shared[open_] += np.where(some, differ.argmax(axis=1), 8)
        open_ = open_[~some]
        open_ = open_[shared[open_] < left[at[open_]]]
    out = np.zeros(n, dtype=np.int64)
    out[at] = np.minimum(np.minimum(shared, left[at]), n - np.maximum(at, before[at]))
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return np.maximum(out[last] - (np.arange(n) - last), 0)
