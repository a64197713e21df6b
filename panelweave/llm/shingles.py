"""Word shingles of texts as 64-bit hashes, computed a batch at a time in numpy.

A word is a run of bytes other than white space, A-Z in lower case. A shingle is a run of
``size`` words; a text with fewer words has one shingle, its whole sequence; a text without
words has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np

SIZE = 5
PIECE = 1 << 20  # bytes hashed at a time
_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)
_PLAIN = bytes(32 if b in (32, 9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BYTE = np.array([int.from_bytes(blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least n of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the hash."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of a piece that begins and ends at word borders."""
    word = data != 32
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edges = np.concatenate(([0], edges))
    if len(word) and word[-1]:
        edges = np.append(edges, len(word))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_STEP, len(data))[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return starts, mix(hashes + (ends - starts).astype(np.uint64))


def words_of(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each text and the end)."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    whole = b" ".join(coded).translate(_PLAIN)
    begins = np.cumsum([0] + [len(c) + 1 for c in coded])
    data = np.frombuffer(whole, dtype=np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            end = whole.find(b" ", end)
            end = len(data) if end < 0 else end
        s, h = _piece_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    starts = np.concatenate(starts) if starts else np.empty(0, dtype=np.int64)
    flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
    return flat, np.searchsorted(starts, begins)


def shingle_sets(texts: Sequence[str | None], size: int = SIZE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, first = words_of(texts)
    step = [np.uint64(pow(_STEP, k, 1 << 64)) for k in range(size)]
    n = len(words) - size + 1
    runs = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        runs += words[k:k + n] * step[k]
    runs = mix(runs)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(runs[a:b - size + 1])
        elif b > a:
            short = np.uint64(b - a)  # the number of words keeps short texts apart from shingles
            yield mix((words[a:b] * np.array(step[:b - a], dtype=np.uint64)).sum(dtype=np.uint64, keepdims=True) ^ mix(np.array([short])))
        else:
            yield np.empty(0, dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for a set of hashes."""
    one = mix(hashes).sum(dtype=np.uint64)
    two = mix(hashes ^ np.uint64(_STEP)).sum(dtype=np.uint64)
    return np.array([one, two], dtype=np.uint64).tobytes()
