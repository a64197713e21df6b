"""Benchmark decontamination by the q-gram lemma.

A benchmark item is cut into windows of 100 characters every 20 (the item itself where it is
short), so any verbatim passage of 119 characters holds one. A document holds a
window within e edits only if they share at least m - q + 1 - q*e q-grams on e + 1 neighbouring
diagonals (m: window length). So shared q-grams are counted in diagonal bands of 2(e + 1) that
overlap by half, bands that reach the bound are kept, and banded alignment verifies them.

The benchmark is the stated query set: it is split into blocks of about ``block_chars``
characters, each small enough to hand to every task, and every document meets every block; its
size changes the number of blocks, not the memory. There is no shuffle and no join.

Letters count in lower case and every white-space character as a blank; positions are code
points of the original text. Items under ``min_chars`` are searched whole and without edits;
those shorter than a q-gram by a hash of the whole, and only where no letter or digit adjoins
them. Null text and null items count as empty, repeated rows are judged each for itself, an empty table or
benchmark gives an empty result. Extra columns are passed through (one named like the result
gives way).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import query, table, with_columns

Q = 10
EDITS = 0.08  # edits per character of a window
WINDOW = 100  # characters; longer items are searched in windows
STRIDE = 20  # characters from one window to the next
MIN_CHARS = 60  # shorter items are searched without edits
BLOCK_CHARS = 1_000_000
PIECE = 32_768  # characters of a text that are searched at a time, to bound the memory
_STEP = np.uint64(0x9E3779B97F4A7C15)
_AS_BLANK = np.arange(256, dtype=np.uint32)
_AS_BLANK[[9, 10, 11, 12, 13, 0x85, 0xA0]] = 32


def codes_of(text: str) -> np.ndarray:
    """Code points, one per character of the text: lower case, white space as blanks."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 256, _AS_BLANK[np.minimum(codes, 255)], codes)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hash of every q-gram, put together from those of 1, 2, 4, ... characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    power, size, left = codes.astype(np.uint64), 1, q
    out, done = np.zeros(n, dtype=np.uint64), 0
    while left:
        if left & 1:
            out = out * _shift(size) + power[done:done + n]
            done += size
        left >>= 1
        if left:
            power = power[:-size] * _shift(size) + power[size:]
            size *= 2
    return out


def _shift(size: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), size, 1 << 64))


@dataclass
class WindowIndex:
    """Windows of one block of items, and where each q-gram occurs in them."""

    items: list  # item id by window
    codes: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    keys: np.ndarray  # distinct gram hashes, sorted
    first: np.ndarray  # of each key, its first posting
    windows: np.ndarray  # postings: window, place in it
    places: np.ndarray
    seen: np.ndarray  # by the top bits of a hash, whether a key has them
    longest: int
    tiny: dict  # items shorter than a q-gram: by length, sorted hashes and (item, codes) of each

    @classmethod
    def of(cls, items: Sequence[tuple], q: int = Q, rate: float = EDITS, window: int = WINDOW, min_chars: int = MIN_CHARS) -> WindowIndex:
        names, cut, tiny = [], [], {}
        for name, text in items:
            codes = codes_of((text or "").strip())
            if len(codes) < q:
                if len(codes):
                    tiny.setdefault(len(codes), {}).setdefault(int(gram_hashes(codes, len(codes))[0]), []).append((name, codes))
                continue
            last = max(len(codes) - window, 0)
            for start in sorted({*range(0, last, STRIDE), last}):
                names.append(name)
                cut.append(codes[start:start + window])
        lengths = np.array([len(c) for c in cut], dtype=np.int64)
        edits = np.where(lengths < min_chars, 0, np.floor(lengths * rate)).astype(np.int64)
        hashes = [gram_hashes(c, q) for c in cut]
        flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        windows = np.repeat(np.arange(len(cut)), [len(h) for h in hashes]) if cut else np.empty(0, dtype=np.int64)
        places = np.concatenate([np.arange(len(h)) for h in hashes]) if cut else np.empty(0, dtype=np.int64)
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        seen = np.zeros(1 << 20, dtype=bool)
        seen[keys >> np.uint64(44)] = True
        return cls(names, cut, edits, np.maximum(lengths - q + 1 - q * edits, 1), keys, np.append(first, len(flat)), windows[order], places[order], seen, int(lengths.max(initial=0)),
                   {n: (np.array(sorted(by), dtype=np.uint64), by) for n, by in tiny.items()})

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, window, place in the window) of every shared q-gram."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(44)])
        if not len(at):
            return at, at, at
        key = np.searchsorted(self.keys, hashes[at])
        key = np.minimum(key, len(self.keys) - 1)
        same = self.keys[key] == hashes[at]
        at, key = at[same], key[same]
        counts = self.first[key + 1] - self.first[key]
        posting = np.repeat(self.first[key] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        return np.repeat(at, counts), self.windows[posting], self.places[posting]


def align(window: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """Least edits of the whole window against a part of the text that begins on a diagonal in [low, high].

    Returns (edits, start, end) or None if there are more than ``edits``. Only the diagonals that
    ``edits`` can reach are computed, a row of the band at a time; each cell holds edits and start together.
    """
    first, width = low - edits, high - low + 1 + 2 * edits
    unit, across = np.int64(1 << 32), np.arange(width, dtype=np.int64)
    starts = first + across
    inside = (starts >= 0) & (starts <= len(text))
    none = np.int64(1 << 60)
    row = np.where(inside, np.maximum(starts, 0), none)
    steps = across * unit
    padded = np.full(width + len(window), -1, dtype=np.int64)  # text under the band; -1 equals no character
    a, b = max(first, 0), min(first + len(padded), len(text))
    if a < b:
        padded[a - first:b - first] = text[a:b]
    for i, char in enumerate(window):
        level = row + (padded[i:i + width] != char) * unit
        np.minimum(level[:-1], row[1:] + unit, out=level[:-1])
        if first + i + 1 < 0:
            level[:-(first + i + 1)] = none  # ahead of the text
        if first + i + width > len(text):
            level[max(len(text) - first - i, 0):] = none  # behind it
        row = np.minimum.accumulate(level - steps)
        row += steps
        if i % 32 == 31 and int(row.min() >> 32) > edits:
            return None
    best = int(np.argmin(row))
    cost = int(row[best] >> 32)
    return (cost, int(row[best] & (unit - 1)), int(starts[best]) + len(window)) if cost <= edits else None


def _alone(codes: np.ndarray, start: int, end: int) -> bool:
    """Whether no letter or digit adjoins the place."""
    return not any(0 <= i < len(codes) and chr(codes[i]).isalnum() for i in (start - 1, end))


def _tiny_leaks(codes: np.ndarray, index: WindowIndex) -> dict:
    """The first place of every item that is shorter than a q-gram, a piece of the text at a time."""
    found: dict = {}
    for n, (keys, by) in index.tiny.items():
        for piece in range(0, len(codes), PIECE):
            hashes = gram_hashes(codes[piece:piece + PIECE + n - 1], n)
            at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)] == hashes)
            for i in at:
                start = piece + int(i)
                for item, pattern in by[int(hashes[i])]:
                    if item not in found and np.array_equal(codes[start:start + n], pattern) and _alone(codes, start, start + n):
                        found[item] = (0, start, start + n)
    return found


def leaks_of(text: str | None, index: WindowIndex, q: int = Q) -> list[tuple]:
    """(item, start, end, edits) of every item a window of which is in the text, the best place of each."""
    if not text or not (index.items or index.tiny):
        return []
    codes = codes_of(text)
    found = _tiny_leaks(codes, index)
    if not index.items:
        return [(item, start, end, cost) for item, (cost, start, end) in found.items()]
    reach = 2 * index.longest  # pieces overlap by more than a window with its edits
    for piece in range(0, max(len(codes) - reach, 1), PIECE):
        part = codes[piece:piece + PIECE + reach]
        at, window, place = index.hits(gram_hashes(part, q))
        if not len(at):
            continue
        stride = index.edits[window] + 1
        diagonal = at - place + 2 * WINDOW  # not negative
        band = diagonal // stride
        both = np.concatenate([window * (1 << 32) + band, window * (1 << 32) + band - 1])
        # a place of the window counts once in a band, however often the text repeats its q-gram there
        order = np.lexsort((np.tile(place, 2), both))
        both, places = both[order], np.tile(place, 2)[order]
        fresh = np.ones(len(both), dtype=bool)
        fresh[1:] = (both[1:] != both[:-1]) | (places[1:] != places[:-1])
        bands, counts = np.unique(both[fresh], return_counts=True)
        kept = bands[counts >= index.bound[bands >> 32]]
        if not len(kept):
            continue
        lines, shared = np.unique(window * (1 << 32) + diagonal, return_counts=True)
        for w in np.unique(kept >> 32):
            best, pattern, stride_w = None, index.codes[w], int(index.edits[w]) + 1
            own = (lines >> 32) == w
            exact = lines[own & (shared == len(pattern) - q + 1)]
            if len(exact):
                start = int(exact[0] & ((1 << 32) - 1)) - 2 * WINDOW
                best = (0, start, start + len(pattern))
            else:
                for k in kept[(kept >> 32) == w] & ((1 << 32) - 1):
                    low = int(k) * stride_w - 2 * WINDOW
                    met = align(pattern, part, low, low + 2 * stride_w - 1, int(index.edits[w]))
                    best = met if best is None or (met is not None and met < best) else best
            if best is not None:
                cost, start, end = best
                old = found.get(index.items[w])
                new = (cost, piece + start, piece + end)
                found[index.items[w]] = new if old is None else min(old, new)
    return [(item, start, end, cost) for item, (cost, start, end) in found.items()]


def item_blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters, dealt by a hash of the id."""
    size = benchmark.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    n = max(1, -(-size // block_chars))
    for k in range(n):
        block = benchmark.filter(F.pmod(F.xxhash64(item), F.lit(n)) == k).select(item, text)
        yield sorted(((r[0], r[1]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def _search(index: WindowIndex, kind: str):
    @F.pandas_udf(kind)
    def search(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: leaks_of(t, index), na_action=None)

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The input with ``leaks``: array of (item, start, end, edits), empty for a clean document."""
    kind = f"array<struct<item:{dict(benchmark.dtypes)[item]},start:int,end:int,edits:int>>"
    columns = []
    for block in item_blocks(benchmark, item, item_text, block_chars):
        columns.append(_search(WindowIndex.of(block), kind)(F.col(text)))
    done = docs.withColumn("_leaks", F.concat(*columns) if columns else F.array().cast(kind))
    return with_columns(done, {"leaks": F.col("_leaks")}).drop("_leaks")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item of the benchmark is found."""
    return find_leaks(docs, benchmark, **options).filter(F.size("leaks") == 0).select(*docs.columns)


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds a passage, with place and edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    rows = found.select("doc_id", F.inline("leaks"))
    return rows.select("doc_id", F.col("item").alias("item_id"), F.col("start").alias("start_char"), F.col("end").alias("end_char"), "edits")
