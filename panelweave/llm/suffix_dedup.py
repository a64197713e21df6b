"""Removal of repeated byte strings with suffix arrays built by induced sorting.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller key. One suffix array over everything cannot be split among machines, so strings are
first brought to where their copies are:

1. Exact copies are found by a hash of the text; all but the smallest go as a whole.
2. Every string is named by the least hash among the ``GRAM``-byte pieces inside it, which is
   the same for equal strings. Neighbouring strings mostly have one name; such a run of strings
   is a context. Names that occur in one document only are dropped here: nothing there repeats.
   Of equal contexts in one batch of documents only those of the smallest key travel on.
3. The contexts of names in few documents, as measured by what a shard holds, are dealt to shards by name. A shard
   builds the suffix array of its distinct contexts by induced sorting and the permuted common
   prefixes; suffixes that share ``LENGTH`` bytes with their neighbours are one string, and all
   but those of the smallest document are cut.
4. Names in more documents (a passage found everywhere) would make a shard as large as the
   corpus. Their contexts are dealt by content: equal contexts meet in one shard, which keeps those
   of the smallest key, and sends their strings, each with its smallest key there, on to where
   equal strings meet. The result is the same; nothing is capped.
5. Cuts come together per document, which is where its text is.

Null text is empty. A null key counts as the largest. Rows with one key never cut each other, so
repeated rows are treated alike. An empty table gives an empty result; extra columns are not used.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import query, table
from panelweave.llm.shingles import _BYTE, _INVERSE, _STEP, mix, powers
from panelweave.llm.suffix_array import common_prefixes, suffix_array
from panelweave.operators.timeline import checked_broadcast
from panelweave.session import pin, scratch_path

LENGTH = 50
GRAM = 16
FREQUENT = 128  # documents with a name up to which a shard takes all its contexts in any case
MOST = 1 << 14  # and the same where a shard is so large that this is a small part of it
PIECE = 1 << 20  # strings named together
DOCUMENTS = 2048  # documents whose names travel together
SEPARATOR = 0xFF  # is in no UTF-8 text
LAST = (1 << 63) - 1
BROADCAST_BYTES = 100 << 20


@dataclass(frozen=True)
class Contexts:
    """Runs of strings with one name: text they are in, name, first string, number of strings, marks.

    A string reaches at least (length - GRAM) / 2 bytes to the left or to the right of its piece.
    The marks hold a byte for what is there on either side; two contexts with a string in common
    agree in one of them, or one has ``UNKNOWN``.
    """

    owner: np.ndarray
    name: np.ndarray
    first: np.ndarray
    strings: np.ndarray
    marks: np.ndarray


LEFT, RIGHT, UNKNOWN = 16, 17, 18  # bits that say which side is known


def contexts(texts: Sequence[bytes], length: int = LENGTH, marked: bool = True) -> Contexts:
    """The contexts of some texts. Texts are laid together, long ones in overlapping pieces, to be worked on in numpy."""
    found, held, size = [], [], 0
    for owner, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            held.append((owner, at, text[at:at + PIECE + length - 1]))
            size += len(held[-1][2])
            if size > PIECE:
                found.append(_contexts(held, length, marked))
                held, size = [], 0
    if held:
        found.append(_contexts(held, length, marked))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return Contexts(none, none.astype(np.uint64), none, none, none)
    return Contexts(*(np.concatenate(x) for x in zip(*found)))


def _contexts(parts: list[tuple[int, int, bytes]], length: int, marked: bool) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    begins = np.cumsum(sizes) - sizes
    n, width = len(data), length - GRAM + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_STEP, n)[:n], out=sums[1:])
    inverse = powers(_INVERSE, n + 1)
    least = hashes = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1])
    strings, span = n - length + 1, 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    least = np.minimum(least[:strings], least[width - span:width - span + strings])
    change = np.concatenate(([True], least[1:] != least[:-1]))
    inside = np.ones(strings, dtype=bool)  # strings over a border between texts do not count
    for end in (begins + sizes)[:-1]:
        inside[max(end - length + 1, 0):end] = False
    change[1:] |= inside[1:] != inside[:-1]
    change[begins[begins < strings]] = True
    first = np.flatnonzero(change)
    ends = np.append(first[1:], strings) - 1
    kept = inside[first]
    first, ends = first[kept], ends[kept]
    names = least[first]
    part = np.searchsorted(begins, first, side="right") - 1
    owner, base = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    marks = _marks(hashes, names, first, ends, width, sums, inverse, begins[part], (begins + sizes)[part], (length - GRAM) // 2) if marked else first
    return owner[part], names, first - begins[part] + base[part], ends - first + 1, marks


def _marks(hashes, names, first, ends, width: int, sums, inverse, begin, end, reach: int) -> np.ndarray:
    # the piece that names a run: the last to come into its first string, the first of its last string, or else searched
    piece = np.where(hashes[first + width - 1] == names, first + width - 1, np.where(hashes[ends] == names, ends, -1))
    open_ = np.flatnonzero(piece < 0)
    for k in range(width):
        here = hashes[first[open_] + k] == names[open_]
        piece[open_[here]] = first[open_[here]] + k
        open_ = open_[~here]
    # a piece that is found again within a string leaves open which one is meant
    short, again = hashes.astype(np.uint16), np.zeros(len(hashes), dtype=bool)
    for d in range(1, min(width + 1, len(hashes))):  # at width itself neighbouring strings of a run may hold one copy each
        same = short[d:] == short[:-d]
        again[d:] |= same
        again[:-d] |= same

    def byte(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (mix((sums[b] - sums[a]) * inverse[a]) >> np.uint64(56)).astype(np.int64)

    marks = np.zeros(len(names), dtype=np.int64)
    a = np.flatnonzero(piece - reach >= begin)
    marks[a] |= byte(piece[a] - reach, piece[a]) << 8 | 1 << LEFT
    a = np.flatnonzero(piece + GRAM + reach <= end)
    marks[a] |= byte(piece[a] + GRAM, piece[a] + GRAM + reach) | 1 << RIGHT
    marks[again[piece] | (ends - first >= width)] = 1 << UNKNOWN
    return marks


def short_names(names: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket and 32 bits; two names that fall together only meet in one shard."""
    return ((names >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64) << 32 | (names & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _of_several(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a value occurs with more than one key."""
    order = np.lexsort((keys, values))
    v, k = values[order], keys[order]
    first = np.ones(len(v), dtype=bool)
    first[1:] = v[1:] != v[:-1]
    run = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    several = k[start] != k[np.append(start[1:], len(v)) - 1] if len(v) else first
    out = np.empty(len(v), dtype=bool)
    out[order] = several[run]
    return out


def repeated_names(texts: DataFrame, buckets: int, frequent: int | None) -> DataFrame:
    """(key, name, frequent) of every name that several keys have. ``texts``: key, text.

    Names travel packed: a row holds those of one bucket of many documents.
    """

    def named(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), DOCUMENTS):
                part = frame.iloc[at:at + DOCUMENTS]
                own = contexts([(t or "").encode("utf-8", "surrogatepass") for t in part["text"]])
                keys, names, marks = part["key"].to_numpy(dtype=np.int64)[own.owner], short_names(own.name, buckets), own.marks
                order = np.argsort(names >> 32, kind="stable")
                bucket = names[order] >> 32
                used, first = np.unique(bucket, return_index=True)
                if not len(used):
                    continue
                low = (names[order] & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                yield pd.DataFrame({"bucket": used.astype(np.int32), "names": np.split(low, first[1:]),
                                    "keys": np.split(keys[order], first[1:]),
                                    "marks": np.split(marks[order].astype(np.int32), first[1:])})

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        names, keys, marks = (np.concatenate(frame[c].to_list()) for c in ("names", "keys", "marks"))
        wide = names.astype(np.int64) << 9
        met = (marks >> UNKNOWN).astype(bool)
        for known, shift in ((LEFT, 8), (RIGHT, 0)):  # agreement to the left, to the right
            mark = np.where((marks >> known) & 1, (marks >> shift) & 255, 256)
            met |= _of_several(wide + mark, keys) & (mark < 256)
        odd = np.unique(names[(marks >> UNKNOWN).astype(bool)])
        met |= np.isin(names, odd)  # next to an unknown piece nothing is ruled out
        names, keys = names[met], keys[met]
        order = np.lexsort((keys, names))
        names, keys = names[order], keys[order]
        fresh = np.ones(len(names), dtype=bool)
        fresh[1:] = (names[1:] != names[:-1]) | (keys[1:] != keys[:-1])
        names, keys = names[fresh], keys[fresh]
        _, number, counts = np.unique(names, return_inverse=True, return_counts=True)
        several = counts[number] > 1
        limit = frequent
        if limit is None:  # up to a quarter of what a shard holds under rare names
            limit = max(FREQUENT, min(int(np.sum(several & (counts[number] <= FREQUENT))) // 4, MOST))
        bucket = np.int64(frame["bucket"].iloc[0]) << 32
        return pd.DataFrame({"key": keys[several], "name": bucket | names[several].view(np.uint32).astype(np.int64),
                             "frequent": counts[number][several] > limit})

    packed = texts.mapInPandas(named, "bucket int, names array<int>, keys array<long>, marks array<int>")
    return packed.groupBy("bucket").applyInPandas(compared, "key long, name long, frequent boolean")


def _objects(pieces: Sequence[bytes]) -> np.ndarray:
    out = np.empty(len(pieces), dtype=object)
    out[:] = pieces
    return out


def _least(number: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    out = np.full(size, LAST, dtype=np.int64)
    np.minimum.at(out, number, keys)
    return out


def _split(by: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """A row for each value of ``by``, with the columns' values as arrays."""
    order = np.argsort(by, kind="stable")
    used, first = np.unique(by[order], return_index=True)
    if not len(used):
        return pd.DataFrame(columns=["shard", *columns], dtype=object)
    return pd.DataFrame({"shard": used, **{c: np.split(v[order], first[1:]) for c, v in columns.items()}})


DEALT, HOT, CUT = 0, 1, 2  # what a packed row holds: contexts for a shard, with frequent names, or ranges that are cut
PACKED = "shard int, kind int, names array<int>, keys array<long>, prints array<long>, firsts array<int>, sizes array<int>, data binary"


def repeated_contexts(texts: DataFrame, names: DataFrame, buckets: int) -> DataFrame:
    """The contexts with those names, packed by shard (see ``PACKED``). ``texts``: key, print, text.

    Of equal contexts in one batch of documents those of the smallest key travel; the others are cut there and then.
    """
    picked = names.groupBy(F.col("key").alias("_key")).agg(
        F.collect_list("name").alias("names"), F.collect_list(F.when(F.col("frequent"), F.col("name"))).alias("hot"))
    found = texts.join(picked, F.col("key") == F.col("_key")).select("key", "print", "text", "names", "hot")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), DOCUMENTS):
                yield packed_contexts(frame.iloc[at:at + DOCUMENTS], buckets)

    return found.mapInPandas(cut, PACKED)


def packed_contexts(part: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """``PACKED`` rows of some documents. ``part``: key, print, text, names and those of them that are frequent."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in part["text"]]
    own = contexts(data, marked=False)
    short = short_names(own.name, buckets)
    wanted = np.concatenate([np.asarray(n, dtype=np.int64) for n in part["names"]])
    wanted_by = np.repeat(np.arange(len(part)), [len(n) for n in part["names"]])
    used = np.unique(wanted)
    place = np.minimum(np.searchsorted(used, short), len(used) - 1)
    pairs = own.owner * len(used) + place
    chosen = np.flatnonzero((used[place] == short) & np.isin(pairs, wanted_by * len(used) + np.searchsorted(used, wanted)))
    owner, first, sizes, short = own.owner[chosen], own.first[chosen], own.strings[chosen] + LENGTH - 1, short[chosen]
    pieces = _objects([data[d][a:a + n] for d, a, n in zip(owner.tolist(), first.tolist(), sizes.tolist())])
    number, distinct = pd.factorize(pieces)
    keys, prints = part["key"].to_numpy(dtype=np.int64)[owner], part["print"].to_numpy(dtype=np.int64)[owner]
    hot = np.isin(short, np.concatenate([np.asarray(n, dtype=np.int64) for n in part["hot"]]))
    deal = np.where(hot, np.array([zlib.crc32(c) % buckets for c in distinct], dtype=np.int64)[number], short >> 32)
    lost = _least(number, keys, len(distinct))[number] < keys
    kind = np.where(lost, CUT, np.where(hot, HOT, DEALT))
    deal = np.where(lost, keys % buckets, deal)
    rows = []
    for k in (DEALT, HOT, CUT):
        at = np.flatnonzero(kind == k)
        low = (short[at] & 0xFFFFFFFF).astype(np.uint32).view(np.int32) if k == DEALT else np.zeros(len(at), dtype=np.int32)
        out = _split(deal[at], names=low, keys=keys[at], prints=prints[at], firsts=first[at], sizes=sizes[at], data=pieces[at])
        out["data"] = [b"" if k == CUT else b"".join(d) for d in out["data"]]
        out.insert(1, "kind", k)
        rows.append(out)
    return pd.concat(rows, ignore_index=True)


def shard_cuts(names: np.ndarray, pieces: np.ndarray, keys: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts: whether a smaller key has the same one; and for the others the strings that a smaller key
    has too, as two arrays: number of the context, place of the string in it."""
    number, distinct = pd.factorize(pieces)
    least = _least(number, keys, len(distinct))
    whole = least[number] < keys
    nothing = np.empty(0, dtype=np.int64)
    name_of = np.empty(len(distinct), dtype=np.int64)
    name_of[number] = names
    _, group, counts = np.unique(name_of, return_inverse=True, return_counts=True)
    several = np.flatnonzero(counts[group] > 1)  # a context alone under its name meets no other
    if not len(several):
        return whole, nothing, nothing
    mark = bytes([SEPARATOR])
    text = np.frombuffer(mark.join(distinct[several]) + mark, dtype=np.uint8)
    sizes = np.array([len(c) + 1 for c in distinct[several]])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(several)), sizes)
    left = np.repeat(begins + sizes - 1, sizes) - np.arange(len(text))
    suffixes = suffix_array(text)
    shared = common_prefixes(text, suffixes, left)[suffixes]
    run = np.cumsum(shared < length)  # suffixes of one run begin with one string
    least_of = least[several][owner[suffixes]]
    valid = left[suffixes] >= length
    smallest = _least(run[valid], least_of[valid], int(run[-1]) + 1)
    lost = np.sort(suffixes[valid & (smallest[run] < least_of)])
    holders = np.flatnonzero(~whole)
    holders = holders[np.argsort(number[holders], kind="stable")]
    of = several[owner[lost]]
    begin = np.searchsorted(number[holders], of, side="left")
    times = np.searchsorted(number[holders], of, side="right") - begin  # a key may hold a context more than once
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return whole, holders[np.repeat(begin, times) + step], np.repeat(lost - begins[owner[lost]], times)


def string_cuts(one: np.ndarray, two: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a smaller key has the same string, given as 128 bits."""
    order = np.lexsort((keys, two, one))
    o, t, k = one[order], two[order], keys[order]
    head = np.ones(len(o), dtype=bool)
    head[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(o), dtype=bool)
    out[order] = k[np.maximum.accumulate(np.where(head, np.arange(len(o)), 0))] < k
    return out


def merge_cuts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = np.concatenate([p[0] for p in parts]).astype(np.int64), np.concatenate([p[1] for p in parts]).astype(np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    if not len(starts):
        return starts, ends
    gap = np.flatnonzero(starts[1:] > ends[:-1])
    return starts[np.append(0, gap + 1)], ends[np.append(gap, len(ends) - 1)]


CUTS = "key long, print long, starts array<int>, ends array<int>"
STRINGS = "shard int, one array<long>, two array<long>, keys array<long>, prints array<long>, places array<int>"


def cuts_by_document(keys: np.ndarray, prints: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """``CUTS`` rows: the ranges of each key and print, those that touch as one."""
    if not len(keys):
        return pd.DataFrame(columns=["key", "print", "starts", "ends"], dtype=object)
    order = np.lexsort((starts, prints, keys))
    k, p = keys[order], prints[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])))
    offset = np.cumsum(new).astype(np.int64) << 32  # documents one behind the other on one axis
    begin, end = starts[order] + offset, np.maximum.accumulate(ends[order] + offset)
    head = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    tail = np.append(head[1:], len(k)) - 1
    first = np.flatnonzero(new[head])
    starts, ends = (begin[head] - offset[head]).astype(np.int32), (end[tail] - offset[tail]).astype(np.int32)
    return pd.DataFrame({"key": k[head][first], "print": p[head][first],
                         "starts": np.split(starts, first[1:]), "ends": np.split(ends, first[1:])})


def solve_shard(frame: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Cuts among the contexts of a shard. The strings of those with frequent names that no smaller key has here go on."""
    cuts, onward = [], pd.DataFrame(columns=["shard", "one", "two", "keys", "prints", "places"])
    for kind, part in frame.groupby("kind"):
        names, keys, prints, firsts, sizes = (np.concatenate(part[c].to_list()).astype(np.int64) for c in ("names", "keys", "prints", "firsts", "sizes"))
        if kind == CUT:
            cuts.append((keys, prints, firsts, firsts + sizes))
            continue
        data, ends = b"".join(part["data"]), np.cumsum(sizes)
        pieces = _objects([data[b - n:b] for b, n in zip(ends.tolist(), sizes.tolist())])
        if kind == DEALT:
            whole, row, place = shard_cuts(names, pieces, keys)
        else:
            number, distinct = pd.factorize(pieces)
            whole = _least(number, keys, len(distinct))[number] < keys
            held = np.flatnonzero(~whole)
            times = sizes[held] - LENGTH + 1
            row = np.repeat(held, times)
            place = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            digests = b"".join(hashlib.blake2b(c[i:i + LENGTH], digest_size=16).digest() for c in pieces[held] for i in range(len(c) - LENGTH + 1))
            one, two = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2).T
            lost = string_cuts(one, two, keys[row])
            on = row[~lost]
            onward = _split(one[~lost] % buckets, one=one[~lost], two=two[~lost], keys=keys[on], prints=prints[on], places=place[~lost] + firsts[on])
            row, place = row[lost], place[lost]
        cuts.append((keys[whole], prints[whole], firsts[whole], (firsts + sizes)[whole]))
        cuts.append((keys[row], prints[row], firsts[row] + place, firsts[row] + place + LENGTH))
    done = cuts_by_document(*(np.concatenate(c) for c in zip(*cuts)))
    rows = [(*r, *[None] * 6) for r in done.itertuples(index=False)] + [(*[None] * 4, *r) for r in onward.itertuples(index=False)]
    return pd.DataFrame(rows, columns=[*done.columns, *onward.columns], dtype=object)  # as floats, numbers beside nulls would lose digits


def shards(found: DataFrame, folder: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(cuts, strings of contexts with frequent names), written to the folder and read again."""
    done = found.groupBy("shard").applyInPandas(lambda frame: solve_shard(frame, buckets), f"{CUTS}, {STRINGS}")
    done.write.mode("overwrite").parquet(folder)
    stored = found.sparkSession.read.schema(done.schema).parquet(folder)
    return (stored.filter("shard IS NULL").select("key", "print", "starts", "ends"),
            stored.filter("shard IS NOT NULL").select("shard", "one", "two", "keys", "prints", "places"))


def frequent_cuts(strings: DataFrame) -> DataFrame:
    """Cuts of the strings that no key of their shard had smaller. A string comes once from each shard at most for each
    smallest key's place, however many documents have it."""

    def lost(frame: pd.DataFrame) -> pd.DataFrame:
        one, two, keys, prints, places = (np.concatenate(frame[c].to_list()).astype(np.int64) for c in ("one", "two", "keys", "prints", "places"))
        cut = string_cuts(one, two, keys)
        return cuts_by_document(keys[cut], prints[cut], places[cut], places[cut] + LENGTH)

    return strings.groupBy("shard").applyInPandas(lost, CUTS)


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", frequent: int | None = None) -> DataFrame:
    """What to cut: key (null as the largest number), print of the text, whole (an exact copy), starts, ends in bytes."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("key"), F.xxhash64(body).alias("print"), body.alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    # a second hash keeps different texts with one print apart
    seen = pin(texts.select("key", "print", F.md5("text").alias("digest"), F.octet_length("text").alias("bytes")))
    smallest = pin(seen.groupBy("print", "digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most"))
    rows = seen.join(smallest, ["print", "digest"])  # rows of texts that several keys have
    copies = pin(rows.filter("least < key").select("key", "print", "bytes").distinct())

    mark = copies.select(F.col("key").alias("_key"), F.col("print").alias("_print"))
    single = texts.join(checked_broadcast(mark), (F.col("key") == F.col("_key")) & (F.col("print") == F.col("_print")), "left_anti")
    names = pin(repeated_names(single.select("key", "text"), buckets, frequent))
    keys = names.select(F.col("key").alias("_named")).distinct()
    named = single.join(checked_broadcast(pin(keys)), F.col("key") == F.col("_named"), "left_semi")  # texts without a name stay where they are
    found = repeated_contexts(named, names, buckets)
    cuts, strings = shards(found, scratch_path(spark, "contexts"), buckets)

    @F.pandas_udf("starts array<int>, ends array<int>")
    def merged(starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = [merge_cuts([(np.asarray(s), np.asarray(e))]) for s, e in zip(starts, ends)]
        return pd.DataFrame(rows, columns=["starts", "ends"])

    together = cuts.unionByName(frequent_cuts(strings)).groupBy("key", "print").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    partly = together.select("key", "print", F.lit(False).alias("whole"), merged("starts", "ends").alias("m")).select("key", "print", "whole", "m.*")
    none = F.array().cast("array<int>")
    whole = copies.filter(F.col("bytes") >= LENGTH).select("key", "print", F.lit(True).alias("whole"), none.alias("starts"), none.alias("ends"))
    return pin(partly.unionByName(whole))


def _cut(text: str | None, whole: bool | None, starts, ends) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, runs removed)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if whole:
        return b"", len(data), 1
    if starts is None:
        return data, 0, 0
    kept, at = [], 0
    for a, b in zip(starts, ends):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    left = b"".join(kept)
    return left, len(data) - len(left), len(starts)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", frequent: int | None = None) -> DataFrame:
    """The input with ``kept`` (bytes left), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    cuts = repeated_spans(docs, text, key, frequent).select(F.col("key").alias("_key"), F.col("print").alias("_print"), "whole", "starts", "ends")
    size = cuts.agg(F.coalesce(F.sum(8 * F.size("starts") + 32), F.lit(0))).first()[0]
    side = F.broadcast(cuts) if size <= BROADCAST_BYTES else cuts  # larger tables are joined by a shuffle
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    met = (F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)) == F.col("_key")) & (F.xxhash64(body) == F.col("_print"))

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pd.Series, whole: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, w, s, e) for t, w, s, e in zip(texts, whole, starts, ends)], columns=["kept", "n_removed", "n_spans"])

    done = docs.join(side, met, "left").withColumn("_cut", cut(F.col(text), F.coalesce("whole", F.lit(False)), "starts", "ends"))
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("kept", "n_bytes", "n_removed", "n_spans")]
    return done.select(*own, F.octet_length(body).cast("long").alias("n_bytes"), "_cut.*")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and runs removed from every document, and a digest of what is left."""
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
