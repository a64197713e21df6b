"""Exact token counts at every prefix of a text, by dynamic programming over the prefixes.

The tokenizer is a byte-level BPE with word ends: a text is normalised, cut in pieces, and each
piece is merged for itself. Byte pair merging has a local property: a sequence of tokens is the
encoding of its text if and only if each two neighbours are the encoding of theirs. So the encoding
of a prefix of i units ends in exactly one token t that may follow the last token of the prefix of
i - len(t) units, and

    count(i) = count(i - len(t)) + 1

fills a table of all prefixes in one walk, each step looking back no further than the longest token.
A prefix of a text ends a word where it is cut, so the walk keeps two entries for each place: the
last token inside a word, and the one that carries the word's end.

A text is cut at ASCII white space, which no token crosses; the table of a chunk (mostly a word) is
kept and used again wherever the chunk occurs. The result is one signed byte for each byte of the
text, the change of the count; bytes inside a character are marked, since no prefix ends there.
Where a text is not in normal form, a prefix ends behind a whole combining sequence. The counts
answer questions of budget and truncation without the tokenizer or the text: ``tokens_in``,
``fitting_bytes``, ``truncate``.

Special tokens written out in a text count as one token, which is the library's default; the
prefixes that end inside one count it as the ordinary text that it is until then.

Null text is empty: no bytes, no tokens. Texts of any length take time in proportion to it, also
without any white space. Rows are judged one by one, so ties, repeated rows and null keys need no
rule; an empty table gives an empty result. Input columns named like a new one give way. What a
task keeps is bounded: twice ``KEPT`` chunks of up to ``SHORT`` bytes and as many pieces, ``PAIRS`` pairs of tokens, and the words of one stretch of texts.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import query, table, with_columns

KEPT = 1 << 18  # of chunks, and of their pieces, the last KEPT to 2 * KEPT used are known
PAIRS = 1 << 18
SHORT = 64
STRETCH = 1 << 23  # bytes of texts whose words are counted together
NEVER = 1 << 60
END = "\u0100"
INSIDE = -128  # no prefix ends behind this byte
INDEX = "struct<n_bytes: bigint, n_tokens: bigint, prefix_tokens: binary, fitting_bytes: bigint>"
#: The contractions of the tokenizer's pattern whose first two characters are two pieces.
SPLIT_CONTRACTIONS = ("'re", "'ve", "'ll")

_SOLID = np.ones(256, dtype=bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
#: ASCII and the accented letters whose lower case is one letter of the same length in bytes.
_COMMON = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017e]+")
#: Byte-level vocabularies write a byte as a printable character: itself where it is one, else the next free one from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {c: b for b, c in zip([b for b in range(256) if b not in _PRINTED], range(256, 512))}


class PrefixCounter:
    """Counts of one vocabulary, given as the text of its file in the format of the tokenizers library.

    Inside, a unit is a byte, written as the character of that number; END is put behind a token that ends a word.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"]:
            raise ValueError("a BPE vocabulary with word ends is needed")
        library = Tokenizer.from_str(vocabulary)
        self.normalise, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        suffix = model["end_of_word_suffix"]
        own = lambda t: (t[:-len(suffix)].translate(_BYTE_OF) + END) if t.endswith(suffix) else t.translate(_BYTE_OF)
        self.tokens = {own(t) for t in model["vocab"]}
        self.ranks = {tuple(map(own, m.split(" ") if isinstance(m, str) else m)): i for i, m in enumerate(model["merges"])}
        self.longest = max(map(len, self.tokens))
        if self.longest > 120:
            raise ValueError("a token is longer than a signed byte can count")
        stems = {t.removesuffix(END) for t in self.tokens}
        self.suffixes = {t[i:] for t in stems for i in range(len(t))}
        self.known = Filled(lambda stem: (self.tree(stem) is not None, self.tree(stem + END) is not None))  # no more than suffixes
        self.trees: dict[str, tuple | None] = {}  # and twice as many
        self.inside = Filled(lambda pair: self._border_holds(self.trees[pair[0]], self.trees[pair[1]]), PAIRS)
        self.ending = Filled(lambda pair: self._border_holds(self.trees[pair[0]], self.trees[pair[1] + END]), PAIRS)
        self.new: dict[bytes, bytes] = {}  # chunk -> its changes
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}  # piece of a chunk -> its changes
        self.old_parts: dict[str, bytes] = {}

    def merged(self, units: list[str]) -> list[tuple]:
        """The tokens that units merge to, the lowest rank first, from the left: (token, its right spine, its left spine, in order).

        A spine lists the parts at that edge from the unit up to the token, each with the rank of the merge that
        takes it in. ``in order`` says that ranks never fell on the way. For a few units only.
        """
        parts = [(u, [], [], True, -1) for u in units]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a[0], b[0]), NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            (a, _, left, fine, x), (b, right, _, good, y) = parts[at:at + 2]
            parts[at:at + 2] = [(a + b, [*right, (b, rank)], [*left, (a, rank)], fine and good and rank >= max(x, y), rank)]
        return [(t, [*right, (t, NEVER)], [*left, (t, NEVER)], fine) for t, right, left, fine, _ in parts]

    def tree(self, token: str) -> tuple | None:
        """The token as its own units merge to it; None if they don't."""
        if token not in self.trees:
            made = self.merged(_units(token)) if token in self.tokens else ()
            self.trees[token] = made[0] if len(made) == 1 else None
        return self.trees[token]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether two neighbours stay as they are when their text is merged."""
        return self._border_holds(self.tree(left), self.tree(right))

    def _border_holds(self, left: tuple, right: tuple) -> bool:
        """Whether no merge over the border comes before the merges that complete the two sides.

        As both sides grow in order of rank, the border is at each time between two parts of their spines.
        """
        if not (left[3] and right[3]):
            return [t[0] for t in self.merged(_units(left[0]) + _units(right[0]))] == [left[0], right[0]]
        ranks, ends, starts, i, j = self.ranks, left[1], right[2], 0, 0
        while True:
            (a, grows), (b, also) = ends[i], starts[j]
            over = ranks.get((a, b), NEVER)
            if over < grows and over <= also and over < NEVER:
                return False
            if grows == also == NEVER:
                return True
            if grows <= also:
                i += 1
            else:
                j += 1

    def word(self, piece: str) -> list[int]:
        """Token counts of the first 0, 1, 2, ... units of a piece, each taken as a whole word."""
        return [s[2] for s in self._walk(piece, [("", 0, 0)])]

    def words(self, pieces: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """``word`` for many pieces. In sorted order, words that begin alike follow each other and go on from the same states."""
        states, before = [("", 0, 0)], ""
        for piece in sorted(pieces):
            if not piece.startswith(before):
                same = 0
                for x, y in zip(piece, before):
                    if x != y:
                        break
                    same += 1
                del states[same + 1:]
            self._walk(piece, states)
            before = piece
            yield piece, [s[2] for s in states]

    def _walk(self, piece: str, states: list[tuple]) -> list[tuple]:
        """Adds the states of the beginnings that are not there yet: (last token inside a word, tokens inside a word, tokens if the word ends here)."""
        suffixes, known, inside, ending, longest = self.suffixes, self.known, self.inside, self.ending, self.longest
        for i in range(len(states), len(piece) + 1):
            at, found = i - 1, []
            token = piece[at:i]
            while token in suffixes:
                found.append(token)
                at -= 1
                if at < 0 or i - at > longest:
                    break
                token = piece[at:i]
            last, count, ended = "", 0, 0
            at = i - len(found)
            for token in reversed(found):
                plain, whole = known[token]
                if plain and not last:
                    before = states[at]
                    if not at or inside[before[0], token]:
                        last, count = token, before[1] + 1
                        if ended:
                            break
                if whole and not ended:
                    before = states[at]
                    if not at or ending[before[0], token]:
                        ended = before[1] + 1
                        if last:
                            break
                at += 1
            states.append((last, count, ended))
        return states

    def plain(self, text: str) -> list[int]:
        """Token counts of the first 1, 2, ... characters of a text without special tokens; INSIDE where no prefix ends."""
        groups = _normal_groups(text)
        normal = self.normalise(text)
        ends = np.cumsum([len(self.normalise(g)) for g in groups])
        if "".join(map(self.normalise, groups)) != normal:
            groups, ends = [text], np.array([len(normal)])
        at = np.zeros(len(normal) + 1, dtype=np.int64)  # count of the normalised text's prefixes
        done, before = 0, 0
        for piece, (first, end) in self.pieces(normal):
            at[done + 1:first + 1] = before
            counts, letters = self.word(piece.translate(_BYTE_OF)), normal[first:end]
            if letters in SPLIT_CONTRACTIONS:
                counts[2] = counts[1] + self.word(letters[1])[1]
            byte = np.cumsum([len(c.encode()) for c in letters])
            at[first + 1:end + 1] = before + np.array(counts)[byte]
            done, before = end, before + counts[-1]
        at[done + 1:] = before
        out = []
        for group, end in zip(groups, ends):
            out += [INSIDE] * (len(group) - 1) + [int(at[end])]
        return out

    def changes(self, chunk: str) -> bytes:
        """One signed byte for each byte of a chunk: by how much the count changes with it."""
        counts: list[int] = []
        rest, before = chunk, 0
        while rest:
            found = min(((i, s) for s in self.specials if (i := rest.find(s)) >= 0), key=lambda x: x[0], default=None)
            plain = rest if found is None else rest[:found[0]]
            counts += [c if c == INSIDE else before + c for c in self.plain(plain)] if plain else []
            whole = self.plain(plain)[-1] if plain else 0
            if found is None:
                break
            special = found[1]
            counts += [before + self.plain(plain + special[:j])[-1] for j in range(1, len(special))]
            before += whole + 1
            counts.append(before)
            rest = rest[found[0] + len(special):]
        out, now = bytearray(), 0
        for c, n in zip(chunk, counts):
            out += b"\x80" * (len(c.encode()) - 1)
            if n == INSIDE:
                out += b"\x80"
            else:
                out.append((n - now) & 255)
                now = n
        return bytes(out)

    def _common(self, chunks: list[str]) -> Iterator[bytes]:
        """The same for chunks of characters that the normal form and lower case keep in place and length."""
        pieces = [[low] if low.isalpha() else _PIECES.findall(low) for low in map(str.lower, chunks)]
        made, units = {}, {}
        for letters in {letters for parts in pieces for letters in parts}:
            known = self.parts.get(letters) or self.old_parts.get(letters)
            if known is None:
                units[letters.encode().decode("latin-1")] = letters
            else:
                made[letters] = known
        made.update((units[piece], self._changes_of(units[piece], piece, counts)) for piece, counts in self.words(units))
        self.parts.update(made)
        for parts in pieces:
            yield made[parts[0]] if len(parts) == 1 else b"".join([made[letters] for letters in parts])

    def _changes_of(self, letters: str, units: str, counts: list[int]) -> bytes:
        if letters in SPLIT_CONTRACTIONS:
            counts[2] = counts[1] + self.word(letters[1])[1]
        if len(units) == len(letters):
            return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
        out, now = bytearray(), 0
        for n, following in zip(counts[1:], units[1:] + "a"):
            if "\x80" <= following < "\xc0":
                out.append(128)
            else:
                out.append((n - now) & 255)
                now = n
        return bytes(out)

    def prefix_changes(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """For each text one signed byte for each of its bytes; white space changes nothing."""
        if len(self.new) >= KEPT:  # what is not used again is forgotten
            self.new, self.old = {}, self.new
        if len(self.parts) >= KEPT:
            self.parts, self.old_parts = {}, self.parts
        new, split = self.new, [text.split() for text in texts]
        missing = set().union(*(filterfalse(new.__contains__, chunks) for chunks in split))
        todo = []
        for chunk in missing:
            known = self.old.get(chunk)
            if known is None:
                todo.append((chunk, chunk.decode()))
            else:
                new[chunk] = known
        common = [(chunk, text) for chunk, text in todo if len(chunk) <= SHORT and _COMMON.fullmatch(text) and "<|" not in text]
        new.update(zip([chunk for chunk, _ in common], self._common([text for _, text in common])))
        for chunk, text in todo:
            if chunk not in new:
                new[chunk] = self.changes(text)
        for text, chunks in zip(texts, split):
            out = np.zeros(len(text), dtype=np.int8)
            out[_SOLID[np.frombuffer(text, dtype=np.uint8)]] = np.frombuffer(b"".join(map(new.__getitem__, chunks)), dtype=np.int8)
            yield out
        for chunk, _ in todo:
            if len(chunk) > SHORT:
                del new[chunk]


class Filled(dict):
    """A dictionary that makes a missing value by a function, and begins anew at ``most`` keys."""

    def __init__(self, make, most: int = 0):
        self.make, self.most = make, most

    def __missing__(self, key):
        if self.most and len(self) >= self.most:
            self.clear()
        self[key] = value = self.make(key)
        return value


def _units(token: str) -> list[str]:
    return [*token[:-2], token[-2:]] if token.endswith(END) else list(token)


def _normal_groups(text: str) -> list[str]:
    """The text in the least groups that can be brought to normal form one by one."""
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return list(text)
    groups: list[str] = []
    for c in text:
        joins = groups and (unicodedata.combining(c) or unicodedata.normalize("NFC", groups[-1][-1] + c) != unicodedata.normalize("NFC", groups[-1][-1]) + unicodedata.normalize("NFC", c)
                            or len(groups[-1]) > 1 and unicodedata.normalize("NFC", groups[-1] + c) != unicodedata.normalize("NFC", groups[-1]) + unicodedata.normalize("NFC", c))
        if joins:
            groups[-1] += c
        else:
            groups.append(c)
    return groups


def _stretches(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """The texts in groups of about ``STRETCH`` bytes: enough for words to share their beginnings, few enough to hold all words."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= STRETCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def prefix_index(docs: DataFrame, vocabulary: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """The input with n_bytes (UTF-8), n_tokens and prefix_tokens: the count at every prefix, as a compressed column of changes.

    With a ``limit`` also fitting_bytes, which ``fitting_bytes`` gives later for any other limit. ``vocabulary``
    is the text of a vocabulary file; it is broadcast, and has the file's size.
    """
    held = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary})

    @F.pandas_udf(INDEX)
    def indexed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        store = held.value  # one for all tasks of a worker, so its tables are used again
        if "counter" not in store:
            gc.collect()  # the counter of an earlier query refers to itself, so nothing else frees it
            store["counter"] = PrefixCounter(store["vocabulary"])
        counter, pack = store["counter"], zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for texts in _stretches(value.encode() if value else b"" for value in batch):
                for text, changes in zip(texts, counter.prefix_changes(texts)):
                    ends, counts = _counts(changes)
                    fits = 0 if limit is None else int(ends[np.flatnonzero(counts <= limit)[-1]])
                    rows.append((len(text), int(counts[-1]), pack.compress(changes.tobytes()), fits))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "prefix_tokens", "fitting_bytes"])

    found = docs.withColumn("_index", indexed(F.col(f"`{text}`")))
    new = {c: F.col(f"_index.{c}") for c in ("n_bytes", "n_tokens", "prefix_tokens", "fitting_bytes") if c != "fitting_bytes" or limit is not None}
    return with_columns(found, new).drop("_index")


def _counts(changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of prefixes in bytes, the empty one first; their token counts)."""
    ends = np.flatnonzero(changes != INSIDE)
    return np.append(0, ends + 1), np.append(0, np.cumsum(changes[ends], dtype=np.int64))


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _counts(np.frombuffer(zstandard.decompress(packed), dtype=np.int8))


def tokens_in(prefix_tokens: Column, n_bytes: Column) -> Column:
    """Tokens of the prefix of ``n_bytes`` bytes (of the longest whole prefix within it); null stays null."""

    @F.pandas_udf("long")
    def counted(packed: pd.Series, upto: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(packed, upto):
            if p is None or pd.isna(n):
                out.append(None)
                continue
            ends, counts = _unpacked(p)
            out.append(int(counts[np.searchsorted(ends, max(n, 0), side="right") - 1]))
        return pd.Series(out, dtype="Int64")

    return counted(prefix_tokens, n_bytes)


def fitting_bytes(prefix_tokens: Column, limit: int) -> Column:
    """Bytes of the longest prefix with at most ``limit`` tokens. Counts can fall with a character more, so all prefixes are looked at."""

    @F.pandas_udf("long")
    def fitting(packed: pd.Series) -> pd.Series:
        out = []
        for p in packed:
            if p is None:
                out.append(None)
                continue
            ends, counts = _unpacked(p)
            out.append(int(ends[np.flatnonzero(counts <= limit)[-1]]))
        return pd.Series(out, dtype="Int64")

    return fitting(prefix_tokens)


def truncate(indexed: DataFrame, limit: int, text: str = "text") -> DataFrame:
    """The result of ``prefix_index`` with every text cut to its longest prefix of at most ``limit`` tokens."""
    cut = F.decode(F.substring(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(1), fitting_bytes(F.col("prefix_tokens"), limit).cast("int")), "UTF-8")
    return indexed.withColumn(text, F.when(F.col("n_tokens") > limit, cut).otherwise(F.col(f"`{text}`")))


LIMIT = 2048


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and the bytes of its longest prefix within the limit."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    counted = prefix_index(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, limit=LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fitting_bytes")
