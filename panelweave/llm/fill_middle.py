r"""Fill-in-middle examples from texts that are stored as seekable compressed frames.

A text is a row of units (``[A-Za-z]+`` or any one other character). ``store_frames`` keeps it as
independent zstandard frames of about ``FRAME_BYTES`` bytes, each with the units, characters and
bytes that come before it. A place given in units is found by a search in these sums and one
decompressed frame; a stretch of the text is streamed frame by frame. So a transformation touches
the frames that hold its two cuts for the selection, and no text is ever whole in memory beside
the column that brought it.

``fill_in_middle`` cuts a text at two seeded unit places into prefix, middle and suffix and writes
the parts behind their marks: prefix, suffix, middle (psm) or suffix, prefix, middle (spm). The
result is stored as frames too. Texts that are empty or contain a mark stay plain, and so does a
seeded share. ``restore`` finds the marks in a transformed text and streams the original from it.

Seeds are the first four 8-digit groups of the SHA-256 of ``1:`` and the decimal key; a null key
counts as no digits. Rows are judged one by one: repeated rows and ties give equal rows, null text
is empty, an empty table gives an empty result. Input columns named like a new one give way. A
run of letters longer than a frame is one unit over many frames.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import query, table, with_columns

FRAME_BYTES = 1 << 16
MARKS = ("<P>", "<S>", "<M>")
_MARK = re.compile(b"<[PSM]>")
FRAMES = "struct<n_units: bigint, n_chars: bigint, n_bytes: bigint, frames: array<struct<units: bigint, chars: bigint, bytes: bigint, goes_on: boolean, data: binary>>>"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


def unit_starts(data: np.ndarray, goes_on: bool) -> np.ndarray:
    """For each byte whether a unit begins with it; ``goes_on``: the byte before is a letter."""
    letter = _LETTER[data]
    before = np.empty_like(letter)
    before[:1], before[1:] = goes_on, letter[:-1]
    return np.where(letter, ~before, (data & 0xC0) != 0x80)


@dataclass
class Frames:
    """Frames of one text. ``units``, ``chars``, ``bytes``: what comes before each frame, and at the end the sums."""

    units: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])
    bytes: list[int] = field(default_factory=lambda: [0])
    goes_on: list[bool] = field(default_factory=list)
    data: list[bytes] = field(default_factory=list)

    @classmethod
    def of(cls, pieces: Iterable[bytes], size: int = FRAME_BYTES) -> Frames:
        """Frames of about ``size`` bytes from a stream; a frame ends with a whole character."""
        out, pack, held, letter = cls(), zstandard.ZstdCompressor(level=1), b"", False
        for piece in pieces:
            piece, at = held + piece if held else piece, 0
            while len(piece) - at >= size + 4:
                cut = at + size
                while piece[cut] & 0xC0 == 0x80:
                    cut -= 1
                letter, at = out._add(piece[at:cut], letter, pack), cut
            held = piece[at:]
        if held:
            out._add(held, letter, pack)
        return out

    def _add(self, data: bytes, letter: bool, pack: zstandard.ZstdCompressor) -> bool:
        own = np.frombuffer(data, dtype=np.uint8)
        self.goes_on.append(letter)
        self.units.append(self.units[-1] + int(unit_starts(own, letter).sum()))
        self.chars.append(self.chars[-1] + int(((own & 0xC0) != 0x80).sum()))
        self.bytes.append(self.bytes[-1] + len(data))
        self.data.append(pack.compress(data))
        return bool(_LETTER[own[-1]])

    def frame(self, i: int) -> bytes:
        return zstandard.decompress(self.data[i])

    def place(self, unit: int) -> tuple[int, int]:
        """(characters, bytes) before a unit; all of the text for a unit behind the last. Decompresses one frame at most."""
        if unit >= self.units[-1]:
            return self.chars[-1], self.bytes[-1]
        i = int(np.searchsorted(self.units, unit, side="right")) - 1
        own = np.frombuffer(self.frame(i), dtype=np.uint8)
        at = int(np.flatnonzero(unit_starts(own, self.goes_on[i]))[unit - self.units[i]])
        return self.chars[i] + int(((own[:at] & 0xC0) != 0x80).sum()), self.bytes[i] + at

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The text from byte ``start`` to byte ``end``, frame by frame; other frames are left alone."""
        end = self.bytes[-1] if end is None else end
        if start >= end:
            return
        for i in range(int(np.searchsorted(self.bytes, start, side="right")) - 1, len(self.data)):
            at = self.bytes[i]
            if at >= end:
                break
            data = self.frame(i)
            yield data if at >= start and at + len(data) <= end else data[max(start - at, 0):end - at]

    def marks(self) -> Iterator[tuple[str, int]]:
        """Every mark with its first byte, in one pass that looks over the ends of frames."""
        held, at = b"", 0
        for data in self.stream():
            held = held + data if held else data
            for found in _MARK.finditer(held):
                yield found[0].decode(), at + found.start()
            at += max(len(held) - 2, 0)
            held = held[-2:]

    def row(self) -> tuple:
        parts = [dict(units=u, chars=c, bytes=b, goes_on=g, data=d) for u, c, b, g, d in zip(self.units, self.chars, self.bytes, self.goes_on, self.data)]
        return self.units[-1], self.chars[-1], self.bytes[-1], parts

    @classmethod
    def read(cls, n_units: int, n_chars: int, n_bytes: int, frames) -> Frames:
        take = lambda name: [f[name] for f in frames]
        return cls([*take("units"), n_units], [*take("chars"), n_chars], [*take("bytes"), n_bytes], take("goes_on"), take("data"))


NAMES = ["n_units", "n_chars", "n_bytes", "frames"]
MADE = ["form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]


def _frames_of(batch: pd.DataFrame) -> Iterator[Frames]:
    for row in batch[NAMES].itertuples(index=False):
        yield Frames.read(*row)


def store_frames(docs: DataFrame, text: str = "text", size: int = FRAME_BYTES) -> DataFrame:
    """The input with its text replaced by n_units, n_chars, n_bytes and frames."""

    @F.pandas_udf(FRAMES)
    def stored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([Frames.of([value.encode()] if value else [], size).row() for value in batch], columns=NAMES)

    found = docs.withColumn("_stored", stored(F.col(f"`{text}`"))).drop(text)
    return with_columns(found, {c: F.col(f"_stored.{c}") for c in NAMES}).drop("_stored")


def seeds(key: Column) -> list[Column]:
    """Four numbers from the key, each the value of eight hexadecimal digits."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(stored: DataFrame, key: str = "doc_id", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """The result of ``store_frames`` with form (plain, spm, psm), prefix_chars, middle_chars (null if plain), output, in frames, and two digests.

    ``output_sha256`` is that of the output, ``restored_sha256`` that of the text rebuilt from it, both streamed from the frames.
    """

    @F.pandas_udf(f"struct<form: string, prefix_chars: bigint, middle_chars: bigint, output: {FRAMES}, output_sha256: string, restored_sha256: string>")
    def transformed(batches: Iterator[tuple[pd.DataFrame, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for texts, chosen in batches:
            rows = []
            for text, h in zip(_frames_of(texts), chosen.itertuples(index=False)):
                form, chars, middle, out = "plain", None, None, text
                if text.data and h[2] % 100 < 100 - plain_percent and not next(text.marks(), None):
                    form = "spm" if h[3] % 100 < spm_percent else "psm"
                    cuts = sorted((h[0] % (text.units[-1] + 1), h[1] % (text.units[-1] + 1)))
                    (chars, first), (more, second) = map(text.place, cuts)
                    middle, out = more - chars, Frames.of(_written(form, text, first, second))
                rows.append((form, chars, middle, dict(zip(NAMES, out.row())), _sha256(out.stream()), _sha256(restored(form, out))))
            yield pd.DataFrame(rows, columns=MADE).astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    made = stored.withColumn("_made", transformed(F.struct(*NAMES), F.struct(*[h.alias(f"h{i}") for i, h in enumerate(seeds(F.col(f"`{key}`")), 1)])))
    return with_columns(made, {c: F.col(f"_made.{c}") for c in MADE}).drop("_made")


def _written(form: str, text: Frames, first: int, second: int) -> Iterator[bytes]:
    p, s, m = (mark.encode() for mark in MARKS)
    parts = [(p, 0, first), (s, second, None), (m, first, second)]
    if form == "spm":
        parts[:2] = parts[1::-1]
    for mark, start, end in parts:
        yield mark
        yield from text.stream(start, end)


def restored(form: str, output: Frames) -> Iterator[bytes]:
    """The original text, streamed from a transformed one. A mark ends its predecessor's part, as no text with marks is transformed."""
    if form == "plain":
        yield from output.stream()
        return
    at = dict(output.marks())
    p, s, m = (at[mark] for mark in MARKS)
    ends = {p: s, s: m, m: None} if form == "psm" else {s: p, p: m, m: None}
    for start in (p, m, s):
        yield from output.stream(start + len(MARKS[0]), ends[start])


def _sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
             ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op13_fill_middle", OP13_SQL)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-middle example, and of the text rebuilt from it."""
    made = fill_in_middle(store_frames(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
