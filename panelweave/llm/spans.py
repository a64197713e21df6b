"""Spans of regular expressions as column expressions: where they are, merging, redacting.

Positions are code points, 0-based, end exclusive. Everything stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ONE = "struct<start:int,end:int,kind:string,text:string>"
SPAN = f"array<{ONE}>"
SLICE = 256


def none(kind: str = SPAN) -> Column:
    return F.array().cast(kind)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.transform(F.array(value), body)[0]


def slices(items: Column) -> Column:
    """The items (a value that is cheap to name, see ``bound``) in arrays of ``SLICE``."""
    places = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / SLICE).cast("int"))
    return F.when(F.size(items) > 0, F.transform(places, lambda k: F.slice(items, k * SLICE + 1, F.lit(SLICE)))).otherwise(F.array(F.slice(items, 1, 0)))


def scan(items: Column, start: Mapping[str, Column], step: Callable[[Column, Column], tuple[Mapping[str, Column], Column]], kind: str) -> Column:
    """One result of type ``kind`` per item, from a state that runs along the items.

    ``step`` takes (state, item) and gives the fields of the next state and the result. Results are
    gathered in slices of ``SLICE`` and then put together, as an array that grows by one is copied
    each time: so n items take about n * SLICE copies and no n * n.
    """
    several = f"array<{kind}>"

    def one(state: Column, item: Column) -> Column:
        following, result = step(state, item)
        return F.struct(*[following[k].alias(k) for k in start], F.concat(state["out"], F.array(result)).alias("out"))

    def slice_of(state: Column, part: Column) -> Column:
        begin = F.struct(*[state[k].alias(k) for k in start], F.array().cast(several).alias("out"))
        return bound(F.aggregate(part, begin, one), lambda done: F.struct(
            *[done[k].alias(k) for k in start], F.concat(state["out"], F.array(done["out"])).alias("out")))

    def whole(all_items: Column) -> Column:
        begin = F.struct(*[v.alias(k) for k, v in start.items()], F.array().cast(f"array<{several}>").alias("out"))
        return F.flatten(F.aggregate(slices(all_items), begin, slice_of, lambda s: s["out"]))

    return bound(items, whole)


def match_spans(text: Column, pattern: str, kind: str, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches, in order: array of (start, end, kind, text).

    ``regexp_extract_all`` gives the matches and ``split`` the text between them; their lengths
    add up to the positions. ``guard`` is a cheap condition without which nothing can match; the
    two scans are made only for texts in which there is a match.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.arrays_zip(between.alias("between"), found.alias("found"))

    def step(state: Column, piece: Column) -> tuple[dict, Column]:
        begin = state["at"] + F.length(piece["between"])
        end = begin + F.coalesce(F.length(piece["found"]), F.lit(0))
        return {"at": end}, F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), piece["found"].alias("text"))

    has = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    spans = F.filter(scan(pieces, {"at": F.lit(0)}, step, ONE), lambda s: s["text"].isNotNull())
    return F.when(has, spans).otherwise(none())


def joined(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).cast("int").alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, mark: str) -> Column:
    """The text with every character that a span covers replaced; touching spans share one mark."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def step(state: Column, span: Column) -> tuple[dict, Column]:
        apart = (span["start"] > state["at"]) | (state["at"] == 0)
        return {"at": F.greatest(state["at"], span["end"])}, F.struct(
            state["at"].alias("start"), F.greatest(span["start"], state["at"]).alias("end"), apart.alias("marked"))

    def cut(part: Column) -> Column:
        """The kept stretches of a slice, taken from its region: a place in a long text is found by walking to it."""
        first, size = part[0]["start"], F.element_at(part, -1)["end"] - part[0]["start"]
        return bound(F.substring(text, first + 1, size), lambda region: F.array_join(F.transform(part, lambda r: F.concat(
            F.substring(region, r["start"] - first + 1, r["end"] - r["start"]), F.when(r["marked"], F.lit(mark)).otherwise(F.lit("")))), ""))

    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    kept = scan(ordered, {"at": F.lit(0)}, step, "struct<start:int,end:int,marked:boolean>")
    done = F.concat(F.array_join(bound(kept, lambda ranges: F.transform(slices(ranges), cut)), ""), F.substring(text, last + 1, F.length(text)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
