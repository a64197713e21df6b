"""As-of joins and date-shifted lookups.

An as-of join is a union of both sides followed by a fill along the series: one
shuffle on the keys, linear in the rows, no range join and no pairs. Long series
are cut up by ``timeline.fill``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators.timeline import LONG, UNKNOWN, Axis, fill, split_long_series, spread_join


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    right_time: str | None = None,
    direction: str = "backward",
    max_age_days: int | None = None,
    whole_row: bool = False,
    keep_time: str | None = None,
    tie: Sequence[str] = (),
    size: str = UNKNOWN,
) -> DataFrame:
    """Left rows with the newest known (or next) values of ``columns`` from the right.

    ``backward`` takes the last right row at or before the left time, ``forward`` the
    next one at or after it; an equal time matches in both. By default every column is
    filled on its own, so a null in the newest row is taken from an older one;
    ``whole_row=True`` takes all columns from one and the same row. ``keep_time``
    names a column for the matched right time. ``tie`` orders right rows of equal
    time. ``size`` says how long the
    series of both sides together are, where that is known.
    """
    right_time = right_time or time
    backward = direction == "backward"
    late, early = F.lit(1), F.lit(0)
    key_cols = [F.col(k) for k in keys]
    need_time = keep_time is not None or max_age_days is not None

    source = {c: f"_r_{c}" for c in columns}
    ties = {c: f"_tie_{c}" for c in tie}
    payload = (
        [F.struct(*[F.col(c) for c in columns], F.col(right_time).alias("_when")).alias("_row")]
        if whole_row
        else [F.col(c).alias(s) for c, s in source.items()]
        + ([F.col(right_time).alias("_when")] if need_time else [])
    )
    events = right.filter(F.col(right_time).isNotNull()).select(
        *key_cols,
        F.col(right_time).alias(time),
        *payload,
        *[F.col(c).alias(a) for c, a in ties.items()],
        (early if backward else late).alias("_side"),
        F.lit(False).alias("_is_left"),
    )
    rows = left.withColumns({"_side": late if backward else early, "_is_left": F.lit(True)})
    both = rows.unionByName(events, allowMissingColumns=True)

    axis = Axis.of(keys, [time, "_side", *ties.values()], size=size)
    carried = ["_row"] if whole_row else [*source.values(), *(["_when"] if need_time else [])]
    narrow = rows.select(*key_cols).unionByName(events.select(*key_cols))
    filled = fill(both, axis, carried, "forward" if backward else "backward", probe=narrow)
    matched = filled.filter("_is_left")

    value = (lambda c: F.col("_row").getField(c)) if whole_row else (lambda c: F.col(source[c]))
    when = F.col("_row").getField("_when") if whole_row else F.col("_when")
    if max_age_days is not None:
        first, second = (F.col(time), when) if backward else (when, F.col(time))
        fresh = F.datediff(first, second) <= max_age_days
        result = {c: F.when(fresh, value(c)) for c in columns}
        moment = F.when(fresh, when)
    else:
        result = {c: value(c) for c in columns}
        moment = when
    if keep_time is not None:
        result[keep_time] = moment
    return matched.select(*left.columns, *[v.alias(k) for k, v in result.items()])


@dataclass(frozen=True)
class Source:
    """A set of dated events to align with the panel.

    ``when='known'`` takes the latest event at or before the day; ``'later'`` takes the
    next event strictly after it (as for split factors). ``stamp`` names a column for
    the date of the matched event.
    """

    frame: DataFrame
    time: str
    columns: tuple[str, ...]
    when: str = "known"
    stamp: str | None = None


def align(
    left: DataFrame,
    sources: Sequence[Source],
    *,
    keys: Sequence[str],
    time: str,
    size: str = UNKNOWN,
    probe: DataFrame | None = None,
) -> DataFrame:
    """As-of join of any number of sources in one pass.

    All events are stacked with the left rows and filled along the series together, so
    the panel is shuffled once whatever the number of sources. Events sort before the
    left rows of their day. Every column is filled on its own.
    """
    both = left.withColumns({"_side": F.lit(1), "_is_left": F.lit(True)})
    narrow = left.select(*keys)
    known: list[str] = []
    later: list[str] = []
    for source in sources:
        stamp = [F.col(source.time).alias(source.stamp)] if source.stamp else []
        events = source.frame.filter(F.col(source.time).isNotNull()).select(
            *keys, F.col(source.time).alias(time), *source.columns, *stamp,
            F.lit(0).alias("_side"), F.lit(False).alias("_is_left"),
        )
        both = both.unionByName(events, allowMissingColumns=True)
        narrow = narrow.unionByName(events.select(*keys))
        target = known if source.when == "known" else later
        target += [*source.columns, *([source.stamp] if source.stamp else [])]
    axis = Axis.of(keys, [time, "_side"], size=size)
    narrow = narrow if probe is None else probe
    if later:
        both = fill(both, axis, later, "backward", probe=narrow)
    if known:
        both = fill(both, axis, known, "forward", probe=narrow)
    return both.filter("_is_left").drop("_side", "_is_left")


def offset_lookup(
    left: DataFrame,
    series: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    series_time: str,
    value: str,
    offsets: Sequence[int],
    prefix: str,
    default: float | None = None,
) -> DataFrame:
    """Values of a series at ``time`` minus each of several day offsets, in one join.

    The series (one row per key and day) is moved forward instead of the left rows
    being multiplied: each value is emitted at the dates that look back to it, the
    offsets are gathered per key and date, and one equi-join brings all of them. Where very
    many left rows have one key and date, they meet a broadcast of just that row.
    """
    shifted = series.select(
        *keys, F.col(value).alias("_v"), F.col(series_time).alias("_t"),
        F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_offset"),
    ).withColumn("_t", F.date_add("_t", F.col("_offset")))
    gathered = shifted.groupBy(*keys, "_t").agg(
        *[F.max(F.when(F.col("_offset") == o, F.col("_v"))).alias(f"{prefix}{o}") for o in offsets]
    )
    joined = spread_join(left.withColumn("_t", F.col(time)), gathered, [*keys, "_t"], "left").drop("_t")
    if default is not None:
        joined = joined.fillna(default, subset=[f"{prefix}{o}" for o in offsets])
    return joined


def value_days_ago(
    df: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    columns: Mapping[str, str],
    days: int,
    mode: str = "exact",
    size: str = UNKNOWN,
) -> DataFrame:
    """Value of each column ``days`` calendar days earlier.

    ``exact`` needs a row on that very day (equi-join on key and day); ``asof`` takes
    the last known value at or before it.
    """
    if mode == "exact":
        past = df.select(
            *keys, F.date_add(time, days).alias(time), *[F.col(s).alias(o) for s, o in columns.items()]
        )
        return df.join(past, [*keys, time], "left")
    axis = Axis.of(keys, time, size=size)
    short, long = split_long_series(df, axis)
    quoted = lambda names: ", ".join(f"`{c}`" for c in names)
    # a range of days on the date itself keeps the order that other windows of the series share; only SQL text can state it
    clock = f"`{time}`" if dict(df.dtypes)[time] == "date" else f"unix_date(CAST(`{time}` AS DATE))"
    span = f"PARTITION BY {quoted(keys)} ORDER BY {clock} RANGE BETWEEN UNBOUNDED PRECEDING AND {int(days)} PRECEDING"
    result = None
    if short is not None:
        result = short.withColumns({o: F.expr(f"last(`{s}`, true) OVER ({span})") for s, o in columns.items()})
    if long is None:
        return result
    past = long.select(*keys, F.date_add(time, days).alias("_past"), *[F.col(s).alias(o) for s, o in columns.items()])
    older = asof_join(
        long, past, keys=keys, time=time, right_time="_past", columns=list(columns.values()), size=LONG
    )
    return older if result is None else result.unionByName(older)
