"""Ordered work on many series at once, safe against very long series.

Every positional operation of the engine (lag, rolling mean, fill, running total,
row number) goes through the functions below. A series that fits one task is a
plain ``Window.partitionBy(keys)``: one shuffle, one sort. A series longer than
``spark.panelweave.maxGroupRows`` is cut up instead:

1. its rows are range-partitioned and sorted on (keys, order), which spreads the
   series over many tasks, and numbered exactly;
2. rows are grouped into chunks of equal length by that number;
3. windows with a bounded frame run per chunk, with the few neighbouring rows the
   frame can reach copied in; fills and running totals run per chunk and take
   over the state of the earlier chunks from a table of one row per chunk.

No row is dropped, sampled or approximated on either route.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelweave.session import broadcast_byte_limit, group_row_limit, pin

FIXED_TYPES = ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz")
PARTITION_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits

Stage = Callable[[WindowSpec], Mapping[str, Column]]


# How long the series of a frame are: to be found out, each fits one task, none does.
UNKNOWN, FITS, LONG = "unknown", "fits", "long"


@dataclass(frozen=True)
class Axis:
    """What separates the series (``keys``) and what orders their rows (``order``).

    ``size=FITS`` skips the search for long series. It is right after an aggregation to
    key and calendar day: such a series has at most one row per day of history. A plan of
    several steps finds the long series once and passes ``FITS`` or ``LONG`` on.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    size: str = UNKNOWN

    @classmethod
    def of(cls, keys: str | Sequence[str], order: str | Sequence[str], size: str = UNKNOWN) -> Axis:
        as_tuple = lambda v: (v,) if isinstance(v, str) else tuple(v)
        return cls(as_tuple(keys), as_tuple(order), size)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def up_to_row(self, forward: bool) -> WindowSpec:
        """All rows up to the current one, counted from the oldest or from the newest.

        Looking ahead is written as looking back in descending order: Spark extends a
        frame that grows at its end row by row, but recomputes one that shrinks at its
        start, which would be quadratic in the length of the series.
        """
        return _up_to_row(self.keys, self.order, forward)


def _up_to_row(keys: Sequence[str], order: Sequence[str], forward: bool) -> WindowSpec:
    sort = [F.asc(c) if forward else F.desc(c) for c in order]
    return Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def long_series_keys(df: DataFrame, keys: Sequence[str], probe: DataFrame | None = None) -> DataFrame | None:
    """Keys with more rows than one task may be handed, or None.

    ``probe`` may be any cheaper frame with the same keys and at least as many
    rows per key as ``df``, such as the base table ``df`` was aggregated from.
    There are at most rows/limit such keys.
    """
    limit = group_row_limit(df.sparkSession)
    probe = df if probe is None else probe
    if probe.count() <= limit:
        return None
    found = pin(probe.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys))
    return None if found.isEmpty() else found


def row_bytes(df: DataFrame) -> int:
    """Bytes of one row by its types: 8 for a number or date, and what Spark assumes for text and nested values."""
    return 8 + sum(f.dataType.jsonValue() in FIXED_TYPES and 8 or 64 for f in df.schema.fields)


def checked_broadcast(side: DataFrame) -> DataFrame:
    """Hint a broadcast only after counting the rows; otherwise leave the choice to Spark.

    The limit is in bytes: rows times the width by the types. Give it frames that are cheap to
    count (pinned, written, or a small base table).
    """
    return F.broadcast(side) if side.count() * row_bytes(side) <= broadcast_byte_limit(side.sparkSession) else side


def split_long_series(
    df: DataFrame, axis: Axis, probe: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Split into (rows of series that fit one task, rows of longer series); None for no such rows."""
    if axis.size == FITS:
        return df, None
    if axis.size == LONG:
        return None, df
    found = long_series_keys(df, axis.keys, probe)
    if found is None:
        return df, None
    return split_by_keys(df, found, axis.keys)


def split_by_keys(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not in ``found``, rows whose key is)."""
    side = checked_broadcast(found).select(*[F.col(k).alias(f"_long_{k}") for k in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_long_{k}")) for k in keys]
    return df.join(side, match, "left_anti"), df.join(side, match, "left_semi")


def spread_join(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", probe: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join with a side that has one row per key, where some keys may be very frequent in ``df``.

    Rows of the frequent keys meet a broadcast of just those keys' side rows; all other
    rows take the ordinary shuffle join. A null key counts as a key like any other when it
    is looked for, so many rows without a key do not meet in one task; it matches a null
    key of the side only if ``null_safe``. Supports left, inner, left_semi and left_anti.
    """
    on = list(on)
    joined = (lambda a, b, h: null_safe_join(a, b, on, h)) if null_safe else (lambda a, b, h: a.join(b, on, h))
    found = long_series_keys(df, on, probe)
    if found is None:
        return joined(df, side, how)
    keys = checked_broadcast(found)
    frequent_side = checked_broadcast(pin(null_safe_join(side, keys, on, "left_semi")))
    rest = joined(null_safe_join(df, keys, on, "left_anti"), side, how)
    frequent = joined(null_safe_join(df, keys, on, "left_semi"), frequent_side, how)
    return rest.unionByName(frequent)


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "_pos", keep: Callable[[DataFrame], DataFrame] = pin,
) -> DataFrame:
    """Exact 0-based position of every row in the total order, without one global task.

    Range partitioning gives each task a stretch of the order; the row numbers within
    the tasks become global by adding the sizes of the earlier tasks. The layout is
    kept because sizes and rows have to come from the same one, by a checkpoint unless ``keep``
    is another way to store it.
    """
    laid = keep(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    task = F.shiftright("_slot", PARTITION_BITS)
    within = F.col("_slot").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    sizes = laid.groupBy(task.alias("_task")).agg((F.max(within) + 1).alias("_size"))
    # one row per shuffle partition, so this window is small whatever the data size
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    if keep is not pin:  # stored to be read often
        starts = pin(starts)
    return (
        laid.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .withColumn(name, F.col("_start") + within)
        .drop("_task", "_slot", "_start")
    )


def _chunked(df: DataFrame, axis: Axis, reach: int) -> tuple[DataFrame, int]:
    size = max(group_row_limit(df.sparkSession), reach, 1)
    numbered = number_rows(df, [*axis.keys, *axis.order])
    return numbered.withColumn("_chunk", F.floor(F.col("_pos") / F.lit(size))), size


def _both(short: DataFrame | None, long: DataFrame) -> DataFrame:
    return long if short is None else short.unionByName(long)


def _staged(df: DataFrame, stages: Sequence[Stage], spec: WindowSpec) -> DataFrame:
    for stage in stages:
        df = df.withColumns(dict(stage(spec)))
    return df


def rolling(
    df: DataFrame,
    axis: Axis,
    *stages: Stage,
    before: int = 0,
    after: int = 0,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add columns computed over bounded frames of the series.

    Each stage is a function from a window (keys and order set) to named columns;
    later stages may use the columns of earlier ones. ``before`` and ``after`` are
    how many rows the stages reach back and ahead, added up over all stages.
    """
    short, long = split_long_series(df, axis, probe)
    result = None if short is None else _staged(short, stages, axis.window)
    if long is None:
        return result
    chunked, size = _chunked(long, axis, max(before, after))
    offset = F.col("_pos") % F.lit(size)
    places = F.array_compact(
        F.array(
            F.col("_chunk"),
            F.when(offset >= size - before, F.col("_chunk") + 1),
            F.when(offset < after, F.col("_chunk") - 1),
        )
    )
    spread = chunked.withColumn("_at", F.explode(places))
    spec = Window.partitionBy(*axis.keys, "_at").orderBy("_pos")
    pieces = _staged(spread, stages, spec).filter(F.col("_at") == F.col("_chunk"))
    return _both(result, pieces.drop("_at", "_chunk", "_pos"))


def fill(
    df: DataFrame,
    axis: Axis,
    columns: Mapping[str, str] | Sequence[str],
    direction: str = "forward",
    probe: DataFrame | None = None,
) -> DataFrame:
    """Carry the last known value forward (or the next one backward) within a series.

    ``columns`` maps source to result; a plain list fills in place.
    """
    targets = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    forward = direction == "forward"

    def filled(spec: WindowSpec) -> dict[str, Column]:
        return {out: F.last(src, ignorenulls=True).over(spec) for src, out in targets.items()}

    short, long = split_long_series(df, axis, probe)
    result = None if short is None else short.withColumns(filled(axis.up_to_row(forward)))
    if long is None:
        return result

    chunked, _ = _chunked(long, axis, 0)
    group = [*axis.keys, "_chunk"]
    edge = F.max_by if forward else F.min_by
    carried = {src: f"_carry_{i}" for i, src in enumerate(targets)}
    ends = chunked.groupBy(*group).agg(
        *[edge(F.col(s), F.when(F.col(s).isNotNull(), F.col("_pos"))).alias(c) for s, c in carried.items()]
    )
    earlier = _up_to_row(axis.keys, ["_chunk"], forward).rowsBetween(Window.unboundedPreceding, -1)
    state = {c: F.last(c, ignorenulls=True).over(earlier) for c in carried.values()}
    inner = chunked.withColumns(filled(_up_to_row(group, ["_pos"], forward)))
    joined = null_safe_join(inner, ends.select(*group, *[v.alias(k) for k, v in state.items()]), group)
    done = joined.withColumns({out: F.coalesce(out, carried[src]) for src, out in targets.items()})
    return _both(result, done.drop("_chunk", "_pos", *carried.values()))


def running(
    df: DataFrame,
    axis: Axis,
    totals: Mapping[str, tuple[str, str | Column]],
    direction: str = "forward",
    probe: DataFrame | None = None,
) -> DataFrame:
    """Running ``sum``, ``product`` or ``count`` up to and including each row.

    ``totals`` maps the result name to (kind, input column). ``direction='backward'``
    runs from the newest row to the oldest.
    """
    forward = direction == "forward"
    how = {"sum": F.sum, "product": F.product, "count": F.count}
    named = {out: (kind, F.col(c) if isinstance(c, str) else c) for out, (kind, c) in totals.items()}

    def run(spec: WindowSpec) -> dict[str, Column]:
        return {out: how[kind](c).over(spec) for out, (kind, c) in named.items()}

    short, long = split_long_series(df, axis, probe)
    result = None if short is None else short.withColumns(run(axis.up_to_row(forward)))
    if long is None:
        return result

    chunked, _ = _chunked(long, axis, 0)
    group = [*axis.keys, "_chunk"]
    parts = chunked.groupBy(*group).agg(*[how[k](c).alias(f"_part_{o}") for o, (k, c) in named.items()])
    earlier = _up_to_row(axis.keys, ["_chunk"], forward).rowsBetween(Window.unboundedPreceding, -1)
    combine = {"sum": F.sum, "product": F.product, "count": F.sum}
    state = parts.select(
        *group, *[combine[k](f"_part_{o}").over(earlier).alias(f"_state_{o}") for o, (k, _) in named.items()]
    )
    inner = chunked.withColumns(run(_up_to_row(group, ["_pos"], forward)))
    joined = null_safe_join(inner, state, group)

    def merged(out: str, kind: str) -> Column:
        own, earlier = F.col(out), F.col(f"_state_{out}")
        both = own * earlier if kind == "product" else own + earlier
        return F.coalesce(both, own, earlier)

    done = joined.withColumns({out: merged(out, kind) for out, (kind, _) in named.items()})
    return _both(result, done.drop("_chunk", "_pos", *[f"_state_{o}" for o in named]))


def accumulate(
    grouped: DataFrame,
    axis: Axis,
    totals: Mapping[str, tuple[str, str | Column]],
    base: DataFrame,
    direction: str = "forward",
) -> DataFrame:
    """``running`` over an aggregated frame whose size is only known to be at most ``base``'s.

    A small base settles it; otherwise the aggregate is checkpointed once, so that
    measuring it and using it do not both compute it.
    """
    if base.count() <= group_row_limit(base.sparkSession):
        return running(grouped, replace(axis, size=FITS), totals, direction)
    return running(pin(grouped), axis, totals, direction)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join by equal columns where null equals null; the columns of the left side stay."""
    renamed = right.select(
        *[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns]
    )
    match = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    joined = left.join(renamed, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{c}" for c in on])


def full_mean(value: str, rows: int, spec: WindowSpec) -> Column:
    """Mean of the last ``rows`` values; null until all of them exist and are known."""
    frame = spec.rowsBetween(-(rows - 1), Window.currentRow)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def relative_change(new: Column, old: Column, scale: float = 100.0) -> Column:
    return F.lit(scale) * (F.try_divide(new, old) - F.lit(1.0))
