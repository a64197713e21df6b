"""Time-series operators (calendar, fills, shifts, changes, labels)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.asof import value_days_ago
from panelweave.operators.timeline import FITS, Axis, fill, full_mean, relative_change, rolling, running

# Forward-return horizons in calendar days and the trading rows they span.
HORIZON_ROWS = {15: 11, 30: 22, 60: 44, 90: 66, 120: 88, 150: 110}


def calendar_spine(df: DataFrame, *, keys: Sequence[str], time: str, future_days: int = 0) -> DataFrame:
    """Every calendar day of every key, from its first day to its last plus ``future_days``.

    The output is one row per key and day by construction.
    """
    bounds = df.groupBy(*keys).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    days = F.sequence(F.col("_a").cast("date"), F.date_add(F.col("_b").cast("date"), future_days))
    return bounds.select(*keys, F.explode(days).alias(time))


def densify(
    events: DataFrame, *, keys: Sequence[str], time: str, columns: Sequence[str], direction: str = "forward"
) -> DataFrame:
    """Events with one row per key and day, spread over all days and filled."""
    spine = calendar_spine(events, keys=keys, time=time)
    joined = spine.join(events.select(*keys, time, *columns), [*keys, time], "left")
    return fill(joined, Axis.of(keys, time, size=FITS), columns, direction)


def shift_rows(df: DataFrame, axis: Axis, columns: Mapping[str, tuple[str, int]], probe=None) -> DataFrame:
    """``columns``: result -> (source, k); k > 0 looks k rows back, k < 0 ahead."""
    before = max([k for _, k in columns.values()] + [0])
    after = max([-k for _, k in columns.values()] + [0])
    stage = lambda w: {
        out: (F.lag(src, k) if k >= 0 else F.lead(src, -k)).over(w) for out, (src, k) in columns.items()
    }
    return rolling(df, axis, stage, before=before, after=after, probe=probe)


def pct_change(
    df: DataFrame,
    axis: Axis,
    columns: Mapping[str, tuple[str, int]],
    *,
    unit: str = "rows",
    pad: str | None = None,
    scale: float = 100.0,
    probe: DataFrame | None = None,
    known: Mapping[str, str] | None = None,
) -> DataFrame:
    """Percent change against the value k rows (or k calendar days) earlier.

    ``pad='past'`` first fills nulls from the past. With ``unit='days'`` the older value
    is the last one known k days ago. ``known`` may name, for a source that was filled from the past,
    the column it was filled from: the last one known is the same in both, and reading it there leaves the
    look back to the same window as the fill.
    """
    sources = sorted({src for src, _ in columns.values()})
    padded = {s: f"_pad_{s}" for s in sources}
    if pad == "past":
        df = fill(df, axis, padded, probe=probe)
    elif set(sources) & set(columns):  # a result takes the place of a source
        df = df.withColumns({p: F.col(s) for s, p in padded.items()})
    else:
        padded = {s: s for s in sources}
    spare = [p for s, p in padded.items() if p != s]
    if unit == "rows":
        stage = lambda w: {
            out: relative_change(F.col(padded[s]), F.lag(padded[s], k).over(w), scale)
            for out, (s, k) in columns.items()
        }
        df = rolling(df, axis, stage, before=max(k for _, k in columns.values()), probe=probe)
        return df.drop(*spare)
    looked_up = padded if pad == "past" else padded | {s: k for s, k in (known or {}).items() if s in padded}
    for k in sorted({k for _, k in columns.values()}):
        wanted = {out: s for out, (s, n) in columns.items() if n == k}
        old = {looked_up[s]: f"_old_{s}" for s in set(wanted.values())}
        df = value_days_ago(
            df, keys=axis.keys, time=axis.order[0], columns=old, days=k, mode="asof", size=axis.size
        )
        df = df.withColumns(
            {out: relative_change(F.col(padded[s]), F.col(f"_old_{s}"), scale) for out, s in wanted.items()}
        ).drop(*old.values())
    return df.drop(*spare)


def sma_trend(
    df: DataFrame,
    axis: Axis,
    value: str,
    lengths: Sequence[int],
    *,
    prefix: str | None = None,
    against: str = "value",
    scale: float = 1.0,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Simple moving averages with their one-step slope and their distance to the value.

    Per length n: ``<p>_sma<n>`` (full windows only), ``_vector`` (percent change to the
    row before) and ``_position`` = scale * (sma - value) / value. For two lengths also
    ``<p>_sma<a>_to_<b>``. ``against='sma_reversed'`` gives (value - sma) / value.
    """
    p = prefix or value
    v = F.col(value)
    sign = 1.0 if against == "value" else -1.0

    def means(w):
        return {f"{p}_sma{n}": full_mean(value, n, w) for n in lengths}

    def slopes(w):
        out: dict[str, Column] = {}
        for n in lengths:
            sma = F.col(f"{p}_sma{n}")
            out[f"{p}_sma{n}_vector"] = relative_change(sma, F.lag(sma, 1).over(w))
            out[f"{p}_sma{n}_position"] = F.lit(sign * scale) * F.try_divide(sma - v, v)
        if len(lengths) == 2:
            a, b = (F.col(f"{p}_sma{n}") for n in lengths)
            out[f"{p}_sma{lengths[0]}_to_{lengths[1]}"] = F.try_divide(a - b, b)
        return out

    return rolling(df, axis, means, slopes, before=max(lengths), probe=probe)


def days_since(df: DataFrame, axis: Axis, event: Column, *, out: str, time: str, probe=None) -> DataFrame:
    """Days since the last row for which ``event`` holds (0 on the row itself)."""
    marked = df.withColumn("_event_day", F.when(event, F.col(time).cast("date")))
    filled = fill(marked, axis, ["_event_day"], probe=probe)
    return filled.withColumn(out, F.datediff(F.col(time), F.col("_event_day"))).drop("_event_day")


def change_points(df: DataFrame, axis: Axis, value: str, probe: DataFrame | None = None) -> DataFrame:
    """Rows whose value differs from the row before within the key, with both deltas."""
    stage = lambda w: {"change": F.col(value) - F.lag(value, 1).over(w)}
    moved = rolling(df, axis, stage, before=1, probe=probe).filter(F.col("change") != 0)
    return rolling(
        moved, axis, lambda w: {"prev_change": F.lag("change", 1).over(w)}, before=1, probe=probe
    )


def carry_last_change(df: DataFrame, axis: Axis, value: str, *, out: str, after: Column | None = None, probe=None) -> DataFrame:
    """The latest non-zero step of the value, carried until the next one.

    ``after``: a step counts only from a row with a later time than that, as if earlier rows were not there.
    """
    time = axis.order[0]
    back = lambda w: {"_before": F.lag(value, 1).over(w), "_time_before": F.lag(time, 1).over(w)}
    stepped = rolling(df, axis, back, before=1, probe=probe)
    step = F.col(value) - F.col("_before")
    counts = step != 0 if after is None else (step != 0) & (F.col("_time_before") > after)
    marked = stepped.withColumn(out, F.when(counts, step)).drop("_before", "_time_before")
    return fill(marked, axis, [out], probe=probe)


def forward_returns(
    df: DataFrame,
    axis: Axis,
    horizons: Mapping[str, int],
    *,
    close: str = "close",
    base: str = "open",
    scale: float = 100.0,
    probe: DataFrame | None = None,
) -> DataFrame:
    """scale * (close h rows ahead / base - 1) for every horizon, in one window pass."""
    stage = lambda w: {
        out: relative_change(F.lead(close, h).over(w), F.col(base), scale) for out, h in horizons.items()
    }
    return rolling(df, axis, stage, after=max(horizons.values()), probe=probe)


def label_horizons() -> dict[str, int]:
    return {f"future_{days}dprice_change": rows for days, rows in HORIZON_ROWS.items()}


def cumulative_product(df: DataFrame, axis: Axis, value: str, *, out: str, newest_first: bool = True, probe=None):
    return running(df, axis, {out: ("product", value)}, "backward" if newest_first else "forward", probe)


def every_nth_row(df: DataFrame, axis: Axis, n: int, probe: DataFrame | None = None) -> DataFrame:
    """The newest row of each key and every n-th before it."""
    counted = running(df, axis, {"_rank": ("count", F.lit(1))}, "backward", probe)
    return counted.filter((F.col("_rank") - 1) % n == 0).drop("_rank")
