"""Filters, de-duplication, membership, overrides and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.scalars import outside_bounds
from panelweave.operators.timeline import UNKNOWN, Axis, running, spread_join


def members(df: DataFrame, keys: DataFrame, on: Sequence[str], negate: bool = False) -> DataFrame:
    """Rows whose key is (or is not) in another frame."""
    return spread_join(df, keys.select(*on).distinct(), on, "left_anti" if negate else "left_semi")


def key_difference(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the left frame the right one does not have."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_anti")


def count_outside(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows out of any bound, rows kept, and the total, in one pass."""
    out = outside_bounds(bounds)
    return df.agg(
        F.count_if(out).alias("n_outside"), F.count_if(~out).alias("n_kept"), F.count(F.lit(1)).alias("n_rows")
    )


def within_bounds(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.filter(~outside_bounds(bounds))


def keep_first_per(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per group: the first in the order.

    Done as an aggregation of the smallest (order, row) struct, so partial results are
    merged before the shuffle and a hot group costs no more than a cold one.
    """
    rest = [c for c in df.columns if c not in group]
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    best = F.min_by(F.struct(*rest), F.struct(*sort))
    return df.groupBy(*group).agg(best.alias("_row")).select(
        *group, *[F.col("_row").getField(c).alias(c) for c in rest]
    ).select(*df.columns)


def dedup_statements(df: DataFrame, keys: Sequence[str], known_date: str, period: str) -> DataFrame:
    """Per known date keep the oldest period; rows without a known date go."""
    return keep_first_per(df.filter(F.col(known_date).isNotNull()), [*keys, known_date], [period])


def shift_repeated_dates(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], probe: DataFrame | None = None, size: str = UNKNOWN
) -> DataFrame:
    """Second and later rows of the same key and date move one day on."""
    counted = running(df, Axis.of([*keys, time], tie, size), {"_nth": ("count", F.lit(1))}, probe=probe)
    moved = F.when(F.col("_nth") > 1, F.date_add(F.col(time), 1)).otherwise(F.col(time))
    return counted.withColumn(time, F.when(F.col(time).isNotNull(), moved)).drop("_nth").select(*df.columns)


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in all columns."""
    return (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))
    )


def hash_split(df: DataFrame, identity: Sequence[str], test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds ``is_test``; the same row lands on the same side however it is partitioned."""
    text = F.concat_ws("-", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in identity])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("is_test", bucket < test_percent)


def override_for_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Set columns of the rows whose key is in ``keys``; other rows stay as they are."""
    marked = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = spread_join(df, marked, on)
    hit = F.col("_hit").isNotNull()
    return joined.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}
    ).drop("_hit").select(*df.columns)


def null_share_by_key(df: DataFrame, keys: Sequence[str], tested: str, counted: str) -> DataFrame:
    """Per key: rows with a null in ``tested``, all rows, and the share in percent."""
    present = F.col(counted).isNotNull()
    return (
        df.groupBy(*keys)
        .agg(
            F.count_if(F.col(tested).isNull() & present).alias("rows_with_nulls"),
            F.count_if(present).alias("rows_total"),
        )
        .withColumn(
            "null_percent",
            F.bround(100.0 * F.try_divide(F.col("rows_with_nulls"), F.col("rows_total")), 1),
        )
    )


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def share_of_total(df: DataFrame, by: Sequence[str], value: Column, out: str = "total") -> DataFrame:
    """Sum per group and its percentage of the overall sum."""
    grouped = df.groupBy(*by).agg(F.sum(value).alias(out))
    overall = grouped.agg(F.sum(out).alias("_all"))  # one row
    return grouped.join(F.broadcast(overall)).withColumn(
        "share_percent", 100.0 * F.try_divide(F.col(out), F.col("_all"))
    ).drop("_all")
