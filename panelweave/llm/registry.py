"""Queries of this package and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str], types: list[str]) -> DataFrame:
    """A frame of a few rows given in code, made of literals (no Python objects reach the executors)."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns; a column of the input that has such a name gives way, whatever its case."""
    taken = {n.lower() for n in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in new.items()])


def word_count(text: Column) -> Column:
    """Number of words (see WORD); null counts as 0. One pass over the text, JVM-side."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    first, last = F.element_at(pieces, 1), F.element_at(pieces, -1)
    blank_ends = (first == "").cast("int") + ((F.size(pieces) > 1) & (last == "")).cast("int")
    return (F.size(pieces) - blank_ends).cast("long")
