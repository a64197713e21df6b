"""Registry of runnable queries and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder; each is read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame


    def once(self, name: str, build: Callable[[], DataFrame], keep: Callable[[DataFrame], DataFrame] = pin) -> DataFrame:
        """A derived table that several consumers share: computed and stored once, by ``keep``."""
        if name not in self.__dict__:
            setattr(self, name, keep(build()))
        return self.__dict__[name]


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = build.__doc__
        run.__module__ = build.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = 4, only: tuple[str, ...] | None = None) -> DataFrame:
    """Doubles rounded, so that results of different engines can be compared."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles if only is None or c in only})


def day(name: str) -> Column:
    return F.col(name).cast("date")
