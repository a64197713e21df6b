"""Audits and statistics, each as one or two distributed passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.timeline import Axis, accumulate, checked_broadcast, null_safe_join, spread_join
from panelweave.session import pin, stored


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) with one row per cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(cells))


def summarise(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[Column], Column]], by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates of every column in one pass over the rows, one result row per column."""
    wide = df.groupBy(*by).agg(
        *[f(F.col(c).cast("double")).alias(f"{i}_{m}") for i, c in enumerate(columns) for m, f in measures.items()]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{m}").alias(m) for m in measures])
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(*by, F.inline(cells))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that have nulls, with how many; one pass for all columns."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_nulls")) for c in columns])
    return counts.select(F.inline(cells)).filter(F.col("n_nulls") > 0)


def attrition_report(df: DataFrame, key: str, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows and distinct keys that survive the first 1, 2, ... cleaning filters.

    Each row gets the number of filters it passes in sequence; counting per (key, depth)
    and adding up from the deepest gives all steps without an action per step.
    """
    # the deepest prefix that holds: count leading filters that are all true
    passed = [F.coalesce(condition, F.lit(False)).cast("int") for _, condition in steps]
    prefix, total = F.lit(1), F.lit(0)
    for p in passed:
        prefix = prefix * p
        total = total + prefix
    per_key = df.groupBy(F.col(key).alias("_key"), total.alias("_depth")).agg(F.count(F.lit(1)).alias("_n"))
    deepest = per_key.groupBy("_key").agg(
        F.max("_depth").alias("_deepest"),
        *[F.sum(F.when(F.col("_depth") >= i, F.col("_n"))).alias(f"_n{i}") for i in range(len(steps) + 1)],
    )
    names = ["start", *[name for name, _ in steps]]
    totals = deepest.agg(
        *[F.count_if(F.col("_deepest") >= i).alias(f"k{i}") for i in range(len(names))],
        *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(names))],
    )
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"k{i}").alias("n_keys"), F.col(f"r{i}").alias("n_rows"))
            for i, n in enumerate(names)
        ]
    )
    return totals.select(F.inline(cells))


def impute_group_mean(df: DataFrame, group: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Nulls replaced by the mean of the group, and the lookup table of means.

    The means come from an aggregation (partial sums before the shuffle) joined back,
    not from a window, so no task has to hold a whole group; frequent groups meet a
    broadcast of their means.
    """
    lookup = df.groupBy(group).agg(F.avg(column).alias("group_mean"))
    filled = spread_join(df, lookup, [group], null_safe=True).withColumn(column, F.coalesce(column, "group_mean"))
    return filled.select(*df.columns), lookup


# --- exact quantiles --------------------------------------------------------------

SKETCH = 1000  # accuracy of the sketch that brackets a quantile: rank error rows / SKETCH
ALL_VALUES_BELOW = 50 * SKETCH  # groups this small are bracketed by their minimum and maximum


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    *,
    base: DataFrame | None = None,
    measures: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per (by..., column), with further ``measures`` of the columns, in two scans.

    The first scan takes the measures and a mergeable sketch that brackets each quantile between
    two values with well under one percent of the rows between them. The second counts every value
    inside a bracket, and the rows between two brackets together, under the number of the bracket:
    the running sum over these few counts finds the exact ranks. So neither all values are sorted,
    nor does a popular value or a large group end up in one task, unlike with the built-in
    ``percentile``. ``base`` may be a frame that is cheaper to count and has at least as many rows
    as ``df``. Columns without values have measures and null quantiles if measures are asked for,
    else no row.
    """
    margin = 2.0 / SKETCH
    probabilities = [p for q in quantiles.values() for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    typed = df.select(*by, *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    taken = {"_n": F.count, "_min": F.min, "_max": F.max, "_s": lambda v: F.percentile_approx(v, probabilities, SKETCH), **(measures or {})}
    sketched = pin(typed.groupBy(*by).agg(*[f(F.col(f"_c{i}")).alias(f"{m}{i}") for i in range(len(columns)) for m, f in taken.items()]))
    base = df if base is None else base

    found = pin(_values_at(typed, sketched, columns, quantiles, by, base, False))
    if not found.filter("NOT _met").isEmpty():  # beyond the sketch's error bound: search all values instead
        found = _values_at(typed, sketched, columns, quantiles, by, base, True)
    found = found.drop("_met")
    if not measures:
        return found
    cells = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{m}{i}").alias(m) for m in measures]) for i, c in enumerate(columns)])
    return null_safe_join(sketched.select(*by, F.inline(cells)), found, [*by, "column"])


def _values_at(
    typed: DataFrame, sketched: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float], by: Sequence[str], base: DataFrame, whole_range: bool
) -> DataFrame:
    """(by..., column, a column per quantile, _met): ``_met`` is false where a rank lies outside its bracket."""
    names, places = list(quantiles), range(len(columns))
    all_of = lambda i: F.lit(True) if whole_range else F.col(f"_n{i}") <= ALL_VALUES_BELOW
    edge = lambda i, j, side: F.when(all_of(i), F.col(("_min", "_max")[side] + str(i))).otherwise(F.get(f"_s{i}", 2 * j + side))
    brackets = sketched.select(*by, *[edge(i, j, side).alias(f"{('_lo', '_hi')[side]}{i}_{j}") for i in places for j in range(len(names)) for side in (0, 1)])
    # without groups the brackets are exactly one row
    tagged = spread_join(typed, brackets, by, "inner", probe=base, null_safe=True) if by else typed.join(F.broadcast(brackets))

    def cell(i: int) -> Column:
        v, inside, passed = F.col(f"_c{i}"), F.lit(False), F.lit(0)
        for j in range(len(names)):
            inside = inside | v.between(F.col(f"_lo{i}_{j}"), F.col(f"_hi{i}_{j}"))
            passed = passed + (v > F.col(f"_hi{i}_{j}")).cast("int")
        return F.when(v.isNotNull(), F.struct(F.lit(i).alias("_i"), passed.alias("_bracket"), F.when(inside, v).alias("value"), v.alias("_v")))

    cells = tagged.select(*by, F.inline(F.array_compact(F.array(*[cell(i) for i in places]))))
    counts = cells.groupBy(*by, "_i", "_bracket", "value").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_at"))
    ranked = accumulate(counts, Axis.of([*by, "_i"], "_at"), {"upto": ("sum", "n")}, base).filter("value IS NOT NULL")

    sizes = sketched.select(*by, F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_n")) for i in places])))
    # one row per group and column: sent to the values where it is small, so that a group is no one task's work
    placed = null_safe_join(ranked, checked_broadcast(sizes), [*by, "_i"], "inner")
    first, end = F.col("upto") - F.col("n"), F.col("upto")
    at = lambda p: F.max(F.when((first <= p) & (p < end), F.col("value")))
    values, met = [], F.lit(True)
    for name in names:
        target = F.lit(float(quantiles[name])) * (F.col("_n") - 1)
        low, high = at(F.floor(target)), at(F.ceil(target))
        values.append((low + (high - low) * F.max(target - F.floor(target))).alias(name))
        met = met & low.isNotNull() & high.isNotNull()
    named = F.get(F.array(*[F.lit(c) for c in columns]), F.col("_i")).alias("column")
    return placed.groupBy(*by, "_i").agg(*values, met.alias("_met")).select(*by, named, *names, "_met")


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, base=None) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    found = exact_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by, base=base, measures=measures)
    return found.select(*by, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def group_outcome_stats(df: DataFrame, by: Sequence[str], value: str, *, base=None) -> DataFrame:
    """Mean, median, min and max of a value per outcome."""
    found = exact_quantiles(df, [value], {"median": 0.5}, by, base=base, measures={"mean": F.avg, "min": F.min, "max": F.max})
    return found.select(*by, "mean", "median", "min", "max")


def box_stats(df: DataFrame, by: str, value: str, *, base=None) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts per group."""
    q = exact_quantiles(df, [value], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], base=base).drop("column")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = q.withColumns({"_lo": F.col("q1") - reach, "_hi": F.col("q3") + reach})
    # value counts keep the second pass small: one row per distinct value and group
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    inside = F.col(value).between(F.col("_lo"), F.col("_hi"))
    return (
        null_safe_join(counts, checked_broadcast(pin(fences)), [by], "inner")
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("n_outliers"),
        )
    )


# --- correlation ------------------------------------------------------------------

FLAT = 1e-12  # a variance below this part of the mean square is rounding


def pair_sums(
    df: DataFrame, columns: Sequence[str], centre: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all column pairs, over the rows complete in both: n[i, j], sum of i, sum of squares of i, sum of products.

    One aggregate in one scan: each row becomes the vector (known, value, square) of its columns,
    with 0 for what is missing, and the products of these vectors are added up as one matrix. So a
    row is neither repeated per pair nor do the pairs become expressions. Values are shifted by a
    value of the column beforehand, which changes no variance and keeps digits; ``centre=False`` leaves
    that out, for values as wide as they are large. The result has the size of the columns squared and
    belongs to the driver. NaN counts as missing.
    """
    k = len(columns)
    cells = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns]
    peek = [0.0] * k
    if centre:
        peek = df.select(*[c.alias(f"_{i}") for i, c in enumerate(cells)]).limit(1000).agg(*[F.max(f"_{i}") for i in range(k)]).first()
    shifted = [c - F.lit(float(peek[i] or 0.0)) for i, c in enumerate(cells)]
    parts = [*[c.isNotNull().cast("double") for c in cells], *[F.coalesce(c, F.lit(0.0)) for c in shifted], *[F.coalesce(c * c, F.lit(0.0)) for c in shifted]]
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*parts)).alias("_v")), "_v")
    gram = RowMatrix(rows, numCols=3 * k).computeGramianMatrix().toArray()
    return gram[:k, :k], gram[k:2 * k, :k], gram[2 * k:, :k], gram[k:2 * k, k:2 * k]


def _coefficients(df: DataFrame, columns: Sequence[str], centre: bool = True) -> np.ndarray:
    """The correlation matrix; NaN where a column has no variation over the rows complete in both."""
    n, total, squares, products = pair_sums(df, columns, centre)
    with np.errstate(all="ignore"):
        variance = squares - total * total / n  # of column i over the rows that have j too
        variance = np.where(variance > FLAT * squares, variance, np.nan)
        return np.clip((products - total * total.T / n) / np.sqrt(variance * variance.T), -1.0, 1.0)


def _table(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]], centre: bool = True) -> DataFrame:
    r = _coefficients(df, columns, centre)
    rows = [(columns[i], columns[j], None if np.isnan(r[i, j]) else float(r[i, j])) for i, j in pairs]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, r double")


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All column pairs with their correlation over complete pairs."""
    return _table(df, columns, list(combinations(range(len(columns)), 2)))


def corr_pairs(df: DataFrame, columns: Sequence[str], above: float) -> DataFrame:
    """Each pair once, where the correlation exceeds the threshold."""
    return pearson(df, columns).filter(F.col("r") > above)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full square matrix in long form; a column without variation has no correlation, not even with itself."""
    n = range(len(columns))
    own = F.col("column_a") == F.col("column_b")
    return _table(df, columns, [(i, j) for i in n for j in n]).withColumn("r", F.when(own & F.col("r").isNotNull(), 1.0).otherwise(F.col("r")))


def _ranked_values(long: DataFrame, by: Sequence[str], base: DataFrame) -> DataFrame:
    """Distinct values per group with their count and the count up to and including them."""
    counts = long.filter(F.col("value").isNotNull()).groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    return accumulate(counts, Axis.of(by, "value"), {"upto": ("sum", "n")}, base)


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation with average ranks, over rows complete in all columns.

    The values of all columns are counted, and ranked by running sums within each column, stored once. A
    column whose ranks are few has them sent to the rows; only columns with many different values move the
    rows, one narrow shuffle each, and popular values of those meet a broadcast. Rows stay rows throughout.
    """
    row = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_v{i}") for i, c in enumerate(columns)]).dropna()
    row = stored(row, "complete")
    cells = row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"_v{i}").alias("value")) for i in range(len(columns))])))
    ranked = _ranked_values(cells, ["column"], cells)
    ranks = stored(ranked.select("column", "value", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank")), "ranks")
    for i, c in enumerate(columns):
        own = ranks.filter(F.col("column") == i).select(F.col("value").alias(f"_v{i}"), F.col("rank").alias(f"_r{i}"))
        few = checked_broadcast(own)
        row = (row.join(few, f"_v{i}") if few is not own else spread_join(row, own, [f"_v{i}"], "inner", probe=row)).drop(f"_v{i}")
    return _table(row.select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(columns)]), columns, list(combinations(range(len(columns)), 2)), centre=False)


# --- shape ------------------------------------------------------------------------


def skewness_buckets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and its class: low, not or high skewed, at -1 and 1."""
    moments = summarise(df, columns, {"n": F.count, "population": F.skewness})
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("population") * F.sqrt(n * (n - 1)) / (n - 2))
    s = F.col("skewness")
    name = F.when(s <= -1, "skewed_low").when(s >= 1, "skewed_high").when(s.isNotNull(), "not_skewed")
    return moments.select("column", skew.alias("skewness")).withColumn("bucket", name)


def normality_jb(df: DataFrame, columns: Sequence[str], critical: float = 10.597) -> DataFrame:
    """Jarque-Bera statistic per column; normal while below the chi-square(2) value.

    The default critical value is the 0.995 quantile (alpha = 0.005).
    """
    moments = summarise(df, columns, {"n": F.count, "_s": F.skewness, "_k": F.kurtosis})
    jb = F.col("n") / 6.0 * (F.col("_s") ** 2 + F.col("_k") ** 2 / 4.0)
    return moments.select("column", "n", jb.alias("jb")).withColumn("looks_normal", F.col("jb") < critical)


def winsor_bounds(train: DataFrame, columns: Sequence[str], deviations: float = 3.0) -> DataFrame:
    """One row with mean +- k sample standard deviations of every column."""
    low = [(F.avg(c) - deviations * F.stddev_samp(c)).alias(f"_lo_{c}") for c in columns]
    high = [(F.avg(c) + deviations * F.stddev_samp(c)).alias(f"_hi_{c}") for c in columns]
    return train.agg(*low, *high)


def winsorize(
    df: DataFrame, columns: Sequence[str], train: DataFrame | None = None, deviations: float = 3.0, passes: int = 1
) -> DataFrame:
    """Clamp to bounds learnt on ``train`` (default: the frame itself), ``passes`` times."""
    train = df if train is None else train
    for _ in range(passes):
        bounds = F.broadcast(winsor_bounds(train, columns, deviations))  # exactly one row

        def clamp(frame: DataFrame, bounds=bounds) -> DataFrame:
            wide = frame.join(bounds)
            new = {
                c: F.when(F.col(c) > F.col(f"_hi_{c}"), F.col(f"_hi_{c}"))
                .when(F.col(c) < F.col(f"_lo_{c}"), F.col(f"_lo_{c}"))
                .otherwise(F.col(c))
                for c in columns
            }
            return wide.withColumns(new).select(*frame.columns)

        df, train = clamp(df), clamp(train)
    return df


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 100) -> DataFrame:
    """Equal-width counts between each column's minimum and maximum; empty bins are left out."""
    long = to_long(df, columns).filter(F.col("value").isNotNull())
    ends = summarise(df, columns, {"lo": F.min, "hi": F.max})
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(bins - 1))
    # one row of ends per column name, a number fixed by the call
    return (
        long.join(F.broadcast(ends), "column")
        .groupBy("column", F.coalesce(index, F.lit(0)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distinct_profile(df: DataFrame, flag: str, columns: Sequence[str], below: int = 20) -> DataFrame:
    """Distinct values per flag and column, for the columns with fewer than ``below``."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    values = df.select(flag, F.inline(cells)).filter(F.col("value").isNotNull()).distinct()
    counted = values.groupBy(flag, "column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return counted.filter(F.col("n_distinct") < below)


def class_balance(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    shares = df.agg(*[F.avg(c).alias(c) for c in labels])
    cells = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("share_of_ones")) for c in labels])
    return shares.select(F.inline(cells))

