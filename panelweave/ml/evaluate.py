"""Evaluation tables for scored rows, each from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions.scalars import outcome_tag
from panelweave.operators.relational import members, share_of_total
from panelweave.operators.stats import group_outcome_stats
from panelweave.operators.timeline import Axis, accumulate, checked_broadcast, null_safe_join, rolling
from panelweave.session import pin

SWEEP = (0.55, 0.60, 0.65, 0.70, 0.75, 0.80)  # fixed values: decision thresholds


def _counts(label: str, pred: str) -> list[Column]:
    cell = lambda l, p: F.count_if((F.col(label) == l) & (F.col(pred) == p))
    return [cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")]


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_counts(label, pred))


def classification_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, accuracy and F1 of the positive class; 0 where undefined."""
    m = confusion_matrix(df, label, pred, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return m.select(
        *by,
        safe(tp, tp + fp).alias("precision"),
        safe(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _by_score(df: DataFrame, label: str, score: str, by: Sequence[str], probe=None) -> DataFrame:
    """Positives and negatives per distinct score, accumulated from the highest score down."""
    grouped = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    )
    axis = Axis.of([*by, "_all"], score)
    totals = {"cum_tp": ("sum", "_p"), "cum_fp": ("sum", "_n")}
    base = df if probe is None else probe
    return accumulate(grouped.withColumn("_all", F.lit(0)), axis, totals, base, "backward").drop("_all")


def roc_curve(df: DataFrame, label: str = "label", score: str = "proba", by: Sequence[str] = (), probe=None) -> DataFrame:
    """One point per distinct score: false and true positive rate at that threshold."""
    points = _by_score(df, label, score, by, probe)
    ends = points.groupBy(*by).agg(F.max("cum_tp").alias("_tp"), F.max("cum_fp").alias("_fp"))
    # one row per group: sent to the points where it is small, so that a group is no one task's work
    joined = null_safe_join(points, checked_broadcast(pin(ends)), list(by), "inner") if by else points.join(F.broadcast(ends))
    return joined.select(
        *by, F.col(score).alias("threshold"),
        F.try_divide(F.col("cum_fp").cast("double"), F.col("_fp").cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_tp").cast("double"), F.col("_tp").cast("double")).alias("tpr"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "proba", by: Sequence[str] = (), probe=None) -> DataFrame:
    """Exact area under the curve: share of (positive, negative) pairs ranked right, ties half.

    No pairs are formed: per distinct score the positives already passed are multiplied
    with the negatives at it. Null where one class is absent.
    """
    s = _by_score(df, label, score, by, probe)
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    right = n * (F.col("cum_tp") - p) + 0.5 * n * p
    return s.groupBy(*by).agg(F.try_divide(F.sum(right), F.sum(p) * F.sum(n)).alias("auc"))


def regression_errors(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    gap = F.col(actual) - F.col(pred)
    return df.groupBy(*by).agg(F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"))


def direction_accuracy(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Rows and percent by whether the sign was right; a zero on either side is wrong."""
    right = (F.col(actual) * F.col(pred) > 0).cast("int")
    known = df.filter(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    return share_of_total(known.withColumn("correct", right), ["correct"], F.lit(1), "n")


def threshold_sweep(
    df: DataFrame, actual_class: str, score: str = "proba", thresholds: Sequence[float] = SWEEP
) -> DataFrame:
    """Selected rows per threshold and true class, with the share of the class in percent."""
    hits = [F.count_if(F.col(score) >= t).alias(f"t{i}") for i, t in enumerate(thresholds)]
    per_class = df.groupBy(actual_class).agg(*hits)
    cells = F.array(
        *[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("n_selected")) for i, t in enumerate(thresholds)]
    )
    long = per_class.select(actual_class, F.inline(cells))
    total = long.groupBy("threshold").agg(F.sum("n_selected").alias("_all"))
    return long.join(total, "threshold").select(
        actual_class, "threshold", "n_selected",
        (100.0 * F.try_divide(F.col("n_selected"), F.col("_all"))).alias("share_percent"),
    )


def precision_vs_gain(df: DataFrame, actual_return: str, pred: str = "pred", gain: float = 0.1) -> DataFrame:
    """How the positive predictions divide between rows with and without any gain."""
    classed = df.filter(F.col(pred).isNotNull() & F.col(actual_return).isNotNull()).withColumn(
        "gained", (F.col(actual_return) >= gain).cast("int")
    )
    return share_of_total(classed, ["gained"], F.col(pred), "n_predicted")


def realised_returns(df: DataFrame, label: str, pred: str, value: str, base=None) -> DataFrame:
    """Return statistics by (true, predicted) outcome."""
    tagged = df.withColumn("outcome", outcome_tag(label, pred))
    return group_outcome_stats(tagged, ["outcome"], value, base=base)


def horizon_summary(df: DataFrame, label: str = "label", pred: str = "pred", score: str = "proba", horizon: str = "horizon") -> DataFrame:
    """Precision and AUC in percent, one row per horizon."""
    precision = classification_metrics(df, label, pred, [horizon]).select(
        horizon, F.bround(100.0 * F.col("precision"), 2).alias("precision_percent")
    )
    area = roc_auc(df, label, score, [horizon]).select(horizon, F.bround(100.0 * F.col("auc"), 2).alias("auc_percent"))
    return null_safe_join(precision, area, [horizon])


def regression_summary(df: DataFrame, actual: str, pred: str, horizon: str = "horizon") -> DataFrame:
    """Mean absolute error times 100 and share of right directions in percent, one row per horizon."""
    right = (F.col(actual) * F.col(pred) > 0).cast("double")
    known = df.filter(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    return known.groupBy(horizon).agg(
        F.bround(100.0 * F.avg(F.abs(F.col(actual) - F.col(pred))), 2).alias("mae_percent"), F.bround(100.0 * F.avg(right), 2).alias("direction_percent"))


def buy_signals(
    df: DataFrame, axis: Axis, *, price: str, score: str = "proba", threshold: float = 0.55, ahead: int = 22
) -> DataFrame:
    """All rows of the keys with at least one signal, the signal and the price ``ahead`` rows later."""
    flagged = df.withColumn("signal", (F.col(score) >= threshold).cast("int"))
    chosen = members(flagged, flagged.filter(F.col("signal") == 1), axis.keys)
    stage = lambda w: {"price_ahead": F.lead(price, ahead).over(w)}
    return rolling(chosen, axis, stage, after=ahead, probe=df)
