"""Column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _c(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- coercion -------------------------------------------------------------------


def to_number(value: ColumnLike) -> Column:
    """Double, or null where the text is no finite number."""
    return blank_non_finite(F.trim(_c(value).cast("string")).try_cast("double"))


def to_day(value: ColumnLike) -> Column:
    """Date, or null where the text is no date."""
    return _c(value).try_cast("date")


def to_int_days(value: ColumnLike) -> Column:
    """Whole days from text such as ``12``, ``12.0`` or ``12 days 00:00:00``."""
    text = F.regexp_replace(_c(value).cast("string"), r"\s*days?.*$", "")
    return text.try_cast("double").cast("int")


def split_ratio(value: ColumnLike) -> Column:
    """``from/to`` of a split text ``"to/from"``: ``"4/1"`` gives 0.25."""
    halves = F.split(_c(value), "/")
    return F.try_divide(to_number(F.get(halves, 1)), to_number(F.get(halves, 0)))


def normalise_symbol(value: ColumnLike) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(value), r"^\s+|\s+$", ""), r"\.", "-")


def strip_day_suffix(value: ColumnLike) -> Column:
    return F.regexp_replace(_c(value), r" days 00:00:00$", "")


def outcome_tag(actual: ColumnLike, predicted: ColumnLike) -> Column:
    return F.concat_ws(" ", _c(actual).cast("string"), _c(predicted).cast("string"))


# --- arithmetic -----------------------------------------------------------------


def ratio(top: ColumnLike, bottom: ColumnLike) -> Column:
    """Quotient; null for a zero or missing denominator."""
    return F.try_divide(_c(top).cast("double"), _c(bottom).cast("double"))


def percent(top: ColumnLike, bottom: ColumnLike) -> Column:
    return F.lit(100.0) * ratio(top, bottom)


def percent_gap(new: ColumnLike, base: ColumnLike) -> Column:
    """100 * (new - base) / base."""
    return F.lit(100.0) * F.try_divide(_c(new) - _c(base), _c(base))


def clip(value: ColumnLike, low: float, high: float) -> Column:
    v = _c(value)
    return F.when(v.isNull(), v).otherwise(F.least(F.greatest(v, F.lit(low)), F.lit(high)))


LARGEST = 1.7976931348623157e308  # fixed value: the largest finite double


def blank_non_finite(value: ColumnLike, zero_is_missing: bool = False) -> Column:
    """Null for NaN and infinities, on request also for zero. NaN sorts above all numbers."""
    v = _c(value)
    good = F.abs(v) <= LARGEST
    return F.when(good & (v != 0) if zero_is_missing else good, v)


def round_half_even(value: ColumnLike, digits: int) -> Column:
    return F.bround(_c(value), digits)


# --- dates ----------------------------------------------------------------------


def shift_years(value: ColumnLike, years: int) -> Column:
    return F.add_months(_c(value), 12 * years)


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(_c(later), _c(earlier))


def fiscal_year(value: ColumnLike, last_month: int = 9) -> Column:
    d = _c(value)
    return F.when(F.month(d) <= last_month, F.year(d)).otherwise(F.year(d) + 1)


def prev_business_day(value: ColumnLike) -> Column:
    """The day before; for a Monday the Friday before."""
    d = _c(value)
    return F.when(F.dayofweek(d) == 2, F.date_sub(d, 3)).otherwise(F.date_sub(d, 1))


# --- choices --------------------------------------------------------------------


def first_match(branches: Sequence[tuple[Column, ColumnLike]], default: Column | None = None) -> Column:
    """The choice of the first condition that holds."""
    chosen = None
    for condition, choice in branches:
        chosen = F.when(condition, _c(choice)) if chosen is None else chosen.when(condition, _c(choice))
    return chosen if default is None else chosen.otherwise(default)


def first_not_null(columns: Sequence[ColumnLike]) -> Column:
    return F.coalesce(*[_c(c) for c in columns])


def flag(condition: Column, missing: int = 0) -> Column:
    """1 where the condition holds, 0 where not, ``missing`` where it is unknown."""
    return F.when(condition, 1).when(condition.isNotNull(), 0).otherwise(missing)


# --- frames ---------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def outside_bounds(bounds: Mapping[str, tuple[float | None, float | None]]) -> Column:
    """True where any column leaves its (low, high) range; a null is inside."""
    test = F.lit(False)
    for name, (low, high) in bounds.items():
        if low is not None:
            test = test | F.coalesce(F.col(name) < low, F.lit(False))
        if high is not None:
            test = test | F.coalesce(F.col(name) > high, F.lit(False))
    return test
