from datetime import date

from pyspark.sql import functions as F

from panelweave.functions import scalars as sc
from panelweave.operators.relational import count_outside, hash_split
from panelweave.plans.panel import payer_flag, threshold_labels


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_coercion(spark):
    text = [F.lit(v) for v in ("1.5", " 2 ", "None", "NA", "", "inf", "NaN", "1e400")]
    assert one(spark, *[sc.to_number(t) for t in text]) == (1.5, 2.0, None, None, None, None, None, None)
    assert one(spark, sc.to_day(F.lit("2020-02-29")), sc.to_day(F.lit("2020-02-30"))) == (date(2020, 2, 29), None)
    assert one(spark, *[sc.to_int_days(F.lit(v)) for v in ("12", "12.0", "12 days 00:00:00", "x")]) == (12, 12, 12, None)


def test_split_ratio(spark):
    assert one(spark, *[sc.split_ratio(F.lit(v)) for v in ("4/1", "2/3", "0/1", "4", "a/b", None)]) == (0.25, 1.5, None, None, None, None)


def test_symbols_and_tags(spark):
    assert one(spark, sc.normalise_symbol(F.lit(" BRK.B\n")), sc.outcome_tag(F.lit(1.0), F.lit(1))) == ("BRK-B", "1.0 1")


def test_dates(spark):
    monday, saturday = F.lit("2023-01-02").cast("date"), F.lit("2023-01-07").cast("date")
    assert one(spark, sc.prev_business_day(monday), sc.prev_business_day(saturday)) == (date(2022, 12, 30), date(2023, 1, 6))
    assert one(spark, sc.shift_years(F.lit("2020-02-29").cast("date"), -1)) == (date(2019, 2, 28),)
    assert one(spark, *[sc.fiscal_year(F.lit(d).cast("date")) for d in ("2020-09-30", "2020-10-01")]) == (2020, 2021)


def test_ratios_clip_and_blanks(spark):
    zero, null = F.lit(0.0), F.lit(None).cast("double")
    assert one(spark, sc.ratio(F.lit(1.0), zero), sc.percent_gap(F.lit(3.0), F.lit(2.0)), sc.clip(null, 0, 1), sc.clip(F.lit(9.0), 0.0, 1.0)) == (None, 50.0, None, 1.0)
    inf = F.lit(float("inf"))
    got = one(spark, *[sc.blank_non_finite(v, True) for v in (inf, -inf, F.lit(float("nan")), zero, null, F.lit(2.0))])
    assert got == (None, None, None, None, None, 2.0)
    assert one(spark, sc.round_half_even(F.lit(2.5), 0), sc.round_half_even(F.lit(3.5), 0)) == (2.0, 4.0)


def test_first_match_prefers_the_first(spark):
    yes, null = F.lit(True), F.lit(None).cast("boolean")
    assert one(spark, sc.first_match([(null, F.lit(1)), (yes, F.lit(2)), (yes, F.lit(3))])) == (2,)
    assert one(spark, sc.flag(null), sc.flag(null, 1), sc.flag(yes)) == (0, 1, 1)


def test_bounds_labels_and_flags(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,)], "v double")
    assert tuple(count_outside(df, {"v": (2.0, None)}).first()) == (1, 2, 3)
    labelled = threshold_labels(df, {"v": 5.0}).orderBy(F.col("v").asc_nulls_last())
    assert [r["v_label"] for r in labelled.collect()] == [0, 1, None]
    assert [r[0] for r in df.select(payer_flag("v")).collect()] == [True, True, False]


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(1000)
    one_way = {r[0] for r in hash_split(df, ["id"]).filter("is_test").collect()}
    other = {r[0] for r in hash_split(df.repartition(7), ["id"]).filter("is_test").collect()}
    assert one_way == other and 120 < len(one_way) < 280


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, 2.0, "a", True)], "i int, d double, s string, b boolean")
    assert sc.numeric_columns(df) == ["i", "d"] and sc.text_columns(df) == ["s"]
