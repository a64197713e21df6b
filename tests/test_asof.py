from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from panelweave.operators.asof import Source, align, asof_join, offset_lookup, value_days_ago

D = lambda d: date(2020, 1, d)


def frames(spark):
    left = spark.createDataFrame([("a", D(1)), ("a", D(5)), ("a", D(9)), ("b", D(5))], "k string, d date")
    right = spark.createDataFrame(
        [("a", D(2), 1.0, "x"), ("a", D(5), None, "y"), ("a", D(8), 3.0, None), ("c", D(1), 9.0, "z")],
        "k string, d date, v double, s string",
    )
    return left, right


def test_backward_fills_each_column_on_its_own(spark):
    left, right = frames(spark)
    got = rows(asof_join(left, right, keys=["k"], time="d", columns=["v", "s"], keep_time="seen"), "k", "d")
    assert got == [
        ("a", D(1), None, None, None), ("a", D(5), 1.0, "y", D(5)), ("a", D(9), 3.0, "y", D(8)), ("b", D(5), None, None, None),
    ]


def test_whole_row_keeps_the_nulls_of_the_newest(spark):
    left, right = frames(spark)
    got = rows(asof_join(left, right, keys=["k"], time="d", columns=["v", "s"], whole_row=True), "k", "d")
    assert got[1:3] == [("a", D(5), None, "y"), ("a", D(9), 3.0, None)]


def test_forward_and_age(spark):
    left, right = frames(spark)
    ahead = rows(asof_join(left, right, keys=["k"], time="d", columns=["v"], direction="forward"), "k", "d")
    assert [r[2] for r in ahead] == [1.0, 3.0, None, None]
    fresh = rows(asof_join(left, right, keys=["k"], time="d", columns=["v"], max_age_days=0, whole_row=True), "k", "d")
    assert [r[2] for r in fresh] == [None, None, None, None]


def test_later_is_strict(spark):
    left, right = frames(spark)
    got = rows(align(left, [Source(right.select("k", F.col("d").alias("e"), "v"), "e", ("v",), when="later")], keys=["k"], time="d"), "k", "d")
    assert [r[2] for r in got] == [1.0, 3.0, None, None]


def test_a_later_row_never_changes_the_past(spark):
    left, right = frames(spark)
    more = right.unionByName(spark.createDataFrame([("a", D(9), 77.0, "q")], right.schema))
    before = rows(asof_join(left, right, keys=["k"], time="d", columns=["v"]).filter(F.col("d") < D(9)), "k", "d")
    after = rows(asof_join(left, more, keys=["k"], time="d", columns=["v"]).filter(F.col("d") < D(9)), "k", "d")
    assert before == after


def test_offsets_and_days_ago(spark):
    series = spark.createDataFrame([("a", D(1), 1.0), ("a", D(8), 8.0)], "k string, d date, v double")
    left = spark.createDataFrame([("a", D(8))], "k string, d date")
    got = offset_lookup(left, series, keys=["k"], time="d", series_time="d", value="v", offsets=(0, 7, 3), prefix="o", default=1.0)
    assert got.select("o0", "o7", "o3").first() == (8.0, 1.0, 1.0)
    common = {"keys": ["k"], "time": "d", "columns": {"v": "old"}, "days": 5}
    assert [r[3] for r in rows(value_days_ago(series, **common), "d")] == [None, None]
    assert [r[3] for r in rows(value_days_ago(series, mode="asof", **common), "d")] == [None, 1.0]


def test_days_ago_on_long_series(spark, tiny_groups):
    series = spark.createDataFrame([("a", D(i), float(i)) for i in range(1, 20)], "k string, d date, v double")
    got = rows(value_days_ago(series, keys=["k"], time="d", columns={"v": "old"}, days=5, mode="asof"), "d")
    assert [r[3] for r in got] == [None] * 5 + [float(i) for i in range(1, 15)]


def test_offset_lookup_of_a_frequent_key_and_day(spark):
    series = spark.createDataFrame([("hot", date(2020, 1, d), float(d)) for d in range(1, 20)] + [("k", date(2020, 1, 5), 50.0)], "k string, d date, v double")
    left = [(i, "hot", date(2020, 1, 15)) for i in range(300)] + [(i, "hot", date(2020, 1, 10 + i % 7)) for i in range(300, 320)] + [(400, "k", date(2020, 1, 12)), (401, None, date(2020, 1, 12))]
    df = spark.createDataFrame(left, "id int, k string, t date").repartition(5)
    ask = lambda: rows(offset_lookup(df, series, keys=["k"], time="t", series_time="d", value="v", offsets=[0, 7], prefix="v").select("id", "v0", "v7"), "id")
    want = [(i, None if k != "hot" else float(t.day), {"hot": float(t.day - 7) if t.day > 7 else None, "k": 50.0, None: None}[k]) for i, k, t in left]
    assert ask() == want
    spark.conf.set("spark.panelweave.maxGroupRows", "50")
    try:
        assert ask() == want
        plan = offset_lookup(df, series, keys=["k"], time="t", series_time="d", value="v", offsets=[0, 7], prefix="v")
        heavy = plan.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert heavy <= 2 * 322 / 5  # the 300 rows of one key and day stay where they were dealt
    finally:
        spark.conf.unset("spark.panelweave.maxGroupRows")
