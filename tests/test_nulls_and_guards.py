"""Null dates and null groups are kept, size switches are guarded, and scans are pruned."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelweave import session
from panelweave.ml import evaluate
from panelweave.operators import splits, stats
from panelweave.operators.timeline import spread_join
from panelweave.session import DEFAULT_GROUP_ROWS, GROUP_ROWS
from panelweave.sources import files

DAY = dt.date(2024, 1, 1)


def dated(spark, stamps=False):
    rows = [(i, None if i % 7 == 3 else DAY + dt.timedelta(days=i // 2), float(i)) for i in range(20)]
    frame = spark.createDataFrame(rows, "id int, date date, target double")
    return frame.withColumn("date", F.col("date").cast("timestamp") + F.make_dt_interval(hours=F.col("id"))) if stamps else frame


@pytest.mark.parametrize("stamps", [False, True])
def test_holdout_keeps_rows_without_a_date_and_counts_them_oldest(spark, stamps):
    df = dated(spark, stamps)
    train, test = splits.holdout_newest(df, time="date", target="target", percent=25.0, tie=["id"])
    known = sorted((r for r in df.collect() if r.date is not None), key=lambda r: (r.date, -r.id), reverse=True)
    assert {r.id for r in test.collect()} == {r.id for r in known[:5]}
    assert train.count() == 15 and train.filter("date IS NULL").count() == 3


def test_folds_keep_rows_without_a_date_and_count_them_newest(spark):
    folds = splits.time_folds(dated(spark), time="date", tie=["id"], n_splits=2, test_size=4, gap=1).collect()
    ordered = sorted(dated(spark).collect(), key=lambda r: (r.date is None, r.date or DAY, r.id))
    for fold, start in ((0, 12), (1, 16)):
        part = lambda name, fold=fold: {r.id for r in folds if r.fold == fold and r.part == name}
        assert part("test") == {r.id for r in ordered[start:start + 4]}
        assert part("train") == {r.id for r in ordered[:start - 1]}


def grouped(spark):
    rows = [(g, float(v), v % 2, (v * 37 % 11) / 10) for g in ("a", None) for v in range(1, 12)] + [("b", None, 0, 0.5)]
    return spark.createDataFrame(rows, "g string, value double, label int, proba double")


@pytest.mark.parametrize("few", [0, stats.ALL_VALUES_BELOW])
@pytest.mark.parametrize("long", [3, DEFAULT_GROUP_ROWS])
def test_null_groups_have_all_statistics(spark, monkeypatch, few, long):
    monkeypatch.setattr(stats, "ALL_VALUES_BELOW", few)
    spark.conf.set(GROUP_ROWS, str(long))
    try:
        df = grouped(spark)
        told = {r.g: r for r in stats.describe(df, ["value"], ["g"]).collect()}
        assert (told[None].q25, told[None].q50, told[None].q75) == (3.5, 6.0, 8.5) == (told["a"].q25, told["a"].q50, told["a"].q75)
        assert told["b"].q50 is None and told["b"]["count"] == 0
        assert {r.g: r.median for r in stats.group_outcome_stats(df, ["g"], "value").collect()} == {None: 6.0, "a": 6.0, "b": None}
        boxes = {r.g: (r.q1, r.q3, r.whisker_high) for r in stats.box_stats(df, "g", "value").collect()}
        assert boxes[None] == boxes["a"] == (3.5, 8.5, 11.0)
        curves = evaluate.roc_curve(df, by=["g"]).groupBy("g").count().collect()
        assert {r.g: r["count"] for r in curves}[None] == 11
        assert None in {r.horizon for r in evaluate.horizon_summary(
            df.withColumnRenamed("g", "horizon").withColumn("pred", F.lit(1))).collect()}
    finally:
        spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(stats, "ALL_VALUES_BELOW", 0)
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, n: F.array(*[F.lit(5.0)] * len(p)))  # a sketch that is far off
    df = spark.createDataFrame([(float(v),) for v in range(101)], "value double")
    row = stats.exact_quantiles(df, ["value"], {"q10": 0.1, "q90": 0.9}).first()
    assert (row.q10, row.q90) == (10.0, 90.0)


@pytest.mark.parametrize("long", [2, DEFAULT_GROUP_ROWS])
def test_spread_join_with_null_keys(spark, long):
    spark.conf.set(GROUP_ROWS, str(long))
    try:
        df = spark.createDataFrame([(None, i) for i in range(5)] + [("x", 9)], "k string, i int")
        side = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
        assert sorted((r.i, r.v) for r in spread_join(df, side, ["k"], null_safe=True).collect()) == [(i, 1) for i in range(5)] + [(9, 2)]
        assert [r.v for r in spread_join(df, side, ["k"]).filter("i < 5").collect()] == [None] * 5
    finally:
        spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))


def test_correlation_of_sixty_columns(spark):
    import numpy as np

    data = np.random.default_rng(1).normal(size=(200, 60)).cumsum(axis=1)
    names = [f"c{i}" for i in range(60)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{n} double" for n in names))
    got = {(r.column_a, r.column_b): r.r for r in stats.corr_matrix(df, names).collect()}
    want = np.corrcoef(data.T)
    assert len(got) == 3600
    assert max(abs(got[names[i], names[j]] - want[i, j]) for i in range(60) for j in range(60)) < 1e-9


def test_a_constant_column_correlates_with_nothing(spark):
    df = spark.createDataFrame([(1.0, float(i), None) for i in range(5)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["b", "b"] == 1.0
    assert all(v is None or v != v for k, v in got.items() if k != ("b", "b"))


def test_a_date_range_reads_only_its_years(spark, tmp_path):
    rows = [(i, dt.date(2015 + i % 5, 3, 1 + i % 20)) for i in range(200)]
    files.write_panel(spark.createDataFrame(rows, "stock int, date date"), str(tmp_path / "panel"))
    part = files.read_panel(spark, str(tmp_path / "panel"), since="2018-01-01", until="2018-12-31")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and part.count() == 40
    assert files.read_panel(spark, str(tmp_path / "panel")).count() == 200


def test_no_private_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
