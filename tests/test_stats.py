import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweave.operators import splits as sp
from panelweave.operators import stats


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"g{i % 7}", 7.0 if rng.random() < 0.35 else rng.lognormvariate(0, 2), rng.gauss(0, 1)) for i in range(4000)]
    data += [("hot", None, None), ("lonely", 5.0, None)]
    frame = pd.DataFrame(data, columns=["g", "x", "y"])
    return frame, spark.createDataFrame(data, "g string, x double, y double").repartition(6)


@pytest.mark.parametrize("brackets", [False, True])
@pytest.mark.parametrize("limit", [None, "50"])
def test_quantiles_are_exact(spark, skewed, monkeypatch, brackets, limit):
    frame, df = skewed
    if brackets:
        monkeypatch.setattr(stats, "SKETCH", 100)
        monkeypatch.setattr(stats, "ALL_VALUES_BELOW", 150)
    if limit:
        spark.conf.set("spark.panelweave.maxGroupRows", limit)
    try:
        q = {"lo": 0.0, "a": 0.25, "b": 0.5, "c": 0.9, "hi": 1.0}
        got = {r["column"]: r for r in stats.exact_quantiles(df, ["x", "y"], q).collect()}
        for c in ("x", "y"):
            for n, p in q.items():
                assert got[c][n] == pytest.approx(frame[c].quantile(p), rel=1e-12)
        grouped = {r["g"]: r["m"] for r in stats.exact_quantiles(df, ["x"], {"m": 0.5}, ["g"]).collect()}
        assert grouped == pytest.approx(frame.groupby("g")["x"].median().to_dict())
    finally:
        spark.conf.unset("spark.panelweave.maxGroupRows")


def test_describe_equals_pandas(skewed):
    frame, df = skewed
    got = {r["column"]: r for r in stats.describe(df, ["x", "y"]).collect()}
    want = frame[["x", "y"]].describe()
    for c in ("x", "y"):
        assert [got[c][n] for n in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want[c]))


def test_correlations_equal_pandas(skewed):
    frame, df = skewed
    assert stats.pearson(df, ["x", "y"]).first()["r"] == pytest.approx(frame[["x", "y"]].corr().iloc[0, 1])
    complete = frame[["x", "y"]].dropna()
    ranked = complete.rank().corr().iloc[0, 1]
    assert stats.spearman(df, ["x", "y"]).first()["r"] == pytest.approx(ranked)


def test_sixty_columns_are_one_matrix(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=(300, 60)) @ rng.normal(size=(60, 60)) + 1e6 * np.arange(60)
    values[rng.random(values.shape) < 0.1] = np.nan
    values[:, 7] = 12345.678  # no variation
    frame = pd.DataFrame(values, columns=[f"c{i}" for i in range(60)])
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in row] for row in values], frame.columns.tolist()).repartition(5)
    got = {(r["column_a"], r["column_b"]): r["r"] for r in stats.corr_matrix(df, frame.columns.tolist()).collect()}
    want = frame.corr()
    assert len(got) == 3600
    for (a, b), r in got.items():
        if "c7" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_all_columns_are_ranked_together(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame(rng.integers(0, 6, size=(500, 5)).astype(float), columns=list("abcde"))
    frame.loc[:180, "a"] = 3.0  # one value holds a third of the rows
    df = spark.createDataFrame(frame).repartition(4)
    want = frame.corr(method="spearman")
    for r in stats.spearman(df, list("abcde")).collect():
        assert r["r"] == pytest.approx(want.loc[r["column_a"], r["column_b"]])
    plans = stats.spearman(df, list("abcde"))
    assert plans.count() == 10


def test_quantiles_come_with_measures_also_for_groups_without_values(skewed):
    _, df = skewed
    found = stats.exact_quantiles(df, ["x", "y"], {"m": 0.5}, ["g"], measures={"n": F.count, "top": F.max})
    lonely = {r["column"]: r for r in found.filter("g = 'lonely'").collect()}
    assert (lonely["x"]["n"], lonely["x"]["m"], lonely["x"]["top"]) == (1, 5.0, 5.0)
    assert (lonely["y"]["n"], lonely["y"]["m"], lonely["y"]["top"]) == (0, None, None)


def test_folds_are_ranges_of_positions(spark):
    rng = random.Random(8)
    data = [(i, f"2020-01-{rng.randint(1, 28):02d}", rng.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, d string, y int").select("id", F.col("d").cast("date").alias("d"), "y").repartition(7)
    placed = sp.with_positions(df, time="d", tie=["id"])
    order = sorted(data, key=lambda r: (r[1], r[0]))
    assert rows(placed.select("position", "id"), "position") == [(i, r[0]) for i, r in enumerate(order)]
    folds = sp.fold_ranges(200, n_splits=3, test_size=15, gap=7)
    repeated = sp.time_folds(df, time="d", tie=["id"], n_splits=3, test_size=15, gap=7)
    for f in folds:
        for part, of in (("train", f.train), ("test", f.test)):
            want = rows(repeated.filter((F.col("fold") == f.number) & (F.col("part") == part)).select("id"), "id")
            assert rows(of(placed).select("id"), "id") == want
    told = {(r["fold"], r["part"]): r for r in sp.fold_report(placed, folds, "y", time="d").collect()}
    assert told[0, "test"]["n_rows"] == 15 and told[2, "train"]["n_rows"] == 200 - 15 - 7
    assert told[1, "train"]["share_of_ones"] == pytest.approx(np.mean([r[2] for r in order[:folds[1].train_end]]))
    with pytest.raises(ValueError):
        sp.fold_ranges(50, n_splits=3, test_size=15, gap=7)
    assert sp.chain_shape(1_000_000) == {"n_splits": 5, "test_size": 30_000, "gap": 11_050}
    assert sp.chain_shape(1000) == {"n_splits": 5, "test_size": 100, "gap": 36}


def test_skewness_equals_pandas(skewed):
    frame, df = skewed
    got = {r["column"]: r["skewness"] for r in stats.skewness_buckets(df, ["x", "y"]).collect()}
    assert got == pytest.approx(frame[["x", "y"]].skew().to_dict())


def test_winsorize_learns_on_train_and_repeats(spark):
    train = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 2, 1, 50]], "v double")
    other = spark.createDataFrame([(1000.0,), (None,), (2.0,)], "v double")
    series = pd.Series([1, 2, 3, 2, 1, 50.0])
    first = series.mean() + series.std()
    clipped = series.clip(series.mean() - series.std(), first)
    second = min(first, clipped.mean() + clipped.std())
    got = [r[0] for r in stats.winsorize(other, ["v"], train, deviations=1.0, passes=2).collect()]
    assert got == [pytest.approx(second), None, 2.0]


def test_histogram_counts_everything_once(skewed):
    frame, df = skewed
    got = rows(stats.histogram(df, ["y"], 10).select("bin", "n"), "bin")
    counts, _ = np.histogram(frame["y"].dropna(), 10)
    assert dict(got) == {i: n for i, n in enumerate(counts) if n}


@pytest.fixture
def dated(spark):
    data = [(i, f"2020-01-{1 + i // 10:02d}" if i < 60 else "2020-01-07", float(i)) for i in range(120)]
    return spark.createDataFrame(data, "id int, d string, y double").withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("limit", ["5000000", "4"])
def test_folds_are_disjoint_and_keep_the_gap(spark, dated, limit):
    spark.conf.set("spark.panelweave.maxGroupRows", limit)
    try:
        got = rows(sp.time_folds(dated, time="d", tie=["id"], n_splits=3, test_size=15, gap=7).select("fold", "part", "id"))
    finally:
        spark.conf.unset("spark.panelweave.maxGroupRows")
    tests = [sorted(i for f, p, i in got if f == k and p == "test") for k in range(3)]
    assert tests == [list(range(75, 90)), list(range(90, 105)), list(range(105, 120))]
    for k in range(3):
        assert sorted(i for f, p, i in got if f == k and p == "train") == list(range(0, tests[k][0] - 7))


def test_holdout_takes_the_newest_rows(spark, dated, tiny_groups):
    train, test = sp.holdout_newest(dated, time="d", target="y", percent=5.0, tie=["id"])
    assert sorted(r["id"] for r in test.collect()) == list(range(60, 66))
    assert train.count() == 114
    assert sp.purge_gap(train, time="d", days=2).agg(F.max("d")).first()[0].day == 4


def test_attrition_counts_keys_per_step(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 1), ("b", 1, None), ("c", None, None)], "k string, x int, y int")
    steps = [("x", F.col("x").isNotNull()), ("y", F.col("y").isNotNull())]
    assert rows(stats.attrition_report(df, "k", steps), "step_no") == [(0, "start", 3, 4), (1, "x", 2, 2), (2, "y", 1, 1)]


@pytest.mark.parametrize("limit", [None, "1"])
def test_spearman_moves_rows_only_for_columns_with_many_values(spark, monkeypatch, limit):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 9, 400).astype(float), rng.normal(size=400)
    c = np.round(a + b)
    df = spark.createDataFrame([(None if i % 50 == 0 else float(x), float(y), float("nan") if i % 70 == 1 else float(z)) for i, (x, y, z) in enumerate(zip(a, b, c))], "a double, b double, c double")
    whole = [i for i in range(400) if i % 50 and i % 70 != 1]
    rank = lambda v: np.array([np.sum(v < x) + (np.sum(v == x) + 1) / 2 for x in v])
    ranks = [rank(v[whole]) for v in (a, b, c)]
    moved, join = [], stats.spread_join
    monkeypatch.setattr(stats, "spread_join", lambda *args, **kw: moved.append(args[2]) or join(*args, **kw))
    if limit:
        spark.conf.set("spark.panelweave.maxBroadcastBytes", limit)
    try:
        got = {(r.column_a, r.column_b): r.r for r in stats.spearman(df, ["a", "b", "c"]).collect()}
    finally:
        spark.conf.unset("spark.panelweave.maxBroadcastBytes")
    assert got == pytest.approx({(x, y): np.corrcoef(ranks[i], ranks[j])[0, 1] for i, x in enumerate("abc") for j, y in enumerate("abc") if i < j})
    assert len(moved) == (3 if limit else 0)
