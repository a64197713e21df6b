import os
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pyspark.ml.classification import LinearSVC

from panelweave.ml import evaluate as ev
from panelweave.ml.kernel import RandomFourierFeatures
from panelweave.operators.splits import fold_ranges, with_positions
from panelweave.ml import model as ml
from panelweave.sources.files import load_model, save_model


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    data = [(i, rng.randrange(2), rng.randrange(20) / 20) for i in range(400)]
    return spark.createDataFrame(data, "id int, label int, proba double")


def test_auc_agrees_with_the_evaluator_and_ignores_monotone_maps(scored):
    auc = ev.roc_auc(scored).first()["auc"]
    check = BinaryClassificationEvaluator(rawPredictionCol="proba", labelCol="label", numBins=0)
    assert auc == pytest.approx(check.evaluate(scored))
    assert auc == pytest.approx(ev.roc_auc(scored.withColumn("proba", F.exp(F.col("proba") * 3))).first()["auc"])


def test_auc_needs_both_classes(scored):
    assert ev.roc_auc(scored.filter("label = 1")).first()["auc"] is None


def test_metrics_of_a_known_table(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4, "label int, pred int")
    assert tuple(ev.confusion_matrix(df).first()) == (3, 1, 2, 4)
    assert tuple(ev.classification_metrics(df).first()) == pytest.approx((0.75, 0.7, 6 / 9))


def test_zero_direction_is_wrong(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, -3.0), (0.0, 1.0), (1.0, -1.0)], "a double, p double")
    assert rows(ev.direction_accuracy(df, "a", "p"), "correct") == [(0, 2, 50.0), (1, 2, 50.0)]


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(9)
    data = []
    for i in range(600):
        x, s = rng.gauss(0, 1), rng.choice(["Tech", "Energy", "Health"])
        data.append((i, None if i % 50 == 0 else x, s, int(x + (s == "Tech") > 0.5)))
    return spark.createDataFrame(data, "id int, x double, sector string, y int")


def test_train_save_load_and_screen(spark, learnable, tmp_path):
    model = ml.fit(learnable, ["x"], ["sector"], "y", "boosted", maxIter=3, maxDepth=3)
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"))
    first = rows(ml.screen(model, learnable, 30, ["id"]), "id")
    assert first == rows(ml.screen(again, learnable, 30, ["id"]), "id")
    assert first and all(p >= 0.5 and period == 30 for _, p, period in first)
    ranked = ml.feature_importance(model, spark)
    assert ranked.agg(F.sum("value_percent")).first()[0] == pytest.approx(100.0)
    assert ranked.filter("rank = 1").first()["feature"] == "x"
    assert ev.roc_auc(ml.predict(model, learnable, ["y"]).withColumnRenamed("y", "label")).first()["auc"] > 0.9


def test_unseen_sector_is_an_error(spark, learnable):
    model = ml.fit(learnable, ["x"], ["sector"], "y", "boosted", maxIter=1, maxDepth=2)
    other = spark.createDataFrame([(1, 0.0, "Unknown", 0)], learnable.schema)
    with pytest.raises(Exception, match="(?i)unseen"):
        ml.predict(model, other, ["id"]).collect()


def test_one_hot_leaves_out_the_first_value(spark, learnable):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    hot = Pipeline(stages=ml.one_hot_encoder(["sector"])).fit(learnable).transform(learnable)
    got = dict(rows(hot.select("sector", F.array_max(vector_to_array("sector_hot"))).distinct()))
    assert got == {"Energy": 0.0, "Health": 1.0, "Tech": 1.0}


def test_standardize_uses_the_population_deviation(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(ml.standardize(train, train, ["a", "b"]), "a") == [(-1.0, 0.0), (1.0, 0.0)]


def test_svc_with_weights(spark, learnable):
    weighted = ml.balanced_weights(learnable, "y")
    model = ml.fit(weighted, ["x"], ["sector"], "y", "svc", maxIter=5, weightCol="weight")
    right = ml.predict(model, learnable, ["y"]).filter("y = pred").count()
    assert right > 450


# --- kernel map, folds and grid

def test_fourier_features_stand_for_the_gaussian_kernel(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "x"]).repartition(3)
    mapped = RandomFourierFeatures(inputCol="x", outputCol="z", dimensions=4096, gamma=0.3).transform(df)
    z = np.array([r["z"].toArray() for r in mapped.orderBy("id").collect()])
    exact = np.exp(-0.3 * ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    error = np.abs(z @ z.T - exact)
    assert error.max() < 5 / np.sqrt(4096) and error.mean() < 1 / np.sqrt(4096)
    again = np.array([r["z"].toArray() for r in RandomFourierFeatures(inputCol="x", outputCol="z", dimensions=4096, gamma=0.3).transform(df.repartition(1)).orderBy("id").collect()])
    assert (again == z).all()


def test_kernel_machine_separates_what_a_line_cannot_and_is_saved(spark, tmp_path):
    rng = random.Random(2)
    points = [(rng.gauss(0, 1), rng.gauss(0, 1), rng.choice("ab")) for _ in range(800)]
    df = spark.createDataFrame([(i, a, b, s, int(a * a + b * b < 1.2)) for i, (a, b, s) in enumerate(points)], "id int, a double, b double, s string, y int")
    right = lambda model: ml.predict(model, df, ["y"]).filter("y = pred").count() / 800
    line = ml.fit(df, ["a", "b"], ["s"], "y", "svc")
    curve = ml.fit(df, ["a", "b"], ["s"], "y", "kernel", dimensions=64, gamma=0.5)
    assert right(curve) > 0.93 > right(line) + 0.2
    save_model(curve, str(tmp_path / "kernel"))
    assert rows(ml.predict(load_model(str(tmp_path / "kernel")), df, ["id"]), "id") == rows(ml.predict(curve, df, ["id"]), "id")


@pytest.mark.parametrize("kind, shape", [("svc", {"maxIter": 12}), ("svc", {"maxIter": 4, "fitIntercept": False}), ("kernel", {"maxIter": 12, "dimensions": 32, "gamma": 0.4})])
def test_machines_fitted_by_scans_equal_those_that_keep_their_rows(spark, tmp_path, monkeypatch, kind, shape):
    rng = random.Random(7)
    data = []
    for i in range(600):
        a, b, c, s = rng.gauss(0, 1), rng.gauss(50, 9), rng.randrange(5), rng.choice(["Tech", "Energy", "Health"])
        data.append((i, None if i % 37 == 0 else a, float("nan") if i % 41 == 0 else b, None if i % 29 == 0 else c, 3.0, s, None if i % 50 == 0 else int(a + 0.3 * c + (s == "Tech") + rng.gauss(0, 1) > 1), rng.random()))
    df = spark.createDataFrame(data, "id int, a double, b double, c int, same double, s string, y int, w double").repartition(3)
    kept = ml.fit(df, ["a", "b", "c", "same"], ["s"], "y", kind, weightCol="w", **shape)
    monkeypatch.setattr(ml, "KEPT_BYTES", 0)
    monkeypatch.setattr(LinearSVC, "_fit", None)  # would keep them
    scanned = ml.fit(df, ["a", "b", "c", "same"], ["s"], "y", kind, weightCol="w", **shape)
    one, two = kept.stages[-1], scanned.stages[-1]
    assert two.coefficients.toArray() == pytest.approx(one.coefficients.toArray(), abs=1e-9) and two.intercept == pytest.approx(one.intercept, abs=1e-9)
    save_model(scanned, str(tmp_path / "scanned"))
    assert rows(ml.predict(load_model(str(tmp_path / "scanned")), df, ["id"]), "id") == rows(ml.predict(kept, df, ["id"]), "id")


def test_scans_refuse_what_the_machine_refuses(spark, monkeypatch):
    monkeypatch.setattr(ml, "KEPT_BYTES", 0)
    df = spark.createDataFrame([(1.0, "a", 2), (2.0, "b", 0), (3.0, "a", 1)], "x double, s string, y int")
    with pytest.raises(Exception, match="labels have to be 0 or 1"):
        ml.fit(df, ["x"], ["s"], "y", "svc")


@pytest.fixture(scope="module")
def placed(spark):
    rng = random.Random(12)
    data = []
    for i in range(500):
        x, s = rng.gauss(0, 1), rng.choice(["Tech", "Energy", "Health"])
        data.append((i, f"2020-{1 + i // 50:02d}-{1 + i % 28:02d}", None if i % 40 == 0 else x, s, int(x + (s == "Tech") > 0.5), 3 * x + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(data, "id int, d string, x double, sector string, y int, r double").withColumn("d", F.col("d").cast("date"))
    at = with_positions(df, time="d", tie=["id"])
    prepared = ml.preparation(["x"], ["sector"]).fit(at)
    return prepared, ml.feature_matrix(prepared, at, ["id", "position", "y", "r"])


def test_forward_folds_equal_single_fits_and_have_running_means(spark, placed):
    _, rows_ = placed
    folds = fold_ranges(500, n_splits=3, test_size=80, gap=20)
    fitted = lambda train: ml.fit_matrix(train, "y", "boosted", maxIter=4, maxDepth=3)
    table = ml.forward_cv(rows_, folds, "y", fitted).orderBy("fold").collect()
    assert [r["fold"] for r in table] == [0, 1, 2]
    one = ml.predict(fitted(rows_.filter(F.col("position") < folds[1].train_end)), rows_.filter(F.col("position").between(folds[1].start, folds[1].end - 1)), ["y"])
    single = ev.classification_metrics(one, "y", "pred").first()
    assert (table[1]["precision"], table[1]["accuracy"], table[1]["f1"]) == pytest.approx(tuple(single))
    assert table[1]["auc"] == pytest.approx(ev.roc_auc(one, "y").first()["auc"])
    for m in ("auc", "precision", "accuracy", "f1"):
        for i in range(3):
            assert table[i][f"mean_{m}"] == pytest.approx(np.mean([r[m] for r in table[:i + 1]]))


def test_grid_points_equal_single_fits(spark, placed):
    _, rows_ = placed
    folds = fold_ranges(500, n_splits=2, test_size=100, gap=10)
    model, table = ml.grid_search(rows_, folds, "r", {"maxDepth": (1, 4), "maxIter": (3,)})
    scores = {(r["params"], r["fold"]): r["mse"] for r in table.collect()}
    assert len(scores) == 4
    fitted = ml.fit_matrix(folds[1].train(rows_), "r", "regressor", maxDepth=4, maxIter=3)
    single = ev.regression_errors(ml.predict(fitted, folds[1].test(rows_), ["r"], classifier=False), "r", "pred").first()["mse"]
    assert scores["maxDepth=4, maxIter=3", 1] == pytest.approx(single)
    assert table.filter("best").select("params").distinct().first()[0] == "maxDepth=4, maxIter=3" and model.getMaxDepth() == 4


def test_whole_model_scores_raw_rows(spark, placed):
    prepared, rows_ = placed
    model = ml.whole_model(prepared, ml.fit_matrix(rows_, "y", "boosted", maxIter=3, maxDepth=3))
    raw = spark.createDataFrame([(1, None, "Tech"), (2, 3.0, "Energy"), (3, -3.0, "Health")], "id int, x double, sector string")
    assert {r["id"]: r["pred"] for r in ml.predict(model, raw, ["id"]).collect()}.keys() == {1, 2, 3}
    assert {r["feature"] for r in ml.feature_importance(model, spark).collect()} == {"x", "sector"}


def test_fits_run_together_only_where_their_rows_have_room(spark, placed, monkeypatch):
    _, rows_ = placed
    assert ml.room_for_fits(rows_) == 6 and ml.room_for_fits(rows_, 3, 2048) == 3
    monkeypatch.setattr(ml, "FITS_BYTES", 500 * (4 * 2 + ml.BINNED_ROW_BYTES) * 2)
    assert ml.room_for_fits(rows_) == 2
    monkeypatch.setattr(ml, "FITS_BYTES", 1)
    assert ml.room_for_fits(rows_) == 1 and ml.room_for_fits(rows_.limit(0)) == 1


def test_a_fit_shuffles_bins_of_a_bounded_number_of_partitions(spark, placed, monkeypatch):
    _, rows_ = placed
    seen = []

    class Counted(GBTClassifier):
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return super().fit(df)

    monkeypatch.setitem(ml.ESTIMATORS, "counted", lambda **p: Counted(maxIter=1, seed=42, **p))
    ml.fit_matrix(rows_.repartition(50), "y", "counted")
    assert seen == [(min(50, ml.WAVES * spark.sparkContext.defaultParallelism), 500)]


def test_positions_are_stored_once_as_parquet(spark):
    df = spark.range(300).select("id", F.expr("date_add(date'2020-01-01', CAST(id * 7 % 50 AS int))").alias("d")).repartition(5)
    at = with_positions(df, time="d", tie=["id"])
    assert all("/positions-" in f for f in at.inputFiles()) and at.inputFiles()
    got = rows(at, "position")
    assert [p for *_, p in got] == list(range(300)) and [r[:2] for r in got] == sorted((r[:2] for r in got), key=lambda r: (r[1], r[0]))


def test_the_built_panel_is_stored_once(spark, monkeypatch):
    from panelweave.catalog import modelling
    from panelweave.catalog.registry import Tables

    monkeypatch.setattr(modelling.landed, "inputs", lambda t: None)
    monkeypatch.setattr(modelling.pn, "build_panel", lambda *a, **k: spark.range(5))
    monkeypatch.setattr(modelling.pn, "clean_panel", lambda built, mode: built.withColumn("mode", F.lit(mode)))
    t = Tables(spark, "/nowhere")
    train, score = modelling.labelled_panel(t, "score"), modelling.labelled_panel(t, "score")
    assert train.inputFiles() == score.inputFiles() and all("/panel-" in f for f in train.inputFiles()) and train.count() == 5


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", ["gbt_classify", "forest_classify", "gbt_regress", "linear_svc", "kernel_svm", "grid_search", "forward_cv", "score_screen", "feature_importance"])
def test_model_queries_on_the_cleaned_panel(spark, name):
    from panelweave.catalog import QUERIES

    found = QUERIES[name](spark, SMALL)
    got = found.collect()
    assert got
    if "horizon" in found.columns:
        assert {r["horizon"] for r in got} == {15, 30, 60, 90, 120, 150}
    if name == "feature_importance":
        assert found.columns == ["feature", "15", "30", "60", "90", "120", "150"] and len(got) > 30
    if name == "forward_cv":
        assert [r["fold"] for r in sorted(got)] == [0, 1, 2, 3, 4]
    if name == "score_screen":
        assert all(r["predicted_proba"] >= 0.5 for r in got) and {r["period"] for r in got} <= {15, 30, 60, 90, 120, 150}
