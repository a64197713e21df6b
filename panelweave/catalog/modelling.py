"""Encoders, models and evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.catalog import landed
from panelweave.catalog.registry import Tables, day, query, rounded
from panelweave.functions.scalars import numeric_columns
from panelweave.ml import evaluate as ev
from panelweave.ml import model as ml
from panelweave.operators.relational import keep_first_per
from panelweave.operators.splits import FOLD_SHAPE, Fold, chain_shape, fold_ranges, fold_report, holdout_newest, purge_gap, with_positions
from panelweave.operators.timeline import FITS, Axis
from panelweave.plans import panel as pn
from panelweave.session import scratch_path, stored
from panelweave.sources import files

# --- encoders -----------------------------------------------------------------------


@query(
    "label_encode",
    "SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INT) AS p_type_id FROM part",
)
def label_encode(t: Tables) -> DataFrame:
    encoder = ml.label_encoder(["p_type"])
    fitted = encoder.fit(t.part)
    return fitted.transform(t.part).select("p_partkey", "p_type", F.col("p_type_id").cast("int").alias("p_type_id"))


@query(
    "one_hot",
    """
    WITH k AS (SELECT DISTINCT p_type FROM part), n AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS rank FROM k),
    c AS (SELECT count(*) AS total FROM k)
    SELECT p_partkey, total - 1 - rank AS slot, rank > 0 AS has_indicator FROM part JOIN n USING (p_type), c
    """,
)
def one_hot(t: Tables) -> DataFrame:
    fitted = Pipeline(stages=ml.one_hot_encoder(["p_type"])).fit(t.part)
    hot = vector_to_array("p_type_hot")
    position = F.array_position(hot, F.lit(1.0))
    slot = F.when(position == 0, F.size(hot)).otherwise(position - 1)
    return fitted.transform(t.part).select(
        "p_partkey", slot.cast("bigint").alias("slot"), (position > 0).alias("has_indicator")
    )


@query(
    "standardize",
    """
    WITH f AS (SELECT avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp, avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq
               FROM lineitem WHERE l_returnflag = 'A')
    SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - mp) / sp, 7) AS l_extendedprice, round((l_quantity - mq) / sq, 7) AS l_quantity
    FROM lineitem, f
    """,
)
def standardize(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    train = t.lineitem.filter(F.col("l_returnflag") == "A")
    return rounded(ml.standardize(rows, train, ["l_extendedprice", "l_quantity"]), 7)


# --- models -------------------------------------------------------------------------

AS_OF = "2001-06-30"
HORIZONS = tuple(pn.THRESHOLDS)
TARGET = {h: f"future_{h}dprice_change" for h in HORIZONS}
LABEL = {h: f"future_{h}dprice_change_label" for h in HORIZONS}
NOT_FEATURES = ("stock", "open", "close", "days_after_crisis", "position", *TARGET.values(), *LABEL.values())


def labelled_panel(t: Tables, mode: str = "train") -> DataFrame:
    """The built panel, stored once for all modes; cleaning and labels are a filter and a few columns of its scan."""
    build = lambda: pn.build_panel(landed.inputs(t), as_of=F.lit(AS_OF).cast("date"), start="1995-06-30", size=FITS)
    cleaned = pn.clean_panel(t.once("built_panel", build, lambda built: stored(built, "panel")), mode)
    return pn.threshold_labels(cleaned, pn.horizon_thresholds()) if mode == "train" else cleaned


def features_of(panel: DataFrame) -> list[str]:
    return [c for c in numeric_columns(panel) if c not in NOT_FEATURES]


def model_rows(t: Tables, categories: tuple[str, ...] = ("sector",)) -> tuple[PipelineModel, DataFrame]:
    """(fitted preparation, stored rows with keys, returns, labels and the assembled features)."""
    panel = labelled_panel(t)
    prepared = ml.preparation(features_of(panel), categories).fit(panel)
    return prepared, ml.feature_matrix(prepared, panel, ["stock", "date", *TARGET.values(), *LABEL.values()])


def _split(rows: DataFrame, horizon: int) -> tuple[DataFrame, DataFrame]:
    """All but the newest 5 percent with a return, less a gap of the horizon, and those 5 percent."""
    train, test = holdout_newest(rows, time="date", target=TARGET[horizon], percent=5.0, tie=["stock"])
    return purge_gap(train, time="date", days=horizon), test


def _per_horizon(rows: DataFrame, fit_and_score) -> DataFrame:
    """The six horizons, as many at a time as there is room for, as one frame."""
    parts = ml.at_once([lambda h=h: fit_and_score(h).withColumn("horizon", F.lit(h)) for h in HORIZONS], ml.room_for_fits(rows))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _classified(t: Tables, kind: str, **params) -> DataFrame:
    _, rows = model_rows(t)

    def one(h: int) -> DataFrame:
        train, test = _split(rows, h)
        return ml.predict(ml.fit_matrix(train, LABEL[h], kind, **params), test, ["stock", "date", F.col(LABEL[h]).alias("label")])

    return _per_horizon(rows, one)


@query("gbt_classify")
def gbt_classify(t: Tables) -> DataFrame:
    """Six horizons of 50 boosted trees, each trained on all but the newest 5 percent and scored on those."""
    return _classified(t, "boosted")


@query("forest_classify")
def forest_classify(t: Tables) -> DataFrame:
    """The same rows scored by the second ensemble, 50 trees grown apart."""
    return _classified(t, "forest", maxDepth=8)


@query("gbt_regress")
def gbt_regress(t: Tables) -> DataFrame:
    """Returns of six horizons by 50 boosted trees, with the industry in place of the sector."""
    _, rows = model_rows(t, ("industry",))

    def one(h: int) -> DataFrame:
        train, test = _split(rows, h)
        actual = F.col(TARGET[h]).alias("actual")
        return ml.predict(ml.fit_matrix(train, TARGET[h], "regressor"), test, ["stock", "date", actual], classifier=False)

    return _per_horizon(rows, one)


@query("linear_svc")
def linear_svc(t: Tables) -> DataFrame:
    """A linear machine with class weights, trained on all but the newest 5 percent and scored on those."""
    panel = labelled_panel(t)  # a filter on the stored panel; the stages of the fit read their own copy of the train rows
    train, test = _split(panel, 30)
    weighted = ml.balanced_weights(train.filter(F.col(LABEL[30]).isNotNull()), LABEL[30])
    numbers = features_of(panel)
    model = ml.fit(stored(weighted.select(*numbers, "sector", LABEL[30], "weight"), "train"), numbers, ["sector"], LABEL[30], "svc", weightCol="weight")
    return ml.predict(model, test, ["stock", "date", F.col(LABEL[30]).alias("label")])


def _chained(rows: DataFrame, label: str, shape: tuple[int, int, int]) -> tuple[DataFrame, list[Fold]]:
    """The rows with a label and their position in time, stored, and the folds over them."""
    placed = with_positions(rows.filter(F.col(label).isNotNull()), time="date", tie=["stock"])
    total = placed.count()
    return placed, fold_ranges(total, **chain_shape(total, shape))


@query("kernel_svm")
def kernel_svm(t: Tables) -> DataFrame:
    """Forward folds of the machine with a Gaussian kernel, by random Fourier features, classes weighted."""
    rows, folds = _chained(labelled_panel(t), LABEL[30], (3, 22_000, 11_050))
    numbers, dimensions = features_of(rows), 256

    def fitted(train: DataFrame) -> PipelineModel:
        return ml.fit(ml.balanced_weights(train, LABEL[30]), numbers, ["sector"], LABEL[30], "kernel", weightCol="weight", dimensions=dimensions)

    return ml.forward_cv(rows, folds, LABEL[30], fitted, threads=ml.room_for_fits(rows, 3, 8 * dimensions)).drop("auc", "mean_auc")


@query("grid_search")
def grid_search(t: Tables) -> DataFrame:
    """Depth and step size of 50 boosted trees for the 30-day return, each point on every forward fold."""
    _, rows = model_rows(t)
    placed, folds = _chained(rows, TARGET[30], FOLD_SHAPE)
    _, scores = ml.grid_search(placed, folds, TARGET[30], {"maxDepth": (3, 5), "stepSize": (0.03, 0.1)})
    return scores


@query("forward_cv")
def forward_cv(t: Tables) -> DataFrame:
    """Five forward folds of 50 boosted trees for the 30-day label, with running means."""
    _, rows = model_rows(t)
    placed, folds = _chained(rows, LABEL[30], FOLD_SHAPE)
    return ml.forward_cv(placed, folds, LABEL[30], lambda train: ml.fit_matrix(train, LABEL[30], "boosted"), threads=ml.room_for_fits(placed, 3))


@query("score_screen")
def score_screen(t: Tables) -> DataFrame:
    """Models of all six periods, refitted on all rows, saved and loaded, screen the newest row of every stock."""
    prepared, rows = model_rows(t)
    newest = stored(keep_first_per(labelled_panel(t, "score"), ["stock"], [F.datediff(F.lit("9999-12-31").cast("date"), F.col("date"))]), "newest")

    def one(h: int) -> DataFrame:
        path = scratch_path(t.spark, f"model-{h}")
        files.save_model(ml.whole_model(prepared, ml.fit_matrix(rows, LABEL[h], "boosted")), path)
        return ml.screen(files.load_model(path), newest, h, ["stock", "date"])

    return _per_horizon(rows, one).drop("horizon")


@query("feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    """Rank of every feature in the models of the six horizons, refitted on all rows."""
    prepared, rows = model_rows(t)
    fits = [lambda h=h: ml.whole_model(prepared, ml.fit_matrix(rows, LABEL[h], "boosted")) for h in HORIZONS]
    models = ml.at_once(fits, ml.room_for_fits(rows))
    return ml.importance_by_horizon(dict(zip(HORIZONS, models)), t.spark)


@query(
    "fold_balance",
    """
    WITH o AS (SELECT row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS pos, CAST(o_orderdate AS DATE) AS date,
                      CASE WHEN o_totalprice >= 300000 THEN 1 ELSE 0 END AS label, count(*) OVER () AS total FROM orders),
    s AS (SELECT DISTINCT total, total // 10 AS size, 11050 * (total // 10) // 30000 AS gap FROM o),
    f AS (SELECT CAST(i AS INT) AS fold, total - (5 - i) * size AS start, size, gap FROM s, range(5) r(i)),
    p AS (SELECT fold, 'train' AS part, 0 AS low, start - gap AS high FROM f UNION ALL SELECT fold, 'test', start, start + size FROM f)
    SELECT fold, part, count(*) AS n_rows, round(avg(label), 8) AS share_of_ones, min(date) AS first, max(date) AS last
    FROM p JOIN o ON pos >= low AND pos < high GROUP BY 1, 2
    """,
)
def fold_balance(t: Tables) -> DataFrame:
    """Sizes, days and class balance of the forward folds over the orders."""
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("date"), (F.col("o_totalprice") >= 300000).cast("int").alias("label"))
    placed = with_positions(rows, time="date", tie=["o_orderkey"])
    total = t.orders.count()
    folds = fold_ranges(total, **chain_shape(total))
    return rounded(fold_report(placed, folds, "label", time="date"), 8, ("share_of_ones",))


# --- evaluation ---------------------------------------------------------------------

SCORED_SQL = """
    s AS (SELECT o_orderkey AS row_id, o_custkey AS stock, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS horizon, o_totalprice AS price,
                 (o_totalprice - 240000) / 10000 AS actual_return, CASE WHEN o_totalprice >= 300000 THEN 1 ELSE 0 END AS label,
                 ((o_orderkey * 7919 + CAST(floor(o_totalprice / 1000) AS BIGINT)) % 1000) / 1000.0 AS proba,
                 CASE WHEN ((o_orderkey * 7919 + CAST(floor(o_totalprice / 1000) AS BIGINT)) % 1000) >= 500 THEN 1 ELSE 0 END AS pred FROM orders)
"""


def scored(t: Tables) -> DataFrame:
    """Orders as scored rows: the score is a fixed function of key and price, with ties."""
    points = (F.col("o_orderkey") * 7919 + F.floor(F.col("o_totalprice") / 1000)) % 1000
    return t.orders.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("stock"), day("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("horizon"), F.col("o_totalprice").alias("price"),
        ((F.col("o_totalprice") - 240000) / 10000).alias("actual_return"),
        (F.col("o_totalprice") >= 300000).cast("int").alias("label"),
        (points / 1000.0).alias("proba"), (points >= 500).cast("int").alias("pred"),
    )


CONFUSION_SQL = """
    m AS (SELECT horizon, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
                 count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn FROM s GROUP BY 1)
"""


@query("confusion_matrix", f"WITH {SCORED_SQL}, {CONFUSION_SQL} SELECT * FROM m")
def confusion_matrix(t: Tables) -> DataFrame:
    return ev.confusion_matrix(scored(t), by=["horizon"])


@query(
    "classification_metrics",
    f"""
    WITH {SCORED_SQL}, {CONFUSION_SQL}
    SELECT horizon, round(tp / nullif(tp + fp, 0), 8) AS precision, round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy,
           round(2 * tp / nullif(2 * tp + fp + fn, 0), 8) AS f1 FROM m
    """,
)
def classification_metrics(t: Tables) -> DataFrame:
    return rounded(ev.classification_metrics(scored(t), by=["horizon"]), 8)


AUC_SQL = """
    p AS (SELECT horizon, label, rank() OVER (PARTITION BY horizon ORDER BY proba) + (count(*) OVER (PARTITION BY horizon, proba) - 1) / 2.0 AS r FROM s),
    auc AS (SELECT horizon, (sum(r) FILTER (WHERE label = 1) - (count(*) FILTER (WHERE label = 1)) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                   / ((count(*) FILTER (WHERE label = 1)) * (count(*) FILTER (WHERE label = 0))) AS auc FROM p GROUP BY 1)
"""


@query("roc_auc", f"WITH {SCORED_SQL}, {AUC_SQL} SELECT horizon, round(auc, 8) AS auc FROM auc")
def roc_auc(t: Tables) -> DataFrame:
    return rounded(ev.roc_auc(scored(t), by=["horizon"], probe=t.orders.withColumn("horizon", F.col("o_orderstatus"))), 8)


@query(
    "roc_curve",
    f"""
    WITH {SCORED_SQL}, t AS (SELECT proba, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM s GROUP BY 1)
    SELECT proba AS threshold, round(sum(n) OVER w / sum(n) OVER (), 8) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 8) AS tpr
    FROM t WINDOW w AS (ORDER BY proba DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def roc_curve(t: Tables) -> DataFrame:
    curve = ev.roc_curve(scored(t), probe=t.orders)
    return rounded(curve, 8, ("fpr", "tpr"))


@query(
    "mae_mse",
    f"""
    WITH {SCORED_SQL}
    SELECT horizon, round(avg(abs(actual_return - 20 * proba)), 6) AS mae, round(avg(power(actual_return - 20 * proba, 2)), 6) AS mse FROM s GROUP BY 1
    """,
)
def mae_mse(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("estimate", 20 * F.col("proba"))
    return rounded(ev.regression_errors(rows, "actual_return", "estimate", ["horizon"]), 6)


@query(
    "direction_accuracy",
    f"""
    WITH {SCORED_SQL}, d AS (SELECT CASE WHEN actual_return * (proba - 0.5) > 0 THEN 1 ELSE 0 END AS correct FROM s)
    SELECT correct, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_percent FROM d GROUP BY 1
    """,
)
def direction_accuracy(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("estimate", F.col("proba") - 0.5)
    return rounded(ev.direction_accuracy(rows, "actual_return", "estimate"), 6)


@query(
    "threshold_sweep",
    f"""
    WITH {SCORED_SQL}, c AS (SELECT CASE WHEN actual_return >= 0.1 THEN 1 ELSE 0 END AS gained, proba FROM s),
    h AS (SELECT gained, t AS threshold, count(*) FILTER (WHERE proba >= t) AS n_selected
          FROM c, (SELECT CAST(unnest([0.55, 0.60, 0.65, 0.70, 0.75, 0.80]) AS DOUBLE) AS t) GROUP BY 1, 2)
    SELECT gained, threshold, n_selected, round(100.0 * n_selected / nullif(sum(n_selected) OVER (PARTITION BY threshold), 0), 6) AS share_percent FROM h
    """,
)
def threshold_sweep(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("gained", (F.col("actual_return") >= 0.1).cast("int"))
    return rounded(ev.threshold_sweep(rows, "gained"), 6, ("share_percent",))


@query(
    "precision_vs_zero",
    f"""
    WITH {SCORED_SQL}, c AS (SELECT CASE WHEN actual_return >= 0.1 THEN 1 ELSE 0 END AS gained, pred FROM s)
    SELECT gained, CAST(sum(pred) AS BIGINT) AS n_predicted, round(100.0 * sum(pred) / sum(sum(pred)) OVER (), 6) AS share_percent FROM c GROUP BY 1
    """,
)
def precision_vs_zero(t: Tables) -> DataFrame:
    return rounded(ev.precision_vs_gain(scored(t), "actual_return"), 6)


@query(
    "realised_returns",
    f"""
    WITH {SCORED_SQL}
    SELECT label || ' ' || pred AS outcome, round(avg(actual_return), 6) AS mean, round(median(actual_return), 6) AS median,
           round(min(actual_return), 6) AS min, round(max(actual_return), 6) AS max FROM s GROUP BY 1
    """,
)
def realised_returns(t: Tables) -> DataFrame:
    return rounded(ev.realised_returns(scored(t), "label", "pred", "actual_return"), 6)


@query(
    "horizon_summary",
    f"""
    WITH {SCORED_SQL}, {CONFUSION_SQL}, {AUC_SQL}
    SELECT horizon, round_even(100.0 * tp / nullif(tp + fp, 0), 2) AS precision_percent, round_even(100 * auc, 2) AS auc_percent FROM m JOIN auc USING (horizon)
    """,
)
def horizon_summary(t: Tables) -> DataFrame:
    return ev.horizon_summary(scored(t))


SIX_SQL = SCORED_SQL.replace("o_orderstatus AS horizon", "CAST(30 * (o_orderkey % 6) + CASE WHEN o_orderkey % 6 = 0 THEN 15 ELSE 0 END AS INT) AS horizon")


@query(
    "horizon_table",
    f"""
    WITH {SIX_SQL}, {CONFUSION_SQL}, {AUC_SQL},
    e AS (SELECT horizon, avg(abs(actual_return - 20 * proba)) AS mae, avg(CASE WHEN actual_return * (proba - 0.5) > 0 THEN 1.0 ELSE 0.0 END) AS up FROM s GROUP BY 1)
    SELECT horizon, round_even(100.0 * tp / nullif(tp + fp, 0), 2) AS precision_percent, round_even(100 * auc, 2) AS auc_percent,
           round_even(100 * mae, 2) AS mae_percent, round_even(100 * up, 2) AS direction_percent
    FROM m JOIN auc USING (horizon) JOIN e USING (horizon)
    """,
)
def horizon_table(t: Tables) -> DataFrame:
    """Classifier and regression measures side by side for the six horizons."""
    sixth = F.col("row_id") % 6
    rows = scored(t).withColumn("horizon", (30 * sixth + F.when(sixth == 0, 15).otherwise(0)).cast("int"))
    away = rows.withColumns({"estimate": 20 * F.col("proba"), "turn": F.col("proba") - 0.5})
    errors = ev.regression_summary(away, "actual_return", "estimate").select("horizon", "mae_percent")
    turns = ev.regression_summary(away, "actual_return", "turn").select("horizon", "direction_percent")
    return ev.horizon_summary(rows).join(errors, "horizon").join(turns, "horizon")


@query(
    "buy_signal_series",
    f"""
    WITH {SCORED_SQL}, b AS (SELECT DISTINCT stock FROM s WHERE proba >= 0.95)
    SELECT row_id, stock, date, price, CASE WHEN proba >= 0.95 THEN 1 ELSE 0 END AS signal,
           lead(price, 2) OVER (PARTITION BY stock ORDER BY date, row_id) AS price_ahead FROM s WHERE stock IN (SELECT stock FROM b)
    """,
)
def buy_signal_series(t: Tables) -> DataFrame:
    rows = scored(t).select("row_id", "stock", "date", "price", "proba")
    axis = Axis.of("stock", ["date", "row_id"])
    return ev.buy_signals(rows, axis, price="price", threshold=0.95, ahead=2).drop("proba")
