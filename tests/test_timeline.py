"""Long and short series must give the same results, whatever order and layout the input has."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweave.operators.timeline import Axis, fill, full_mean, number_rows, rolling, running, spread_join
from panelweave.session import DEFAULT_GROUP_ROWS, GROUP_ROWS

AXIS = Axis.of("k", ["t", "id"])


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    data = []
    for i in range(120):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randrange(12)}"
        value = None if rng.random() < 0.4 else float(rng.randrange(1, 9))
        data.append((i, key, rng.randrange(25), value))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id int, k string, t int, v double")


def both_ways(spark, build):
    plain = rows(build(), "id")
    spark.conf.set(GROUP_ROWS, "4")
    try:
        cut = rows(build(), "id")
    finally:
        spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))
    return plain, cut


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_fill(spark, frame, direction):
    plain, cut = both_ways(spark, lambda: fill(frame, AXIS, {"v": "w"}, direction))
    assert plain == cut and len(plain) == 120


def test_fill_twice_changes_nothing(spark, frame, tiny_groups):
    once = fill(frame, AXIS, ["v"])
    assert rows(once, "id") == rows(fill(once, AXIS, ["v"]), "id")


def test_rolling_reaches_over_chunk_borders(spark, frame):
    def build():
        first = lambda w: {"back": F.lag("v", 2).over(w), "ahead": F.lead("v", 3).over(w), "mean": full_mean("v", 3, w)}
        second = lambda w: {"step": F.col("mean") - F.lag("mean", 1).over(w)}
        return rolling(frame, AXIS, first, second, before=4, after=3)

    plain, cut = both_ways(spark, build)
    assert plain == cut


def test_rolling_further_than_a_chunk(spark, frame):
    plain, cut = both_ways(spark, lambda: rolling(frame, AXIS, lambda w: {"far": F.lag("id", 9).over(w)}, before=9))
    assert plain == cut


@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_running(spark, frame, direction):
    totals = {"s": ("sum", "v"), "n": ("count", F.lit(1)), "p": ("product", "v")}
    plain, cut = both_ways(spark, lambda: running(frame, AXIS, totals, direction))
    assert [r[:6] for r in plain] == [r[:6] for r in cut]
    assert [r[6] for r in plain] == [pytest.approx(r[6]) if r[6] is not None else None for r in cut]


def test_number_rows_is_the_sorted_position(spark, frame):
    numbered = rows(number_rows(frame, ["t", "id"]).select("t", "id", "_pos"), "_pos")
    assert [(t, i) for t, i, _ in numbered] == sorted((t, i) for t, i, _ in numbered)
    assert [p for _, _, p in numbered] == list(range(120))


def test_layout_of_the_input_does_not_matter(spark, frame, tiny_groups):
    one = rows(fill(frame.coalesce(1), AXIS, ["v"]), "id")
    many = rows(fill(frame.repartition(7, "t"), AXIS, ["v"]), "id")
    assert one == many


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join(spark, frame, how):
    side = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, x int")
    plain, cut = both_ways(spark, lambda: spread_join(frame, side, ["k"], how))
    assert plain == cut


def test_fill_looking_ahead_does_not_shrink_a_frame(spark, frame):
    plan = fill(frame, AXIS, ["v"], "backward")._jdf.queryExecution().toString()
    assert "unboundedfollowing" not in plain_text(plan)


def plain_text(plan):
    return plan.lower().replace(" ", "").replace("$", "")
