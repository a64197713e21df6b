"""Hand-computed micro-frames for the domain features, and the panel's no-look-ahead rule."""

import contextlib
import io
import math
import re
from dataclasses import replace
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweave.operators.timeline import FITS, Axis
from panelweave.operators.windows import carry_last_change
from panelweave.plans import features as ft
from panelweave.plans import panel as pn
from panelweave.session import DEFAULT_GROUP_ROWS, GROUP_ROWS


def day(text):
    return F.lit(text).cast("date")


def test_split_factors(spark):
    splits = spark.createDataFrame(
        [("A", "2020-03-01", "2/1"), ("A", "2020-06-01", "4/1"), ("A", "2020-05-01", "junk"), ("A", "2020-06-01", "1/2")],
        "stock string, date string, split string",
    )
    factors = ft.split_factors(splits)
    assert [(str(d), f) for _, d, f in rows(factors, "date")] == [("2020-03-01", 0.25), ("2020-06-01", 0.5)]
    days = spark.createDataFrame([("A", "2020-02-29"), ("A", "2020-03-01"), ("A", "2020-06-01"), ("B", "2020-01-01")], "stock string, d string")
    days = days.select("stock", F.col("d").cast("date").alias("date"))
    assert [r[2] for r in rows(ft.split_factor_on(days, factors), "stock", "date")] == [0.25, 0.5, 1.0, 1.0]


def test_eps_surprise(spark):
    history = spark.createDataFrame(
        [
            ("A", "2020-03-31", "2020-05-01", "2.0", "1.0"),
            ("A", "2020-06-30", "2020-05-01", "3.0", "None"),
            ("A", "2020-09-30", "2020-11-01", "None", "4.0"),
            ("A", "2020-12-31", "2021-02-01", "None", "None"),
            ("A", "2021-03-31", "2021-05-01", "1.0", "0"),
        ],
        "stock string, date string, reportDate string, epsActual string, epsEstimate string",
    )
    got = rows(ft.eps_surprise(history).select("date", "reportDate", "epsActual", "epsEstimate", "surprisePercent"), "date")
    assert [(str(a), str(b), *rest) for a, b, *rest in got] == [
        ("2020-03-31", "2020-05-01", 2.0, 1.0, 100.0),
        ("2020-06-30", "2020-05-02", 3.0, 3.0, 0.0),
        ("2020-09-30", "2020-11-01", 4.0, 4.0, 0.0),
        ("2021-03-31", "2021-05-01", 1.0, 0.0, None),
    ]


def test_forecast_timeline_prefers_the_older_estimate_and_stops_at_as_of(spark):
    history = spark.createDataFrame([("A", date(2020, 3, 31), date(2020, 5, 1)), ("A", date(2020, 6, 30), date(2020, 7, 30))], "stock string, date date, reportDate date")
    growth = spark.createDataFrame(
        [("A", date(2020, 3, 31), 10.0, None, None, None, 5.0), ("A", date(2020, 6, 30), 30.0, None, None, None, 20.0)],
        "stock string, date date, PG_0 double, PG_7 double, PG_30 double, PG_60 double, PG_90 double",
    )
    got = rows(ft.forecast_timeline(history, growth, day("2020-07-01")), "date")
    # 2020-05-01 is both the first report and 90 days before the second: the older estimate wins
    assert [(str(d), g, s) for _, d, g, s in got] == [("2020-05-01", 20.0, 15.0)]


def test_statements_count_from_their_filing(spark):
    days = spark.createDataFrame([("A", date(2020, 5, d)) for d in (1, 10, 20)], "stock string, date date")
    statements = spark.createDataFrame(
        [("A", "2020-03-31", "2020-05-10", "100"), ("A", "2019-12-31", "2020-05-10", "50"), ("A", "2020-04-30", None, "7"), ("A", "2020-04-01", "2020-05-15", "None")],
        "stock string, date string, filing_date string, totalAssets string",
    )
    source = ft.statement_source(statements, ["totalAssets"], "balance")
    got = rows(ft.statement_asof(days, [source], "filing_date_balance").select("date", "totalAssets", "days_after_report"), "date")
    assert [r[1:] for r in got] == [(0.0, None), (50.0, 0), (50.0, 5)]


def test_crisis_clock(spark):
    events = spark.createDataFrame([(date(2020, 1, 10),), (date(2020, 1, 20),)], "date date")
    days = spark.createDataFrame([(date(2020, 1, d),) for d in (9, 10, 19, 20, 31)], "date date")
    assert [r[1] for r in rows(ft.crisis_clock(days, events), "date")] == [None, 0, 9, 0, 11]


def test_dividend_change(spark):
    quarters = spark.createDataFrame(
        [("A", date(2020, 3, 31), 10.0, 10.0), ("A", date(2020, 6, 30), 10.0, 10.0), ("A", date(2020, 9, 30), 20.0, 10.0), ("A", date(2020, 12, 31), 50.0, 10.0)],
        "stock string, date date, payDiv double, sharesBasic double",
    )
    panel = spark.createDataFrame(
        [("A", date(2020, 7, 1), 1.0), ("A", date(2020, 8, 2), 1.0), ("A", date(2020, 11, 3), 1.0), ("N", date(2020, 7, 11), 0.0)],
        "stock string, date date, divCash double",
    )
    got = rows(ft.dividend_change(panel, ft.dividend_events(quarters)).drop("divCash"), "stock", "date")
    assert [r[2:] for r in got] == [(None, None, None), (1.0, None, 1), (3.0, 1.0, 2), (0.0, 0.0, 10)]


def test_kpi_ratios_and_piotroski_survive_zero(spark):
    columns = [*pn.BALANCE_COLUMNS, *pn.CASHFLOW_COLUMNS, *pn.INCOME_COLUMNS, "close"]
    zero = spark.createDataFrame([("A", date(2020, 1, 1), *[0.0] * len(columns))], "stock string, date date, " + ", ".join(f"{c} double" for c in columns))
    done = ft.piotroski_score(zero.withColumns(ft.kpi_ratios()))
    row = done.first()
    assert row["CR"] is None and row["PB"] is None
    assert row["Piotroski_Score"] == 4  # income, cash, cash against income, no issuance


# --- the whole panel ----------------------------------------------------------------


def finance(spark, until=None):
    start = date(2018, 1, 1)
    days = [start + timedelta(days=i) for i in range(900) if (start + timedelta(days=i)).weekday() < 5]
    prices, history, trend, long_trend, statements = [], [], [], [], []
    for k, stock in enumerate(["AAA", "BBB"]):
        for i, d in enumerate(days):
            c = 100 + 10 * math.sin(i / 17 + k) + i / 20
            prices.append((stock, d, c - 1, c + 2, c - 2, c, 1000 + i))
        for q in range(11):
            end = date(2018 + q // 4, 3 * (q % 4) + 3, 30)
            report, filed = end + timedelta(days=25), end + timedelta(days=35)
            history.append((stock, str(end), str(report), str(1 + q / 10 + k), str(1 + q / 11)))
            trend.append((stock, str(end), "0y" if q % 4 == 3 else "0q", str(1.0 + k), *[str(1.5 + q / 10 + a / 50) for a in (0, 1, 2, 3, 4)]))
            long_trend.append((stock, str(end + timedelta(days=366)), "+1y", "1", *[str(2 + q / 10 + a / 40) for a in (0, 1, 2, 3, 4)]))
            statements.append((stock, str(end), str(filed), *[str(100 + 7 * q + 13 * j + k) for j in range(16)]))
    if until:
        prices = [p for p in prices if p[1] <= until]
        statements = [s for s in statements if s[2] <= str(until)]
        history = [h for h in history if h[2] <= str(until)]
    estimates = "earningsEstimateYearAgoEps string, " + ", ".join(f"{c} string" for c in ft.ESTIMATE_AGES.values())
    amounts = [*pn.BALANCE_COLUMNS, *pn.CASHFLOW_COLUMNS, *pn.INCOME_COLUMNS]
    make = spark.createDataFrame
    filed = make(statements, "stock string, date string, filing_date string, " + ", ".join(f"{c} string" for c in amounts))
    return pn.Inputs(
        prices=make(prices, "stock string, date date, open double, high double, low double, close double, volume long"),
        splits=make([("AAA", "2019-03-04", "2/1")], "stock string, date string, split string"),
        earn_history=make(history, "stock string, date string, reportDate string, epsActual string, epsEstimate string"),
        earn_trend=make(trend, f"stock string, date string, period string, {estimates}"),
        long_trend=make(long_trend, f"stock string, date string, period string, {estimates}"),
        balance=filed, cashflow=filed, income=filed,
        general=make([("AAA", "Tech", "Software")], "stock string, sector string, industry string"),
        macro=make([(d, 20 + i % 7 + 0.5) for i, d in enumerate(days)], "date date, VIX_high double"),
        event_dates=make([(date(2018, 12, 21),)], "date date"),
    )


@pytest.fixture(scope="module")
def panel(spark):
    return pn.build_panel(finance(spark), as_of=day("2020-06-30")).toPandas().sort_values(["stock", "date"])


def test_panel_values(spark, panel):
    a = panel[panel["stock"] == "AAA"].set_index("date")
    d = date(2019, 3, 1)
    raw = {r["date"]: r for r in finance(spark).prices.filter("stock = 'AAA'").collect()}
    assert a.loc[d, "close"] == pytest.approx(raw[d]["close"] * 0.5)
    assert a.loc[date(2019, 3, 4), "close"] == pytest.approx(raw[date(2019, 3, 4)]["close"])
    assert a.loc[d, "days_after_earnings_report"] == (d - date(2019, 1, 24)).days
    assert a.loc[d, "days_after_crisis"] == (d - date(2018, 12, 21)).days
    dates = sorted(raw)
    i = dates.index(date(2019, 6, 3))
    expected = 100 * (raw[dates[i + 22]]["close"] / raw[dates[i]]["open"] - 1)
    assert a.loc[dates[i], "future_30dprice_change"] == pytest.approx(expected)
    vix = [20 + j % 7 + 0.5 for j in range(len(dates))]
    assert a.loc[dates[i], "VIX_WoW"] == pytest.approx(100 * (vix[i] / vix[i - 5] - 1))
    # the statement filed 35 days after 2019-03-30 is the newest known on 2019-06-03
    q = 4
    revenue, cost = 100 + 7 * q + 13 * 14, 100 + 7 * q + 13 * 15
    assert a.loc[dates[i], "GM"] == pytest.approx((revenue - cost) / revenue)
    assert set(panel["sector"].dropna()) == {"Tech"}


def test_panel_has_no_look_ahead(spark, panel):
    until = date(2020, 1, 31)
    shorter = pn.build_panel(finance(spark, until), as_of=day("2020-06-30")).toPandas().sort_values(["stock", "date"])
    known = [c for c in shorter.columns if not c.startswith("future_")]
    full = panel[panel["date"] <= until][known].reset_index(drop=True)
    part = shorter[known].reset_index(drop=True)
    # forecasts dated by reports after the cut are the vendor's own look-ahead, so leave them out
    forecasts = [c for c in known if "forecast" in c or "frcst" in c or c in ("EPS_YoY_Growth", "PEG_Backwards", "YoY_PEGB")]
    import pandas as pd

    pd.testing.assert_frame_equal(full.drop(columns=forecasts), part.drop(columns=forecasts), check_dtype=False)


def test_panel_sorts_once_and_starts_few_jobs(spark):
    inputs = finance(spark)
    spark.sparkContext.setJobGroup("panel-build", "panel")
    try:
        built = pn.build_panel(inputs, as_of=day("2020-06-30"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("panel-build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        built.explain()
    sorts = [re.sub(r"#\d+", "", line) for line in told.getvalue().splitlines() if "Sort [stock" in line]
    # the plan is printed from its end: before the events are stacked with the prices nothing of the panel is sorted again
    assert "Sort [stock ASC NULLS FIRST, date ASC NULLS FIRST, _side ASC NULLS FIRST]" in sorts[0]
    assert sum("date ASC NULLS FIRST, _side ASC" in line for line in sorts) == 1


def test_panel_steps_share_their_windows(spark):
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        pn.build_panel(finance(spark), as_of=day("2020-06-30")).explain()
    lines = told.getvalue().splitlines()
    stacked = next(i for i, line in enumerate(lines) if re.search(r"Sort \[stock.*_side#\d+ ASC", line))
    # alignment, ratios with the step of the forecast, score with the carried step, returns, moves of the index; eight before
    assert sum("Window [" in line for line in lines[:stacked]) == 5


def test_panel_of_known_length_is_not_searched_for_long_series(spark, panel, monkeypatch):
    import pandas as pd

    def search(*args, **kwargs):
        raise AssertionError("prices were counted")

    monkeypatch.setattr(pn, "long_series_keys", search)
    built = pn.build_panel(finance(spark), as_of=day("2020-06-30"), size=FITS).toPandas().sort_values(["stock", "date"])
    pd.testing.assert_frame_equal(built.reset_index(drop=True)[list(panel.columns)], panel.reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("limit", ["3", "1000"])
def test_steps_and_changes_without_waiting_for_filters_and_fills(spark, limit):
    start = date(2020, 1, 1)
    values = [None, 1.0, 1.0, 0.0, 4.0, None, 8.0, 8.0, 2.0, None]
    df = spark.createDataFrame([(k, start + timedelta(days=i), v, v) for k in "AB" for i, v in enumerate(values)], "stock string, date date, ratio double, level double")
    axis, begin = Axis.of("stock", "date"), F.lit(start + timedelta(days=3))
    spark.conf.set(GROUP_ROWS, limit)
    try:
        late = F.col("date") > begin
        was = rows(carry_last_change(df.filter(late), axis, "level", out="step"), "stock", "date")
        assert rows(carry_last_change(df, axis, "level", out="step", after=begin).filter(late), "stock", "date") == was
        assert [r[4] for r in was[:6]] == [None, None, None, None, -6.0, -6.0]
        plain = ft.yoy_kpis(ft.kpi_gap_fill(df, axis, ["ratio"]), axis, {"ratio": "change"}, periods=2)
        seen, known = ft.known_kpis(df, ["ratio"])
        beside = ft.yoy_kpis(ft.kpi_gap_fill(seen, axis, ["ratio"], known=known), axis, {"ratio": "change"}, periods=2, known=known)
        assert rows(beside.select(plain.columns), "stock", "date") == rows(plain, "stock", "date")
    finally:
        spark.conf.set(GROUP_ROWS, str(DEFAULT_GROUP_ROWS))


def test_kept_columns_and_choices(spark, panel):
    outside = {"VIX_high", "VIX_DoD", "VIX_WoW", "VIX_MoM", "days_after_crisis", "EPS_1Y_exp_Change_QoQ"}
    assert set(panel.columns) == {"stock", "date", *pn.KEPT_COLUMNS, *ft.YOY_NAMES.values(), *pn.TARGETS, *outside}
    whole = pn.build_panel(finance(spark), as_of=day("2020-06-30"), keep=None)
    assert {"volume", "totalAssets", "asset_turnover"} <= set(whole.columns)
    other = pn.build_panel(finance(spark), as_of=day("2020-06-30"), choices=pn.Choices(roe_on_assets=True)).toPandas().sort_values(["stock", "date"])
    known = other["ROE"].notna().to_numpy()
    assert known.any() and (other["ROE"][known].to_numpy() == pytest.approx(other["ROA"][known].to_numpy()))


def test_stocks_without_balance_or_estimates_are_left_out(spark, panel):
    inputs = finance(spark)
    extra = inputs.prices.filter("stock = 'AAA'").withColumn("stock", F.lit("NONE"))
    wider = pn.build_panel(replace(inputs, prices=inputs.prices.unionByName(extra)), as_of=day("2020-06-30"))
    assert wider.count() == len(panel) and wider.filter("stock = 'NONE'").isEmpty()
    no_trend = replace(inputs, earn_trend=inputs.earn_trend.filter("stock != 'AAA'"))
    assert pn.build_panel(no_trend, as_of=day("2020-06-30")).filter("stock = 'AAA'").isEmpty()


def test_estimates_that_tie_have_one_order(spark):
    data = [("A", date(2020, 3, 31), 1.0, None), ("A", date(2020, 3, 31), 3.0, None), ("A", date(2020, 2, 29), None, 9.0), ("A", date(2020, 4, 30), 7.0, 2.0)]
    df = spark.createDataFrame(data, "stock string, at date, v0 double, v31 double")
    for parts in (1, 4):
        placed = ft.dated_estimates(df.repartition(parts), {0: "v0", 31: "v31"}, "at", day("2021-01-01"), "v")
        assert rows(placed, "date") == [("A", date(2020, 1, 29), 9.0), ("A", date(2020, 3, 30), 2.0), ("A", date(2020, 3, 31), 3.0), ("A", date(2020, 4, 30), 7.0)]


def test_macro_table_has_all_series(spark):
    days = [date(2019, 1, 1) + timedelta(days=i) for i in range(420)]
    data = [(s, d, float(i + k)) for k, s in ((10, "vix_high"), (100, "cb_assets"), (3, "bond10y")) for i, d in enumerate(days) if s != "cb_assets" or i % 7 == 0]
    table = ft.macro_table(spark.createDataFrame(data, "series_id string, date date, value double"))
    names = {"date", *ft.VIX_NAMES.values(), *ft.ASSET_NAMES.values(), *ft.BOND_NAMES.values()}
    assert set(table.columns) == names and table.count() == 420
    last = table.orderBy(F.desc("date")).first()
    assert last["10YBond"] == 422.0 and last["10YB_MoM"] == pytest.approx(100 * (422 / 392 - 1))
    assert last["10Y_Val_to_30MA"] == pytest.approx(100 * (422 - 407.5) / 422)
    assert last["Fed_Balance_YoY"] == pytest.approx(100 * ((100 + 413) / (100 + 56) - 1))  # both days take the week's value


def test_panel_is_the_same_when_series_are_cut_up(spark, panel):
    import pandas as pd

    spark.conf.set("spark.panelweave.maxGroupRows", "200")
    try:
        cut = pn.build_panel(finance(spark), as_of=day("2020-06-30")).toPandas().sort_values(["stock", "date"])
    finally:
        spark.conf.unset("spark.panelweave.maxGroupRows")
    pd.testing.assert_frame_equal(cut.reset_index(drop=True)[list(panel.columns)], panel.reset_index(drop=True), check_dtype=False)


def test_clean_panel_modes(spark):
    needed = sorted({c for rules in pn.RULES.values() for _, columns in rules for c in columns})
    full = {c: 1.0 for c in needed}
    data = [
        {"id": 1, **full}, {"id": 2, **full, "PEG_Forward": None}, {"id": 3, **full, "DY": None},
        {"id": 4, **full, "EPS_YoY_Growth": float("inf")}, {"id": 5, **full, "Fed_Balance_YoY": None},
    ]
    schema = "id int, stock string, sector string, industry string, " + ", ".join(f"{c} double" for c in needed)
    df = spark.createDataFrame([(r["id"], "GEN", None, None, *[r[c] for c in needed]) for r in data], schema)
    kept = {m: sorted(r["id"] for r in pn.clean_panel(df, m).collect()) for m in pn.RULES}
    assert kept == {"train": [1, 3], "score": [1, 3], "validate": [1, 2, 3, 5]}
    row = pn.clean_panel(df, "train").filter("id = 3").first()
    assert row["DY"] == 0.0 and row["sector"] == "Information Technology"
    assert "industry" not in pn.clean_panel(df, "score").columns


def test_three_sets_of_thresholds(spark):
    df = spark.createDataFrame([(4.5, 0.04), (5.0, 0.03), (None, None)], "future_15dprice_change double, older double")
    for values, want in ((pn.THRESHOLDS, [1, 1, None]), (pn.THRESHOLDS_ROUND, [0, 1, None])):
        labelled = pn.threshold_labels(df, {"future_15dprice_change": values[15]})
        assert [r["future_15dprice_change_label"] for r in labelled.collect()] == want
    older = pn.threshold_labels(df, {"older": pn.THRESHOLDS_FRACTION[15]})
    assert [r["older_label"] for r in older.collect()] == [1, 0, None]
    assert set(pn.THRESHOLDS) == set(pn.THRESHOLDS_ROUND) == set(pn.THRESHOLDS_FRACTION)
