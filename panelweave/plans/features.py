"""Domain features: prices, earnings, forecasts, statements, ratios and macro series.

Every function takes and returns frames keyed by ``stock`` and ``date`` (or
``series_id`` and ``date`` for macro series) and works on all securities at once.
Dates are DATE, amounts DOUBLE, missing is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions.scalars import (
    blank_non_finite,
    flag,
    percent_gap,
    ratio,
    shift_years,
    split_ratio,
    to_day,
    to_number,
)
from panelweave.operators.asof import Source, align, asof_join, value_days_ago
from panelweave.operators.relational import (
    dedup_statements,
    keep_first_per,
    override_for_keys,
    shift_repeated_dates,
)
from panelweave.operators.timeline import FITS, UNKNOWN, Axis, fill, rolling
from panelweave.operators.windows import change_points, cumulative_product, densify, pct_change, sma_trend

# Days before the report at which an estimate was taken, and its column.
ESTIMATE_AGES = {
    0: "earningsEstimateAvg",
    7: "epsTrend7daysAgo",
    30: "epsTrend30daysAgo",
    60: "epsTrend60daysAgo",
    90: "epsTrend90daysAgo",
}

# Ratio column and the name of its year-over-year change.
YOY_NAMES = {
    "ROE": "YoY_ROE",
    "LTDE": "YoY_LTDE",
    "DE": "YoY_DE",
    "CR": "YoY_CR",
    "GM": "YoY_GM",
    "ROA": "YoY_ROA",
    "DPR": "YoY_DPR",
    "Acc_Rec_Pay_Ration": "YoY_AR_Ration",
    "ES": "YoY_ES",
    "Piotroski_Score": "YoY_Piotroski",
    "PE": "YoY_PE",
    "PB": "YoY_PB",
    "PEG_Forward": "YoY_PEGF",
    "PEG_Backwards": "YoY_PEGB",
    "DY": "YoY_DY",
}

FIRST_DAY = "0001-01-01"  # before any price
STOCK_DAYS = Axis.of("stock", "date", size=FITS)  # only for frames aggregated to stock and day
STOCK_ROWS = Axis.of("stock", "date")


# --- splits and prices --------------------------------------------------------------


def split_factors(splits: DataFrame) -> DataFrame:
    """(stock, date, factor): what prices of the days before ``date`` are multiplied with.

    The factor of a split is from/to times the factors of all later splits. Malformed
    texts have no effect.
    """
    parsed = splits.select("stock", to_day("date").alias("date"), split_ratio("split").alias("coef"))
    per_day = parsed.dropna().groupBy("stock", "date").agg(F.product("coef").alias("coef"))
    return cumulative_product(per_day, STOCK_DAYS, "coef", out="factor").drop("coef")


def known_factors(factors: DataFrame) -> DataFrame:
    """(stock, date, factor) as events that hold from their day on: on a split's day the product of the strictly later splits.

    The first event of a stock, with all its splits, lies before any price. So a fill from the
    past serves prices and everything else that is aligned with them.
    """
    ahead = F.coalesce(F.lead("factor", 1).over(STOCK_DAYS.window), F.lit(1.0))
    later = factors.select("stock", "date", ahead.alias("factor"))
    return later.unionAll(factors.groupBy("stock").agg(F.lit(FIRST_DAY).cast("date").alias("date"), F.min_by("factor", "date").alias("factor")))


def split_factor_on(
    rows: DataFrame, factors: DataFrame, time: str = "date", out: str = "factor", size: str = UNKNOWN
) -> DataFrame:
    """Rows with the factor valid on their day: that of the next split, 1 after the last."""
    named = factors.select("stock", F.col("date").alias("_split_day"), F.col("factor").alias(out))
    joined = align(rows, [Source(named, "_split_day", (out,), when="later")], keys=["stock"], time=time, size=size)
    return joined.fillna(1.0, subset=[out])


def split_adjusted_prices(prices: DataFrame, factors: DataFrame, size: str = UNKNOWN) -> DataFrame:
    """Open, high, low and close on today's share basis; volume as traded."""
    priced = split_factor_on(prices, factors, size=size)
    return adjust_ohlc(priced).drop("factor")


def adjust_ohlc(priced: DataFrame) -> DataFrame:
    return priced.withColumns({c: F.col(c) * F.col("factor") for c in ("open", "high", "low", "close")})


def price_trend(prices: DataFrame, axis: Axis = STOCK_ROWS) -> DataFrame:
    """50 and 200 row price averages over trading rows: slope, distance, and their ratio."""
    return sma_trend(prices, axis, "close", (50, 200), prefix="price")


# --- earnings -----------------------------------------------------------------------


def eps_surprise(history: DataFrame, size: str = UNKNOWN) -> DataFrame:
    """Reported quarters with actual and estimate filled from each other.

    A second quarter reported on the same day moves to the next day. Quarters with
    neither number are left out.
    """
    typed = history.select(
        "stock",
        to_day("date").alias("date"),
        to_day("reportDate").alias("reportDate"),
        to_number("epsActual").alias("epsActual"),
        to_number("epsEstimate").alias("epsEstimate"),
    )
    moved = shift_repeated_dates(typed, ["stock"], "reportDate", ["date"], probe=history.select("stock", F.col("reportDate")), size=size)
    both = moved.withColumns(
        {
            "epsActual": F.coalesce("epsActual", "epsEstimate"),
            "epsEstimate": F.coalesce("epsEstimate", "epsActual"),
        }
    ).filter(F.col("epsEstimate").isNotNull())
    return both.withColumns(
        {
            "epsDifference": F.col("epsActual") - F.col("epsEstimate"),
            "surprisePercent": percent_gap("epsActual", "epsEstimate"),
        }
    )


def forecast_growth(trend: DataFrame, history: DataFrame, factors: DataFrame) -> DataFrame:
    """Expected year-over-year growth of a quarter, as seen 0, 7, 30, 60 and 90 days before.

    Estimates are brought to today's share basis with the split factor of the day they
    were made. One row per stock and quarter: PG_0, PG_7, PG_30, PG_60, PG_90.
    """
    names = list(ESTIMATE_AGES.values())
    typed = trend.select(
        "stock", to_day("date").alias("date"),
        to_number("earningsEstimateYearAgoEps").alias("year_ago"),
        *[to_number(c).alias(c) for c in names],
    ).filter(F.col("date").isNotNull())
    typed = keep_first_per(typed, ["stock", "date"], names)
    reports = history.select("stock", to_day("date").alias("date"), to_day("reportDate").alias("reportDate"))
    reports = reports.groupBy("stock", "date").agg(F.min("reportDate").alias("reportDate"))
    known = typed.join(reports, ["stock", "date"], "left")

    cells = F.array(*[F.struct(F.lit(a).alias("age"), F.col(c).alias("estimate")) for a, c in ESTIMATE_AGES.items()])
    long = known.select("stock", "date", "year_ago", "reportDate", F.inline(cells)).withColumn(
        "seen", F.date_sub("reportDate", F.col("age"))
    )
    on_basis = split_factor_on(long, factors, time="seen", size=FITS)  # a handful of rows per stock and quarter
    wide = on_basis.groupBy("stock", "date").agg(
        F.max(F.when(F.col("age") == 0, F.col("year_ago") * F.col("factor"))).alias("_year_ago"),
        *[F.max(F.when(F.col("age") == a, F.col("estimate") * F.col("factor"))).alias(f"_e{a}") for a in ESTIMATE_AGES],
    )
    return wide.select(
        "stock", "date", *[percent_gap(f"_e{a}", "_year_ago").alias(f"PG_{a}") for a in ESTIMATE_AGES]
    )


def dated_estimates(
    rows: DataFrame, values: Mapping[int, str], anchor: str, as_of: Column, out: str
) -> DataFrame:
    """(stock, date, value): each estimate placed the given days before its anchor date.

    Where several fall on one day the one made longest before its report wins; of equally old
    ones that for the later report, then the larger. Nothing after ``as_of`` is known.
    """
    cells = F.array(*[F.struct(F.lit(a).alias("age"), F.col(c).alias("value")) for a, c in values.items()])
    long = rows.select("stock", F.col(anchor).alias("_anchor"), F.inline(cells))
    placed = long.withColumn("date", F.date_sub("_anchor", F.col("age"))).filter(
        F.col("value").isNotNull() & (F.col("date") <= as_of)
    )
    return placed.groupBy("stock", "date").agg(F.max(F.struct("age", "_anchor", "value"))["value"].alias(out))


def forecast_timeline(history: DataFrame, growth: DataFrame, as_of: Column, oldest: int = 90) -> DataFrame:
    """Days on which the growth forecast changed, with the step from the forecast before.

    Sparse: one row per change. Align it with a panel to get daily values. Steps without
    a predecessor are left out. ``oldest`` is where the 90-day-old estimate is placed.
    """
    reports = history.select("stock", "date", "reportDate")
    joined = reports.join(growth, ["stock", "date"])
    places = {oldest if a == 90 else a: f"PG_{a}" for a in ESTIMATE_AGES}
    events = dated_estimates(joined, places, "reportDate", as_of, "YoY_Proj_Growth")
    step = lambda w: {
        "forecasts_diff": F.col("YoY_Proj_Growth") - F.lag("YoY_Proj_Growth", 1).over(w)
    }
    return rolling(events, STOCK_DAYS, step, before=1).filter(F.col("forecasts_diff").isNotNull())


def long_forecast_events(long_trend: DataFrame, factors: DataFrame, as_of: Column) -> DataFrame:
    """Estimates for the year ahead, dated to when they were made: (stock, date, frcst_1y)."""
    typed = (
        long_trend.filter(F.col("period") == "+1y")
        .select(
            "stock", shift_years(to_day("date"), -1).alias("made"),
            *[to_number(c).alias(c) for c in ESTIMATE_AGES.values()],
        )
    )
    events = dated_estimates(typed, ESTIMATE_AGES, "made", as_of, "_raw")
    return split_factor_on(events, factors, size=FITS).select(
        "stock", "date", (F.col("_raw") * F.col("factor")).alias("frcst_1y")
    )


def real_eps_events(trend: DataFrame, history: DataFrame, factors: DataFrame) -> DataFrame:
    """Yearly earnings actually reached, dated to their report: (stock, date, real_EPS)."""
    yearly = trend.filter(F.col("period").contains("y")).select(
        "stock", shift_years(to_day("date"), -1).alias("date"),
        to_number("earningsEstimateYearAgoEps").alias("raw"),
    )
    reports = history.select("stock", to_day("date").alias("date"), to_day("reportDate").alias("reportDate"))
    dated = yearly.join(reports, ["stock", "date"]).withColumn("_basis_day", shift_years("reportDate", 1))
    on_basis = split_factor_on(dated.drop("date"), factors, time="_basis_day", size=FITS)  # a row per stock and year
    return (
        on_basis.withColumn("real_EPS", F.col("raw") * F.col("factor"))
        .filter(F.col("real_EPS").isNotNull())
        .groupBy("stock", F.col("reportDate").alias("date"))
        .agg(F.max("real_EPS").alias("real_EPS"))
    )


def long_forecast_change(days: DataFrame, estimates: DataFrame, real: DataFrame, size: str = UNKNOWN) -> DataFrame:
    """Expected change in percent of the year-ahead earnings against those reached."""
    aligned = align(
        days,
        [Source(estimates, "date", ("frcst_1y",)), Source(real, "date", ("real_EPS",))],
        keys=["stock"], time="date", size=size,
    )
    return expected_change(aligned)


def expected_change(aligned: DataFrame) -> DataFrame:
    return aligned.withColumn("1Y_expect_Change", percent_gap("frcst_1y", "real_EPS")).drop("frcst_1y", "real_EPS")


# --- statements and ratios ----------------------------------------------------------


def statement_source(frame: DataFrame, columns: Sequence[str], name: str) -> Source:
    """A statement table as events of its filing dates: numbers parsed, repeated filings resolved."""
    typed = frame.select(
        "stock", to_day("date").alias("date"), to_day("filing_date").alias("filing_date"),
        *[to_number(c).alias(c) for c in columns],
    )
    unique = dedup_statements(typed, ["stock"], "filing_date", "date")
    return Source(unique.drop("date"), "filing_date", tuple(columns), stamp=f"filing_date_{name}")


def statement_asof(days: DataFrame, sources: Sequence[Source], clock: str, size: str = UNKNOWN) -> DataFrame:
    """Panel days with the statements known on them; unknown amounts are 0.

    ``clock`` is the stamp column that ``days_after_report`` counts from.
    """
    aligned = align(days, sources, keys=["stock"], time="date", size=size)
    return settle_statements(aligned, sources, clock)


def settle_statements(aligned: DataFrame, sources: Sequence[Source], clock: str) -> DataFrame:
    amounts = [c for s in sources for c in s.columns]
    return aligned.fillna(0.0, subset=amounts).withColumn(
        "days_after_report", F.datediff("date", F.col(clock))
    )


def kpi_ratios(roe_on_assets: bool = False) -> dict[str, Column]:
    """Ratios from statement amounts and the close.

    Return on equity divides by assets less liabilities; ``roe_on_assets=True`` divides
    by all assets instead.
    """
    c = F.col
    equity = c("totalAssets") if roe_on_assets else c("totalAssets") - c("totalLiab")
    long_term_base = c("totalAssets") - c("shortLongTermDebtTotal")
    shares = c("commonStockSharesOutstanding")
    paid = F.abs(c("dividendsPaid"))
    per_share_book = ratio(c("totalAssets") - c("totalLiab"), shares)
    return {
        "ROE": ratio("netIncome", equity),
        "LTDE": ratio("longTermDebt", long_term_base),
        "DE": ratio(c("shortTermDebt") + c("longTermDebt"), long_term_base),
        "CR": ratio("totalCurrentAssets", "totalCurrentLiabilities"),
        "GM": ratio(c("totalRevenue") - c("costOfRevenue"), "totalRevenue"),
        "ROA": ratio("netIncome", "totalAssets"),
        "DPR": ratio(paid, "netIncome"),
        "Acc_Rec_Pay_Ration": ratio("netReceivables", "accountsPayable"),
        "ES": F.try_divide(100.0 * ratio("netIncome", shares), c("close")),
        "DY": F.try_divide(400.0 * ratio(paid, shares), c("close")),
        "asset_turnover": ratio("totalRevenue", "totalAssets"),
        "PB": F.try_divide(c("close"), per_share_book),
    }


def earnings_ratios() -> dict[str, Column]:
    """Price to yearly earnings, and that grown by the expected changes (in percent)."""
    c = F.col
    pe = F.try_divide(c("close"), 4.0 * c("epsActual"))
    return {
        "PE": pe,
        "PEG_Forward": pe * (1.0 + c("1Y_expect_Change")),
        "PEG_Backwards": pe * (1.0 + c("YoY_Proj_Growth")),
    }


def piotroski_score(df: DataFrame, keys: Sequence[str] = ("stock",), time: str = "date", size: str = UNKNOWN) -> DataFrame:
    """Sum of nine 0/1 signals, four of them against the values known 365 days ago.

    An unknown comparison counts 0; unknown share issuance counts 1.
    """
    compared = ("longTermDebt", "CR", "GM", "asset_turnover")
    old = {c: f"_ago_{c}" for c in compared}
    with_past = value_days_ago(df, keys=keys, time=time, columns=old, days=365, mode="asof", size=size)
    c = F.col
    signals = [
        flag(c("netIncome") >= 0),
        flag(c("ROA") >= 0),
        flag(c("totalCashFromOperatingActivities") >= 0),
        flag(c("totalCashFromOperatingActivities") >= c("netIncome")),
        flag(c("longTermDebt") <= c("_ago_longTermDebt")),
        flag(c("CR") >= c("_ago_CR")),
        flag(c("GM") >= c("_ago_GM")),
        flag(c("asset_turnover") >= c("_ago_asset_turnover")),
        1 - flag(c("issuanceOfCapitalStock") > 0),
    ]
    total = signals[0]
    for s in signals[1:]:
        total = total + s
    return with_past.withColumn("Piotroski_Score", total).drop(*old.values())


def known_kpis(df: DataFrame, columns: Sequence[str], zero_is_missing: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """The frame with the usable values of the ratios beside them, and the names of these: zero and non-finite ones are missing."""
    known = {c: f"_known_{c}" for c in columns}
    return df.withColumns({k: blank_non_finite(c, zero_is_missing) for c, k in known.items()}), known


def kpi_gap_fill(
    df: DataFrame, axis: Axis, columns: Sequence[str], zero_is_missing: bool = True, probe: DataFrame | None = None,
    known: Mapping[str, str] | None = None,
) -> DataFrame:
    """Zero and non-finite ratios become missing, then the last known value is carried on.

    ``known`` names the columns of ``known_kpis`` where the frame has them already.
    """
    if known is not None:
        return fill(df, axis, {known[c]: c for c in columns}, probe=probe)
    blanked = df.withColumns({c: blank_non_finite(c, zero_is_missing) for c in columns})
    return fill(blanked, axis, columns, probe=probe)


def yoy_kpis(
    df: DataFrame, axis: Axis, names: Mapping[str, str] = YOY_NAMES, unit: str = "days", periods: int = 365, probe=None,
    known: Mapping[str, str] | None = None,
) -> DataFrame:
    """Year-over-year change in percent of every ratio, all in one window; ``known`` as in ``kpi_gap_fill``."""
    wanted = {out: (src, periods) for src, out in names.items()}
    return pct_change(df, axis, wanted, unit=unit, probe=probe, known=known)


# --- macro --------------------------------------------------------------------------


def macro_trend(
    series: DataFrame,
    *,
    value: str = "value",
    changes: Mapping[str, int] | None = None,
    lengths: Sequence[int] = (50, 200),
    against: str = "value",
    scale: float = 1.0,
) -> DataFrame:
    """Daily macro series with percent changes and moving-average trend, per ``series_id``.

    ``series`` has one row per series and day (see ``windows.densify``). Averages look
    back only.
    """
    axis = Axis.of("series_id", "date", size=FITS)
    changed = pct_change(series, axis, {o: (value, k) for o, k in (changes or {}).items()}) if changes else series
    return sma_trend(changed, axis, value, lengths, prefix="m", against=against, scale=scale)


# Names of the macro columns of the panel, by what they are made from.
VIX_NAMES = {"value": "VIX_high"}
ASSET_NAMES = {
    "Fed_Balance_YoY": "Fed_Balance_YoY",
    "m_sma50_vector": "Fed_SMA50_vector",
    "m_sma200_vector": "Fed_SMA200_vector",
    "m_sma50_position": "Fed_SMA50_position",
    "m_sma200_position": "Fed_SMA200_position",
    "m_sma50_to_200": "Fed_SMA50_to_200_position",
}
BOND_NAMES = {
    "value": "10YBond",
    "10YB_MoM": "10YB_MoM",
    "10YB_YoY": "10YB_YoY",
    "m_sma30_vector": "10YB_30MA_Vector",
    "m_sma200_vector": "10YB_200MA_Vector",
    "m_sma30_position": "10Y_Val_to_30MA",
    "m_sma200_position": "10Y_Val_to_200MA",
}


def macro_table(series: DataFrame, vix: str = "vix_high", assets: str = "cb_assets", bond: str = "bond10y") -> DataFrame:
    """One row per day with the volatility index, the central bank's balance and the bond yield with their trends.

    ``series`` is the long table (series_id, date, value), a row per series and day at most. Balance and
    yield are known on every day since their first, by their last value; the index on its own days only.
    """
    one = lambda name: series.filter(F.col("series_id") == name).select("series_id", "date", "value")
    last = series.agg(F.max("date").alias("date"))

    def daily(name: str) -> DataFrame:
        """Every day from the series' first to the last of any series."""
        known = one(name).unionAll(last.select(F.lit(name), "date", F.lit(None).cast("double")))
        return densify(known.groupBy("series_id", "date").agg(F.max("value").alias("value")), keys=["series_id"], time="date", columns=["value"])

    named = lambda df, names: df.select("date", *[F.col(c).alias(n) for c, n in names.items()])
    balance = macro_trend(daily(assets), changes={"Fed_Balance_YoY": 360})
    rates = macro_trend(daily(bond), changes={"10YB_MoM": 30, "10YB_YoY": 365}, lengths=(30, 200), against="average", scale=100.0)
    return named(one(vix), VIX_NAMES).join(named(balance, ASSET_NAMES), "date", "full").join(named(rates, BOND_NAMES), "date", "full")


def crisis_clock(days: DataFrame, event_days: DataFrame, time: str = "date") -> DataFrame:
    """Days since the last date of a list; null before the first.

    The list becomes a calendar (day -> last event on or before it) with one row per
    day between the first and the last event, which every panel day looks up by
    equality; days after the last event compare with that one date.
    """
    listed = event_days.select(F.col(time).cast("date").alias("_event")).distinct().dropna()
    # one row per listed day, at most one per calendar day
    following = F.lead("_event", 1).over(Window.orderBy("_event"))
    spans = listed.withColumn("_next", following).filter(F.col("_next").isNotNull())
    lookup = spans.select(
        F.explode(F.sequence("_event", F.date_sub("_next", 1))).alias(time), F.col("_event")
    )
    last = listed.agg(F.max("_event").alias("_last"))
    found = days.join(F.broadcast(lookup), time, "left").join(F.broadcast(last))  # a row per calendar day, and one row
    since = F.when(F.col(time) >= F.col("_last"), F.col("_last")).otherwise(F.col("_event"))
    return found.withColumn("days_after_crisis", F.datediff(F.col(time), since)).drop("_event", "_last").select(
        *days.columns, "days_after_crisis"
    )


# --- older panel --------------------------------------------------------------------


def current_ratio_backfill(df: DataFrame) -> DataFrame:
    """Missing current ratios from their parts; rows without liabilities go."""
    c = F.col
    assets = c("acctRec") + c("cashAndEq") + c("inventory") + c("taxAssets")
    liabilities = c("acctPay") + c("taxLiabilities") + c("deposits") + c("deferredRev")
    kept = df.filter(F.coalesce(liabilities != 0, F.lit(True)))
    return kept.withColumn("currentRatio", F.coalesce("currentRatio", F.try_divide(assets, liabilities)))


def dividend_events(
    statements: DataFrame, axis: Axis = STOCK_ROWS, announced_days: int = 60, probe: DataFrame | None = None
) -> DataFrame:
    """Changes of the dividend per share, dated to their announcement, with the change before."""
    per_share = statements.withColumn("div_per_share", F.try_divide("payDiv", "sharesBasic")).filter(
        F.col("div_per_share").isNotNull()
    )
    moved = change_points(per_share, axis, "div_per_share", probe=probe)
    return moved.select(
        "stock", F.date_sub("date", announced_days).alias("date"),
        F.col("change").alias("dividends_change"), F.col("prev_change").alias("prev_div_change"),
    )


def non_payers(df: DataFrame, amount: str) -> DataFrame:
    return df.groupBy("stock").agg(F.sum(amount).alias("_paid")).filter(F.coalesce("_paid", F.lit(0.0)) == 0).select("stock")


def dividend_change(panel: DataFrame, events: DataFrame, size: str = UNKNOWN) -> DataFrame:
    """Panel with dividend change, the change before, and days since the announcement.

    Stocks that never paid get 0, and days since the first day of the panel.
    """
    aligned = asof_join(
        panel, events, keys=["stock"], time="date", columns=["dividends_change", "prev_div_change"],
        whole_row=True, keep_time="_announced", size=size,
    ).withColumn("days_after_divid_report", F.datediff("date", "_announced")).drop("_announced")
    start = panel.agg(F.min("date").alias("_start"))
    dated = aligned.join(F.broadcast(start))  # exactly one row
    done = override_for_keys(
        dated, non_payers(panel, "divCash"), ["stock"],
        {
            "dividends_change": F.lit(0.0),
            "prev_div_change": F.lit(0.0),
            "days_after_divid_report": F.datediff("date", "_start"),
        },
    )
    return done.drop("_start")
