"""The feature panel: building, cleaning and labelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.asof import Source, align
from panelweave.operators.timeline import FITS, LONG, UNKNOWN, Axis, checked_broadcast, long_series_keys, split_by_keys
from panelweave.operators.windows import carry_last_change, every_nth_row, forward_returns, label_horizons, pct_change
from panelweave.plans import features as ft
from panelweave.session import pin

# Statement columns the ratios use.
BALANCE_COLUMNS = (
    "totalAssets", "totalLiab", "totalCurrentAssets", "totalCurrentLiabilities", "longTermDebt",
    "shortTermDebt", "shortLongTermDebtTotal", "netReceivables", "accountsPayable",
    "commonStockSharesOutstanding",
)
CASHFLOW_COLUMNS = ("netIncome", "dividendsPaid", "totalCashFromOperatingActivities", "issuanceOfCapitalStock")
INCOME_COLUMNS = ("totalRevenue", "costOfRevenue")

# Label thresholds in percent per horizon, and an alternative set.
THRESHOLDS = {15: 4.112, 30: 6.18, 60: 9.25, 90: 11.53, 120: 13.77, 150: 15.95}
THRESHOLDS_ROUND = {15: 5.0, 30: 7.0, 60: 10.0, 90: 12.0, 120: 14.0, 150: 16.0}
# Thresholds of the older labels, on returns as fractions of close to close.
THRESHOLDS_FRACTION = {15: 0.038, 30: 0.059, 60: 0.093, 90: 0.122, 120: 0.148, 150: 0.173}

# Ratios in which zero means missing and the older value is carried on.
GAP_FILLED = (
    "ROE", "LTDE", "DE", "CR", "GM", "ROA", "DPR", "Acc_Rec_Pay_Ration", "ES", "DY",
    "Piotroski_Score", "PE", "PB", "PEG_Forward", "PEG_Backwards",
)

# Names of the earnings columns in the panel.
PANEL_NAMES = {
    "surprisePercent": "EPS_surprise",
    "YoY_Proj_Growth": "EPS_YoY_Growth",
    "forecasts_diff": "EPS_QoQ_frcst_diff",
    "1Y_expect_Change": "EPS_1Y_exp_Change",
}

# Columns of the panel beside the keys, before changes and outside series are added.
KEPT_COLUMNS = (
    "days_after_earnings_report", "open", "close", "sector", "industry", "ROE", "LTDE", "DE", "CR", "GM", "ROA", "DPR",
    "Acc_Rec_Pay_Ration", "ES", "DY", "Piotroski_Score", "PE", "PB", "PEG_Forward", "PEG_Backwards", "EPS_surprise",
    "EPS_YoY_Growth", "EPS_QoQ_frcst_diff", "EPS_1Y_exp_Change",
)

TARGETS = tuple(label_horizons())


@dataclass(frozen=True)
class Inputs:
    """Landed tables, one frame per entity, all stocks together. See FIXTURES.md."""

    prices: DataFrame
    splits: DataFrame
    earn_history: DataFrame
    earn_trend: DataFrame
    long_trend: DataFrame
    balance: DataFrame
    cashflow: DataFrame
    income: DataFrame
    general: DataFrame
    macro: DataFrame  # wide: one row per day, joined on date
    event_dates: DataFrame


@dataclass(frozen=True)
class Choices:
    """Where definitions differ: return on equity by all assets, zero ratios taken as missing, yearly changes
    by ``days`` or by ``rows``, and the days before a report at which its 90-day-old estimate is placed."""

    roe_on_assets: bool = False
    zero_is_missing: bool = True
    yearly_by: str = "days"
    oldest_estimate: int = 90


def build_panel(
    inputs: Inputs, *, as_of: Column, start: str = "2000-01-01", vix: str | None = "VIX_high",
    keep: Sequence[str] | None = KEPT_COLUMNS, choices: Choices = Choices(), size: str = UNKNOWN,
) -> DataFrame:
    """All features and forward returns for all stocks, as one job.

    Splits, earnings, forecasts and the three statements are aligned with the prices in
    one pass, all by the last value known, so the panel is shuffled and sorted by stock and
    day once; all later windows share that order. Sector, macro series and event dates come in
    by broadcast. Stocks without any balance sheet or any estimate are left out. Stocks whose
    series are too long for one task are found once and built apart, unless ``size`` says that all fit,
    as after an aggregation to stock and day. ``keep`` are the columns
    that stay beside the keys before changes and outside series are added; None keeps all.
    """
    prices = inputs.prices
    found = None if size == FITS else long_series_keys(prices.select("stock"), ["stock"])
    shared = _shared_tables(inputs, as_of, choices)
    built = lambda rows, size: _panel_of(rows, inputs, shared, size, start, vix, keep, choices)
    if found is None:
        return built(prices, FITS)
    short, long = split_by_keys(prices, found, ["stock"])
    return built(short, FITS).unionByName(built(long, LONG))


def _shared_tables(inputs: Inputs, as_of: Column, choices: Choices) -> list[Source]:
    """Everything dated that the prices are aligned with. A few rows per stock each."""
    factors = pin(ft.split_factors(inputs.splits))  # read several times below, so stored once
    reports = ft.eps_surprise(inputs.earn_history, size=FITS)
    growth = ft.forecast_growth(inputs.earn_trend, inputs.earn_history, factors)
    present = lambda frame, name: Source(
        frame.select("stock").distinct().withColumns({"date": F.lit(ft.FIRST_DAY).cast("date"), name: F.lit(True)}), "date", (name,))
    return [
        Source(ft.known_factors(factors), "date", ("factor",)),
        Source(reports, "reportDate", ("surprisePercent", "epsActual"), stamp="_reported"),
        Source(
            ft.forecast_timeline(reports, growth, as_of, choices.oldest_estimate), "date", ("YoY_Proj_Growth", "forecasts_diff"), stamp="_forecast"
        ),
        Source(ft.long_forecast_events(inputs.long_trend, factors, as_of), "date", ("frcst_1y",)),
        Source(ft.real_eps_events(inputs.earn_trend, inputs.earn_history, factors), "date", ("real_EPS",)),
        ft.statement_source(inputs.cashflow, CASHFLOW_COLUMNS, "cashflow"),
        ft.statement_source(inputs.income, INCOME_COLUMNS, "income"),
        ft.statement_source(inputs.balance, BALANCE_COLUMNS, "balance"),
        present(inputs.balance, "_has_balance"),
        present(inputs.earn_trend, "_has_estimates"),
    ]


def _panel_of(
    prices: DataFrame, inputs: Inputs, shared: list[Source], size: str, start: str, vix: str | None, keep: Sequence[str] | None, choices: Choices
) -> DataFrame:
    axis = Axis.of("stock", "date", size)
    stocks = prices.select("stock").distinct()
    mine = shared if size == FITS else [replace(s, frame=s.frame.join(stocks, "stock", "left_semi")) for s in shared]
    statements = [s for s in mine if (s.stamp or "").startswith("filing_date_")]
    clocked = ft.crisis_clock(prices, inputs.event_dates)  # of the day alone, so looked up while rows are narrow
    aligned = align(clocked, mine, keys=["stock"], time="date", size=size).filter("_has_balance AND _has_estimates")
    adjusted = ft.adjust_ohlc(aligned.fillna(1.0, subset=["factor"])).drop("factor")
    settled = ft.settle_statements(adjusted, statements, "filing_date_cashflow").withColumns(
        {
            "days_after_earnings_report": F.datediff("date", "_reported"),
            "days_after_forecast_changed": F.datediff("date", "_forecast"),
        }
    )
    ratios = ft.expected_change(settled).withColumns(ft.kpi_ratios(choices.roe_on_assets)).withColumns(ft.earnings_ratios())

    # steps that wait for no other's window stand next to each other, so that they share one pass: first all but the score's ...
    score = "Piotroski_Score"
    seen, known = ft.known_kpis(ratios.withColumnsRenamed(PANEL_NAMES), [c for c in GAP_FILLED if c != score], choices.zero_is_missing)
    scored = ft.piotroski_score(seen, size=size)
    late = ("sector", "industry", "days_after_crisis")
    names = [c for c in (scored.columns if keep is None else ("stock", "date", *keep)) if c not in late]
    scored = scored.select(*names, "days_after_crisis", *[c for c in known.values() if c not in names])
    filled = ft.kpi_gap_fill(scored, axis, list(known), choices.zero_is_missing, known=known)
    yoy = lambda df, columns, values: ft.yoy_kpis(
        df, axis, {c: out for c, out in ft.YOY_NAMES.items() if c in columns}, choices.yearly_by, known=values)
    yearly, last = ft.known_kpis(yoy(filled, known, known), [score], choices.zero_is_missing)
    # ... then the score's and the step carried on
    begin = F.lit(start).cast("date")
    steps = carry_last_change(yearly, axis, "EPS_1Y_exp_Change", out="EPS_1Y_exp_Change_QoQ", after=begin)
    rated = yoy(ft.kpi_gap_fill(steps, axis, [score], choices.zero_is_missing, known=last), [score], last)
    traded = rated.filter((F.col("date") > begin) & F.col("PE").isNotNull() & (F.col("close") != 0)).drop(*known.values(), *last.values())

    labelled = forward_returns(traded, axis, label_horizons())

    # the macro table has one row per calendar day, which history bounds; the sector table has one per stock
    widened = labelled.join(F.broadcast(inputs.macro), "date", "left").join(
        checked_broadcast(inputs.general.select("stock", "sector", "industry")), "stock", "left"
    )
    moves = {"VIX_DoD": (vix, 1), "VIX_WoW": (vix, 5), "VIX_MoM": (vix, 22)} if vix else {}
    moved = pct_change(widened, axis, moves) if vix else widened
    outside = [c for c in inputs.macro.columns if c != "date"]
    columns = [*names, *ft.YOY_NAMES.values(), "EPS_1Y_exp_Change_QoQ", *label_horizons(), *outside, *late, *moves]
    return moved.select(*[c for c in columns if not c.startswith("_") and not c.startswith("filing_date_")])


# --- cleaning -----------------------------------------------------------------------

# One rule per step: ('need', columns) drops rows with a null in them, ('zero', columns)
# replaces nulls by 0, ('finite', ()) turns infinities into null everywhere.
_COMMON_HEAD = (
    ("need", ("EPS_surprise",)),
    ("zero", ("DY", "YoY_DPR", "DPR", "YoY_DY")),
    ("need", ("YoY_CR",)),
    ("zero", ("DE", "LTDE")),
    ("need", ("VIX_MoM",)),
    ("zero", ("Acc_Rec_Pay_Ration",)),
)
_COMMON_TAIL = (
    ("need", ("EPS_1Y_exp_Change",)),
    ("sector", ()),
    ("need", ("YoY_AR_Ration",)),
    ("finite", ()),
    ("need", ("EPS_1Y_exp_Change", "EPS_YoY_Growth", "EPS_QoQ_frcst_diff")),
)
RULES = {
    "train": (*_COMMON_HEAD, ("need", ("PEG_Forward", "PEG_Backwards")), *_COMMON_TAIL, ("need", ("Fed_Balance_YoY",))),
    "score": (*_COMMON_HEAD, ("need", ("PEG_Forward", "PEG_Backwards")), *_COMMON_TAIL, ("need", ("Fed_Balance_YoY",))),
    "validate": (*_COMMON_HEAD, ("need", ("PEG_Backwards",)), *_COMMON_TAIL),
}
# Columns that a mode leaves out in the end.
DROPPED = {
    "train": (),
    "score": ("close", "open", "industry", "days_after_crisis", *TARGETS),
    "validate": (
        "industry", "open", "close", "ROA", "YoY_ROE", "YoY_ROA", "LTDE", "PB", "YoY_LTDE", "YoY_DE",
        "YoY_PB", "YoY_AR_Ration", "10YB_30MA_Vector",
    ),
}
# Sector and industry the vendor leaves out.
KNOWN_SECTORS = {"GEN": ("Information Technology", "Software & Services")}


def clean_panel(
    df: DataFrame,
    mode: str = "train",
    *,
    rules: Sequence[tuple[str, Sequence[str]]] | None = None,
    sectors: Mapping[str, tuple[str, str]] = KNOWN_SECTORS,
    key: str = "stock",
    thin: int | None = None,
    time: str = "date",
    extra_need: Sequence[str] = (),
) -> DataFrame:
    """Apply the ordered cleaning rules. ``mode`` is train, score or validate.

    ``rules`` replaces the table of the mode, ``extra_need`` adds required columns and
    ``thin=5`` keeps the newest row per key and every fifth before it.
    """
    for kind, columns in [*(rules or RULES[mode]), ("need", tuple(extra_need))]:
        if kind == "need":
            df = df.dropna(subset=list(columns)) if columns else df
        elif kind == "zero":
            df = df.fillna(0.0, subset=list(columns))
        elif kind == "finite":
            numbers = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
            df = df.withColumns({c: ft.blank_non_finite(c) for c in numbers})
        elif kind == "sector":
            for stock, (sector, industry) in sectors.items():
                hit = F.col(key).cast("string") == stock
                df = df.withColumns(
                    {
                        "sector": F.when(hit, sector).otherwise(F.col("sector")),
                        "industry": F.when(hit, industry).otherwise(F.col("industry")),
                    }
                )
    if thin:
        df = every_nth_row(df, Axis.of(key, time), thin)
    return df.drop(*(DROPPED[mode] if rules is None else ()))


def cleaning_steps(mode: str = "train") -> list[tuple[str, Column]]:
    """The row filters of a mode as (name, condition), for ``stats.attrition_report``.

    Each condition holds for the rows that its step keeps: nulls that an earlier step replaced
    are none, and behind the step that blanks infinities those count as missing.
    """
    steps, replaced, blanked = [], set(), False
    for kind, columns in RULES[mode]:
        if kind == "zero":
            replaced |= set(columns)
        elif kind == "finite":
            blanked = True
        elif kind == "need":
            condition = F.lit(True)
            for c in columns:
                value = ft.blank_non_finite(c) if blanked else F.col(c)
                condition = condition & (F.lit(True) if c in replaced and not blanked else value.isNotNull())
            steps.append((" & ".join(columns), condition))
    return steps


def payer_flag(column: str = "DY") -> Column:
    """True for stocks with a dividend yield; an unknown yield counts as none."""
    return F.coalesce(F.col(column), F.lit(0.0)) != 0


def threshold_labels(df: DataFrame, thresholds: Mapping[str, float], suffix: str = "_label") -> DataFrame:
    """1 where the return reaches the threshold of its horizon, else 0; unknown stays unknown."""
    return df.withColumns({f"{c}{suffix}": (F.col(c) >= F.lit(t)).cast("int") for c, t in thresholds.items()})


def horizon_thresholds(values: Mapping[int, float] = THRESHOLDS) -> dict[str, float]:
    return {f"future_{days}dprice_change": t for days, t in values.items()}


def latest_snapshot(df: DataFrame, as_of: Column, time: str = "date") -> DataFrame:
    """Rows of the as-of day of any frame. Of a written panel ``sources.files.read_day`` reads one year's folder only."""
    return df.filter(F.col(time) == as_of)

