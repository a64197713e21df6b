"""Domain features, the panel, its cleaning and its labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.catalog import landed
from panelweave.catalog.landed import (
    AMOUNTS_SQL, HISTORY_SQL, PRICES_SQL, QUARTERS_SQL, SPLITS_SQL, TREND_SQL,
)
from panelweave.catalog.registry import Tables, day, query, rounded
from panelweave.catalog.series import priority_days
from panelweave.operators.stats import attrition_report
from panelweave.operators.timeline import FITS, Axis
from panelweave.operators.windows import densify, forward_returns, label_horizons
from panelweave.plans import features as ft
from panelweave.plans import panel as pn

STOCK_DAYS = Axis.of("stock", "date", size=FITS)
AS_OF = "2001-06-30"


@query(
    "split_factor",
    f"""
    WITH {SPLITS_SQL}
    SELECT stock, date, round(product(coef) OVER (PARTITION BY stock ORDER BY date DESC
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS factor FROM splits
    """,
)
def split_factor(t: Tables) -> DataFrame:
    return rounded(ft.split_factors(landed.splits(t)), 6)


@query(
    "split_adjusted_prices",
    f"""
    WITH {SPLITS_SQL}, {PRICES_SQL},
    f AS (SELECT p.stock, p.date, coalesce(product(s.coef), 1) AS factor FROM p
          LEFT JOIN splits s ON s.stock = p.stock AND s.date > p.date GROUP BY 1, 2)
    SELECT p.stock, p.date, round(open * factor, 4) AS open, round(high * factor, 4) AS high, round(low * factor, 4) AS low,
           round(close * factor, 4) AS close, volume FROM p JOIN f ON p.stock = f.stock AND p.date = f.date
    """,
)
def split_adjusted_prices(t: Tables) -> DataFrame:
    return rounded(ft.split_adjusted_prices(landed.prices(t), ft.split_factors(landed.splits(t)), size=FITS))


@query(
    "price_trend",
    f"""
    WITH {PRICES_SQL},
    m AS (SELECT *, CASE WHEN count(close) OVER w5 = 50 THEN avg(close) OVER w5 END AS s50,
                 CASE WHEN count(close) OVER w2 = 200 THEN avg(close) OVER w2 END AS s200
          FROM p WINDOW w5 AS (PARTITION BY stock ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
                        w2 AS (PARTITION BY stock ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW))
    SELECT stock, date, round(100 * (s50 / nullif(lag(s50) OVER w, 0) - 1), 4) AS price_sma50_vector,
           round(100 * (s200 / nullif(lag(s200) OVER w, 0) - 1), 4) AS price_sma200_vector,
           round((s50 - close) / nullif(close, 0), 4) AS price_sma50_position,
           round((s200 - close) / nullif(close, 0), 4) AS price_sma200_position,
           round((s50 - s200) / nullif(s200, 0), 4) AS price_sma50_to_200
    FROM m WINDOW w AS (PARTITION BY stock ORDER BY date)
    """,
)
def price_trend(t: Tables) -> DataFrame:
    trend = ft.price_trend(landed.prices(t), STOCK_DAYS)
    return rounded(trend.drop("open", "high", "low", "close", "volume", "price_sma50", "price_sma200"))


@query(
    "eps_surprise",
    f"""
    WITH {QUARTERS_SQL}, {HISTORY_SQL},
    m AS (SELECT stock, date, "reportDate", coalesce(a, e) AS a, coalesce(e, a) AS e FROM h)
    SELECT stock, date, "reportDate", a AS "epsActual", e AS "epsEstimate", round(a - e, 6) AS "epsDifference",
           round(100 * (a - e) / nullif(e, 0), 4) AS "surprisePercent" FROM m WHERE e IS NOT NULL
    """,
)
def eps_surprise(t: Tables) -> DataFrame:
    done = ft.eps_surprise(landed.history(t))
    return rounded(rounded(done, 6, ("epsDifference",)), 4, ("surprisePercent",))


def _growth_sql() -> str:
    cells = ", ".join(
        f"e{k} * coalesce((SELECT product(s.coef) FROM splits s WHERE s.stock = tr.stock AND s.date > h.\"reportDate\" - {k}), 1) AS f{k}"
        for k in (0, 7, 30, 60, 90)
    )
    return f"""
    {QUARTERS_SQL}, {SPLITS_SQL}, {HISTORY_SQL}, {TREND_SQL},
    g AS (SELECT tr.stock, tr.date, h."reportDate" AS rd, {cells},
                 ya * coalesce((SELECT product(s.coef) FROM splits s WHERE s.stock = tr.stock AND s.date > h."reportDate"), 1) AS y
          FROM tr JOIN h ON h.stock = tr.stock AND h.date = tr.date),
    pg AS (SELECT stock, date, rd, """ + ", ".join(
        f'100 * (f{k} - y) / nullif(y, 0) AS "PG_{k}"' for k in (0, 7, 30, 60, 90)
    ) + " FROM g)"


GROWTH_SQL = _growth_sql()


@query(
    "forecast_growth",
    f"WITH {GROWTH_SQL} SELECT stock, date, " + ", ".join(f'round("PG_{k}", 7) AS "PG_{k}"' for k in (0, 7, 30, 60, 90)) + " FROM pg",
)
def forecast_growth(t: Tables) -> DataFrame:
    return rounded(ft.forecast_growth(landed.trend(t), landed.history(t), ft.split_factors(landed.splits(t))), 7)


TIMELINE_SQL = f"""
    {GROWTH_SQL},
    m AS (SELECT stock, date, "reportDate" FROM h WHERE a IS NOT NULL OR e IS NOT NULL),
    ev AS (SELECT pg.stock, pg.rd - k AS date, arg_max(v, k) AS growth
           FROM (SELECT stock, date, rd, unnest([0, 7, 30, 60, 90]) AS k, unnest(["PG_0", "PG_7", "PG_30", "PG_60", "PG_90"]) AS v FROM pg) pg
           JOIN m ON m.stock = pg.stock AND m.date = pg.date
           WHERE v IS NOT NULL AND pg.rd - k <= DATE '{AS_OF}' GROUP BY 1, 2),
    tl AS (SELECT stock, date, growth, growth - lag(growth) OVER (PARTITION BY stock ORDER BY date) AS diff FROM ev)
"""


@query(
    "forecast_timeline",
    f"""
    WITH {TIMELINE_SQL}
    SELECT stock, date, round(growth, 7) AS "YoY_Proj_Growth", round(diff, 7) AS forecasts_diff FROM tl WHERE diff IS NOT NULL
    """,
)
def forecast_timeline(t: Tables) -> DataFrame:
    factors = ft.split_factors(landed.splits(t))
    growth = ft.forecast_growth(landed.trend(t), landed.history(t), factors)
    return rounded(ft.forecast_timeline(ft.eps_surprise(landed.history(t)), growth, F.lit(AS_OF).cast("date")), 7)


LONG_SQL = f"""
    lt AS (SELECT stock, CAST(date - INTERVAL 1 YEAR AS DATE) AS made, unnest([0, 7, 30, 60, 90]) AS k,
                  unnest([e0, e7, e30, e60, e90]) AS v FROM tr WHERE month(date) = 6),
    le AS (SELECT stock, made - k AS date, arg_max(v, k) AS v FROM lt
           WHERE v IS NOT NULL AND made - k <= DATE '{AS_OF}' GROUP BY 1, 2),
    lf AS (SELECT stock, date, v * coalesce((SELECT product(s.coef) FROM splits s WHERE s.stock = le.stock AND s.date > le.date), 1) AS frcst FROM le),
    re AS (SELECT tr.stock, h."reportDate" AS date, max(ya * coalesce((SELECT product(s.coef) FROM splits s
                  WHERE s.stock = tr.stock AND s.date > CAST(h."reportDate" + INTERVAL 1 YEAR AS DATE)), 1)) AS eps
           FROM tr JOIN h ON h.stock = tr.stock AND h.date = CAST(tr.date - INTERVAL 1 YEAR AS DATE)
           WHERE tr.period = '0y' GROUP BY 1, 2)
"""


@query(
    "long_forecast_change",
    f"""
    WITH {QUARTERS_SQL}, {SPLITS_SQL}, {HISTORY_SQL}, {TREND_SQL}, {PRICES_SQL}, {LONG_SQL}
    SELECT p.stock, p.date, round(100 * (lf.frcst - re.eps) / nullif(re.eps, 0), 4) AS "1Y_expect_Change"
    FROM p ASOF LEFT JOIN lf ON lf.stock = p.stock AND p.date >= lf.date
    ASOF LEFT JOIN re ON re.stock = p.stock AND p.date >= re.date
    """,
)
def long_forecast_change(t: Tables) -> DataFrame:
    factors = ft.split_factors(landed.splits(t))
    estimates = ft.long_forecast_events(landed.long_trend(t), factors, F.lit(AS_OF).cast("date"))
    real = ft.real_eps_events(landed.trend(t), landed.history(t), factors)
    days = landed.prices(t).select("stock", "date")
    return rounded(ft.long_forecast_change(days, estimates, real, size=FITS))


@query(
    "statement_asof",
    f"""
    WITH {QUARTERS_SQL}, {AMOUNTS_SQL}, {PRICES_SQL},
    filed AS (SELECT *, date + 30 + CAST(stock % 10 AS INT) + CASE WHEN ret % 4 = 0 THEN 91 ELSE 0 END AS filing_date,
                     CASE WHEN opn % 3 <> 0 THEN "netIncome" END AS income_or_null FROM st),
    u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock, filing_date ORDER BY date) AS rn FROM filed) WHERE rn = 1)
    SELECT p.stock, p.date, coalesce(a."totalAssets", 0) AS "totalAssets", coalesce(b.income_or_null, 0) AS "netIncome",
           coalesce(a."totalRevenue", 0) AS "totalRevenue", CAST(p.date - a.filing_date AS INT) AS days_after_report
    FROM p ASOF LEFT JOIN u a ON a.stock = p.stock AND p.date >= a.filing_date
    ASOF LEFT JOIN (SELECT * FROM u WHERE income_or_null IS NOT NULL) b ON b.stock = p.stock AND p.date >= b.filing_date
    """,
)
def statement_asof(t: Tables) -> DataFrame:
    filed = landed.statements(t).withColumn("netIncome", F.when(F.col("opn") % 3 != 0, F.col("netIncome")))
    sources = [
        ft.statement_source(filed, ["netIncome"], "cashflow"),
        ft.statement_source(filed, ["totalRevenue"], "income"),
        ft.statement_source(filed, ["totalAssets"], "balance"),
    ]
    days = landed.prices(t).select("stock", "date")
    known = ft.statement_asof(days, sources, "filing_date_cashflow", size=FITS)
    return known.select("stock", "date", "totalAssets", "netIncome", "totalRevenue", "days_after_report")


KPI_SQL = """
    k AS (SELECT *, "netIncome" / nullif("totalAssets" - "totalLiab", 0) AS "ROE",
      "longTermDebt" / nullif("totalAssets" - "shortLongTermDebtTotal", 0) AS "LTDE",
      ("shortTermDebt" + "longTermDebt") / nullif("totalAssets" - "shortLongTermDebtTotal", 0) AS "DE",
      "totalCurrentAssets" / nullif("totalCurrentLiabilities", 0) AS "CR",
      ("totalRevenue" - "costOfRevenue") / nullif("totalRevenue", 0) AS "GM",
      "netIncome" / nullif("totalAssets", 0) AS "ROA", abs("dividendsPaid") / nullif("netIncome", 0) AS "DPR",
      "netReceivables" / nullif("accountsPayable", 0) AS "Acc_Rec_Pay_Ration",
      100 * "netIncome" / nullif("commonStockSharesOutstanding", 0) / nullif(hi / 73, 0) AS "ES",
      400 * abs("dividendsPaid") / nullif("commonStockSharesOutstanding", 0) / nullif(hi / 73, 0) AS "DY",
      "totalRevenue" / nullif("totalAssets", 0) AS asset_turnover,
      (hi / 73) / nullif(("totalAssets" - "totalLiab") / nullif("commonStockSharesOutstanding", 0), 0) AS "PB" FROM st)
"""
KPI_NAMES = ("ROE", "LTDE", "DE", "CR", "GM", "ROA", "DPR", "Acc_Rec_Pay_Ration", "ES", "DY", "asset_turnover", "PB")


def _kpis(t: Tables) -> DataFrame:
    return landed.statements(t).withColumn("close", F.col("hi") / 73).withColumns(ft.kpi_ratios())


@query(
    "kpi_ratios",
    f"WITH {QUARTERS_SQL}, {AMOUNTS_SQL}, {KPI_SQL} SELECT stock, date, "
    + ", ".join(f'round("{c}", 8) AS "{c}"' for c in KPI_NAMES) + " FROM k",
)
def kpi_ratios(t: Tables) -> DataFrame:
    return rounded(_kpis(t).select("stock", "date", *KPI_NAMES), 8)


EARNED_SQL = """
          SELECT q.stock, q.date, (hi / 73) / nullif(4 * (qty / 100), 0) AS pe, 100 * (e - a) / nullif(a, 0) AS up, ln / n AS back
          FROM q JOIN h ON q.stock = h.stock AND q.date = h.date
"""
PIOTROSKI_SQL = """
    SELECT k.stock, k.date,
      CAST((CASE WHEN k."netIncome" >= 0 THEN 1 ELSE 0 END) + (CASE WHEN k."ROA" >= 0 THEN 1 ELSE 0 END)
      + (CASE WHEN k."totalCashFromOperatingActivities" >= 0 THEN 1 ELSE 0 END)
      + (CASE WHEN k."totalCashFromOperatingActivities" >= k."netIncome" THEN 1 ELSE 0 END)
      + (CASE WHEN k."longTermDebt" <= o."longTermDebt" THEN 1 ELSE 0 END)
      + (CASE WHEN k."CR" >= c."CR" THEN 1 ELSE 0 END) + (CASE WHEN k."GM" >= g."GM" THEN 1 ELSE 0 END)
      + (CASE WHEN k.asset_turnover >= a.asset_turnover THEN 1 ELSE 0 END)
      + (CASE WHEN k."issuanceOfCapitalStock" > 0 THEN 0 ELSE 1 END) AS INT) AS "Piotroski_Score"
    FROM k ASOF LEFT JOIN k o ON o.stock = k.stock AND k.date - 365 >= o.date
    ASOF LEFT JOIN (SELECT * FROM k WHERE "CR" IS NOT NULL) c ON c.stock = k.stock AND k.date - 365 >= c.date
    ASOF LEFT JOIN (SELECT * FROM k WHERE "GM" IS NOT NULL) g ON g.stock = k.stock AND k.date - 365 >= g.date
    ASOF LEFT JOIN (SELECT * FROM k WHERE asset_turnover IS NOT NULL) a ON a.stock = k.stock AND k.date - 365 >= a.date
"""


@query(
    "earnings_ratios",
    f"""
    WITH {QUARTERS_SQL}, {HISTORY_SQL},
    e AS ({EARNED_SQL})
    SELECT stock, date, round(pe, 7) AS "PE", round(pe * (1 + up), 5) AS "PEG_Forward", round(pe * (1 + back), 5) AS "PEG_Backwards" FROM e
    """,
)
def earnings_ratios(t: Tables) -> DataFrame:
    c = F.col
    rows = landed.quarters(t).select(
        "stock", "date", (c("hi") / 73).alias("close"), (c("qty") / 100).alias("epsActual"),
        ft.percent_gap(F.when(c("opn") % 4 != 0, c("ln") / 10), F.when(c("ret") % 5 != 0, c("qty") / 100)).alias("1Y_expect_Change"),
        (c("ln") / c("n")).alias("YoY_Proj_Growth"),
    ).withColumns(ft.earnings_ratios())
    exact = rounded(rows.select("stock", "date", "PE", "PEG_Forward", "PEG_Backwards"), 7, ("PE",))
    return rounded(exact, 5, ("PEG_Forward", "PEG_Backwards"))


@query(
    "piotroski_score",
    f"""
    WITH {QUARTERS_SQL}, {AMOUNTS_SQL}, {KPI_SQL}
    {PIOTROSKI_SQL}
    """,
)
def piotroski_score(t: Tables) -> DataFrame:
    return ft.piotroski_score(_kpis(t), size=FITS).select("stock", "date", "Piotroski_Score")


FULL_SQL = f"""
    {QUARTERS_SQL}, {HISTORY_SQL}, {AMOUNTS_SQL}, {KPI_SQL}, e AS ({EARNED_SQL}), pi AS ({PIOTROSKI_SQL}),
    r AS (SELECT k.*, CAST(pi."Piotroski_Score" AS DOUBLE) AS "Piotroski_Score", e.pe AS "PE", e.pe * (1 + up) AS "PEG_Forward", e.pe * (1 + back) AS "PEG_Backwards"
          FROM k JOIN pi USING (stock, date) JOIN e USING (stock, date))
"""


def _all_ratios(t: Tables) -> DataFrame:
    """Every ratio of the panel, per stock and quarter."""
    c = F.col
    earned = _kpis(t).withColumns({
        "epsActual": c("qty") / 100, "YoY_Proj_Growth": c("ln") / c("n"),
        "1Y_expect_Change": ft.percent_gap(F.when(c("opn") % 4 != 0, c("ln") / 10), F.when(c("ret") % 5 != 0, c("qty") / 100)),
    })
    scored = ft.piotroski_score(earned.withColumns(ft.earnings_ratios()), size=FITS)
    return scored.withColumn("Piotroski_Score", F.col("Piotroski_Score").cast("double"))


@query(
    "kpi_gap_fill",
    f"WITH {FULL_SQL} SELECT stock, date, "
    + ", ".join(
        f'round(last_value(nullif("{c}", 0) IGNORE NULLS) OVER (PARTITION BY stock ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 5) AS "{c}"'
        for c in pn.GAP_FILLED
    ) + " FROM r",
)
def kpi_gap_fill(t: Tables) -> DataFrame:
    return rounded(ft.kpi_gap_fill(_all_ratios(t), STOCK_DAYS, pn.GAP_FILLED).select("stock", "date", *pn.GAP_FILLED), 5)


@query(
    "yoy_kpis",
    f"WITH {FULL_SQL} SELECT r.stock, r.date, "
    + ", ".join(f'round(100 * (r."{c}" / nullif(o{i}."{c}", 0) - 1), 3) AS "{out}"' for i, (c, out) in enumerate(ft.YOY_NAMES.items()))
    + " FROM r "
    + " ".join(
        f'ASOF LEFT JOIN (SELECT * FROM r WHERE "{c}" IS NOT NULL) o{i} ON o{i}.stock = r.stock AND r.date - 365 >= o{i}.date'
        for i, c in enumerate(ft.YOY_NAMES)
    ),
)
def yoy_kpis(t: Tables) -> DataFrame:
    changed = ft.yoy_kpis(_all_ratios(t), STOCK_DAYS)
    return rounded(changed.select("stock", "date", *ft.YOY_NAMES.values()), 3)


# --- macro --------------------------------------------------------------------------


@query(
    "macro_trend",
    """
    WITH v AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders GROUP BY 1, 2),
    s AS (SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v GROUP BY 1),
    f AS (SELECT s.series_id, s.date, last_value(v.value IGNORE NULLS) OVER (PARTITION BY s.series_id ORDER BY s.date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
          FROM s LEFT JOIN v ON v.series_id = s.series_id AND v.date = s.date),
    m AS (SELECT *, CASE WHEN count(value) OVER a = 30 THEN avg(value) OVER a END AS s30,
                 CASE WHEN count(value) OVER b = 200 THEN avg(value) OVER b END AS s200,
                 lag(value, 30) OVER w AS v30, lag(value, 365) OVER w AS v365
          FROM f WINDOW w AS (PARTITION BY series_id ORDER BY date),
                        a AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
                        b AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW))
    SELECT series_id, date, value, round(100 * (value / nullif(v30, 0) - 1), 4) AS mom, round(100 * (value / nullif(v365, 0) - 1), 4) AS yoy,
           round(100 * (s30 / nullif(lag(s30) OVER w, 0) - 1), 4) AS ma30_vector,
           round(100 * (s200 / nullif(lag(s200) OVER w, 0) - 1), 4) AS ma200_vector,
           round(100 * (value - s30) / nullif(value, 0), 4) AS val_to_30ma, round(100 * (value - s200) / nullif(value, 0), 4) AS val_to_200ma
    FROM m WINDOW w AS (PARTITION BY series_id ORDER BY date)
    """,
)
def macro_trend(t: Tables) -> DataFrame:
    dense = densify(priority_days(t), keys=["series_id"], time="date", columns=["value"])
    trend = ft.macro_trend(
        dense, changes={"mom": 30, "yoy": 365}, lengths=(30, 200), against="average", scale=100.0
    )
    return rounded(
        trend.select(
            "series_id", "date", "value", "mom", "yoy",
            F.col("m_sma30_vector").alias("ma30_vector"), F.col("m_sma200_vector").alias("ma200_vector"),
            F.col("m_sma30_position").alias("val_to_30ma"), F.col("m_sma200_position").alias("val_to_200ma"),
        )
    )


@query(
    "crisis_clock",
    """
    WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_totalprice >= 499000)
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(CAST(o_orderdate AS DATE) - c.d AS INT) AS days_after_crisis
    FROM orders ASOF LEFT JOIN c ON CAST(o_orderdate AS DATE) >= c.d
    """,
)
def crisis_clock(t: Tables) -> DataFrame:
    listed = t.orders.filter(F.col("o_totalprice") >= 499000).select(day("o_orderdate").alias("date"))
    return ft.crisis_clock(t.orders.select("o_orderkey", day("o_orderdate").alias("date")), listed)


# --- older panel --------------------------------------------------------------------


@query(
    "current_ratio_backfill",
    f"""
    WITH {QUARTERS_SQL}
    SELECT stock, date, round(coalesce(CASE WHEN opn % 3 <> 0 THEN hi END, (qty + ln + n + opn) / nullif(ret + opn - 9.0, 0)), 5) AS "currentRatio"
    FROM q WHERE ret + opn - 9 <> 0
    """,
)
def current_ratio_backfill(t: Tables) -> DataFrame:
    c = F.col
    rows = landed.quarters(t).select(
        "stock", "date", F.when(c("opn") % 3 != 0, c("hi")).alias("currentRatio"),
        c("qty").alias("acctRec"), c("ln").alias("cashAndEq"), c("n").alias("inventory"), c("opn").alias("taxAssets"),
        c("ret").cast("double").alias("acctPay"), c("opn").cast("double").alias("taxLiabilities"),
        F.lit(-9.0).alias("deposits"), F.lit(0.0).alias("deferredRev"),
    )
    return rounded(ft.current_ratio_backfill(rows).select("stock", "date", "currentRatio"), 5)


@query(
    "dividend_change",
    f"""
    WITH {QUARTERS_SQL}, {PRICES_SQL},
    ps AS (SELECT stock, date, opn / n AS dps FROM q),
    c AS (SELECT *, dps - lag(dps) OVER (PARTITION BY stock ORDER BY date) AS change FROM ps),
    e AS (SELECT stock, date - 60 AS announced, change, lag(change) OVER (PARTITION BY stock ORDER BY date) AS prev_change FROM c WHERE change <> 0),
    start AS (SELECT min(date) AS d FROM p)
    SELECT p.stock, p.date, round(CASE WHEN p.stock % 7 = 0 THEN 0 ELSE e.change END, 6) AS dividends_change,
           round(CASE WHEN p.stock % 7 = 0 THEN 0 ELSE e.prev_change END, 6) AS prev_div_change,
           CAST(CASE WHEN p.stock % 7 = 0 THEN p.date - start.d ELSE p.date - e.announced END AS INT) AS days_after_divid_report
    FROM p ASOF LEFT JOIN e ON e.stock = p.stock AND p.date >= e.announced, start
    """,
)
def dividend_change(t: Tables) -> DataFrame:
    c = F.col
    statements = landed.quarters(t).select(
        "stock", "date", c("opn").cast("double").alias("payDiv"), c("n").cast("double").alias("sharesBasic")
    )
    panel = landed.prices(t).select(
        "stock", "date", F.when(c("stock") % 7 == 0, 0.0).otherwise(c("volume").cast("double")).alias("divCash")
    )
    done = ft.dividend_change(panel, ft.dividend_events(statements, STOCK_DAYS), size=FITS)
    return rounded(done.drop("divCash"), 6)


# --- panel --------------------------------------------------------------------------


@query("build_panel")
def build_panel(t: Tables) -> DataFrame:
    return pn.build_panel(landed.inputs(t), as_of=F.lit(AS_OF).cast("date"), start="1995-06-30", size=FITS)


# Column of the panel -> the line value it takes and the value that stands for a gap.
RAW = {
    "EPS_surprise": ("l_tax", 0.05), "DY": ("l_discount", 0.0), "YoY_DPR": ("l_tax", 0.03), "DPR": ("l_discount", 0.01),
    "YoY_DY": ("l_tax", 0.02), "YoY_CR": ("l_discount", 0.04), "DE": ("l_tax", 0.0), "LTDE": ("l_discount", 0.02),
    "VIX_MoM": ("l_quantity", 7.0), "Acc_Rec_Pay_Ration": ("l_quantity", 9.0), "PEG_Forward": ("l_quantity", 11.0),
    "PEG_Backwards": ("l_quantity", 13.0), "EPS_1Y_exp_Change": ("l_quantity", 15.0), "YoY_AR_Ration": ("l_quantity", 17.0),
    "EPS_YoY_Growth": ("l_quantity", 19.0), "EPS_QoQ_frcst_diff": ("l_quantity", 21.0), "Fed_Balance_YoY": ("l_quantity", 23.0),
}
ZEROED = ("DY", "YoY_DPR", "DPR", "YoY_DY", "DE", "LTDE", "Acc_Rec_Pay_Ration")
NEEDED = tuple(c for c in RAW if c not in ZEROED)


def _raw_panel(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("stock"), F.col("l_linestatus").alias("sector"),
        F.col("l_returnflag").alias("industry"), *[F.nullif(c, F.lit(gap)).alias(n) for n, (c, gap) in RAW.items()],
    )


@query(
    "clean_panel",
    "WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey AS stock, l_linestatus, l_returnflag, "
    + ", ".join(f'nullif({c}, {gap}) AS "{n}"' for n, (c, gap) in RAW.items())
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, stock, CASE WHEN stock = 7 THEN 'IT' ELSE l_linestatus END AS sector, "
    + "CASE WHEN stock = 7 THEN 'Software' ELSE l_returnflag END AS industry, "
    + ", ".join(f'coalesce("{n}", 0) AS "{n}"' for n in ZEROED)
    + ", " + ", ".join(f'"{n}"' for n in NEEDED)
    + " FROM r WHERE " + " AND ".join(f'"{n}" IS NOT NULL' for n in NEEDED),
)
def clean_panel(t: Tables) -> DataFrame:
    return pn.clean_panel(_raw_panel(t), "train", sectors={"7": ("IT", "Software")})


def _attrition_sql(mode: str) -> str:
    """One SELECT per step: rows and stocks that pass all needs up to it."""
    parts, passed = [f"SELECT '{mode}' AS mode, 0 AS step_no, 'start' AS step, count(DISTINCT stock) AS n_keys, count(*) AS n_rows FROM r"], []
    needs = [columns for kind, columns in pn.RULES[mode] if kind == "need"]
    for i, columns in enumerate(needs, 1):
        passed += [f'"{c}" IS NOT NULL' for c in columns]
        parts.append(f"SELECT '{mode}', {i}, '{' & '.join(columns)}', count(DISTINCT stock), count(*) FROM r WHERE {' AND '.join(passed)}")
    return " UNION ALL ".join(parts)


@query(
    "attrition_cleaning",
    "WITH r AS (SELECT l_suppkey AS stock, " + ", ".join(f'nullif({c}, {gap}) AS "{n}"' for n, (c, gap) in RAW.items()) + " FROM lineitem) "
    + " UNION ALL ".join(_attrition_sql(m) for m in pn.RULES),
)
def attrition_cleaning(t: Tables) -> DataFrame:
    """Rows and stocks left after every step of the cleaning rules, for each mode."""
    raw = _raw_panel(t)
    reports = [attrition_report(raw, "stock", pn.cleaning_steps(m)).select(F.lit(m).alias("mode"), "*") for m in pn.RULES]
    return reports[0].unionAll(reports[1]).unionAll(reports[2])


@query(
    "threshold_labels",
    """
    WITH d AS (SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS open,
                      max(l_extendedprice) AS close FROM lineitem GROUP BY 1, 2),
    r AS (SELECT stock, date, """
    + ", ".join(
        f"100 * (lead(close, {h}) OVER (PARTITION BY stock ORDER BY date) / nullif(open, 0) - 1) AS r{d}"
        for d, h in {15: 11, 30: 22, 60: 44, 90: 66, 120: 88, 150: 110}.items()
    )
    + " FROM d) SELECT stock, date, "
    + ", ".join(f"CAST(r{d} >= {v} AS INT) AS future_{d}dprice_change_label" for d, v in pn.THRESHOLDS.items())
    + " FROM r",
)
def threshold_labels(t: Tables) -> DataFrame:
    returns = forward_returns(landed.prices(t), STOCK_DAYS, label_horizons())
    labelled = pn.threshold_labels(returns, pn.horizon_thresholds())
    return labelled.select("stock", "date", *[f"{c}_label" for c in pn.horizon_thresholds()])


@query(
    "payer_flag",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0.05), 0) <> 0 AS pays_dividends FROM lineitem",
)
def payer_flag(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_discount", F.lit(0.05)).alias("DY"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", pn.payer_flag().alias("pays_dividends"))


@query(
    "build_panel_core",
    f"""
    WITH {TIMELINE_SQL}, {PRICES_SQL}, {LONG_SQL}, {AMOUNTS_SQL},
    filed AS (SELECT *, date + 30 + CAST(stock % 10 AS INT) + CASE WHEN ret % 4 = 0 THEN 91 ELSE 0 END AS filing_date FROM st),
    u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock, filing_date ORDER BY date) AS rn FROM filed) WHERE rn = 1),
    f AS (SELECT p.stock, p.date, coalesce(product(s.coef), 1) AS factor FROM p
          LEFT JOIN splits s ON s.stock = p.stock AND s.date > p.date GROUP BY 1, 2),
    hr AS (SELECT stock, "reportDate" AS rd, coalesce(a, e) AS a, coalesce(e, a) AS e FROM h WHERE a IS NOT NULL OR e IS NOT NULL),
    cd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_totalprice >= 499000),
    k AS (SELECT p.stock, p.date, p.open * f.factor AS open, p.close * f.factor AS close, CAST(p.date - hr.rd AS INT) AS days_report,
                 100 * (hr.a - hr.e) / nullif(hr.e, 0) AS surprise, u."totalCurrentAssets" / nullif(u."totalCurrentLiabilities", 0) AS cr,
                 (u."totalRevenue" - u."costOfRevenue") / nullif(u."totalRevenue", 0) AS gm, p.close * f.factor / nullif(4 * hr.a, 0) AS pe,
                 t.growth, 100 * (lf.frcst - re.eps) / nullif(re.eps, 0) AS expected, CAST(p.date - cd.d AS INT) AS days_crisis
          FROM p JOIN f ON f.stock = p.stock AND f.date = p.date
          ASOF LEFT JOIN hr ON hr.stock = p.stock AND p.date >= hr.rd
          ASOF LEFT JOIN u ON u.stock = p.stock AND p.date >= u.filing_date
          ASOF LEFT JOIN (SELECT * FROM tl WHERE diff IS NOT NULL) t ON t.stock = p.stock AND p.date >= t.date
          ASOF LEFT JOIN lf ON lf.stock = p.stock AND p.date >= lf.date
          ASOF LEFT JOIN re ON re.stock = p.stock AND p.date >= re.date
          ASOF LEFT JOIN cd ON p.date >= cd.d),
    w AS (SELECT *, last_value(nullif(cr, 0) IGNORE NULLS) OVER b AS "CR", last_value(nullif(gm, 0) IGNORE NULLS) OVER b AS "GM",
                 last_value(nullif(pe, 0) IGNORE NULLS) OVER b AS "PE"
          FROM k WINDOW b AS (PARTITION BY stock ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT w.stock, w.date, round(close, 4) AS close, days_report AS days_after_earnings_report, round(surprise, 5) AS "EPS_surprise",
           round("CR", 9) AS "CR", round("GM", 9) AS "GM", round("PE" / 73, 7) AS "PE_per_73", round(growth, 7) AS "EPS_YoY_Growth",
           round(expected, 4) AS "EPS_1Y_exp_Change", days_crisis AS days_after_crisis,
           round(100 * (lead(close, 22) OVER (PARTITION BY w.stock ORDER BY w.date) / nullif(open, 0) - 1), 4) AS future_30dprice_change,
           'SECTOR_' || n_regionkey AS sector
    FROM w JOIN supplier ON s_suppkey = w.stock JOIN nation ON s_nationkey = n_nationkey
    WHERE w.date > DATE '1995-06-30' AND "PE" IS NOT NULL AND close <> 0
    """,
)
def build_panel_core(t: Tables) -> DataFrame:
    """Columns of the panel that one SQL text can follow from the raw lines to the label."""
    panel = pn.build_panel(landed.inputs(t), as_of=F.lit(AS_OF).cast("date"), start="1995-06-30", size=FITS)
    core = panel.select(
        "stock", "date", "close", "days_after_earnings_report", "EPS_surprise", "CR", "GM", "PE", "EPS_YoY_Growth",
        "EPS_1Y_exp_Change", "days_after_crisis", "future_30dprice_change", "sector",
    )
    # a prime divisor keeps the quotient off the ties on which engines round differently
    digits = {"EPS_surprise": 5, "CR": 9, "GM": 9, "PE_per_73": 7, "EPS_YoY_Growth": 7}
    plain = rounded(core, 4, ("close", "EPS_1Y_exp_Change", "future_30dprice_change"))
    scaled = plain.withColumn("PE", F.col("PE") / 73).withColumnRenamed("PE", "PE_per_73")
    return scaled.withColumns({c: F.round(c, d) for c, d in digits.items()})
