"""The given tables in the role of landed vendor tables.

A supplier is a stock, its lines are trades, its quarters are financial statements.
Amounts are counts and sums of whole numbers, so every engine gets the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.catalog.registry import Tables, day
from panelweave.plans.features import macro_table
from panelweave.plans.panel import Inputs

QUARTERS_SQL = """
    q AS (SELECT l_suppkey AS stock, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) - 1 AS date,
                 count(*) AS n, sum(l_quantity) AS qty, CAST(sum(l_linenumber) AS DOUBLE) AS ln,
                 max(l_extendedprice) AS hi, min(l_extendedprice) AS lo,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS ret, count(*) FILTER (WHERE l_linestatus = 'O') AS opn
          FROM lineitem GROUP BY 1, 2)
"""
SPLITS_SQL = """
    splits AS (SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, product(100.0 / (100 + round(100 * l_discount))) AS coef
               FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.095 GROUP BY 1, 2)
"""
HISTORY_SQL = """
    h AS (SELECT stock, date, date + 20 + CAST(stock % 10 AS INT) AS "reportDate",
                 CASE WHEN ret % 5 <> 0 THEN qty / 100 END AS a, CASE WHEN opn % 4 <> 0 THEN ln / 10 END AS e FROM q)
"""
PRICES_SQL = """
    p AS (SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS open,
                 max(l_extendedprice) AS high, min(l_extendedprice) AS low, max(l_extendedprice) AS close,
                 count(*) AS volume FROM lineitem GROUP BY 1, 2)
"""


def quarters(t: Tables) -> DataFrame:
    """One row per supplier and quarter, the source of all statement-like tables."""
    return t.once("landed_quarters", lambda: _quarters(t))


def _quarters(t: Tables) -> DataFrame:
    start = F.date_trunc("quarter", F.col("l_shipdate").cast("timestamp")).cast("date")
    return t.lineitem.groupBy(
        F.col("l_suppkey").alias("stock"), F.date_sub(F.add_months(start, 3), 1).alias("date")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("qty"),
        F.sum("l_linenumber").cast("double").alias("ln"),
        F.max("l_extendedprice").alias("hi"),
        F.min("l_extendedprice").alias("lo"),
        F.count_if(F.col("l_returnflag") == "R").alias("ret"),
        F.count_if(F.col("l_linestatus") == "O").alias("opn"),
    )


def text(value: Column) -> Column:
    """A number the way the vendor sends it: as text, 'None' when missing."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def splits(t: Tables) -> DataFrame:
    """Split texts, as landed."""
    return t.once("landed_splits", lambda: _splits(t))


def _splits(t: Tables) -> DataFrame:
    marked = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.095))
    to = (100 + F.round(100 * F.col("l_discount"))).cast("int").cast("string")
    return marked.select(
        F.col("l_suppkey").alias("stock"), day("l_shipdate").cast("string").alias("date"),
        F.concat(to, F.lit("/100")).alias("split"),
    )


def history(t: Tables) -> DataFrame:
    c = F.col
    return quarters(t).select(
        "stock", "date", F.date_add("date", (20 + c("stock") % 10).cast("int")).alias("reportDate"),
        text(F.when(c("ret") % 5 != 0, c("qty") / 100)).alias("epsActual"),
        text(F.when(c("opn") % 4 != 0, c("ln") / 10)).alias("epsEstimate"),
    )


def trend(t: Tables) -> DataFrame:
    c = F.col
    return quarters(t).select(
        "stock", "date", F.when(F.month("date") == 12, "0y").otherwise("0q").alias("period"),
        text(c("ln") / 5).alias("earningsEstimateYearAgoEps"),
        text(c("qty") / 50).alias("earningsEstimateAvg"),
        text((c("qty") + c("n")) / 50).alias("epsTrend7daysAgo"),
        text(F.when(c("ret") % 3 != 0, (c("qty") + 2 * c("n")) / 50)).alias("epsTrend30daysAgo"),
        text((c("qty") + 3 * c("n")) / 50).alias("epsTrend60daysAgo"),
        text(F.when(c("opn") % 2 != 0, (c("qty") + 4 * c("n")) / 50)).alias("epsTrend90daysAgo"),
    )


TREND_SQL = """
    tr AS (SELECT stock, date, CASE WHEN month(date) = 12 THEN '0y' ELSE '0q' END AS period, ln / 5 AS ya, qty / 50 AS e0, (qty + n) / 50 AS e7,
                  CASE WHEN ret % 3 <> 0 THEN (qty + 2 * n) / 50 END AS e30, (qty + 3 * n) / 50 AS e60,
                  CASE WHEN opn % 2 <> 0 THEN (qty + 4 * n) / 50 END AS e90 FROM q)
"""


def long_trend(t: Tables) -> DataFrame:
    return trend(t).withColumn("period", F.when(F.month("date") == 6, "+1y").otherwise("0y"))


def prices(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_suppkey").alias("stock"), day("l_shipdate").alias("date")).agg(
        F.min("l_extendedprice").alias("open"), F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def amounts() -> dict[str, Column]:
    """Statement amounts of a quarter."""
    c = F.col
    return {
        "totalAssets": c("qty") * 10,
        "totalLiab": c("ln") * 10,
        "totalCurrentAssets": c("qty") * 3,
        "totalCurrentLiabilities": c("ln") * 2,
        "longTermDebt": c("ret") * 5.0,
        "shortTermDebt": c("opn") * 2.0,
        "shortLongTermDebtTotal": c("n") * 1.0,
        "netReceivables": c("opn") * 4.0,
        "accountsPayable": c("ret") * 3.0,
        "commonStockSharesOutstanding": c("n") * 100.0,
        "netIncome": c("qty") - c("ln") * 5,
        "dividendsPaid": c("opn") * -1.0,
        "totalCashFromOperatingActivities": c("qty") - c("n") * 20,
        "issuanceOfCapitalStock": c("ret") - 3.0,
        "totalRevenue": c("qty") * 2,
        "costOfRevenue": c("ln") * 3,
    }


AMOUNTS_SQL = """
    st AS (SELECT stock, date, n, qty, ln, hi, ret, opn, qty * 10 AS "totalAssets", ln * 10 AS "totalLiab", qty * 3 AS "totalCurrentAssets",
                  ln * 2 AS "totalCurrentLiabilities", ret * 5.0 AS "longTermDebt", opn * 2.0 AS "shortTermDebt",
                  n * 1.0 AS "shortLongTermDebtTotal", opn * 4.0 AS "netReceivables", ret * 3.0 AS "accountsPayable",
                  n * 100.0 AS "commonStockSharesOutstanding", qty - ln * 5 AS "netIncome", opn * -1.0 AS "dividendsPaid",
                  qty - n * 20 AS "totalCashFromOperatingActivities", ret - 3.0 AS "issuanceOfCapitalStock",
                  qty * 2 AS "totalRevenue", ln * 3 AS "costOfRevenue" FROM q)
"""


def statements(t: Tables) -> DataFrame:
    """Quarters with all amounts and a filing date; two quarters share one now and then."""
    filed = F.date_add("date", (30 + F.col("stock") % 10 + F.when(F.col("ret") % 4 == 0, 91).otherwise(0)).cast("int"))
    return quarters(t).withColumns(amounts()).withColumn("filing_date", filed)


def general(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("stock"), F.concat(F.lit("SECTOR_"), F.col("n_regionkey").cast("string")).alias("sector"),
        F.col("n_name").alias("industry"),
    )


def macro_series(t: Tables) -> DataFrame:
    """Three daily series in long form: the day's dearest order as index and balance, the cheapest as yield."""
    price = F.col("o_totalprice")
    per_day = t.orders.groupBy(day("o_orderdate").alias("date")).agg(F.max(price).alias("high"), F.min(price).alias("low"))
    cell = lambda name, c: F.struct(F.lit(name).alias("series_id"), F.col(c).alias("value"))
    return per_day.select("date", F.inline(F.array(cell("vix_high", "high"), cell("cb_assets", "high"), cell("bond10y", "low"))))


def macro(t: Tables) -> DataFrame:
    return t.once("landed_macro", lambda: macro_table(macro_series(t)))


def inputs(t: Tables) -> Inputs:
    filed = statements(t)
    crises = t.orders.filter(F.col("o_totalprice") >= 499000).select(day("o_orderdate").alias("date"))
    return Inputs(
        prices=prices(t), splits=splits(t), earn_history=history(t), earn_trend=trend(t), long_trend=long_trend(t),
        balance=filed, cashflow=filed, income=filed, general=general(t), macro=macro(t), event_dates=crises,
    )
