"""Joins in time, window functions and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.catalog.registry import Tables, day, query, rounded
from panelweave.ml.model import attach_predictions
from panelweave.operators import asof, relational as rel, windows as win
from panelweave.operators.timeline import FITS, Axis, fill, full_mean, rolling, spread_join

CUSTOMER_DAYS_SQL = """
    d AS (SELECT o_custkey AS stock, CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS open,
                 max(o_totalprice) AS close, count(*) AS volume FROM orders GROUP BY 1, 2)
"""
SUPPLIER_DAYS_SQL = """
    d AS (SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS open,
                 max(l_extendedprice) AS close, count(*) AS volume FROM lineitem GROUP BY 1, 2)
"""
PRIORITY_DAYS_SQL = """
    d AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value
          FROM orders GROUP BY 1, 2)
"""
STOCK_DAYS = Axis.of("stock", "date", size=FITS)
SERIES_DAYS = Axis.of("series_id", "date", size=FITS)
USER_EVENTS = Axis.of("user_id", ["ts", "event_id"])


def day_prices(rows: DataFrame, stock: str, when: str, amount: str) -> DataFrame:
    """One row per key and day; the aggregation bounds every series by its calendar days."""
    return rows.groupBy(F.col(stock).alias("stock"), day(when).alias("date")).agg(
        F.min(amount).alias("open"), F.max(amount).alias("close"), F.count(F.lit(1)).alias("volume")
    )


def customer_days(t: Tables) -> DataFrame:
    return day_prices(t.orders, "o_custkey", "o_orderdate", "o_totalprice")


def supplier_days(t: Tables) -> DataFrame:
    return day_prices(t.lineitem, "l_suppkey", "l_shipdate", "l_extendedprice")


def priority_days(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("series_id"), day("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("value")
    )


@query(
    "flagship_forward_return",
    f"""
    WITH {SUPPLIER_DAYS_SQL},
    s AS (SELECT *, CASE WHEN count(close) OVER w = 50 THEN avg(close) OVER w END AS sma,
                 lag(close) OVER (PARTITION BY stock ORDER BY date) AS before,
                 lead(close, 22) OVER (PARTITION BY stock ORDER BY date) AS ahead
          FROM d WINDOW w AS (PARTITION BY stock ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
    SELECT stock, date, close, round((sma - close) / nullif(close, 0), 6) AS sma50_position,
           round(100 * (close / nullif(before, 0) - 1), 4) AS change_1,
           round(100 * (ahead / nullif(open, 0) - 1), 4) AS future_30dprice_change
    FROM s WHERE sma IS NOT NULL AND ahead IS NOT NULL
    ORDER BY ahead / open DESC, stock, date LIMIT 100
    """,
)
def flagship_forward_return(t: Tables) -> DataFrame:
    trend = win.sma_trend(supplier_days(t), STOCK_DAYS, "close", [50], prefix="p")
    changed = win.pct_change(trend, STOCK_DAYS, {"change_1": ("close", 1)})
    labelled = win.forward_returns(changed, STOCK_DAYS, {"future_30dprice_change": 22})
    known = labelled.dropna(subset=["p_sma50", "future_30dprice_change"])
    best = rel.top_n(known, 100, [F.desc("future_30dprice_change"), F.asc("stock"), F.asc("date")])
    return best.select(
        "stock", "date", "close", F.round("p_sma50_position", 6).alias("sma50_position"),
        F.round("change_1", 4).alias("change_1"), F.round("future_30dprice_change", 4).alias("future_30dprice_change"),
    )


# --- joins --------------------------------------------------------------------------


@query(
    "join_left_equi",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment AS sector, n_name AS industry
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def join_left_equi(t: Tables) -> DataFrame:
    dim = t.customer.filter(F.col("c_acctbal") > 0).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    lookup = dim.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("sector"), F.col("n_name").alias("industry")
    )
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return spread_join(rows, lookup, ["o_custkey"])


@query(
    "join_left_composite",
    f"""
    WITH {SUPPLIER_DAYS_SQL},
    r AS (SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS returned
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
    SELECT d.stock, d.date, d.close, r.returned FROM d LEFT JOIN r ON d.stock = r.stock AND d.date = r.date
    """,
)
def join_left_composite(t: Tables) -> DataFrame:
    returned = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_suppkey").alias("stock"), day("l_shipdate").alias("date"))
        .agg(F.sum("l_quantity").alias("returned"))
    )
    return supplier_days(t).select("stock", "date", "close").join(returned, ["stock", "date"], "left")


OFFSETS = (0, 7, 30, 60, 90)


@query(
    "join_multi_offset",
    f"""
    WITH {PRIORITY_DAYS_SQL}
    SELECT o.o_orderkey, o.o_orderpriority AS series_id, CAST(o.o_orderdate AS DATE) AS date,
           coalesce(d0.value, 1) AS ago_0, coalesce(d7.value, 1) AS ago_7, coalesce(d30.value, 1) AS ago_30,
           coalesce(d60.value, 1) AS ago_60, coalesce(d90.value, 1) AS ago_90
    FROM orders o
    """
    + "".join(
        f" LEFT JOIN d d{k} ON d{k}.series_id = o.o_orderpriority AND d{k}.date = CAST(o.o_orderdate AS DATE) - {k}"
        for k in OFFSETS
    ),
)
def join_multi_offset(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("series_id"), day("o_orderdate").alias("date"))
    return asof.offset_lookup(
        rows, priority_days(t), keys=["series_id"], time="date", series_time="date", value="value",
        offsets=OFFSETS, prefix="ago_", default=1.0,
    )


def _purchases(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("bought"), F.col("value").alias("bought_value"), F.col("event_id").alias("buy_id")
    )


@query(
    "asof_backward",
    """
    SELECT e.event_id, e.user_id, e.ts, p.value AS bought_value, p.ts AS bought_at
    FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON e.user_id = p.user_id AND e.ts >= p.ts
    """,
)
def asof_backward(t: Tables) -> DataFrame:
    return asof.asof_join(
        t.events.select("event_id", "user_id", "ts"), _purchases(t), keys=["user_id"], time="ts", right_time="bought",
        columns=["bought_value"], keep_time="bought_at", tie=["buy_id"],
    )


@query(
    "asof_backward_max_age",
    """
    SELECT event_id, user_id, CASE WHEN date_diff('day', CAST(pts AS DATE), CAST(ts AS DATE)) <= 2 THEN v END AS bought_value
    FROM (SELECT e.event_id, e.user_id, e.ts, p.value AS v, p.ts AS pts
          FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
            ON e.user_id = p.user_id AND e.ts >= p.ts)
    """,
)
def asof_backward_max_age(t: Tables) -> DataFrame:
    joined = asof.asof_join(
        t.events.select("event_id", "user_id", "ts"), _purchases(t), keys=["user_id"], time="ts", right_time="bought",
        columns=["bought_value"], max_age_days=2, whole_row=True, tie=["buy_id"],
    )
    return joined.drop("ts")


@query(
    "asof_forward",
    """
    SELECT e.event_id, e.user_id, p.value AS bought_value
    FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON e.user_id = p.user_id AND e.ts <= p.ts
    """,
)
def asof_forward(t: Tables) -> DataFrame:
    return asof.asof_join(
        t.events.select("event_id", "user_id", "ts"), _purchases(t), keys=["user_id"], time="ts", right_time="bought",
        columns=["bought_value"], direction="forward", tie=["buy_id"],
    ).drop("ts")


@query(
    "asof_by_known_date",
    """
    WITH s AS (SELECT l_partkey AS stock, CAST(l_shipdate AS DATE) AS filed, sum(l_quantity) AS shipped,
                      max(l_extendedprice) AS top_price FROM lineitem GROUP BY 1, 2),
         r AS (SELECT stock, filed, shipped AS returned FROM (
                 SELECT l_partkey AS stock, CAST(l_shipdate AS DATE) AS filed, sum(l_quantity) AS shipped
                 FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)),
         l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS stock, CAST(o_orderdate AS DATE) AS date
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l.*, s.shipped, s.top_price, r.returned FROM l
    ASOF LEFT JOIN s ON l.stock = s.stock AND l.date >= s.filed
    ASOF LEFT JOIN r ON l.stock = r.stock AND l.date >= r.filed
    """,
)
def asof_by_known_date(t: Tables) -> DataFrame:
    filed = [F.col("l_partkey").alias("stock"), day("l_shipdate").alias("filed")]
    shipped = t.lineitem.groupBy(*filed).agg(
        F.sum("l_quantity").alias("shipped"), F.max("l_extendedprice").alias("top_price")
    )
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").groupBy(*filed).agg(F.sum("l_quantity").alias("returned"))
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("stock"), day("o_orderdate").alias("date")
    )
    # events per part are fewer than its lines, so twice the line table bounds every series
    keys = t.lineitem.select(F.col("l_partkey").alias("stock"))
    return asof.align(
        rows,
        [asof.Source(shipped, "filed", ("shipped", "top_price")), asof.Source(returned, "filed", ("returned",))],
        keys=["stock"], time="date", probe=keys.unionAll(keys).unionAll(keys),
    )


@query(
    "join_back_predictions",
    """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN ((o_orderkey * 7919) % 1000) / 1000.0 END AS proba
    FROM orders
    """,
)
def join_back_predictions(t: Tables) -> DataFrame:
    stored = t.orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (((F.col("o_orderkey") * 7919) % 1000) / 1000.0).alias("proba")
    )
    return attach_predictions(t.orders.select("o_orderkey", "o_totalprice"), stored, "o_orderkey")


@query(
    "null_share_by_key",
    """
    SELECT l_suppkey, count(*) FILTER (WHERE l_tax = 0) AS rows_with_nulls, count(*) AS rows_total,
           round_even(100.0 * count(*) FILTER (WHERE l_tax = 0) / count(*), 1) AS null_percent
    FROM lineitem GROUP BY 1
    """,
)
def null_share_by_key(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_suppkey", F.nullif("l_tax", F.lit(0.0)).alias("rate"), "l_extendedprice")
    return rel.null_share_by_key(rows, ["l_suppkey"], "rate", "l_extendedprice")


# --- calendars and fills ------------------------------------------------------------


@query(
    "calendar_spine",
    """
    SELECT user_id, CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) + 7, INTERVAL 1 DAY)) AS DATE) AS date
    FROM events GROUP BY user_id
    """,
)
def calendar_spine(t: Tables) -> DataFrame:
    return win.calendar_spine(t.events.select("user_id", day("ts").alias("date")), keys=["user_id"], time="date", future_days=7)


@query(
    "densify_fill",
    """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS value FROM events GROUP BY 1, 2),
         s AS (SELECT user_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM e GROUP BY 1)
    SELECT s.user_id, s.date, last_value(e.value IGNORE NULLS) OVER (PARTITION BY s.user_id ORDER BY s.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM s LEFT JOIN e ON s.user_id = e.user_id AND s.date = e.date
    """,
)
def densify_fill(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", day("ts").alias("date")).agg(F.max("value").alias("value"))
    return win.densify(daily, keys=["user_id"], time="date", columns=["value"])


def _sparse_events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value")
    )


@query(
    "fill_forward",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
      (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM events
    """,
)
def fill_forward(t: Tables) -> DataFrame:
    return fill(_sparse_events(t), USER_EVENTS, ["value"], "forward", probe=t.events).drop("ts")


@query(
    "fill_backward",
    """
    SELECT event_id, user_id, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
      (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
    FROM events
    """,
)
def fill_backward(t: Tables) -> DataFrame:
    return fill(_sparse_events(t), USER_EVENTS, ["value"], "backward", probe=t.events).drop("ts")


# --- shifts and changes -------------------------------------------------------------


@query(
    "shift_lag_lead",
    """
    SELECT event_id, user_id, lag(value, 1) OVER w AS prev_1, lag(value, 5) OVER w AS prev_5, lead(value, 2) OVER w AS next_2
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def shift_lag_lead(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value")
    wanted = {"prev_1": ("value", 1), "prev_5": ("value", 5), "next_2": ("value", -2)}
    return win.shift_rows(rows, USER_EVENTS, wanted).drop("ts", "value")


@query(
    "value_days_ago",
    f"""
    WITH {PRIORITY_DAYS_SQL}
    SELECT d.series_id, d.date, d.value, x.value AS exact_365, a.value AS known_365
    FROM d LEFT JOIN d x ON x.series_id = d.series_id AND x.date = d.date - 365
    ASOF LEFT JOIN d a ON a.series_id = d.series_id AND d.date - 365 >= a.date
    """,
)
def value_days_ago(t: Tables) -> DataFrame:
    common = {"keys": ["series_id"], "time": "date", "days": 365, "size": FITS}
    exact = asof.value_days_ago(priority_days(t), columns={"value": "exact_365"}, **common)
    return asof.value_days_ago(exact, columns={"value": "known_365"}, mode="asof", **common)


@query(
    "pct_change_k",
    f"""
    WITH {SUPPLIER_DAYS_SQL},
    p AS (SELECT *, CASE WHEN volume > 1 THEN close END AS thick FROM d),
    f AS (SELECT *, last_value(thick IGNORE NULLS) OVER (PARTITION BY stock ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS padded FROM p)
    SELECT stock, date, round(100 * (close / nullif(lag(close, 1) OVER w, 0) - 1), 4) AS chg_1,
           round(100 * (close / nullif(lag(close, 5) OVER w, 0) - 1), 4) AS chg_5,
           round(100 * (close / nullif(lag(close, 22) OVER w, 0) - 1), 4) AS chg_22,
           round(100 * (padded / nullif(lag(padded, 1) OVER w, 0) - 1), 4) AS padded_1
    FROM f WINDOW w AS (PARTITION BY stock ORDER BY date)
    """,
)
def pct_change_k(t: Tables) -> DataFrame:
    rows = supplier_days(t).withColumn("thick", F.when(F.col("volume") > 1, F.col("close")))
    moved = win.pct_change(rows, STOCK_DAYS, {"chg_1": ("close", 1), "chg_5": ("close", 5), "chg_22": ("close", 22)})
    padded = win.pct_change(moved, STOCK_DAYS, {"padded_1": ("thick", 1)}, pad="past")
    return rounded(padded.select("stock", "date", "chg_1", "chg_5", "chg_22", "padded_1"))


@query(
    "sma_full_window",
    f"""
    WITH {CUSTOMER_DAYS_SQL},
    p AS (SELECT stock, date, CASE WHEN volume = 1 THEN close END AS close FROM d)
    SELECT stock, date, round(CASE WHEN count(close) OVER w3 = 3 THEN avg(close) OVER w3 END, 4) AS sma3,
           round(CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END, 4) AS sma5
    FROM p WINDOW w3 AS (PARTITION BY stock ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
                  w5 AS (PARTITION BY stock ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
    """,
)
def sma_full_window(t: Tables) -> DataFrame:
    rows = customer_days(t).select("stock", "date", F.when(F.col("volume") == 1, F.col("close")).alias("close"))
    means = lambda w: {"sma3": full_mean("close", 3, w), "sma5": full_mean("close", 5, w)}
    return rounded(rolling(rows, STOCK_DAYS, means, before=5).drop("close"))


@query(
    "sma_vector_position",
    f"""
    WITH {PRIORITY_DAYS_SQL},
    m AS (SELECT *, CASE WHEN count(value) OVER w5 = 50 THEN avg(value) OVER w5 END AS s50,
                 CASE WHEN count(value) OVER w2 = 200 THEN avg(value) OVER w2 END AS s200
          FROM d WINDOW w5 AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
                        w2 AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW))
    SELECT series_id, date, round(100 * (s50 / nullif(lag(s50) OVER w, 0) - 1), 4) AS sma50_vector,
           round(100 * (s200 / nullif(lag(s200) OVER w, 0) - 1), 4) AS sma200_vector,
           round((s50 - value) / nullif(value, 0), 4) AS sma50_position,
           round((s200 - value) / nullif(value, 0), 4) AS sma200_position,
           round((s50 - s200) / nullif(s200, 0), 4) AS sma50_to_200
    FROM m WINDOW w AS (PARTITION BY series_id ORDER BY date)
    """,
)
def sma_vector_position(t: Tables) -> DataFrame:
    trend = win.sma_trend(priority_days(t), SERIES_DAYS, "value", (50, 200), prefix="p")
    return rounded(
        trend.select(
            "series_id", "date", F.col("p_sma50_vector").alias("sma50_vector"),
            F.col("p_sma200_vector").alias("sma200_vector"), F.col("p_sma50_position").alias("sma50_position"),
            F.col("p_sma200_position").alias("sma200_position"), F.col("p_sma50_to_200").alias("sma50_to_200"),
        )
    )


@query(
    "cumulative_product",
    """
    WITH c AS (SELECT l_partkey AS stock, CAST(l_shipdate AS DATE) AS date, product(1 / (1 + l_discount)) AS coef
               FROM lineitem GROUP BY 1, 2)
    SELECT stock, date, round(product(coef) OVER (PARTITION BY stock ORDER BY date DESC
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS factor
    FROM c
    """,
)
def cumulative_product(t: Tables) -> DataFrame:
    coefs = t.lineitem.groupBy(F.col("l_partkey").alias("stock"), day("l_shipdate").alias("date")).agg(
        F.product(1 / (1 + F.col("l_discount"))).alias("coef")
    )
    return rounded(win.cumulative_product(coefs, STOCK_DAYS, "coef", out="factor").drop("coef"), 6)


@query(
    "days_since_last_event",
    """
    SELECT event_id, user_id, CAST(date_diff('day', last_value(CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), CAST(ts AS DATE)) AS INT) AS days
    FROM events
    """,
)
def days_since_last_event(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    since = win.days_since(rows, USER_EVENTS, F.col("event_type") == "error", out="days", time="ts", probe=t.events)
    return since.drop("ts", "event_type")


LEVELS_SQL = "e AS (SELECT event_id, user_id, ts, floor(value / 20) AS level FROM events)"


def _levels(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "ts", F.floor(F.col("value") / 20).cast("double").alias("level"))


@query(
    "change_points",
    f"""
    WITH {LEVELS_SQL},
    c AS (SELECT *, level - lag(level) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change FROM e)
    SELECT event_id, user_id, level, change, lag(change) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_change
    FROM c WHERE change <> 0
    """,
)
def change_points(t: Tables) -> DataFrame:
    return win.change_points(_levels(t), USER_EVENTS, "level", probe=t.events).drop("ts")


@query(
    "carry_last_change",
    f"""
    WITH {LEVELS_SQL},
    c AS (SELECT *, level - lag(level) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change FROM e)
    SELECT event_id, user_id, last_value(nullif(change, 0) IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_step
    FROM c
    """,
)
def carry_last_change(t: Tables) -> DataFrame:
    return win.carry_last_change(_levels(t), USER_EVENTS, "level", out="last_step", probe=t.events).drop("ts", "level")


# --- labels -------------------------------------------------------------------------


@query(
    "forward_return",
    f"WITH {SUPPLIER_DAYS_SQL} SELECT stock, date, "
    + ", ".join(
        f"round(100 * (lead(close, {rows}) OVER w / nullif(open, 0) - 1), 4) AS future_{days}dprice_change"
        for days, rows in win.HORIZON_ROWS.items()
    )
    + " FROM d WINDOW w AS (PARTITION BY stock ORDER BY date)",
)
def forward_return(t: Tables) -> DataFrame:
    labelled = win.forward_returns(supplier_days(t), STOCK_DAYS, win.label_horizons())
    return rounded(labelled.drop("open", "close", "volume"))


@query(
    "forward_return_close",
    f"""
    WITH {CUSTOMER_DAYS_SQL}
    SELECT stock, date, round(lead(close, 2) OVER w / nullif(close, 0) - 1, 6) AS ret_2,
           round(lead(close, 4) OVER w / nullif(close, 0) - 1, 6) AS ret_4
    FROM d WINDOW w AS (PARTITION BY stock ORDER BY date)
    """,
)
def forward_return_close(t: Tables) -> DataFrame:
    labelled = win.forward_returns(customer_days(t), STOCK_DAYS, {"ret_2": 2, "ret_4": 4}, base="close", scale=1.0)
    return rounded(labelled.select("stock", "date", "ret_2", "ret_4"), 6)
