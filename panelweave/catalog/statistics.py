"""Audits, statistics and dataset splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.catalog.registry import Tables, day, query, rounded
from panelweave.operators import relational as rel, splits as sp, stats

LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
GAPS = {"l_quantity": 7.0, "l_discount": 0.03, "l_tax": 0.0}


def gappy_lines(t: Tables) -> DataFrame:
    """Lines with some values missing."""
    return t.lineitem.withColumns({c: F.nullif(c, F.lit(v)) for c, v in GAPS.items()})


GAPPY_SQL = """
    g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_quantity, 7) AS l_quantity, l_extendedprice,
                 nullif(l_discount, 0.03) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)
"""


@query(
    "null_audit",
    f"WITH {GAPPY_SQL}"
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_nulls FROM g WHERE {c} IS NULL HAVING count(*) > 0" for c in LINE),
)
def null_audit(t: Tables) -> DataFrame:
    return stats.null_audit(gappy_lines(t))


@query(
    "attrition_report",
    f"""
    WITH {GAPPY_SQL},
    f AS (SELECT l_partkey, l_quantity IS NOT NULL AS a, l_discount IS NOT NULL AND l_quantity IS NOT NULL AS b,
                 l_tax > 0.05 AND l_discount IS NOT NULL AND l_quantity IS NOT NULL AS c FROM g)
    SELECT 0 AS step_no, 'start' AS step, count(DISTINCT l_partkey) AS n_keys, count(*) AS n_rows FROM f
    UNION ALL SELECT 1, 'quantity', count(DISTINCT l_partkey), count(*) FROM f WHERE a
    UNION ALL SELECT 2, 'discount', count(DISTINCT l_partkey), count(*) FROM f WHERE b
    UNION ALL SELECT 3, 'tax', count(DISTINCT l_partkey), count(*) FROM f WHERE c
    """,
)
def attrition_report(t: Tables) -> DataFrame:
    c = F.col
    steps = [
        ("quantity", c("l_quantity").isNotNull()), ("discount", c("l_discount").isNotNull()), ("tax", c("l_tax") > 0.05),
    ]
    return stats.attrition_report(gappy_lines(t), "l_partkey", steps)


@query(
    "group_aggregates",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n, count(DISTINCT l_suppkey) AS n_stocks,
           round(avg(l_extendedprice), 4) AS avg_price FROM lineitem GROUP BY 1, 2
    """,
)
def group_aggregates(t: Tables) -> DataFrame:
    return rounded(
        t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
            F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"),
            F.count_distinct("l_suppkey").alias("n_stocks"), F.avg("l_extendedprice").alias("avg_price"),
        )
    )


@query(
    "group_outcome_stats",
    """
    SELECT l_returnflag || ' ' || l_linestatus AS outcome, round(avg(l_extendedprice), 4) AS mean,
           round(median(l_extendedprice), 4) AS median, min(l_extendedprice) AS min, max(l_extendedprice) AS max
    FROM lineitem GROUP BY 1
    """,
)
def group_outcome_stats(t: Tables) -> DataFrame:
    tagged = t.lineitem.select(F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("outcome"), "l_extendedprice")
    return rounded(stats.group_outcome_stats(tagged, ["outcome"], "l_extendedprice"))


@query(
    "impute_group_mean",
    f"""
    WITH {GAPPY_SQL}, m AS (SELECT l_returnflag, avg(l_quantity) AS v FROM g GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, round(coalesce(l_quantity, v), 6) AS l_quantity
    FROM g JOIN m USING (l_returnflag)
    """,
)
def impute_group_mean(t: Tables) -> DataFrame:
    rows = gappy_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return rounded(stats.impute_group_mean(rows, "l_returnflag", "l_quantity")[0], 6)


@query(
    "group_mean_lookup",
    f"WITH {GAPPY_SQL} SELECT l_returnflag, round(avg(l_quantity), 6) AS group_mean FROM g GROUP BY 1",
)
def group_mean_lookup(t: Tables) -> DataFrame:
    return rounded(stats.impute_group_mean(gappy_lines(t), "l_returnflag", "l_quantity")[1], 6)


@query(
    "share_of_total",
    """
    SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, round(100 * sum(o_totalprice) / sum(sum(o_totalprice)) OVER (), 6) AS share_percent
    FROM orders GROUP BY 1
    """,
)
def share_of_total(t: Tables) -> DataFrame:
    shares = rel.share_of_total(t.orders, ["o_orderpriority"], F.col("o_totalprice"))
    return rounded(rounded(shares, 2, ("total",)), 6, ("share_percent",))


def _describe_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
            round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
            max({c}) AS max FROM g"""
        for c in columns
    )


@query("describe_columns", f"WITH {GAPPY_SQL} {_describe_sql(LINE)}")
def describe_columns(t: Tables) -> DataFrame:
    return rounded(stats.describe(gappy_lines(t), LINE, base=t.lineitem), 6)


# --- correlation --------------------------------------------------------------------

PAIRED = ("l_quantity", "l_extendedprice", "l_discount", "gross")
PAIRED_SQL = f"{GAPPY_SQL}, x AS (SELECT *, l_extendedprice * (1 + coalesce(l_tax, 0)) AS gross FROM g)"


def _pairs_sql() -> list[tuple[str, str, str]]:
    return [
        (a, b, f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r FROM x")
        for i, a in enumerate(PAIRED) for b in PAIRED[i + 1:]
    ]


def _paired(t: Tables) -> DataFrame:
    return gappy_lines(t).withColumn("gross", F.col("l_extendedprice") * (1 + F.coalesce("l_tax", F.lit(0.0))))


@query(
    "corr_pairs",
    f"WITH {PAIRED_SQL}, c AS (" + " UNION ALL ".join(s for _, _, s in _pairs_sql())
    + ") SELECT column_a, column_b, round(r, 8) AS r FROM c WHERE r > 0.4",
)
def corr_pairs(t: Tables) -> DataFrame:
    return rounded(stats.corr_pairs(_paired(t), PAIRED, 0.4), 8)


@query(
    "corr_matrix",
    f"WITH {PAIRED_SQL}, c AS (" + " UNION ALL ".join(s for _, _, s in _pairs_sql())
    + ") SELECT column_a, column_b, round(r, 8) AS r FROM c UNION ALL SELECT column_b, column_a, round(r, 8) FROM c UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in PAIRED),
)
def corr_matrix(t: Tables) -> DataFrame:
    return rounded(stats.corr_matrix(_paired(t), PAIRED), 8)


@query(
    "corr_spearman",
    f"""
    WITH {GAPPY_SQL},
    k AS (SELECT l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM g WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL),
    r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
                 rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb,
                 rank() OVER (ORDER BY c) + (count(*) OVER (PARTITION BY c) - 1) / 2.0 AS rc FROM k)
    SELECT 'l_quantity' AS column_a, 'l_extendedprice' AS column_b, round(corr(ra, rb), 8) AS r FROM r
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(ra, rc), 8) FROM r
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(rb, rc), 8) FROM r
    """,
)
def corr_spearman(t: Tables) -> DataFrame:
    return rounded(stats.spearman(gappy_lines(t), ("l_quantity", "l_extendedprice", "l_discount")), 8)


# --- shape --------------------------------------------------------------------------

SHAPED = ("l_quantity", "l_extendedprice", "cubed")
SHAPED_SQL = f"{GAPPY_SQL}, s AS (SELECT *, power(l_quantity / 10, 3) AS cubed FROM g)"


def _shaped(t: Tables) -> DataFrame:
    return gappy_lines(t).withColumn("cubed", F.pow(F.col("l_quantity") / 10, F.lit(3)))


@query(
    "skewness_buckets",
    f"WITH {SHAPED_SQL}, k AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", skewness({c}) AS v FROM s" for c in SHAPED)
    + ") SELECT \"column\", round(v, 6) AS skewness, CASE WHEN v <= -1 THEN 'skewed_low' WHEN v >= 1 THEN 'skewed_high' ELSE 'not_skewed' END AS bucket FROM k",
)
def skewness_buckets(t: Tables) -> DataFrame:
    return rounded(stats.skewness_buckets(_shaped(t), SHAPED), 6)


@query(
    "normality_jb",
    f"WITH {SHAPED_SQL}, k AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) AS sk,
            avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3 AS ku FROM s, (SELECT avg({c}) AS m FROM s)"""
        for c in SHAPED
    )
    + ") SELECT \"column\", n, round(n / 6.0 * (sk * sk + ku * ku / 4), 3) AS jb, n / 6.0 * (sk * sk + ku * ku / 4) < 10.597 AS looks_normal FROM k",
)
def normality_jb(t: Tables) -> DataFrame:
    return rounded(stats.normality_jb(_shaped(t), SHAPED), 3)


@query(
    "winsorize_3sigma",
    """
    WITH b AS (SELECT avg(cu) - 1.5 * stddev_samp(cu) AS lo, avg(cu) + 1.5 * stddev_samp(cu) AS hi
               FROM (SELECT power(l_quantity / 10, 3) AS cu FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'))
    SELECT l_orderkey, l_linenumber, l_partkey,
           round(CASE WHEN power(l_quantity / 10, 3) > hi THEN hi WHEN power(l_quantity / 10, 3) < lo THEN lo ELSE power(l_quantity / 10, 3) END, 5) AS cubed
    FROM lineitem, b
    """,
)
def winsorize(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.pow(F.col("l_quantity") / 10, F.lit(3)).alias("cubed")
    )
    train = rows.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return rounded(stats.winsorize(rows, ["cubed"], train, deviations=1.5).drop("l_shipdate"), 5)


@query(
    "histogram_bins",
    f"WITH {GAPPY_SQL}, v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM g WHERE {c} IS NOT NULL" for c in ("l_quantity", "l_extendedprice"))
    + """), e AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM v GROUP BY 1)
    SELECT v."column", CAST(least(floor((value - lo) / ((hi - lo) / 100)), 99) AS BIGINT) AS bin, count(*) AS n
    FROM v JOIN e ON v."column" = e."column" GROUP BY 1, 2""",
)
def histogram_bins(t: Tables) -> DataFrame:
    return stats.histogram(gappy_lines(t), ("l_quantity", "l_extendedprice"))


@query(
    "box_stats_by_group",
    """
    WITH q AS (SELECT l_returnflag, quantile_cont(cu, 0.25) AS q1, quantile_cont(cu, 0.5) AS median, quantile_cont(cu, 0.75) AS q3
               FROM (SELECT l_returnflag, power(l_quantity / 10, 6) AS cu FROM lineitem) GROUP BY 1),
    v AS (SELECT q.*, power(l_quantity / 10, 6) AS cu, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM lineitem JOIN q USING (l_returnflag))
    SELECT l_returnflag, round(q1, 5) AS q1, round(median, 5) AS median, round(q3, 5) AS q3,
           round(min(cu) FILTER (WHERE cu BETWEEN lo AND hi), 5) AS whisker_low, round(max(cu) FILTER (WHERE cu BETWEEN lo AND hi), 5) AS whisker_high,
           count(*) FILTER (WHERE NOT (cu BETWEEN lo AND hi)) AS n_outliers FROM v GROUP BY ALL
    """,
)
def box_stats_by_group(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", F.pow(F.col("l_quantity") / 10, F.lit(6)).alias("cu"))
    return rounded(stats.box_stats(rows, "l_returnflag", "cu"), 5)


@query(
    "date_bounds",
    "SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day, count(*) AS n FROM orders",
)
def date_bounds(t: Tables) -> DataFrame:
    d = day("o_orderdate")
    return t.orders.agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"), F.count("*").alias("n"))


@query(
    "class_balance",
    "SELECT 'quality' AS label, round(avg(quality), 6) AS share_of_ones FROM labels UNION ALL SELECT 'toxic', round(avg(toxic), 6) FROM labels",
)
def class_balance(t: Tables) -> DataFrame:
    return rounded(stats.class_balance(t.labels, ["quality", "toxic"]), 6)


PROFILED = ("l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")


@query(
    "distinct_profile_by_flag",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT l_tax = 0 AS no_tax, '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem GROUP BY 1" for c in PROFILED
    ) + ") WHERE n_distinct < 20",
)
def distinct_profile_by_flag(t: Tables) -> DataFrame:
    return stats.distinct_profile(t.lineitem.withColumn("no_tax", F.col("l_tax") == 0), "no_tax", PROFILED)


# --- dataset splits -----------------------------------------------------------------

TARGET_SQL = """
    o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS target FROM orders),
    n AS (SELECT *, row_number() OVER (ORDER BY date DESC, o_orderkey) AS rn, count(*) OVER () AS total FROM o WHERE target IS NOT NULL)
"""


def targets(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", day("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("target"),
    )


@query(
    "holdout_newest_pct",
    f"WITH {TARGET_SQL} SELECT o_orderkey, date, target FROM n WHERE rn <= floor(total * 0.05)",
)
def holdout_newest_pct(t: Tables) -> DataFrame:
    return sp.holdout_newest(targets(t), time="date", target="target", tie=["o_orderkey"])[1]


@query(
    "purge_gap",
    f"""
    WITH {TARGET_SQL}, tr AS (SELECT o_orderkey, date, target FROM n WHERE rn > floor(total * 0.05))
    SELECT * FROM tr WHERE date < (SELECT max(date) FROM tr) - 30
    """,
)
def purge_gap(t: Tables) -> DataFrame:
    train, _ = sp.holdout_newest(targets(t), time="date", target="target", tie=["o_orderkey"])
    return sp.purge_gap(train, time="date", days=30)


@query(
    "ts_folds",
    """
    WITH p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS position,
                      count(*) OVER () AS total FROM orders),
    f AS (SELECT *, total - (3 - fold) * 200 AS start FROM p, (SELECT CAST(unnest(range(3)) AS INT) AS fold))
    SELECT o_orderkey, date, fold, CASE WHEN position >= start THEN 'test' ELSE 'train' END AS part
    FROM f WHERE position < start - 75 OR (position >= start AND position < start + 200)
    """,
)
def ts_folds(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("date"))
    return sp.time_folds(rows, time="date", tie=["o_orderkey"], n_splits=3, test_size=200, gap=75)


@query(
    "out_of_time_set",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
    """,
)
def out_of_time_set(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("date"))
    return sp.out_of_time(rows, rows.filter(F.col("date") < "2001-01-01"), time="date")
