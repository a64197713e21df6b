"""Sources, projections, filters, scalar functions, de-duplication, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.catalog import landed
from panelweave.catalog.registry import Tables, day, query, rounded
from panelweave.functions import scalars as sc
from panelweave.operators import relational as rel
from panelweave.operators.timeline import Axis
from panelweave.operators.windows import every_nth_row
from panelweave.plans.panel import latest_snapshot
from panelweave.session import scratch_path
from panelweave.sources import files

# --- sources and sinks --------------------------------------------------------------


@query(
    "scan_tag_source",
    "SELECT o_orderkey, o_totalprice, o_orderstatus AS stock FROM orders",
)
def scan_tag_source(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tagged-csv")
    t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").option(
        "header", True
    ).csv(path)
    return files.read_panel_dir(t.spark, path, "o_orderkey bigint, o_totalprice double", tag_from="folder")


@query(
    "scan_csv_dates",
    "SELECT event_id, CAST(ts AS DATE) AS date, value FROM events",
)
def scan_csv_dates(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dated-csv")
    t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), "value").write.option(
        "header", True
    ).csv(path)
    return files.read_csv_table(t.spark, path, "event_id bigint, date string, value double", dates=["date"])


@query(
    "json_map_explode",
    """
    WITH m AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, value FROM events)
    SELECT event_id, d AS date, try_cast(k * f AS DOUBLE) AS eps
    FROM m, (VALUES ('2024-03-31', 1), ('2024-06-30', 2)) AS q(d, f)
    """,
)
def json_map_explode(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    entry = lambda d, f: F.concat(
        F.lit(f'"{d}":{{"date":"{d}","eps":"'), (k * f).cast("string"), F.lit('"}')
    )
    text = F.concat(F.lit("{"), entry("2024-03-31", 1), F.lit(","), entry("2024-06-30", 2), F.lit("}"))
    rows = t.events.select("event_id", *files.keyed_json_rows(text, "date string, eps string", "date"))
    return rows.select("event_id", "date", sc.to_number("entry.eps").alias("eps"))


@query(
    "json_array_explode",
    """
    SELECT event_id, p AS period, CAST(CAST(json_extract(props, '$.k') AS INT) + o AS DOUBLE) AS estimate
    FROM events, (VALUES ('0q', 0), ('+1y', 100)) AS q(p, o)
    """,
)
def json_array_explode(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    item = lambda p, o: F.concat(
        F.lit(f'{{"period":"{p}","estimate":"'), (k + o).cast("string"), F.lit('"}')
    )
    text = F.concat(F.lit("[["), item("0q", 0), F.lit(","), item("+1y", 100), F.lit('],[{"period":"x"}]]'))
    rows = t.events.select("event_id", files.nested_json_rows(text, "period string, estimate string"))
    return rows.select("event_id", "period", sc.to_number("estimate").alias("estimate"))


@query(
    "scan_symbols",
    "SELECT replace(trim(p_brand || '.' || p_name), '.', '-') AS stock FROM part",
)
def scan_symbols(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "symbols-txt")
    t.part.select(F.concat_ws(".", "p_brand", "p_name").alias("value")).write.text(path)
    return files.read_symbols(t.spark, path)


@query(
    "panel_roundtrip",
    """
    SELECT o_custkey AS stock, CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice
    FROM orders WHERE o_orderdate >= DATE '1998-01-01'
    """,
)
def panel_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "panel")
    panel = t.orders.select(F.col("o_custkey").alias("stock"), day("o_orderdate").alias("date"), "o_orderkey", "o_totalprice")
    files.write_panel(panel, path)
    return files.read_panel(t.spark, path, since="1998-01-01")


# --- projections and filters --------------------------------------------------------


@query(
    "project_rename",
    "SELECT o_orderkey AS row_id, o_custkey AS stock, o_totalprice AS close FROM orders",
)
def project_rename(t: Tables) -> DataFrame:
    return t.orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority").withColumnsRenamed(
        {"o_orderkey": "row_id", "o_custkey": "stock", "o_totalprice": "close"}
    )


@query(
    "filter_not_null",
    """
    SELECT l_orderkey, l_linenumber, rate, margin FROM (
      SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS rate, nullif(l_tax, 0) AS margin FROM lineitem
    ) WHERE rate IS NOT NULL AND margin IS NOT NULL
    """,
)
def filter_not_null(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("rate"), F.nullif("l_tax", F.lit(0.0)).alias("margin"),
    )
    return lines.dropna(subset=["rate", "margin"])


@query(
    "filter_date_range",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders
    WHERE o_orderdate > TIMESTAMP '1996-06-30' AND o_orderdate <= TIMESTAMP '1999-12-31' AND o_totalprice <> 0
    """,
)
def filter_date_range(t: Tables) -> DataFrame:
    when = F.col("o_orderdate")
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("1996-06-30", "1999-12-31"))
    kept = t.orders.filter((when > since) & (when <= until) & (F.col("o_totalprice") != 0))
    return kept.select("o_orderkey", day("o_orderdate").alias("date"), "o_totalprice")


@query(
    "filter_membership",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 450000)
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def filter_membership(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    flagged = t.orders.filter(F.col("o_totalprice") >= 450000)
    barred = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return rel.members(rel.members(rows, flagged, ["o_custkey"]), barred, ["o_custkey"], negate=True)


BOUNDS = {
    "l_quantity": (2.0, 48.0),
    "l_extendedprice": (1500.0, 99000.0),
    "l_discount": (None, 0.09),
    "l_tax": (None, 0.07),
}


@query(
    "range_outlier_count",
    """
    SELECT count(*) FILTER (WHERE bad) AS n_outside, count(*) FILTER (WHERE NOT bad) AS n_kept, count(*) AS n_rows
    FROM (SELECT l_quantity < 2 OR l_quantity > 48 OR l_extendedprice < 1500 OR l_extendedprice > 99000
                 OR l_discount > 0.09 OR l_tax > 0.07 AS bad FROM lineitem)
    """,
)
def range_outlier_count(t: Tables) -> DataFrame:
    return rel.count_outside(t.lineitem, BOUNDS)


@query(
    "range_outlier_removal",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE NOT (l_quantity < 2 OR l_quantity > 48 OR l_extendedprice < 1500 OR l_extendedprice > 99000
               OR l_discount > 0.09 OR l_tax > 0.07)
    """,
)
def range_outlier_removal(t: Tables) -> DataFrame:
    return rel.within_bounds(t.lineitem, BOUNDS).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(
    "str_contains",
    "SELECT p_partkey, p_name, p_type = 'PROMO' AS is_promo FROM part WHERE p_name LIKE '%r%'",
)
def str_contains(t: Tables) -> DataFrame:
    named = t.part.filter(F.col("p_name").contains("r"))
    return named.select("p_partkey", "p_name", (F.col("p_type") == "PROMO").alias("is_promo"))


@query(
    "str_split_ratio",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
           ELSE round((o_orderkey % 7) / nullif(CAST(o_custkey % 5 AS DOUBLE), 0), 6) END AS coef
    FROM orders
    """,
)
def str_split_ratio(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.concat((F.col("o_custkey") % 5).cast("string"), F.lit("/"), (F.col("o_orderkey") % 7).cast("string"))
    )
    return rounded(t.orders.select("o_orderkey", sc.split_ratio(text).alias("coef")), 6)


@query(
    "str_replace_concat",
    """
    SELECT p_partkey, replace(p_brand, '#', '-') AS symbol, CAST(p_size AS VARCHAR) AS days,
           p_type || ' ' || p_brand AS tag
    FROM part
    """,
)
def str_replace_concat(t: Tables) -> DataFrame:
    dotted = F.regexp_replace("p_brand", "#", ".")
    suffixed = F.concat(F.col("p_size").cast("string"), F.lit(" days 00:00:00"))
    return t.part.select(
        "p_partkey",
        sc.normalise_symbol(dotted).alias("symbol"),
        sc.strip_day_suffix(suffixed).alias("days"),
        sc.outcome_tag("p_type", "p_brand").alias("tag"),
    )


@query(
    "coerce_numeric",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS amount,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
           CAST(o_custkey AS INT) AS days
    FROM orders
    """,
)
def coerce_numeric(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    amount = F.when(status == "P", "None").otherwise(F.col("o_totalprice").cast("string"))
    when = F.when(status == "F", "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    span = F.concat(F.col("o_custkey").cast("string"), F.when(status == "O", ".0").otherwise(" days 00:00:00"))
    return t.orders.select(
        "o_orderkey", sc.to_number(amount).alias("amount"), sc.to_day(when).alias("date"),
        sc.to_int_days(span).alias("days"),
    )


# --- dates --------------------------------------------------------------------------


@query(
    "date_shift",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) - 60 AS announced, CAST(o_orderdate AS DATE) + 30 AS due,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS year_before
    FROM orders
    """,
)
def date_shift(t: Tables) -> DataFrame:
    d = day("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.date_sub(d, 60).alias("announced"), F.date_add(d, 30).alias("due"),
        sc.shift_years(d, -1).alias("year_before"),
    )


@query(
    "days_since",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INT) AS days_after_report
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def days_since(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    gap = sc.days_between(day("l_shipdate"), day("o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", gap.alias("days_after_report"))


@query(
    "fiscal_year",
    """
    SELECT CASE WHEN month(o_orderdate) <= 9 THEN year(o_orderdate) ELSE year(o_orderdate) + 1 END AS fiscal_year,
           count(*) AS n FROM orders GROUP BY 1
    """,
)
def fiscal_year(t: Tables) -> DataFrame:
    return t.orders.groupBy(sc.fiscal_year(day("o_orderdate")).alias("fiscal_year")).agg(F.count("*").alias("n"))


@query(
    "prev_business_day",
    """
    SELECT o_orderkey, CASE WHEN isodow(o_orderdate) = 1 THEN CAST(o_orderdate AS DATE) - 3
                            ELSE CAST(o_orderdate AS DATE) - 1 END AS prev_day
    FROM orders
    """,
)
def prev_business_day(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", sc.prev_business_day(day("o_orderdate")).alias("prev_day"))


# --- choices and arithmetic ---------------------------------------------------------


@query(
    "case_when",
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS in_credit,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS sector
    FROM customer
    """,
)
def case_when(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", sc.flag(F.col("c_acctbal") >= 0).alias("in_credit"),
        F.when(segment == "BUILDING", "CONSTRUCTION").otherwise(segment).alias("sector"),
    )


@query(
    "first_match",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_discount >= 0.08 THEN l_discount WHEN l_tax >= 0.06 THEN l_tax
                WHEN l_quantity >= 40 THEN l_quantity END AS picked
    FROM lineitem
    """,
)
def first_match(t: Tables) -> DataFrame:
    c = F.col
    picked = sc.first_match(
        [(c("l_discount") >= 0.08, "l_discount"), (c("l_tax") >= 0.06, "l_tax"), (c("l_quantity") >= 40, "l_quantity")]
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", picked.alias("picked"))


@query(
    "safe_ratio",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           round(l_tax / nullif(l_discount, 0), 6) AS tax_per_discount,
           round(100 * (l_extendedprice - l_quantity) / nullif(l_quantity, 0), 4) AS gap_percent,
           round(100 * abs(l_tax - l_discount) / nullif(l_discount, 0), 4) AS spread_percent
    FROM lineitem
    """,
)
def safe_ratio(t: Tables) -> DataFrame:
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(sc.ratio("l_tax", "l_discount"), 6).alias("tax_per_discount"),
        F.round(sc.percent_gap("l_extendedprice", "l_quantity"), 4).alias("gap_percent"),
        F.round(sc.percent(F.abs(c("l_tax") - c("l_discount")), "l_discount"), 4).alias("spread_percent"),
    )


@query("cbrt_transform", "SELECT c_custkey, round(cbrt(c_acctbal), 6) AS acctbal_cbrt FROM customer")
def cbrt_transform(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.round(F.cbrt("c_acctbal"), 6).alias("acctbal_cbrt"))


@query(
    "inf_zero_to_null",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_tax, 0) AS rate,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS lots
    FROM lineitem
    """,
)
def inf_zero_to_null(t: Tables) -> DataFrame:
    infinite = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_quantity"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        sc.blank_non_finite("l_tax", zero_is_missing=True).alias("rate"),
        sc.blank_non_finite(infinite).alias("lots"),
    )


@query(
    "fill_constant",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_tax END AS dy,
           CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE l_discount END AS dpr
    FROM lineitem
    """,
)
def fill_constant(t: Tables) -> DataFrame:
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_tax")).alias("dy"),
        F.when(F.col("l_linestatus") != "O", F.col("l_discount")).alias("dpr"),
    )
    return gaps.fillna({"dy": 0.0, "dpr": 1.0})


@query(
    "fill_from_column",
    """
    SELECT o_orderkey,
      coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS DOUBLE) END) AS actual,
      coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS DOUBLE) END, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS estimate
    FROM orders
    """,
)
def fill_from_column(t: Tables) -> DataFrame:
    both = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("a"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("double")).alias("e"),
    )
    return both.select(
        "o_orderkey", sc.first_not_null(["a", "e"]).alias("actual"), sc.first_not_null(["e", "a"]).alias("estimate")
    )


@query(
    "clip_bounds",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity, 5.0), 45.0) AS quantity,
           CASE WHEN l_tax = 0 THEN NULL ELSE least(greatest(l_tax, 0.02), 0.06) END AS tax
    FROM lineitem
    """,
)
def clip_bounds(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", sc.clip("l_quantity", 5.0, 45.0).alias("quantity"),
        sc.clip(F.nullif("l_tax", F.lit(0.0)), 0.02, 0.06).alias("tax"),
    )


@query(
    "override_by_keyset",
    """
    WITH low AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_totalprice) < 400000),
         first_day AS (SELECT CAST(min(o_orderdate) AS DATE) AS d FROM orders)
    SELECT o_orderkey, o_custkey,
           CASE WHEN l.o_custkey IS NOT NULL THEN 0.0 ELSE o_totalprice END AS amount,
           CASE WHEN l.o_custkey IS NOT NULL THEN CAST(date_diff('day', d, CAST(o_orderdate AS DATE)) AS INT) END AS days
    FROM orders o LEFT JOIN low l USING (o_custkey), first_day
    """,
)
def override_by_keyset(t: Tables) -> DataFrame:
    low = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("m")).filter(F.col("m") < 400000)
    start = t.orders.agg(F.min(day("o_orderdate")).alias("start"))
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"), day("o_orderdate").alias("date"),
        F.lit(None).cast("int").alias("days"),
    ).join(F.broadcast(start))  # exactly one row
    done = rel.override_for_keys(
        rows, low, ["o_custkey"], {"amount": F.lit(0.0), "days": sc.days_between("date", "start")}
    )
    return done.drop("date", "start")


@query(
    "round_metrics",
    "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_extendedprice / 8, 1) AS share FROM lineitem",
)
def round_metrics(t: Tables) -> DataFrame:
    share = sc.round_half_even(F.col("l_extendedprice") / 8, 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", share.alias("share"))


# --- sorts, limits, duplicates ------------------------------------------------------


@query(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_n(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rel.top_n(rows, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "latest_snapshot",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
    """,
)
def latest_snapshot_query(t: Tables) -> DataFrame:
    newest = t.orders.agg(F.max("o_orderdate")).first()[0]  # one value, as the caller would pass it
    return latest_snapshot(t.orders, F.lit(newest).cast("timestamp_ntz"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "panel_snapshot",
    """
    SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS open, max(l_extendedprice) AS close
    FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) GROUP BY 1, 2
    """,
)
def panel_snapshot(t: Tables) -> DataFrame:
    """The newest day of a written panel, read from the folder of its year."""
    path = scratch_path(t.spark, "snapshot")
    files.write_panel(landed.prices(t), path)
    newest = t.lineitem.agg(F.max(day("l_shipdate"))).first()[0]  # one value, as the caller would pass it
    return files.read_day(t.spark, path, newest).select("stock", "date", "open", "close")


@query(
    "every_nth_row",
    """
    SELECT user_id, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE (rn - 1) % 5 = 0
    """,
)
def every_nth_row_query(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "ts", "value")
    return every_nth_row(rows, Axis.of("user_id", ["ts", "event_id"]), 5).drop("ts")


@query(
    "dedup_keep_ordered",
    """
    SELECT l_suppkey AS stock, CAST(l_shipdate AS DATE) AS filing_date, min(l_orderkey) AS date FROM lineitem GROUP BY 1, 2
    """,
)
def dedup_keep_ordered(t: Tables) -> DataFrame:
    filed = t.lineitem.select(
        F.col("l_suppkey").alias("stock"), day("l_shipdate").alias("filing_date"), F.col("l_orderkey").alias("date")
    )
    return rel.dedup_statements(filed, ["stock"], "filing_date", "date")


@query(
    "dedup_shift_day",
    """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + CASE WHEN row_number() OVER
           (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) > 1 THEN 1 ELSE 0 END AS date
    FROM orders
    """,
)
def dedup_shift_day(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", day("o_orderdate").alias("date"))
    return rel.shift_repeated_dates(rows, ["o_custkey"], "date", ["o_orderkey"])


@query(
    "duplicate_row_count",
    """
    SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))
    """,
)
def duplicate_row_count(t: Tables) -> DataFrame:
    return rel.duplicate_row_count(t.lineitem.select("l_suppkey", day("l_shipdate").alias("date")))


@query(
    "distinct_values",
    "SELECT p_type, count(DISTINCT p_brand) AS n_brands, count(DISTINCT p_name) AS n_names FROM part GROUP BY 1",
)
def distinct_values(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type").agg(
        F.count_distinct("p_brand").alias("n_brands"), F.count_distinct("p_name").alias("n_names")
    )


@query(
    "hash_split",
    """
    SELECT o_orderkey, o_totalprice, ('0x' || substr(md5('42-' || o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 < 20 AS is_test FROM orders
    """,
)
def hash_split(t: Tables) -> DataFrame:
    return rel.hash_split(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])


# --- set operations -----------------------------------------------------------------


@query(
    "union_by_name",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def union_by_name(t: Tables) -> DataFrame:
    buyers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    sellers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return buyers.unionByName(sellers, allowMissingColumns=True)


@query(
    "key_difference",
    "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def key_difference(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return rel.key_difference(t.customer, urgent, ["c_custkey"])
