"""URL allow and block rules as a sort-merge range join.

A rule names a host and a path prefix; it fits the host and all its subdomains where the path
starts with the prefix, and the longest rule that fits wins. The canonical key of (host, path)
is the host with its labels reversed, then the path; a rule is the interval of all keys that
start with its own. A url has one such key for its host and one for each parent domain.

Rule starts, rule ends and url keys are sorted together, and one sweep keeps the stack of active
rules: intervals nest or are disjoint, so a start pushes a rule and an end pops it, and what a
url meets is the top of the stack. The stack after each event is known from the rules alone
(the rules that enclose it), so the sweep only carries the last event's stack forward.

The sweep runs per domain. A domain with a large share of all keys is dealt into pieces by
row, each with the few rule events of that domain, so a popular host never lands in one task.

Null urls and urls without "://" have an empty host and an empty path. They fit no rule and get
the default verdict. Repeated rows are judged each for itself, an empty table gives an empty
result, extra columns are passed through (those named like a result column give way).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.registry import literal_rows, query, table, with_columns

PIECES = 256  # a domain gets so many pieces as its share of all keys has 256ths
POP, PUSH, URL = 0, 1, 2  # the order of events with one key


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)


def url_host(url: Column) -> Column:
    """From the first "://" up to the next /, ?, # or the end, A-Z in lower case; empty where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _key(host: Column, path: Column) -> Column:
    """Bytes, so that an end mark can follow every continuation of a rule."""
    return F.encode(F.concat(_reversed(host), path), "UTF-8")


def _domains(host: Column) -> Column:
    """The host and each of its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_events(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """A push at the start of each rule's interval and a pop at its end, with the stack after it.

    The rules that enclose a rule are those of its host whose path is a prefix of its own.
    """
    plain = literal_rows(spark, [(r.host, r.path, r.verdict) for r in rules], ["r_host", "r_path", "r_verdict"], ["string"] * 3)
    prefixes = plain.select("r_host", F.col("r_path").alias("_own"), F.explode(
        F.transform(F.sequence(F.lit(0), F.length("r_path")), lambda i: F.substr("r_path", F.lit(1), i))).alias("r_path"))
    frame = F.struct(F.length("r_path").alias("depth"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))
    stacks = prefixes.join(plain, ["r_host", "r_path"]).groupBy("r_host", "_own").agg(F.array_sort(F.collect_list(frame)).alias("_stack"))
    start = _key(F.col("r_host"), F.col("_own"))
    end = F.concat(start, F.lit(bytearray(b"\xff")))  # above every UTF-8 continuation
    popped = F.slice("_stack", F.lit(1), F.size("_stack") - 1)
    both = F.array(
        F.struct(start.alias("_key"), F.lit(PUSH).alias("_kind"), F.col("_stack").alias("_stack")),
        F.struct(end.alias("_key"), F.lit(POP).alias("_kind"), popped.alias("_stack")),
    )
    return stacks.select(F.col("r_host").alias("_domain"), F.inline(both))


def filter_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """The input with ``host``, ``path``, ``rule`` (the longest that fits, or null) and ``verdict``."""
    spark = pages.sparkSession
    parts = with_columns(pages, {"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    kept = [c for c in parts.columns if c.lower() not in ("rule", "verdict")]
    numbered = parts.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.monotonically_increasing_id().alias("_id"))
    host, path = F.col("_row.host"), F.col("_row.path")

    hosts = sorted({r.host for r in rules})
    ruled = F.filter(_domains(host), lambda d: d.isin(hosts)) if hosts else F.array().cast("array<string>")
    keys = numbered.select("_id", "_row", F.explode_outer(ruled).alias("_domain"))  # a page that no rule's domain holds stays, as one row

    # at most PIECES x (parent domains of one url) domains have a share over 1/PIECES, so this table is small
    counts = parts.select(F.explode(F.filter(_domains(F.col("host")), lambda d: d.isin(hosts)) if hosts else F.array().cast("array<string>")).alias("_domain"))
    per_domain = counts.groupBy("_domain").count()
    total = per_domain.agg(F.sum("count").alias("_total"))
    shares = per_domain.crossJoin(F.broadcast(total)).select(  # total is one row
        "_domain", F.greatest(F.lit(1), F.floor(F.lit(PIECES) * F.col("count") / F.col("_total"))).cast("int").alias("_pieces"))
    heavy = F.broadcast(shares.filter(F.col("_pieces") > 1))

    dealt = keys.join(heavy, "_domain", "left").select(
        "_domain", F.when(F.col("_domain").isNull(), F.pmod(F.xxhash64("_id"), F.lit(1 << 20)))
        .otherwise(F.pmod(F.xxhash64("_id"), F.coalesce("_pieces", F.lit(1)))).cast("long").alias("_piece"),
        F.when(F.col("_domain").isNotNull(), _key(F.col("_domain"), path)).alias("_key"), F.lit(URL).alias("_kind"),
        F.lit(None).cast("array<struct<depth:int,rule:string,verdict:string>>").alias("_stack"), "_id", "_row")
    events = rule_events(spark, rules).join(heavy, "_domain", "left").select(
        "_domain", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)).cast("long") - 1)).alias("_piece"), "_key", "_kind",
        F.col("_stack").cast("array<struct<depth:int,rule:string,verdict:string>>").alias("_stack"),
        F.lit(None).cast("long").alias("_id"), F.lit(None).cast(keys.schema["_row"].dataType).alias("_row"))

    sweep = Window.partitionBy("_domain", "_piece").orderBy("_key", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = dealt.unionByName(events).withColumn("_stack", F.last("_stack", ignorenulls=True).over(sweep)).filter(F.col("_kind") == URL)
    top = F.when(F.size("_stack") > 0, F.element_at("_stack", -1))
    met = active.select("_id", "_row", top.alias("_top"))
    longest = F.max(F.when(F.col("_top").isNotNull(), F.struct(F.length("_top.rule").alias("n"), F.col("_top.rule").alias("rule"), F.col("_top.verdict").alias("verdict"))))
    best = met.groupBy("_id").agg(F.first("_row").alias("_row"), longest.alias("_best"))
    return best.select("_row.*", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


OP3_SQL = r"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (SELECT row_number() OVER () AS rid, page_id,
             translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
m AS (SELECT rid, max({'n': length(r_host || r_path), 'rule': r_host || r_path, 'verdict': r_verdict}) AS best
      FROM p JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY rid)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)
"""


@query("op3_url_filters", OP3_SQL)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")
