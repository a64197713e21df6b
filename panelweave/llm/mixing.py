"""Mix sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern). The token
capacity of each pattern, once per repetition, is routed to the quotas of its sources; the
k-th repetition of a token costs k, so the flow repeats as little as possible (convex costs).
Only the pattern table, one row per distinct set of sources, comes to the driver; its number
of rows is checked against ``max_patterns``. The flow of a pattern is then handed to documents:
whole repetitions go to all of them, the rest to the first ones in a seeded order, up to the
document whose middle lies at the rest. That order needs no global sort: sizes are added up by
hash bucket, and only the documents of the one bucket that holds the cut are ordered.

Null text has size 0 and takes 0. A null source is a source like any other. Repeated rows
count each; an empty table gives an empty result. Extra columns are passed through, those
named like a result column give way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.registry import literal_rows, query, table, with_columns, word_count
from panelweave.session import pin

BUCKET_DIGITS = 4  # hexadecimal digits of the seeded hash that make a bucket: 65,536 of them


def capped_targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Targets in proportion to the weights that sum to ``total``; none over ``cap`` times its size.

    What a capped source cannot take is shared again among the others by weight, until none is above.
    """
    order = sorted(range(len(sizes)), key=lambda i: cap * sizes[i] / weights[i])
    capped, free = 0.0, float(sum(weights))
    targets = [0.0] * len(sizes)
    for at, i in enumerate(order):
        level = (total - capped) / free
        if level * weights[i] <= cap * sizes[i]:
            for j in order[at:]:
                targets[j] = level * weights[j]
            break
        targets[i] = float(cap * sizes[i])
        capped += cap * sizes[i]
        free -= weights[i]
    return targets


def min_cost_flow(capacities: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], repeats: int) -> list[int]:
    """Tokens each pattern gives, filling the quotas as far as possible at least cost.

    Successive shortest paths. The k-th repetition of a pattern's tokens costs k, so a path's
    cost is that of the pattern it starts from; a path may run pattern - source - pattern
    - source, moving tokens between sources of one pattern to free quota.
    """
    flow = [defaultdict(int) for _ in capacities]  # by pattern: source -> tokens
    used, left = [0] * len(capacities), list(quotas)
    holders = defaultdict(list)
    for p, sources in enumerate(members):
        for s in sources:
            holders[s].append(p)
    for level in range(1, repeats + 1):  # all paths of cost ``level`` before any of cost ``level + 1``
        for start in range(len(capacities)):
            while used[start] < level * capacities[start]:
                came: dict[int, tuple[int, int | None]] = {s: (start, None) for s in members[start]}
                queue, end = list(came), None
                for s in queue:
                    if left[s] > 0:
                        end = s
                        break
                    for p in holders[s]:
                        if flow[p][s] > 0:
                            for t in members[p]:
                                if t not in came:
                                    came[t] = (p, s)
                                    queue.append(t)
                if end is None:
                    break
                amount, at = min(left[end], level * capacities[start] - used[start]), end
                while came[at][1] is not None:
                    amount, at = min(amount, flow[came[at][0]][came[at][1]]), came[at][1]
                at = end
                while at is not None:
                    p, before = came[at]
                    flow[p][at] += amount
                    if before is not None:
                        flow[p][before] -= amount
                    at = before
                used[start] += amount
                left[end] -= amount
    return used


@dataclass(frozen=True)
class Mix:
    """``sources``: name, size, target. ``patterns``: sources of the pattern, size, tokens given."""

    sources: list[tuple[str | None, int, float]]
    patterns: list[tuple[tuple[str | None, ...], int, int]]


def plan_mix(sized: DataFrame, weights: Sequence[float], share: float, repeats: int, max_patterns: int) -> Mix:
    """Quotas and flow from the pattern sizes. Weights go round over the sources by code point, null last."""
    rows = sized.groupBy("_pattern").agg(F.sum("size")).limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} distinct sets of sources: the flow is solved on the driver")
    patterns = sorted(((tuple(r[0]), int(r[1] or 0)) for r in rows), key=lambda p: [(s is None, s or "") for s in p[0]])
    names = sorted({s for p, _ in patterns for s in p}, key=lambda s: (s is None, s or ""))
    index = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for p, n in patterns:
        for s in p:
            sizes[index[s]] += n
    by_turn = [weights[i % len(weights)] for i in range(len(names))]
    targets = capped_targets(sizes, by_turn, share * sum(n for _, n in patterns), repeats)
    given = min_cost_flow([n for _, n in patterns], [[index[s] for s in p] for p, _ in patterns], [int(t) for t in targets], repeats)
    return Mix([(s, sizes[i], targets[i]) for s, i in index.items()], [(p, n, g) for (p, n), g in zip(patterns, given)])


def mix_sources(docs: DataFrame, sources: Column, size: Column, key: str = "doc_id", weights: Sequence[float] = (3, 1, 2),
                share: float = 1.5, repeats: int = 2, seed: int = 17, max_patterns: int = 100_000) -> tuple[DataFrame, Mix]:
    """The input with ``size`` (words) and ``taken`` (words the mix takes, repeats counted), and the plan.

    ``sources`` is an array of the sources a document belongs to, ``size`` its words. The input is
    read four times, so hand in a narrow frame with the sizes stored, as ``sized_documents`` makes.
    Reruns give the same result: the order is that of md5(seed, key), ties by size.
    """
    spark = docs.sparkSession
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    pattern = F.array_sort(F.array_distinct(sources))
    sized = with_columns(docs, {"size": F.coalesce(size.cast("long"), F.lit(0)), "_pattern": pattern, "_hash": digest})
    sized = sized.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    mix = plan_mix(sized, weights, share, repeats, max_patterns)

    rows = [(list(p), g // n if n else 0, g - (g // n) * n if n else 0) for p, n, g in mix.patterns]
    plans = literal_rows(spark, rows, ["_of", "_times", "_rest"], ["array<string>", "long", "long"])
    planned = sized.join(F.broadcast(plans), F.col("_pattern").eqNullSafe(F.col("_of")), "left")  # one row per pattern, counted above

    # sums by bucket: at most 65,536 rows per pattern, whatever the number of documents
    buckets = planned.filter(F.col("_rest") > 0).groupBy("_of", "_rest", "_bucket").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("_of").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        buckets.withColumn("_end", F.sum("_sum").over(upto))
        .filter(F.col("_end") >= F.col("_rest"))
        .groupBy("_of").agg(F.min(F.struct("_bucket", (F.col("_end") - F.col("_sum")).alias("_before"))).alias("_cut"))
        .select(F.col("_of").alias("_cut_of"), F.col("_cut._bucket").alias("_cut_bucket"), F.col("_cut._before").alias("_before"))
    )
    found = planned.join(F.broadcast(cuts), F.col("_of").eqNullSafe(F.col("_cut_of")), "left")  # one row per pattern at most
    at_cut = F.coalesce(F.col("_bucket") == F.col("_cut_bucket"), F.lit(False))
    whole = found.filter(~at_cut).withColumn("_extra", F.coalesce(F.col("_bucket") < F.col("_cut_bucket"), F.lit(False)))
    earlier = Window.partitionBy("_of", "_bucket").orderBy("_hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("_before") + F.sum("size").over(earlier)
    cut = found.filter(at_cut).withColumn("_extra", 2 * end - F.col("size") <= 2 * F.col("_rest"))
    both = whole.unionByName(cut)
    taken = F.coalesce(F.col("size") * (F.col("_times") + F.col("_extra").cast("long")), F.lit(0))
    return with_columns(both, {"taken": taken}).drop("_pattern", "_hash", "_bucket", "_of", "_times", "_rest", "_cut_of",
                                                     "_cut_bucket", "_before", "_extra"), mix


def sized_documents(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source"), text: str = "text") -> DataFrame:
    """The columns named and the number of words, stored once; texts are read once and stay where they are."""
    return pin(docs.select(*columns, word_count(F.col(text)).alias("size")))


def mix_by_source(docs: DataFrame, **options) -> DataFrame:
    """``mix_sources`` for one source per document, with ``source_size`` and ``target`` of that source."""
    taken, mix = mix_sources(docs, F.array(F.col("source")), F.col("size"), **options)
    rows = literal_rows(docs.sparkSession, mix.sources, ["_name", "source_size", "target"], ["string", "long", "double"])
    taken = taken.drop("source_size", "target")
    return taken.join(F.broadcast(rows), F.col("source").eqNullSafe(F.col("_name")), "left").drop("_name")  # one row per source


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT source, source_size, (CASE i % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight, i FROM s),
o AS (SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
             1.5::DOUBLE * sum(source_size) OVER () AS total
      FROM w WINDOW before AS (ORDER BY 2.0 * source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - capped) / free AS level, row_number() OVER (ORDER BY 2.0 * source_size / weight, i) AS pos FROM o),
level AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM l WHERE level * weight <= 2.0 * source_size),
t AS (SELECT source, source_size, CASE WHEN l.pos >= v.pos THEN v.level * weight ELSE 2.0 * source_size END::DOUBLE AS target
      FROM l CROSS JOIN level v),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS times FROM t),
r AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.times, floor(q.target)::BIGINT - q.times * q.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('17-' || coalesce(d.doc_id::VARCHAR, 'null')), d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_end
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (size * (times + CASE WHEN rest > 0 AND 2 * run_end - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""


@query("op8_mix_sources", OP8_SQL)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    docs = sized_documents(table(spark, sf_dir, "documents"))
    return mix_by_source(docs).select("doc_id", "size", "source_size", "target", "taken")
