"""Quality rules as a short-circuit cascade.

Each rule rejects a document or lets it pass. The cost and the rejection rate of every rule
are measured on a sample first; rules then run in the order of rejections per second of cost,
and a document that one rule rejects meets no further rule. The order changes the time only:
a document is kept when no rule rejects it, so the verdict is the same in any order.

Null text counts as empty. An empty table gives an empty result. Repeated rows are judged each
for itself, extra columns are passed through (those named like a result column give way).
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import WORD, query, table, with_columns

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")


class TextView:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return _WORD.findall(self.text)

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(_SYMBOL.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        """Lines that have a word."""
        return [line for line in self.text.split("\n") if _WORD.search(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by 3-word windows that occur more than once."""
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered = end = 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                covered += start + 3 - max(start, end)
                end = start + 3
        return covered

    @cached_property
    def ascii_letters(self) -> tuple[int, int]:
        """(capitals, letters) among A-Z and a-z."""
        capitals = len(re.findall("[A-Z]", self.text))
        return capitals, capitals + len(re.findall("[a-z]", self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]


RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > 25 * t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("capitals", lambda t: 100 * t.ascii_letters[0] > 60 * t.ascii_letters[1]),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class RuleEstimate:
    name: str
    seconds: float
    rejected: int
    seen: int

    @property
    def worth(self) -> float:
        """Share of documents rejected for each second of one document's cost."""
        return self.rejected / max(self.seconds, 1e-9) if self.seen else 0.0


def estimate_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 2000,
                   seed: int = 7) -> list[RuleEstimate]:
    """Cost and selectivity of each rule alone, on a random sample of about ``sample_rows`` rows."""
    total = docs.count()
    if not total:
        return [RuleEstimate(r.name, 0.0, 0, 0) for r in rules]
    sample = docs.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / total), seed)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spent, hits = [0.0] * len(rules), [0] * len(rules)
            for value in batch["text"]:
                for i, rule in enumerate(rules):
                    view = TextView(value)
                    began = time.perf_counter()
                    hits[i] += bool(rule.rejects(view))
                    spent[i] += time.perf_counter() - began
            yield pd.DataFrame({"rule": range(len(rules)), "seconds": spent, "rejected": hits, "seen": len(batch)})

    sums = (
        sample.mapInPandas(probe, "rule int, seconds double, rejected long, seen long")
        .groupBy("rule").agg(F.sum("seconds"), F.sum("rejected"), F.sum("seen"))
    )
    found = {row[0]: row[1:] for row in sums.collect()}  # one row per rule
    return [RuleEstimate(r.name, *found.get(i, (0.0, 0, 0))) for i, r in enumerate(rules)]


def cascade_order(estimates: Sequence[RuleEstimate]) -> list[int]:
    return sorted(range(len(estimates)), key=lambda i: (-estimates[i].worth, i))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", measures: Sequence[str] = (),
                order: Sequence[int] | None = None) -> DataFrame:
    """The input with ``kept`` (no rule rejects the text) and the measures asked for.

    ``order`` is a permutation of the rules; by default it comes from ``estimate_rules``.
    One pass over the table without a shuffle; only the text goes to Python.
    """
    ordered = [rules[i] for i in (order if order is not None else cascade_order(estimate_rules(docs, rules, text)))]
    names = tuple(measures)
    schema = ", ".join(["kept boolean", *[f"{m} long" for m in names]])

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            view = TextView(value)
            kept = not any(rule.rejects(view) for rule in ordered)
            rows.append((kept, *[getattr(view, m) for m in names]))
        return pd.DataFrame(rows, columns=["kept", *names])

    judged = docs.withColumn("_judged", judge(F.col(text)))
    out = {m: F.col(f"_judged.{m}") for m in names} | {"kept": F.col("_judged.kept")}
    return with_columns(judged, out).drop("_judged")


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
tri AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM w, unnest(range(1, len(words) - 1)) AS u(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM tri) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, unnest([0, 1, 2]) AS u(k) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
full_lines AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM lines
               WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(f.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(f.n, 0) AS n_lines,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) AS caps, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters
      FROM w LEFT JOIN full_lines f USING (rid) LEFT JOIN cov c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 25 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 100 * caps > 60 * letters) AS kept
FROM m
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the verdict of the rule cascade."""
    judged = apply_rules(table(spark, sf_dir, "documents"), measures=MEASURES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *MEASURES, failed.alias("base_failed"), "kept")
