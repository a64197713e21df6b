"""Secret scans with multipart credential linking.

Strong parts are reported wherever they are: assignments to a password-like name (``assign``),
access key identifiers (``access``) and long hexadecimal runs (``hex``). Weak parts mean nothing
alone: identifiers (``ident``: user, login, client id, account), keys of 32 to 128 letters of either case
and digits, padded or not (``blob``), and endpoints (``endpoint``: http addresses). They are reported when parts
that complement them lie in their scope, which is the text up to ``scope`` characters around them:

* ident: a secret (assign, hex or blob),
* blob: an identifier (access or ident),
* endpoint: an identifier and a secret.

The interval join of parts and scopes is two sweeps over a document's parts in text order: what
was the last end of each role so far, and from behind what is its next start. All of it is
column expressions on one row; there is no shuffle.

Null text counts as empty. A text of n parts takes about n steps, so long texts with many parts are safe.
Parts that begin together are ordered by end and kind. Repeated rows are scanned each for itself, an empty table gives an
empty result, extra columns are passed through (those named like a result column give way).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import spans as S
from panelweave.llm.registry import query, table, with_columns

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "ident", "blob", "endpoint")
SCOPE = 200
MARK = "[secret]"


def _any_case(words: str) -> str:
    """Letters of an alternation in either case, spelled out, so that only A-Z and a-z are meant."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


ASSIGN = "(" + _any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # of 20 or more in all: a shorter run has no longer match inside it
HEX = "[0-9a-f]{24,}"
IDENT = "(" + _any_case("username|user|login|client_?id|account") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)"""
ENDPOINT = r"https?://[A-Za-z0-9._:/@%?&=#~+-]+"
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,128}+={0,2}+(?![A-Za-z0-9+/=])"  # '=' ahead of it is not part of it; pads at the end only


def _parts(text: Column) -> dict[str, Column]:
    """Parts by kind, each in text order."""
    value = lambda pattern, n: lambda s: F.length(F.regexp_extract(s["text"], pattern, 2)) >= n
    assigns = text.contains("=") | text.contains(":")
    varied = lambda s: s["text"].rlike("[A-Z]") & s["text"].rlike("[a-z]") & s["text"].rlike("[0-9]")
    return {
        "assign": F.filter(S.match_spans(text, ASSIGN, "assign", assigns), value(ASSIGN, 6)),
        "access": S.match_spans(text, ACCESS, "access", text.contains("AKIA")),
        "hex": S.match_spans(text, HEX, "hex"),
        "ident": F.filter(S.match_spans(text, IDENT, "ident", assigns), value(IDENT, 3)),
        "blob": F.filter(S.match_spans(text, KEY, "blob"), varied),
        "endpoint": S.match_spans(text, ENDPOINT, "endpoint", text.contains("://")),
    }


def link(parts: Column, scope: int = SCOPE) -> Column:
    """The strong parts and those weak parts whose scope holds what complements them."""
    far = 1 << 30
    is_id = lambda s: s["kind"].isin("access", "ident")
    is_secret = lambda s: s["kind"].isin("assign", "hex", "blob")
    ordered = F.array_sort(F.transform(parts, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    marked = "struct<start:int,end:int,kind:string,id:boolean,secret:boolean>"

    def forward(state: Column, s: Column) -> tuple[dict, Column]:
        near = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                        (state["id"] + scope > s["start"]).alias("id"), (state["secret"] + scope > s["start"]).alias("secret"))
        return {"id": F.when(is_id(s), F.greatest(state["id"], s["end"])).otherwise(state["id"]),
                "secret": F.when(is_secret(s), F.greatest(state["secret"], s["end"])).otherwise(state["secret"])}, near

    def backward(state: Column, s: Column) -> tuple[dict, Column]:
        near = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                        (s["id"] | (state["id"] < s["end"] + scope)).alias("id"), (s["secret"] | (state["secret"] < s["end"] + scope)).alias("secret"))
        return {"id": F.when(is_id(s), s["start"]).otherwise(state["id"]), "secret": F.when(is_secret(s), s["start"]).otherwise(state["secret"])}, near

    seen = S.scan(ordered, {"id": F.lit(-far), "secret": F.lit(-far)}, forward, marked)
    both = S.scan(F.reverse(seen), {"id": F.lit(far), "secret": F.lit(far)}, backward, marked)
    linked = F.filter(both, lambda s: s["kind"].isin(list(BASE)) | ((s["kind"] == "ident") & s["secret"]) | ((s["kind"] == "blob") & s["id"])
                      | ((s["kind"] == "endpoint") & s["id"] & s["secret"]))
    return F.transform(linked, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def scan_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """The input with ``secrets``: array of (start, end, kind), strong parts and linked weak ones."""
    found = _parts(F.coalesce(F.col(text), F.lit("")))
    collected = docs.withColumn("_parts", F.concat(*found.values()))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return with_columns(collected, {"secrets": F.when(F.size("_parts") > 0, link(F.col("_parts"), scope)).otherwise(empty)}).drop("_parts")


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with every secret replaced by a mark in its text; null text stays null."""
    scanned = scan_secrets(docs, text).withColumn(text, S.redact(F.col(text), F.col("secrets"), MARK))
    return scanned.select(*docs.columns)


def _sql_spans(kind: str, pattern: str, keep: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT rid, '{kind}' AS kind, {KINDS.index(kind)} AS rank, begin_at AS s, begin_at + length(m) AS e FROM (
  SELECT rid, found[i] AS m, i < len(found) AND between[i + 1] = '' AS glued, list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS begin_at
  FROM (SELECT rid, regexp_extract_all(text, '{quoted}') AS found, string_split_regex(text, '{quoted}') AS between FROM d), unnest(range(1, len(found) + 1)) AS u(i)
) WHERE {keep.format(p=quoted)}"""


OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
a AS ({_sql_spans("assign", ASSIGN, "length(regexp_extract(m, '{p}', 2)) >= 6")} UNION ALL {_sql_spans("access", ACCESS, "true")}
      UNION ALL {_sql_spans("hex", HEX, "true")} UNION ALL {_sql_spans("ident", IDENT, "length(regexp_extract(m, '{p}', 2)) >= 3")}
      UNION ALL {_sql_spans("blob", "[A-Za-z0-9+/]+=*", "length(rtrim(m, '=')) BETWEEN 32 AND 128 AND length(m) - length(rtrim(m, '=')) <= 2 AND NOT (contains(m, '=') AND glued) AND m SIMILAR TO '.*[A-Z].*' AND m SIMILAR TO '.*[a-z].*' AND m SIMILAR TO '.*[0-9].*'")}
      UNION ALL {_sql_spans("endpoint", ENDPOINT, "true")}),
l AS (SELECT a.*, exists(SELECT 1 FROM a b WHERE b.rid = a.rid AND b.kind IN ('access', 'ident') AND (b.s, b.e, b.kind) <> (a.s, a.e, a.kind)
                         AND b.s < a.e + {SCOPE} AND b.e + {SCOPE} > a.s) AS has_id,
             exists(SELECT 1 FROM a b WHERE b.rid = a.rid AND b.kind IN ('assign', 'hex', 'blob') AND (b.s, b.e, b.kind) <> (a.s, a.e, a.kind)
                    AND b.s < a.e + {SCOPE} AND b.e + {SCOPE} > a.s) AS has_secret FROM a),
k AS (SELECT rid, rank, s, kind || ':' || s || ':' || e AS span, kind FROM l
      WHERE rank < 3 OR (kind = 'ident' AND has_secret) OR (kind = 'blob' AND has_id) OR (kind = 'endpoint' AND has_id AND has_secret))
SELECT doc_id, count(*) FILTER (kind = 'assign')::BIGINT AS n_assign, count(*) FILTER (kind = 'access')::BIGINT AS n_access,
       count(*) FILTER (kind = 'hex')::BIGINT AS n_hex, sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN k USING (rid) GROUP BY rid, doc_id
"""


@query("op6_secret_scan", OP6_SQL)
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the strong parts, and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(list(BASE)))
    return found.select(
        "doc_id", *[S.count_kind(F.col("secrets"), k).alias(f"n_{k}") for k in BASE],
        F.sha2(S.joined(base, KINDS), 256).alias("base_sha256"), S.joined(F.col("secrets"), KINDS).alias("spans"))
