"""Personal data by gradient boosting over candidate spans.

Generators with high recall propose overlapping candidates: mail addresses (plain and spelled
out), dotted quads, digit runs, international and local phone numbers, account numbers. Checks of
format (digit counts, Luhn, address ranges) make the base spans, which are always reported. A
candidate that overlaps one is labelled personal data. The further kinds also have labels of
their own: an account number whose check digits are right (modulo 97) and a spelled-out address
that decodes to a well-formed one are personal data, and so are a local phone number or a digit
run behind a cue word; a local phone number with no cue either way is not used to learn.
Boosted trees learn format and context features from three quarters of all labelled candidates,
chosen by a hash of their content, so reruns agree; the candidates of one kind and label weigh at
most as much as ``CELL`` of them, so that frequent kinds do not drown rare ones. On the last
quarter, all of it, a threshold per kind is calibrated to ``precision``. Candidates of the further kinds that touch no base span are added if they are over
the threshold or pass the format check of their kind, the likeliest first where they overlap; a
candidate of a base kind that fails its check is dropped, whatever its score.

Candidate search, features, training, thresholds and scores cover all rows, whole texts, with
column expressions and MLlib. Null text counts as empty. Repeated rows are scanned
each for itself, an empty table gives an empty result; extra columns may be carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm import spans as S
from panelweave.llm.registry import query, table, with_columns
from panelweave.session import pin

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_words", "digits", "local_phone", "account")
MARK = "[private]"
CELL = 1250  # candidates of one kind and label that have full weight in training; more share it
CONTEXT = 24  # characters before a candidate that are searched for cue words

# The look-behinds and possessive quantifiers change no match; they keep the search linear on long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
QUAD = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
RUN = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
EMAIL_WORDS = r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]+)++"
DIGITS = r"[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
LOCAL_PHONE = r"(?<![0-9])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])"
ACCOUNT = r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Z0-9])"
BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

CUES = {
    "cue_phone": "phone|tel|call|fax|mobil|cell|handy|llam|appel",
    "cue_mail": "mail|contact|kontakt|write|correo",
    "cue_address": "host|server|addr|login|\\bip\\b",
    "cue_card": "card|visa|master|karte|carte|tarjeta|account|iban|konto|compte|cuenta|ssn|social|passport",
    "cue_number": "\\bno\\.|nr\\.|number|id\\b|order|page|version|\\bv[0-9]|isbn|date",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    return {
        "email": F.lit(True),
        "ip": text.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$"),
        "card": n.between(14, 19) & F.call_function("luhn_check", F.substring(_digits(text), 1, 19)),
        "phone": n.between(10, 15),
    }[kind]


PHONE_CUE = r"(?i)\b(?:phone|tel|telephone|telefon|call|fax|mobile|mobil|cell|handy)\b[^0-9]{0,12}$"
PERSON_CUE = r"(?i)\b(?:ssn|social security|passport|account|konto|compte|cuenta)\b[^0-9]{0,12}$"
ADDRESS = r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$"
SURE = ("email_words", "account")  # kinds with a format check as strict as those of the base kinds


def _check_digits(text: Column) -> Column:
    """Whether an account number is 1 modulo 97, its first four characters put last and letters read as 10 to 35."""
    moved = F.concat(F.substring(text, 5, 64), F.substring(text, 1, 4))
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    chars = F.regexp_extract_all(moved, F.lit("."), F.lit(0))
    rest = F.aggregate(chars, F.lit(0), lambda r, c: (r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)
    return rest == 1


def _decoded(text: Column) -> Column:
    at = F.regexp_replace(text, r"\x20?[(\[]at[)\]]\x20?", "@")
    return F.regexp_replace(at, r"\x20?[(\[]dot[)\]]\x20?", ".")


def _is_sure(kind: Column, text: Column) -> Column:
    return F.when(kind == "account", _check_digits(text)).when(kind == "email_words", _decoded(text).rlike(ADDRESS)).otherwise(False)


def _own_label(kind: Column, text: Column, before: Column) -> Column:
    """Personal data by the kind's own check or cue; null is not known."""
    phone, number = before.rlike(PHONE_CUE), F.lower(before).rlike(CUES["cue_number"])
    return (F.when(kind.isin(*SURE), _is_sure(kind, text))
            .when(kind == "local_phone", F.when(phone, True).when(number, False))
            .when(kind == "digits", phone | before.rlike(PERSON_CUE)).otherwise(False))


def _is_base(kind: Column, text: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, _passes(k, text)) for k in BASE], F.lit(False))


def candidate_spans(text: Column) -> Column:
    """All proposals of all generators, base kinds first; they may overlap. Digit runs of one digit are left out."""
    digit = text.rlike("[0-9]")
    sets = [
        S.match_spans(text, EMAIL, "email", text.contains("@")),
        S.match_spans(text, QUAD, "ip", digit),
        S.match_spans(text, RUN, "card", digit),
        S.match_spans(text, PHONE, "phone", text.contains("+")),
        S.match_spans(text, EMAIL_WORDS, "email_words", text.rlike(r"[(\[]at[)\]]")),
        S.match_spans(text, DIGITS, "digits", digit),
        S.match_spans(text, LOCAL_PHONE, "local_phone", digit),
        S.match_spans(text, ACCOUNT, "account", digit),
    ]
    return F.concat(*sets)


def base_spans(candidates: Column) -> Column:
    return F.filter(candidates, lambda s: _is_base(s["kind"], s["text"]))


FEATURES = (
    *[f"is_{k}" for k in KINDS], "n_chars", "n_digits", "n_letters", "n_dots", "n_gaps", "n_brackets", "plus", "at", "luhn", "quad",
    "groups", "longest_group", "repeated_digit", "left_letter", "right_letter", "sure", *CUES,
)


def features(kind: Column, text: Column, before: Column, after: Column) -> dict[str, Column]:
    digits, count = _digits(text), lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]", ""))
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    cue = F.lower(before)
    return {
        **{f"is_{k}": kind == k for k in KINDS},
        "n_chars": F.length(text), "n_digits": F.length(digits), "n_letters": count("A-Za-z"), "n_dots": count("."),
        "n_gaps": count("\\x20-"), "n_brackets": count("()"), "plus": text.startswith("+"), "at": text.contains("@"),
        "luhn": (F.length(digits) >= 12) & F.call_function("luhn_check", F.substring(digits, 1, 19)), "quad": text.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$"),
        "groups": F.size(groups), "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "repeated_digit": digits.rlike("^([0-9])\\1*$"), "left_letter": before.rlike("[A-Za-z]$"), "right_letter": after.rlike("^[A-Za-z]"),
        "sure": _is_sure(kind, text),
        **{name: cue.rlike(words) for name, words in CUES.items()},
    }


def _overlaps(a: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"]))


def candidate_table(scanned: DataFrame, text: str) -> DataFrame:
    """One row per candidate: row number, span, whether it touches a base span, label (null: not known) and features. ``scanned`` has _row, _base, _candidates."""
    body = F.coalesce(F.col(text), F.lit(""))
    context = F.transform("_candidates", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["text"].alias("text"),
        F.substring(body, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))).alias("before"),
        F.substring(body, s["end"] + 1, F.lit(1)).alias("after")))
    flat = scanned.select("_row", F.inline(context))
    # a base span that starts at or before a candidate overlaps it if it ends behind its start; one that starts later, if before its end
    is_base = _is_base(F.col("kind"), F.col("text"))
    upto = Window.partitionBy("_row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("_row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    touches = F.coalesce(F.max(F.when(is_base, F.col("end"))).over(upto) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(F.when(is_base, F.col("start"))).over(behind) < F.col("end"), F.lit(False))
    label = touches | _own_label(F.col("kind"), F.col("text"), F.col("before"))
    made = features(F.col("kind"), F.col("text"), F.col("before"), F.col("after"))
    return flat.withColumn("touches", touches).withColumn("label", label.cast("double")).select(
        "_row", "start", "end", "kind", "touches", "label", F.xxhash64("text", "before", "after", "kind", "start").alias("_pick"),
        *[made[f].cast("double").alias(f) for f in FEATURES])


def fit_model(candidates: DataFrame, precision: float, seed: int, least: int = 20):
    """Boosted trees and a threshold per kind from all labelled candidates, or None where those to learn from have one label only."""
    known, held = candidates.filter("label IS NOT NULL"), F.pmod(F.col("_pick"), F.lit(4)) == 0
    sizes = known.groupBy("kind", "label").agg(F.count("*").alias("n"), F.count_if(~held).alias("n_train")).collect()
    if len({r.label for r in sizes if r.n_train}) < 2:
        return None
    shares = [F.when((F.col("kind") == r.kind) & (F.col("label") == r.label), F.lit(min(CELL / r.n, 1.0))) for r in sizes]  # a row per kind and label
    train = known.filter(~held).select("label", F.coalesce(*shares).alias("_weight"), *FEATURES)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    learner = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=15, maxDepth=4, stepSize=0.2, seed=seed)
    # every level of every tree shuffles the bins of each partition
    model = learner.fit(assembler.transform(train.coalesce(2 * train.sparkSession.sparkContext.defaultParallelism)))
    scored = score(known.filter(held), assembler, model)
    table_ = scored.groupBy("kind", F.floor(F.col("_score") * 100).cast("int").alias("level")).agg(F.sum("label"), F.count("*")).collect()
    thresholds = {}
    for kind in KINDS[len(BASE):]:
        hits = rows = 0.0
        for _, level, good, n in sorted((r for r in table_ if r[0] == kind), key=lambda r: -r[1]):
            hits, rows = hits + good, rows + n
            if rows >= least and hits >= precision * rows:
                thresholds[kind] = level / 100
    return assembler, model, thresholds


def score(candidates: DataFrame, assembler: VectorAssembler, model) -> DataFrame:
    done = model.transform(assembler.transform(candidates))
    return done.withColumn("_score", vector_to_array("probability")[1])


def find_pii(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), precision: float = 0.98, seed: int = 5) -> DataFrame:
    """The carried columns and ``pii``: array of (start, end, kind), base spans and added ones.

    Candidates are stored once, so texts are read once. Carry the text too to redact it.
    """
    found = candidate_spans(F.coalesce(F.col(text), F.lit("")))
    proposed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_doc"), F.col(f"`{text}`").alias("_text"),
                           F.monotonically_increasing_id().alias("_row"), found.alias("_candidates"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    based = proposed.withColumn("_base", base_spans(F.col("_candidates")))
    trimmed = F.when(F.size("_candidates") > 0, F.col("_text"))  # the text is needed for context only
    scanned = pin(based.select("_doc", "_row", "_candidates", "_base", trimmed.alias("_text")))
    candidates = pin(candidate_table(scanned.filter(F.size("_candidates") > 0), "_text"))
    fitted = fit_model(candidates, precision, seed)

    base = F.transform("_base", plain)
    free = candidates.filter(~F.col("touches") & F.col("kind").isin(*KINDS[len(BASE):]))
    sure = F.col("sure") == 1
    if fitted is None:
        likely = free.filter(sure).withColumn("_score", F.lit(1.0))
    else:
        assembler, model, thresholds = fitted
        bar = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in thresholds.items()], F.lit(2.0))
        likely = score(free, assembler, model).filter((F.col("_score") >= bar) | sure).withColumn("_score", F.when(sure, 1.0).otherwise(F.col("_score")))
    ranked = likely.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("_score")).alias("rank"), "start", "end", "kind"))).alias("_likely"))
    chosen = F.aggregate("_likely", F.array().cast("array<struct<start:int,end:int,kind:string>>"),
                         lambda kept, s: F.when(_overlaps(s, kept), kept).otherwise(F.concat(kept, F.array(plain(s)))))
    added = ranked.select("_row", chosen.alias("_added"))
    both = scanned.select("_row", "_doc", base.alias("_base")).join(added, "_row", "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return with_columns(both.select("_doc.*", "_base", "_added"), {"pii": F.concat("_base", F.coalesce("_added", none))}).drop("_base", "_added")


def redact_pii(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The input with all personal data replaced by a mark in its text; null text stays null."""
    found = find_pii(docs, text, docs.columns, **options)
    return found.withColumn(text, S.redact(F.col(text), F.col("pii"), MARK)).select(*docs.columns)


@query("op10_pii_spans")
def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(list(BASE)))
    return found.select(
        "doc_id", *[S.count_kind(base, k).alias(f"n_{k}") for k in BASE],
        F.sha2(S.joined(base, KINDS), 256).alias("base_sha256"), S.joined(F.col("pii"), KINDS).alias("spans"))
