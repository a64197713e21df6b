"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says how a turn begins and ends, which roles carry loss, and which role may follow
which. Per conversation the machine walks the roles in turn order; every turn becomes segments
(mark, text, mark) with a loss flag each, and the formatted conversation is the segments put
together. Control strings of the template inside a role or a text are escaped, reversibly: the
first character of a control string becomes a backslash and a letter, a backslash becomes
``\\b``. So no control string is left in an escaped text, and splitting at them is exact.

Null text and null role are empty. Turns are ordered by (turn, role, text), nulls first, so
repeated rows and ties have one result. A null conv_id is one conversation. An empty table gives
an empty result; extra columns of the input are not used. A conversation is one output row, so
it has to fit a row, as the training example it becomes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.registry import literal_rows, query, table
from panelweave.llm.spans import scan


@dataclass(frozen=True)
class ChatTemplate:
    """``head`` + role + ``head_end`` + text + ``tail`` for each turn.

    ``follows`` are the transitions of the machine: state -> roles that may come next. The
    states are ``start`` and the roles; a conversation is well formed if every step is a
    transition and the last state is in ``final``.
    """

    head: str = "### "
    head_end: str = ":\n"
    tail: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)
    #: strings that must not occur inside a text, besides the backslash; each with the letter of its escape
    controls: tuple[tuple[str, str], ...] = (("### ", "h"), ("</turn>", "t"))
    #: and inside a role, which ends at ``head_end``
    role_controls: tuple[tuple[str, str], ...] = (("\n", "n"), ("### ", "h"), ("</turn>", "t"))


TEMPLATE = ChatTemplate()
REJECT = "reject"


def escape(text: Column, controls) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    for mark, letter in controls:
        out = F.replace(out, F.lit(mark), F.lit("\\" + letter + mark[1:]))
    return out


def unescape(text: Column, controls) -> Column:
    """Every backslash of an escaped text begins an escape, so the letters can be put back one after another."""
    out = text
    for mark, letter in reversed(controls):
        out = F.replace(out, F.lit("\\" + letter), F.lit(mark[0]))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _next_state(template: ChatTemplate, state: Column, role: Column) -> Column:
    allowed = [F.lit(f"{a}\n{b}") for a, roles in template.follows.items() for b in roles]
    step = F.concat(state, F.lit("\n"), role)
    return F.when(step.isin([f"{a}\n{b}" for a, roles in template.follows.items() for b in roles]), role).otherwise(F.lit(REJECT)) if allowed else F.lit(REJECT)


TURN = "struct<state:string,allowed:boolean,role:string,text:string,loss:boolean>"


def format_conversations(turns: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, well_formed, final_state, first_bad_turn, segments (kind, role, text, loss), formatted.

    The machine walks the turns once and emits for each the state that it enters, whether the step was
    allowed, and the turn's segment with its loss flag; marks, mask and verdict all come from these.
    ``first_bad_turn`` is the place, from 0, of the first turn that no transition allows, null if there is none.
    """
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("_turn"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("_turn"), _turn_order).alias("_turns"))

    def step(state: Column, turn: Column) -> tuple[dict, Column]:
        entered = _next_state(template, state["now"], turn["role"])
        emitted = F.struct(entered.alias("state"), (entered != REJECT).alias("allowed"), turn["role"].alias("role"), turn["text"].alias("text"),
                           turn["role"].isin(list(template.loss_roles)).alias("loss"))
        return {"now": entered}, emitted

    walked = grouped.select("conv_id", scan(F.col("_turns"), {"now": F.lit("start")}, step, TURN).alias("_walk"))
    segment = lambda kind, t, text, loss: F.struct(F.lit(kind).alias("kind"), t["role"].alias("role"), text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("_walk", lambda t: F.array(
        segment("head", t, F.concat(F.lit(template.head), escape(t["role"], template.role_controls), F.lit(template.head_end)), F.lit(False)),
        segment("text", t, escape(t["text"], template.controls), t["loss"]),
        segment("tail", t, F.lit(template.tail), F.lit(False)),
    )))
    final = F.element_at(F.transform("_walk", lambda t: t["state"]), -1)
    bad = F.array_position(F.transform("_walk", lambda t: t["allowed"].cast("int")), 0)
    out = walked.select("conv_id", final.alias("final_state"), F.when(bad > 0, bad - 1).alias("first_bad_turn"), segments.alias("segments"))
    return out.select(
        "conv_id", F.col("final_state").isin(list(template.final)).alias("well_formed"), "final_state", "first_bad_turn", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def _turn_order(a: Column, b: Column) -> Column:
    """(turn, role, text), nulls first; array_sort's default puts null fields first as well but null structs last."""
    fields = [(a["turn"], b["turn"]), (a["role"], b["role"]), (a["text"], b["text"])]
    out = F.lit(0)
    for x, y in reversed(fields):
        out = (
            F.when(x.isNull() & y.isNull(), out).when(x.isNull(), F.lit(-1)).when(y.isNull(), F.lit(1))
            .when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(out)
        )
    return out


def read_back(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    pieces = F.split(formatted, _quoted(template.tail), -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # nothing follows the last tail
    head = len(template.head)
    return F.transform(turns, lambda p: F.struct(
        unescape(F.substr(p, F.lit(head + 1), F.instr(p, template.head_end) - 1 - head), template.role_controls).alias("role"),
        unescape(F.substr(p, F.instr(p, template.head_end) + len(template.head_end)), template.controls).alias("text")))


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


OP4_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, v.turn, v.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
w AS (SELECT *, row_number() OVER t - 1 AS pos, coalesce(lag(role) OVER t, 'start') || ' ' || role AS step FROM c
      WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, step NOT IN ('start system', 'start user', 'system user', 'user assistant', 'assistant user') AS bad, replace(replace(replace(text, '\', '\b'), '### ', '\h## '), '</turn>', '\t/turn>') AS esc,
             replace(replace(replace(replace(role, '\', '\b'), chr(10), '\n'), '### ', '\h## '), '</turn>', '\t/turn>') AS esc_role FROM w)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(esc_role) + 2 + length(esc) + 8)::BIGINT AS formatted_chars,
       NOT bool_or(bad) AND max_by(role, pos) = 'assistant' AS well_formed, CASE WHEN bool_or(bad) THEN 'reject' ELSE max_by(role, pos) END AS final_state,
       (min(pos) FILTER (bad))::BIGINT AS first_bad_turn
FROM e GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text and the loss mask."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    extra = literal_rows(spark, [(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.columns, [t for _, t in turns.dtypes])
    done = format_conversations(turns.unionByName(extra))
    back = done.select("conv_id", "formatted", "well_formed", "final_state", "first_bad_turn", read_back(F.col("formatted")).alias("_back"), F.array_join(F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], TEMPLATE.controls)), "").alias("_loss"))
    whole = F.array_join(F.transform("_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_back").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "well_formed", "final_state", F.col("first_bad_turn").cast("long").alias("first_bad_turn"))
