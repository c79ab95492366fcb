"""Chat formatting (op6), native: prefix-target expansion.

A conversation is formatted as one string of turns, ``<turn>``, role, newline,
text, ``</turn>``, newline. In roles and texts ``&`` and ``<`` are written ``&amp;``
and ``&lt;`` (in roles newlines too, as ``&#10;``), so a ``<`` is always a
marker and the texts come back exactly. Every assistant turn becomes an
example of its own: the string up to that turn's text is its context, the text is
trainable, nothing else is.

Scale: the formatted string and the examples' places are made per
conversation, in one shuffle by conversation; examples are exploded from places, so
text is copied only where a caller asks for the context as a string. A
conversation is one record and must fit into one (2 GB).

Edge cases: a null text or role counts as empty; equal turn numbers are ordered
by role, then text; turns without a number come first; a null conversation id is a
conversation of its own; without assistant turns there are no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.llm.arrays import let, sums_before

OPEN, CLOSE = "<turn>", "</turn>\n"


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _replaced(text, ("&", "&amp;"), ("<", "&lt;"))


def unescape(text: Column) -> Column:
    return _replaced(text, ("&lt;", "<"), ("&#10;", "\n"), ("&amp;", "&"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, examples)``; examples are ``(loss_start, loss_end)``, code points, end exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    role = F.coalesce(F.col(role_col), F.lit(""))
    head = F.concat(F.lit(OPEN), _replaced(escape(role), ("\n", "&#10;")), F.lit("\n"))
    # order by the plain strings, then carry the formatted ones
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    made = turns.select(F.col(conv_col).alias("conv_id"), turn.alias("t"), head.alias("head"), escape(text).alias("body"))
    listed = made.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("t", "head", "body"))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    sizes = F.transform("turns", lambda t: (F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)).cast("long"))
    places = let(sums_before(sizes), lambda before: F.transform("turns", lambda t, i: F.struct(
        (before[i] + F.length(t["head"])).alias("loss_start"), (before[i] + F.length(t["head"]) + F.length(t["body"])).alias("loss_end"),
        (t["t"]["role"] == trained_role).alias("trained"))))
    examples = F.transform(F.filter(places, lambda p: p["trained"]), lambda p: F.struct(p["loss_start"].alias("loss_start"), p["loss_end"].alias("loss_end")))
    return listed.select("conv_id", formatted.alias("formatted"), examples.alias("examples"))


def expand_examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: ``(conv_id, example, context, target, loss_start, loss_end)``;
    ``context`` is everything before the reply, ``target`` the reply as formatted."""
    rows = formatted.select("conv_id", "formatted", F.posexplode("examples").alias("example", "place"))
    start, end = F.col("place.loss_start").cast("int"), F.col("place.loss_end").cast("int")
    return rows.select("conv_id", F.col("example").cast("long").alias("example"),
                       F.substring("formatted", F.lit(1), start).alias("context"),
                       F.substring("formatted", start + 1, end - start).alias("target"),
                       F.col("place.loss_start").alias("loss_start"), F.col("place.loss_end").alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """Array of ``(role, text)`` read back from a formatted string."""
    parts = F.slice(F.split(formatted, OPEN, -1), F.lit(2), F.size(F.split(formatted, OPEN, -1)))

    def turn(part: Column) -> Column:
        line_end = F.instr(part, "\n")
        body = F.substring(part, line_end + 1, F.length(part) - line_end - len(CLOSE))
        return F.struct(unescape(F.substring(part, F.lit(1), line_end - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


__all__ = ["format_conversations", "expand_examples", "read_turns", "escape", "unescape", "OPEN", "CLOSE"]
