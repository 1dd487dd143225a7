"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context
and its text alone is trainable. Everything is built from SQL functions; one shuffle
brings the turns of a conversation together, and the read-back needs no second one.
A conversation is one row (its digests run over all of it), so one task must hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
END = "<|end|>\n"
REPLY = "assistant"


def escape(text: Column) -> Column:
    """No ``<|`` is left inside: a backslash more stands between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def head(role: Column) -> Column:
    """The opening mark of a turn; roles of any content are percent-encoded."""
    return F.concat(F.lit("<|"), F.url_encode(role), F.lit("|>\n"))


def expand(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           reply: str = REPLY) -> DataFrame:
    """One row per assistant turn: ``conv_id, example_no, text, loss_from, loss_chars, final``.

    ``text`` holds the whole formatted example; the ``loss_chars`` code points from
    ``loss_from`` (counted from 1) are trainable. Turns after the last reply, and
    conversations without one, give a last row with no trainable part, so nothing is
    lost; ``final`` marks the row that holds the whole conversation.

    Rows are ordered by turn, ties by role and text, null turns first; repeated rows are
    repeated turns. Null text and null roles are empty. A null conversation id is one
    conversation. An empty table gives no rows; other columns are ignored.
    """
    row = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    whole = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select(
        "conv_id", F.size("turns").alias("n"),
        F.transform("turns", lambda t: t.role == reply).alias("replies"),
        F.transform("turns", lambda t: F.struct(head(t.role).alias("head"), escape(t.text).alias("body"))).alias("parts"))
    stops = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.element_at("replies", i) | (i == F.col("n")))
    each = whole.select("conv_id", "n", "replies", "parts", F.posexplode(stops).alias("example_no", "at"))
    last = F.element_at("parts", F.col("at"))
    context = F.array_join(F.transform(F.slice("parts", 1, F.col("at") - 1), lambda p: F.concat(p.head, p.body, F.lit(END))), "")
    each = each.select("conv_id", "example_no", F.concat(context, last.head).alias("before"), last.body.alias("body"),
                       F.element_at("replies", F.col("at")).alias("trainable"), (F.col("at") == F.col("n")).alias("final"))
    return each.select(
        "conv_id", "example_no", F.concat("before", "body", F.lit(END)).alias("text"),
        (F.length("before") + 1).alias("loss_from"),
        F.when(F.col("trainable"), F.length("body")).otherwise(F.lit(None)).alias("loss_chars"), "final")


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and trainable texts parsed from formatted examples, as digests per conversation.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    pieces = F.filter(F.split("text", r"<\|end\|>\n"), lambda p: p != "")
    role = lambda p: F.url_decode(F.regexp_extract(p, r"\A<\|([^|]*)\|>\n", 1))
    body = lambda p: unescape(F.regexp_replace(p, r"\A<\|[^|]*\|>\n", ""))
    turns = F.array_join(F.transform(pieces, lambda p: F.concat(role(p), F.lit("\n"), body(p), F.lit("\n"))), "")
    loss = unescape(F.expr("substring(text, loss_from, loss_chars)"))
    read = examples.select(
        "conv_id", F.length("text").alias("chars"),
        F.when(F.col("final"), F.size(pieces)).alias("n"), F.when(F.col("final"), F.sha2(turns, 256)).alias("turns_sha"),
        F.struct("example_no", F.when(F.col("loss_chars").isNotNull(), loss).otherwise(F.lit("")).alias("loss")).alias("part"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p.loss), "")
    out = read.groupBy("conv_id").agg(F.max("n").cast("long").alias("n_turns"), F.max("turns_sha").alias("turns_sha256"),
                                      joined.alias("all"), F.sum("chars").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("all").cast("long").alias("loss_chars"),
                      F.sha2("all", 256).alias("loss_sha256"), "formatted_chars")
