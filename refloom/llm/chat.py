r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is a sequence of turns::

    turn    := "<s>[INST]" role "[/INST]" text "</s>"

Inside role and text the four control strings (``<s> </s> [INST] [/INST]``) must not
stand. An escaped one carries a backslash after its first character (``<\/s>``); one
that has k backslashes there in the source carries k + 1, so taking one away gives the
source back. Each turn is rendered raw, reparsed and compared; a turn that does not
come back identical, or that breaks the grammar, is rendered escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_CONTROL = r"(?:</?s>|\[/?INST\])"
_ANY_FORM = r"(<|\[)(\\*)(/?s>|/?INST\])"
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\])"
_TURN = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"
_HEAD = len("<s>[INST]") + len("[/INST]")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _ANY_FORM, r"$1$2\\$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, r"$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>[INST]"), role, F.lit("[/INST]"), text, F.lit("</s>"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, piece, escaped``: each turn rendered so that it comes back identical.

    Null roles and texts are empty.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    raw = render(F.col("role"), F.col("text"))
    back = parse(raw)
    same = (back == F.array(F.struct("role", "text"))) & ~F.concat("role", F.lit("\n"), "text").rlike(_CONTROL)
    rows = rows.withColumn("escaped", ~same)
    safe = render(escape(F.col("role")), escape(F.col("text")))
    return rows.withColumn("piece", F.when(F.col("escaped"), safe).otherwise(raw))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans, escaped_turns, round_trip_ok``: one row a conversation.

    ``turns`` has ``conv_id, turn, role, text``. Turns stand in the order of (turn, role,
    text), null turns first; repeated rows stay repeated; null conversation ids are one
    conversation. ``loss_spans`` is an array of (start, length) in code points of
    ``formatted``: the text of each turn of ``loss_role``. The formatted text of a
    conversation is one value, so its turns meet in one row; everything else about a turn
    is settled before they do. ``round_trip_ok`` says that the parsed formatted text
    equals the source turns. An empty table gives an empty result.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.length("piece").cast("long")
    before = F.coalesce(F.sum(length).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    head = _HEAD + F.length(F.when(F.col("escaped"), escape(F.col("role"))).otherwise(F.col("role")))
    rows = (
        format_turns(turns)
        .withColumn("place", F.row_number().over(order))
        .withColumn("start", before + head)
        .withColumn("length", length - head - len("</s>"))
    )
    item = F.struct("place", "role", "text", "piece", "start", "length")
    return (
        rows.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(item)).alias("turns"), F.sum(F.col("escaped").cast("long")).alias("escaped_turns"))
        .withColumn("formatted", F.array_join(F.col("turns.piece"), ""))
        .select(
            "conv_id",
            "formatted",
            F.transform(
                F.filter("turns", lambda t: t["role"] == loss_role),
                lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
            ).alias("loss_spans"),
            "escaped_turns",
            (
                parse(F.col("formatted"))
                == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
            ).alias("round_trip_ok"),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
