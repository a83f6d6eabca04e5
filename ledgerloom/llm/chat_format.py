"""Chat formatting that survives its own parser.

A conversation is rendered as ``<s>[INST]role[/INST]text</s>`` turn by turn. The grammar is
deterministic: a turn ends at the first ``</s>``, its role at the first ``[/INST]``. The rendered
text is parsed again and compared with the source; a conversation in which they differ is
rendered anew with its control strings escaped, until they are identical.

An escaped control string has one more backslash after its first character, so strings that
look escaped already are escaped as well and the reader takes off exactly one. After that no
control string is left inside a text: the second round always agrees.

DataFrame functions only. A conversation's turns are collected, as the result is one text per
conversation; nothing else meets in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stage

START, ROLE_START, ROLE_END, END = "<s>", "[INST]", "[/INST]", "</s>"
# Control strings, and what starts like them after any number of backslashes.
CONTROL = r"</?s>|\[/?INST\]"
ROUNDS = 2


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(text, r"\[(\\*/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1")
    return F.regexp_replace(text, r"\[\\(\\*/?INST\])", "[$1")


def render(turns: Column, escaped: bool) -> Column:
    """The text of an array of (role, text)."""

    def one(turn: Column) -> Column:
        role, text = turn["role"], turn["text"]
        if escaped:
            role, text = escape(role), escape(text)
        return F.concat(F.lit(START + ROLE_START), role, F.lit(ROLE_END), text, F.lit(END))

    return F.array_join(F.transform(turns, one), "")


def parse(rendered: Column) -> Column:
    """Turns (role, text, offset, length) of a rendered text; roles and texts are unescaped.

    ``offset`` (from the start of the turn) and ``length`` are code points of the text as it
    stands in the rendering. A turn outside the grammar, with a control string in its role or
    text, has null for it and so differs from every source.
    """
    parts = F.split(rendered, r"\Q</s>\E", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    head = len(START + ROLE_START)

    def read(raw: Column) -> Column:
        return F.when(~F.regexp_like(raw, F.lit(CONTROL)), unescape(raw))

    def one(part: Column) -> Column:
        # a role ends at the first mark, so what follows is the text
        role = F.substring_index(part, ROLE_END, 1)
        text = F.substr(part, F.length(role) + F.lit(len(ROLE_END) + 1))
        return F.struct(
            read(F.substr(role, F.lit(head + 1))).alias("role"),
            read(text).alias("text"),
            (F.length(role) + len(ROLE_END)).alias("offset"),
            F.length(text).alias("length"),
        )

    return F.transform(parts, one)


def _pairs(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_chats(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, rendered, turns, loss_spans, escaped, identical``.

    Rows are ordered by turn (null first), then by role and text, so repeated turns have a
    fixed order too. A null role or text is an empty one. A null id is a conversation. ``turns``
    is what the parser reads back; ``loss_spans`` has for each turn (offset from its start,
    length) of the text that carries loss, in code points of the rendering: the texts of
    ``loss_role``, and length 0 for other turns. ``identical`` says that parser and source agree; it holds
    for every conversation.
    """
    rows = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    chats = chats.select("conv_id", _pairs(F.col("rows")).alias("source"))
    chats = chats.select(
        "conv_id", "source", render(F.col("source"), False).alias("rendered"), F.lit(False).alias("escaped")
    )
    for _ in range(ROUNDS - 1):
        read = chats.withColumn("again", ~F.coalesce(_pairs(parse(F.col("rendered"))) == F.col("source"), F.lit(False)))
        read = stage(read, "chat-round")
        chats = read.select(
            "conv_id",
            "source",
            F.when(F.col("again"), render(F.col("source"), True)).otherwise(F.col("rendered")).alias("rendered"),
            (F.col("escaped") | F.col("again")).alias("escaped"),
        )
    chats = chats.withColumn("parsed", parse(F.col("rendered")))
    spans = F.transform(
        "parsed",
        lambda t: F.struct(
            t["offset"].alias("offset"),
            F.when(t["role"] == loss_role, t["length"]).otherwise(0).alias("length"),
        ),
    )
    return chats.select(
        "conv_id",
        "rendered",
        _pairs(F.col("parsed")).alias("turns"),
        spans.alias("loss_spans"),
        "escaped",
        F.coalesce(_pairs(F.col("parsed")) == F.col("source"), F.lit(False)).alias("identical"),
    )


def masked_text(rendered: Column, spans: Column) -> Column:
    """What stands under the loss mask, unescaped and joined."""
    turns = F.split(rendered, r"\Q</s>\E", -1)
    texts = F.zip_with(
        F.slice(turns, 1, F.size(turns) - 1),
        spans,
        lambda turn, s: unescape(F.substr(turn, s["offset"] + 1, s["length"])),
    )
    return F.array_join(texts, "")
