"""Chat formatting: every reply of the assistant becomes an example of its own.

A turn is written as ``<turn ROLE>TEXT</turn>`` and a line feed. Control strings inside roles and texts are escaped so
that they can be read back: a backslash becomes ``\\s``, the ``<`` of ``<turn`` and ``</turn`` becomes ``\\l``, and the ``>`` of a
role ``\\g``; every backslash of an escaped text is then followed by one of these letters.

Prefix-target expansion: an example is all that precedes a reply, and the reply; only the text of the reply is trainable,
not its marks. Written out, the examples of a conversation of n turns have n * n / 2 turns. They are therefore kept as what each adds
to the one before it: ``context_chars`` says how much precedes, ``added`` holds the turns since the last reply and
the reply. What follows the last reply is a last row without a reply. :func:`written_out` puts the contexts before
examples, those of chosen conversations or of all.

All of it is native; one shuffle by conversation serves the windows and the groups behind them. The window streams
through a conversation; a row holds the turns between two replies.

Defined cases: a NULL text or role is an empty one; a NULL turn comes first; rows of one turn are ordered by role, then
text, and rows that are equal are turns of their own; rows with a NULL id are one conversation; an empty table has no
examples; a conversation without a reply has a row without one. Other columns do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The role that is trained, and the marks of a turn.
REPLY = "assistant"
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    return _replaced(text, ("\\", "\\s"), ("<turn", "\\lturn"), ("</turn", "\\l/turn"))


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped` and of the escapes of a role."""
    return _replaced(text, ("\\l", "<"), ("\\g", ">"), ("\\s", "\\"))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, head, body): the marked role and the escaped text of every row."""
    known = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    role = _replaced(escaped(F.col("role")), (">", "\\g"))
    return known.withColumns({
        "head": F.concat(F.lit(OPEN), role, F.lit(CLOSE)), "body": escaped(F.col("text")),
    })


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, context_chars, added, loss_start, loss_chars): one row per reply, and one for what follows the last.

    ``loss_start`` counts from 0 in the whole example, of which ``added`` begins at ``context_chars``; it and ``loss_chars``
    are NULL in a row without a reply.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    is_reply = F.col("role") == REPLY
    size = F.length("head") + F.length("body") + len(END)
    zero = F.lit(0).cast("long")
    placed = turns(conversations).withColumns({
        "example": F.coalesce(F.sum(F.when(is_reply, 1).otherwise(0)).over(before), zero),
        "start": F.coalesce(F.sum(size.cast("long")).over(before), zero),
    }).select(
        "conv_id", "example", "start", F.concat("head", "body", F.lit(END)).alias("segment"),
        F.when(is_reply, F.col("start") + F.length("head")).alias("loss_start"),
        F.when(is_reply, F.length("body")).cast("long").alias("loss_chars"),
    )
    gathered = F.array_sort(F.collect_list(F.struct("start", "segment")))
    return placed.groupBy("conv_id", "example").agg(
        F.min("start").alias("context_chars"),
        F.array_join(F.transform(gathered, lambda s: s["segment"]), "").alias("added"),
        F.max("loss_start").alias("loss_start"), F.max("loss_chars").alias("loss_chars"),
    )


def _expanded(made: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars): every row of ``made`` behind its whole context."""
    rows = F.array_sort(F.collect_list(F.struct("example", "context_chars", "added", "loss_start", "loss_chars")))
    whole = made.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", "rows", F.array_join(F.transform("rows", lambda r: r["added"]), "").alias("whole"))
    size = (F.col("context_chars") + F.length("added")).cast("int")
    return whole.select("conv_id", "whole", F.inline("rows")).select(
        "conv_id", "example", F.substring("whole", F.lit(1), size).alias("text"), "loss_start", "loss_chars")


def written_out(made: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars): examples with their whole context; rows without a reply are left out.

    A conversation is gathered in one row, and its text is repeated for every reply.
    """
    return _expanded(made).where(F.col("loss_start").isNotNull())


def read_back(added: Column) -> Column:
    """The (role, text) of every turn in a formatted text."""
    marked = F.filter(F.split(added, END), lambda s: s != "")
    role = lambda s: F.substring_index(F.substring(s, F.lit(len(OPEN) + 1), F.length(s)), CLOSE, 1)
    text = lambda s: F.substring(s, F.length(F.substring_index(s, CLOSE, 1)) + 2, F.length(s))
    return F.transform(marked, lambda s: F.struct(unescaped(role(s)).alias("role"), unescaped(text(s)).alias("text")))


def digests(made: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from examples.

    Every example is written out: its reply is what lies under its own loss mask behind the whole context. The last
    row of a conversation, with or without a reply, holds all turns. The digests need a conversation in one row.
    """
    reply = F.substring("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int"))
    listed = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = _expanded(made).withColumn("reply", F.coalesce(unescaped(reply), F.lit("")))
    replies = F.array_sort(F.collect_list(F.struct("example", "reply")))
    found = parts.groupBy("conv_id").agg(F.max_by("text", "example").alias("text"), replies.alias("replies")).select(
        "conv_id", "text", read_back(F.col("text")).alias("turns"),
        F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("loss"))
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )
