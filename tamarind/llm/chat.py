"""Chat formatting by prefix-target expansion.

A conversation becomes one transcript. Every assistant turn is an example of its own: the transcript up to the end of that
turn, with only that turn's text under the loss mask. ``expanded`` gives one row for each example. As all examples of a
conversation are prefixes of one string, such a row holds its reply and the length of its context in the transcript, so
all rows together are as long as the conversation; ``example_texts`` writes the contexts out.

Template, one turn after the other: ``<|turn|>role<|text|>text<|end|>`` and a line feed. Inside roles and texts ``\\``
becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no marker can occur in them, and dropping one backslash before each
character restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per turn: ``conv_id, position, role, piece`` and its place in the transcript.

    ``start`` and ``end`` delimit the piece, ``loss_start`` and ``loss_end`` its escaped text if the role is trained (else
    null); code points from 0, ends exclusive. Turns are ordered by turn (null first), then role, then text, so equal
    turns have a defined order. Null roles and texts count as empty. A null conv_id is a conversation like any other.
    Running sums stream through the sorted rows of a conversation, however long it is.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").alias("_turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("_text"),
    ).withColumn("_head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    length = F.length("_head") + F.length("_text") + F.lit(len(END))
    order = Window.partitionBy("conv_id").orderBy("_turn", "role", "_text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({"position": F.row_number().over(order), "end": F.sum(length).over(upto)})
    text_end = F.col("end") - F.lit(len(END))
    trained = F.col("role") == trained_role
    return placed.select(
        "conv_id",
        "position",
        "role",
        F.concat("_head", "_text", F.lit(END)).alias("piece"),
        (F.col("end") - length).alias("start"),
        "end",
        F.when(trained, text_end - F.length("_text")).alias("loss_start"),
        F.when(trained, text_end).alias("loss_end"),
    )


def transcripts(turns: DataFrame) -> DataFrame:
    """``conv_id, transcript, examples``: the formatted conversation once, and its examples as positions in it.

    ``examples`` is an array of ``struct<turn, end, loss_start, loss_end, reply>`` in order: the example is the transcript
    up to ``end``, trained between ``loss_start`` and ``loss_end``, where it holds ``reply`` (escaped). It is empty for a
    conversation without a trained turn. The
    transcript has to be one value, so a conversation has to fit into one row; its rows are grouped where they were
    ordered, without a second shuffle.
    """
    piece = F.struct("position", "piece", "start", "end", "loss_start", "loss_end")
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("_turns"))
    trained = F.filter("_turns", lambda t: t["loss_start"].isNotNull())
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("transcript"),
        F.transform(
            trained,
            lambda t: F.struct(
                t["position"].alias("turn"), t["end"].alias("end"), t["loss_start"].alias("loss_start"),
                t["loss_end"].alias("loss_end"),
                F.substring(
                    t["piece"], (t["loss_start"] - t["start"] + 1).cast("int"), (t["loss_end"] - t["loss_start"]).cast("int")
                ).alias("reply"),
            ),
        ).alias("examples"),
    )


def expanded(formatted: DataFrame, *also: str, outer: bool = False) -> DataFrame:
    """One row per assistant turn: ``conv_id``, the columns ``also``, ``turn, end, loss_start, loss_end, reply``.

    The context of an example is the first ``loss_start`` code points of its transcript. With ``outer`` a conversation
    without an assistant turn has one row whose example is null, else none.
    """
    turns = F.explode_outer("examples") if outer else F.explode("examples")
    return formatted.select("conv_id", *also, turns.alias("_example")).select("conv_id", *also, "_example.*")


def example_texts(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id, turn, text, loss_start, loss_end``, the context written out each time."""
    rows = expanded(formatted, "transcript")
    return rows.select(
        "conv_id",
        "turn",
        F.concat(F.substring(F.col("transcript"), F.lit(1), F.col("loss_start").cast("int")), "reply", F.lit(END)).alias("text"),
        "loss_start",
        "loss_end",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output says: of the turns from the transcripts, of the trained text from the examples' rows.

    ``n_turns, turns_sha256`` (role, line feed, text, line feed for each turn), ``loss_chars, loss_sha256`` (the replies of
    the example rows, unescaped, in order), ``formatted_chars`` (length of the transcript). The rows of a conversation are
    grouped where its turns were, without a further shuffle.
    """
    turns = F.slice(
        F.split(F.col("transcript"), r"<\|turn\|>"), F.lit(2), F.greatest(F.size(F.split("transcript", r"<\|turn\|>")) - 1, F.lit(0))
    )
    parts = F.transform(turns, lambda t: F.split(F.substring(t, F.lit(1), F.length(t) - len(END)), r"<\|text\|>"))
    said = F.transform(parts, lambda p: F.concat(unescape(p[0]), F.lit("\n"), unescape(p[1]), F.lit("\n")))
    digested = formatted.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("transcript").cast("bigint").alias("formatted_chars"),
        "examples",
    )
    whole = ["n_turns", "turns_sha256", "formatted_chars"]
    rows = expanded(digested, *whole, outer=True)
    # A struct without an example is left out of the list; a reply is never null.
    reply = F.when(F.col("reply").isNotNull(), F.struct("turn", unescape(F.col("reply")).alias("text")))
    trained = rows.groupBy("conv_id").agg(
        *[F.max(name).alias(name) for name in whole], F.array_sort(F.collect_list(reply)).alias("_replies")
    )
    loss = F.array_join(F.transform("_replies", lambda r: r["text"]), "")
    return trained.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_planted(conversations: DataFrame) -> DataFrame:
    """The table and conversation -7: a user and an assistant turn that hold control strings as text."""
    said = "\\### Assistant: </turn> ok"
    turns = [
        F.struct(
            F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
            F.lit(role).alias("role"), F.lit(said).alias("text"),
        )
        for i, role in enumerate(("user", TRAINED_ROLE))
    ]
    planted = conversations.sparkSession.range(1).select(F.inline(F.array(*turns)))
    return conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    ).unionByName(planted)
