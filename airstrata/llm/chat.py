"""Prefix-target expansion of conversations.

Every assistant turn becomes an example of its own: all turns before it are context,
the reply is the only text under the loss mask. Turns are marked as

    <|im_start|>role<|im_sep|>text<|im_end|>

Control strings inside roles and texts get a backslash behind their first character
(one more, if backslashes stand there already), so no text can hold a mark, and
taking one backslash away restores every text.

Defined cases: a null role or text is empty; turns are put in the order of (turn,
role, text), null turns first; a null conv_id is a conversation of its own; only the
role `assistant`, exactly so spelled, is trainable; repeated rows are repeated turns;
an assistant turn with empty text gives an example with an empty mask. A conversation
whose last turn is no reply also gives a final example without a target, as otherwise
those turns would be in no example. An empty table gives no examples. Other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"

# what follows the first character, < or [, of a control string
_TAILS = (
    r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>"
    r"|/?s>|/?INST\]|<SYS>>|</SYS>>"
)
PLAIN_CONTROL = r"([<\[])(\\*)(" + _TAILS + ")"
ESCAPED_CONTROL = r"([<\[])\\(\\*)(" + _TAILS + ")"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN_CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED_CONTROL, "$1$2$3")


def _mark(turn: Column) -> Column:
    return F.concat(
        F.lit(START), escape(turn["role"]), F.lit(SEP), escape(turn["text"]), F.lit(END)
    )


def expand(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, target (number of the reply among the turns, null for a
    closing example), final (the last example, which holds the whole conversation), text,
    loss_start and loss_end (code points, end excluded).

    Turns meet once per conversation; the expansion itself needs no shuffle.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    size = F.size("turns")
    replies = F.filter(
        F.sequence(F.lit(1), size),
        lambda at: (F.element_at("turns", at)["role"] == ASSISTANT) | (at == size),
    )
    placed = whole.select(
        "conv_id", "turns", F.transform("turns", _mark).alias("marked"), F.explode(replies).alias("at")
    )
    last = F.element_at("turns", F.col("at"))
    trainable = last["role"] == ASSISTANT
    before = F.array_join(F.slice("marked", F.lit(1), F.col("at") - 1), "")
    opening = F.concat(F.lit(START), escape(last["role"]), F.lit(SEP))
    lead = F.length("before") + F.length(opening)
    return placed.withColumn("before", before).select(
        "conv_id",
        F.when(trainable, F.col("at")).alias("target"),
        (F.col("at") == F.size("turns")).alias("final"),
        F.concat("before", F.element_at("marked", F.col("at"))).alias("text"),
        lead.cast("long").alias("loss_start"),
        (lead + F.when(trainable, F.length(escape(last["text"]))).otherwise(0))
        .cast("long")
        .alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples hold, per conversation, read from their texts and masks alone.

    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (code points of all
    examples together), n_examples (with a target).
    """
    under_mask = unescape(
        F.col("text").substr(
            (F.col("loss_start") + 1).cast("int"),
            (F.col("loss_end") - F.col("loss_start")).cast("int"),
        )
    )
    order = F.coalesce("target", F.lit(2**31 - 1))
    whole = examples.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(order.alias("order"), F.when(F.col("target").isNotNull(), under_mask).alias("loss"))
            )
        ).alias("losses"),
        F.max(F.when(F.col("final"), F.col("text"))).alias("text"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
        F.count("target").alias("n_examples"),
    )
    marked = F.slice(F.split("text", r"<\|im_end\|>"), F.lit(1), F.size(F.split("text", r"<\|im_end\|>")) - 1)
    body = F.lit(len(START) + 1)

    def plain(turn: Column) -> Column:
        parts = F.split(F.substring(turn, body, F.length(turn)), r"<\|im_sep\|>")
        return F.concat(
            unescape(F.element_at(parts, 1)), F.lit("\n"), unescape(F.element_at(parts, 2)), F.lit("\n")
        )

    loss = F.array_join(F.transform("losses", lambda part: F.coalesce(part["loss"], F.lit(""))), "")
    return (
        whole.withColumn("marked", marked)
        .withColumn("loss", loss)
        .select(
            "conv_id",
            F.size("marked").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("marked", plain), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
            "n_examples",
        )
    )
