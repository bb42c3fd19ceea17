"""Chat formatting: messages folded from an event log, rendered with turn marks, and read back.

An event belongs to a message of a conversation and has a place in the conversation's sequence.  ``start``, ``edit``
and ``regenerate`` set the message's text to their own (of a ``regenerate`` usually empty), whatever came before;
``delta`` appends.  A message stands where its first event stands.  So the final text is what the last setting event
and the deltas after it hold, which a window over the message's events finds from the end.

In a rendered conversation every turn is ``<|turn|>role<|text|>text<|end|>``.  Control strings inside roles and texts
are escaped: an escape sign goes behind their first sign, and behind as many as already stand there, so that it can
be taken out again.  Escaped texts hold no control string, nor do they form one with a mark beside them, since control
strings have their opening sign at their first place only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: The marks of this template and those of other common ones, without their opening sign.
CONTROLS = r"\|(?:turn|text|end|im_start|im_end|endoftext)\|>|/?s>|/?INST\]"
ESCAPE = "~"
TRAINED = "assistant"

#: Kinds of events, in the order in which events with one sequence number apply.
KINDS = ("start", "edit", "regenerate", "delta")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])({ESCAPE}*)({CONTROLS})", f"$1{ESCAPE}$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]){ESCAPE}({ESCAPE}*)({CONTROLS})", "$1$2$3")


def reconstruct(events: DataFrame, conversation: str = "conv_id", message: str = "message_id", sequence: str = "seq", kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, message_id, first, role, text): the final messages of an event log; ``first`` is their place.

    Events of one sequence number apply in the order of ``KINDS``, then by text; a null number comes first.  The role
    is the last that any event of the message names, else empty.  Null texts are empty.  Deltas without a start make a
    message of their own.  Events of other kinds (null too) change nothing, and a message with only such events does
    not appear.  A null conversation or message is one like any other.  Repeated rows apply as often as they stand.
    An empty log gives no messages.

    The events of a message meet in one task, sorted and spilled by Spark; superseded texts are dropped before texts
    are put together, so only the final text is held.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col(kind))
    read = events.where(F.col(kind).isin(*KINDS)).select(
        F.col(conversation).alias("conv_id"),
        F.col(message).alias("message_id"),
        F.struct(F.col(sequence).alias("seq"), rank.alias("rank"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("event"),
        F.col(role).alias("role"),
    )
    sets = F.col("event.rank") < len(KINDS)
    later = Window.partitionBy("conv_id", "message_id").orderBy(F.desc("event")).rowsBetween(Window.unboundedPreceding, -1)
    valid = F.coalesce(F.max(sets).over(later), F.lit(False)) == F.lit(False)
    return (
        read.withColumn("valid", valid)
        .groupBy("conv_id", "message_id")
        .agg(
            F.min("event.seq").alias("first"),
            F.max(F.when(F.col("role").isNotNull(), F.struct("event.seq", "event.rank", "role"))).alias("named"),
            F.collect_list(F.when(F.col("valid"), F.col("event"))).alias("parts"),
        )
        .select(
            "conv_id",
            "message_id",
            "first",
            F.coalesce("named.role", F.lit("")).alias("role"),
            F.array_join(F.transform(F.sort_array("parts"), lambda p: p["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, segments): every conversation as segments of text, each with whether it is trained on.

    The segments joined are the formatted conversation; the loss mask covers the texts of assistants and no mark.
    Messages stand by ``first``, then by ``message_id``.  One conversation is one row, so it must fit into one.
    """
    body = F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == TRAINED).alias("loss"))
    head = F.struct(F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss"))
    tail = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
    turn = F.struct("first", "message_id", F.array(head, body, tail).alias("segments"))
    return (
        messages.select("conv_id", turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"))
    )


def formatted(segments: Column) -> Column:
    """A conversation as one text."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation, read back."""

    def read(piece: Column) -> Column:
        parts = F.split(piece, r"<\|(?:text|end)\|>")
        return F.struct(unescaped(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))

    pieces = F.split(text, r"<\|turn\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), read)


def trained(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def logged(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Finished conversations as the event log that would have led to them.

    Every message is streamed in two halves.  What assistants say is regenerated once, after its first half; what
    others say is edited into its final form.  Rows with one turn are messages of their own, by role and text.  Rows
    meet by conversation once, and stay so for the fold.
    """
    known = conversations.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).repartition("conv_id")
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    start, rest = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.char_length("text"))

    def event(step: int, kind: str, part: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), part.alias("text"))

    nothing = F.lit("")
    again = F.array(event(0, "start", nothing), event(1, "delta", start), event(2, "regenerate", nothing), event(3, "delta", start), event(4, "delta", rest))
    edited = F.array(event(0, "start", start), event(1, "edit", F.col("text")))
    return (
        known.withColumn("copy", copy)
        .withColumn("event", F.explode(F.when(F.col("role") == TRAINED, again).otherwise(edited)))
        .select(
            "conv_id",
            F.struct("turn", "copy").alias("message_id"),
            F.struct("turn", "copy", "event.step").alias("seq"),
            "event.kind",
            "role",
            "event.text",
        )
    )
