"""Chat formatting from an event log, in DataFrame expressions only.

Event-sourced reconstruction: a log (conv_id, seq, message, role, kind, text) is
partitioned by conversation and message, sorted by `seq` and folded into the final
text: `delta` appends, `edit` replaces all before it, `regenerate` discards all before
it. The messages of a conversation, in the order of their first event, are rendered as

    <|im_start|>role NEWLINE text <|im_end|> NEWLINE

with every backslash in a text doubled and then every `<|` written `<\\|`, so no text
holds a marker and the escapes can be taken back. In a role, `%`, `<` and newline are
percent-coded. The loss mask is the list of the assistant texts' spans in the output.

The events of one message, and the rendered messages of one conversation, meet in one
row because the final text and the output are one value each; offsets come from a
window over messages, which spills.

Defined results: a NULL text is empty, a NULL role is empty, a NULL conversation id is
a conversation of its own; unknown kinds are errors; events with equal `seq` are taken
in the order of kind and text; repeated events count twice; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
DELTA_CHARS = 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


_ROLE_CODES = (("%", "%25"), ("<", "%3C"), ("\n", "%0A"))


def coded_role(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def decoded_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def fold_messages(events: DataFrame) -> DataFrame:
    """conv_id, message, role and final text of every message, `at` its first seq."""
    known = F.coalesce(F.col("kind").isin("delta", "edit", "regenerate"), F.lit(False))
    checked = F.when(known, F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("NULL"))))
    )
    log = events.select(
        "conv_id",
        "message",
        "seq",
        F.coalesce("role", F.lit("")).alias("role"),
        checked.alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    folded = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("at"),
        F.min("role").alias("role"),
        F.sort_array(F.collect_list(F.struct("seq", "kind", "text"))).alias("events"),
    )
    resets = F.filter(
        F.sequence(F.lit(1), F.size("events")), lambda i: F.get("events", i - 1)["kind"] != "delta"
    )
    first = F.coalesce(F.array_max(resets), F.lit(1))
    used = F.expr("slice(events, first, size(events))")
    parts = F.transform(used, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    return folded.withColumn("first", first).select("conv_id", "message", "at", "role", F.array_join(parts, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans (start and length in code points)."""
    body = escaped(F.col("text"))
    header = F.concat(F.lit(START), coded_role(F.col("role")), F.lit("\n"))
    parts = messages.select(
        "conv_id",
        F.struct("at", "message").alias("place"),
        (F.col("role") == ASSISTANT).alias("loss"),
        F.length(header).alias("skip"),
        F.length(body).alias("length"),
        F.concat(header, body, F.lit(END)).alias("part"),
    )
    ahead = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn(
        "start", F.coalesce(F.sum(F.length("part")).over(ahead), F.lit(0)) + F.col("skip")
    )
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "part", "loss", "start", "length"))).alias("parts")
    )
    spans = F.transform(
        F.filter("parts", lambda p: p["loss"]),
        lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, formatted text and loss spans of every conversation of an event log."""
    return render(fold_messages(events))


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, "<\\|im_start\\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(decoded_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, escapes taken back."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, s["length"]))), ""
    )


def events_of_turns(turns: DataFrame) -> DataFrame:
    """An event log whose final messages are the rows (conv_id, turn, role, text).

    User and other turns are typed in part and then edited into their text; assistant
    turns have a draft that is regenerated, then deltas of DELTA_CHARS code points.
    Rows of one turn follow each other by role and text.
    """
    ordered = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
                )
            )
        ).alias("rows")
    )
    rows = ordered.select("conv_id", F.posexplode("rows").alias("message", "row")).select(
        "conv_id", F.col("message").cast("long").alias("message"), "row.role", "row.text"
    )

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    text = F.col("text")
    deltas = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / DELTA_CHARS).cast("int")),
        lambda i: event("delta", F.substring(text, i * DELTA_CHARS + 1, F.lit(DELTA_CHARS))),
    )
    streamed = F.concat(
        F.array(event("delta", F.substring(text, 1, 40)), event("regenerate", F.lit(""))), deltas
    )
    edited = F.array(event("delta", F.substring(text, 1, 40)), event("edit", text))
    log = rows.withColumn("events", F.when(F.col("role") == ASSISTANT, streamed).otherwise(edited))
    return log.select("conv_id", "message", "role", F.posexplode("events").alias("n", "event")).select(
        "conv_id",
        F.struct("message", F.col("n").cast("long").alias("n")).alias("seq"),
        "message",
        "role",
        "event.kind",
        "event.text",
    )
