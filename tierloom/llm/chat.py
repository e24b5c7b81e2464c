"""Chat formatting: rebuild conversations from event logs and render them, with DataFrame functions only.

A log has one row per event: conversation, sequence number, message, kind, role and text. Kinds are ``message`` (a whole
message), ``delta`` (text streamed to the end of a message), ``edit`` (a new text for it) and ``regenerate`` (the message
starts anew, and messages that began after it are gone). Other kinds are ignored.

Rendered, a turn is ``### role: text</turn>`` and a line break. Inside texts and roles the control strings are escaped,
so a reader that splits at them finds the turns again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
# Control strings and their escapes; the backslash comes first when escaping and last when reading.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
LEARNED = "assistant"
KINDS = ("message", "delta", "edit", "regenerate")


def escaped(value: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, code in pairs:
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def plain(value: Column, pairs: tuple = ESCAPES) -> Column:
    for text, code in reversed(pairs):
        value = F.replace(value, F.lit(code), F.lit(text))
    return value


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, first_seq, message_id, role, text) from events.

    Events of one message meet in one group, sorted by sequence number, then kind and text; what comes before its last
    whole text (message, edit or regenerate) is dropped and the rest joined. Events that are equal in every column are
    one event, as logs may deliver twice. The role is that of the first event with one; nulls in text are empty, in role
    too. A message goes if an earlier message is regenerated after it began. Events without sequence number come first.
    """
    known = events.filter(F.col("kind").isin(*KINDS))
    seq = F.col("seq")
    restart = F.col("kind") != "delta"
    event = F.struct(seq, F.col("kind"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = known.groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("first_seq"),
        F.max(F.when(restart, seq)).alias("restart"),
        F.max(F.when(F.col("kind") == "regenerate", seq)).alias("regenerated"),
        F.min(F.when(F.col("role").isNotNull(), F.struct(seq, F.col("role"))))["role"].alias("role"),
        F.array_sort(F.collect_set(event)).alias("log"),
    )
    after = F.filter("log", lambda e: F.col("restart").isNull() | (e["seq"] >= F.col("restart")))
    text = F.array_join(F.transform(after, lambda e: e["text"]), "")
    in_order = Window.partitionBy("conv_id").orderBy("first_seq", "message_id")
    earlier = F.max("regenerated").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    folded = grouped.select(
        "conv_id", "first_seq", "message_id", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
        earlier.alias("earlier"),
    )
    stays = F.coalesce(F.col("earlier") <= F.col("first_seq"), F.lit(True))
    return folded.filter(stays).drop("earlier")


def render(messages: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per conversation: conv_id, formatted, and segments (text, loss) whose texts make up ``formatted``.

    ``loss`` marks the escaped texts of the learned role, without marks of the turn. A conversation is one text, so its
    messages meet in one row; messages are ordered by first_seq, then message_id.
    """
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    turn = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == learned).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )
    rendered = messages.select("conv_id", "first_seq", "message_id", turn.alias("turn"))
    gathered = rendered.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("first_seq", "message_id", "turn"))).alias("turns")
    )
    segments = F.flatten(F.transform("turns", lambda t: t["turn"]))
    return gathered.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def turns(formatted: str | Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    value = F.col(formatted) if isinstance(formatted, str) else formatted
    parts = F.split(value, "</turn>\n")

    def read(part: Column) -> Column:
        at = F.locate(AFTER_ROLE, part)
        role = F.substring(part, len(HEAD) + 1, at - len(HEAD) - 1)
        text = F.substring(part, at + len(AFTER_ROLE), F.length(part))
        return F.struct(plain(role, ROLE_ESCAPES).alias("role"), plain(text).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), read)


def events_of(conversations: DataFrame) -> DataFrame:
    """Rows of finished turns (conv_id, turn, role, text) as a log: each row, repeated ones too, is one whole message.

    Rows are numbered by turn, then role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    seq = F.row_number().over(order).cast("long")
    return conversations.select(
        "conv_id", seq.alias("seq"), seq.alias("message_id"), F.lit("message").alias("kind"), "role", "text"
    )


def chat_report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    output = render(fold(events_of(conversations)))
    found = output.select("conv_id", "formatted", turns("formatted").alias("turns"), "segments")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: plain(s["text"]))
    read = found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(said, "").alias("said"),
        F.array_join(masked, "").alias("masked"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
