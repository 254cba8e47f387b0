"""Chat formatting by event sourcing, with built-in functions only.

A conversation is a log of events, each with a sequence number and the message it belongs to:

- `message` sets a message's text, `edit` replaces it, `delta` appends to it (streamed text);
- `regenerate` empties it, so that later deltas start anew; `delete` removes the message until it is set again.

Logs are partitioned by conversation, and the events of a message are ordered by sequence number; those after the last one
that sets or empties the text are folded into the final text. Messages stand in the order of their first events. Ties in the
sequence number are ordered by kind, role and text. A null text is empty, as is a null role; a message has the role of
its first event. A null conversation id is a conversation of its own. Repeated rows are repeated events.

The template is `<|turn|>role<|text|>text<|end|>` for every message. Inside roles and texts a backslash is doubled, and
control strings get a backslash after their first letter, so none survives; dropping each backslash before a letter gives
the text back.

`conversation_log` turns a table of finished turns into such a log, as a chat server would have written it, so that the fold
has drafts to forget and pieces to put together. An empty table has no log and no conversation; further columns are left out.

Folding and rendering share one partitioning by conversation, as a conversation ends up in one row anyhow. Events are gathered
by message only, and sorted groups spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template, and control strings of other templates that must not survive in texts either.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = r"<(?=\||/?s>|/?SYS>|</?SYS)|\[(?=/?INST\])"
TRAINED_ROLE = "assistant"
PIECE = 512  # code points of a streamed piece
SETS = ("message", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversation_log(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The log of a table of finished turns; its fold is the table.

    A turn of the trained role is a draft (its first piece) that is regenerated and then streamed in pieces of `PIECE` code
    points. Any other turn is a message that lacks its last piece, and an edit to the whole text, which comes after the next
    turn has begun. Rows of one turn are messages of their own, in the order of role and text, numbered among themselves to
    keep equal rows apart. The sequence number of an event is its time, turn, row and step.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    plain = rows.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    cut = plain.withColumn("copy", F.row_number().over(order)).withColumn("pieces", pieces)
    now, later = F.col("turn"), F.coalesce(F.try_add("turn", F.lit(1)), "turn")

    def event(time: Column, step: Column, kind: str, text: Column) -> Column:
        seq = F.struct(time.alias("time"), F.col("turn"), F.col("copy"), step.cast("int").alias("step"))
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = F.concat(
        F.array(
            event(now, F.lit(0), "delta", F.coalesce(F.get("pieces", F.lit(0)), F.lit(""))),
            event(now, F.lit(1), "regenerate", F.lit(None).cast("string")),
        ),
        F.transform("pieces", lambda x, i: event(now, i + 2, "delta", x)),
    )
    kept = F.slice("pieces", 1, F.greatest(F.size("pieces") - 1, F.lit(0)))
    edited = F.array(event(now, F.lit(0), "message", F.array_join(kept, "")), event(later, F.lit(1), "edit", F.col("text")))
    events = F.inline(F.when(F.col("role") == TRAINED_ROLE, streamed).otherwise(edited))
    return cut.select("conv_id", F.struct("turn", "copy").alias("message_id"), "role", events)


def fold(events: DataFrame) -> DataFrame:
    """`conv_id`, `position` (the first sequence number), `role` and the final `text` of every message that remains."""
    events = events.repartition("conv_id")
    event = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    logs = events.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # The last event that sets the text, counted from 1; deltas before it are forgotten.
    last = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(*SETS), i + 1))), F.lit(0))
    head = F.when(last > 0, F.get(F.col("log"), last - 1))
    tail = F.slice("log", F.greatest(last + 1, F.lit(1)), F.size("log"))
    start = F.when(head["kind"].isin("message", "edit"), head["text"]).otherwise("")
    text = F.concat(F.coalesce(start, F.lit("")), F.array_join(F.transform(F.filter(tail, lambda e: e["kind"] == "delta"), lambda e: e["text"]), ""))
    gone = F.coalesce(head["kind"] == "delete", F.lit(False))
    return logs.filter(~gone).select("conv_id", F.col("log")[0]["seq"].alias("position"), F.col("log")[0]["role"].alias("role"), text.alias("text"))


def render(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: `conv_id`, `formatted`, and `loss`, for every turn the part of it under the loss mask.

    `loss` holds (start, length) in code points of the turn's own stretch of `formatted`, which ends with the end mark;
    length 0 where nothing is trained on. An offset in the whole string is the sum of the earlier stretches.
    """
    role, text = escape(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(TURN), role, F.lit(TEXT))
    parts = messages.select(
        "conv_id",
        "position",
        F.concat(head, text, F.lit(END)).alias("stretch"),
        F.length(head).alias("start"),
        F.when(F.col("role") == trained_role, F.length(text)).otherwise(0).alias("length"),
    )
    turns = F.sort_array(F.collect_list(F.struct("position", "stretch", "start", "length")))
    return parts.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id",
        F.array_join("turns.stretch", "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns (`role`, `text`) of rendered conversations, and the unescaped texts under the loss mask."""
    # No escaped text holds the end mark, so splitting there is exact; what follows the last one is empty.
    stretches = F.split("formatted", r"<\|end\|>")
    parts = F.slice(stretches, 1, F.size(stretches) - 1)
    split = formatted.withColumn("stretches", parts)

    def turn(x: Column) -> Column:
        at = F.instr(x, TEXT)
        role = F.substring(x, F.lit(len(TURN) + 1), at - len(TURN) - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(x, at + len(TEXT), F.length(x))).alias("text"))

    return split.select(
        "conv_id",
        "formatted",
        F.transform("stretches", turn).alias("turns"),
        F.transform(
            F.filter(F.arrays_zip("stretches", "loss"), lambda x: x["loss"]["length"] > 0),
            lambda x: unescape(F.substring(x["stretches"], x["loss"]["start"] + 1, x["loss"]["length"])),
        ).alias("trained"),
    )
