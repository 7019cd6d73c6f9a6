"""Operator 7: chat formatting from an event log.

Conversations are rebuilt by folding their events in order of ``seq``:

* ``message``    starts a message (its text replaces whatever the message had),
* ``delta``      appends a streamed piece to a message,
* ``edit``       replaces the text of a message,
* ``regenerate`` throws the text of a message away; later deltas build it anew.

The finished messages are rendered between ``<|im_start|>`` and ``<|im_end|>``
with a loss mask over the assistant's texts. Texts are escaped, so that control
strings inside them can neither open nor close a turn, and reading the output
back gives the very texts.

Only DataFrame functions. One exchange by conversation serves the window sums
and both groupings; what is gathered per conversation is its own output row.

Defined cases: null texts and roles are empty; a message has the role of its
first event, later ones may leave theirs out; events with one ``seq`` are
ordered by kind and text; events of another or no kind are ignored, and a
message without any other event doesn't exist; an empty log gives no rows; a
message whose only events are deltas starts from an empty text; a null
conversation id is a conversation like any other; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Escape sign (a control picture that text hardly ever holds) and its codes.
ESC = "␛"
RESETS = ("message", "edit", "regenerate")
KINDS = (*RESETS, "delta")


def escape(text: Column) -> Column:
    """Reversible: afterwards no ``<|`` and no raw escape sign is left."""
    return F.replace(F.replace(text, F.lit(ESC), F.lit(ESC + "0")), F.lit("<|"), F.lit(f"<{ESC}1|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ESC + "2"))


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit(ESC + "1"), F.lit("")), F.lit(ESC + "2"), F.lit("\n"))
    return F.replace(out, F.lit(ESC + "0"), F.lit(ESC))


def fold_events(events: DataFrame, conv: str = "conv_id", msg: str = "msg_id", seq: str = "seq",
                kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages: (conv, msg, role, text), one row per message."""
    e = events.where(F.col(kind).isin(*KINDS)).select(F.col(conv), F.col(msg), F.struct(
        F.col(seq).alias("s"), F.col(kind).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"),
        F.coalesce(F.col(role), F.lit("")).alias("r")).alias("_e"))
    log = e.groupBy(conv, msg).agg(F.sort_array(F.collect_list("_e")).alias("_log"))
    # the last reset decides where the text begins
    at = F.array_max(F.transform("_log", lambda x, i: F.when(x["k"].isin(*RESETS), i).otherwise(F.lit(-1))))
    live = F.filter("_log", lambda x, i: i >= F.col("_at"))
    return (log.withColumn("_at", at)
            .select(conv, msg, F.element_at("_log", 1)["r"].alias(role),
                    F.array_join(F.transform(live, lambda x: F.when(x["k"] == "regenerate", F.lit(""))
                                             .otherwise(x["t"])), "").alias(text)))


def render(messages: DataFrame, conv: str = "conv_id", msg: str = "msg_id", role: str = "role", text: str = "text",
           loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: (conv, formatted, segments).

    ``segments`` cuts ``formatted`` into pieces of (text, loss); the pieces
    joined are ``formatted``, and those with ``loss`` are the loss mask.
    """
    head = F.concat(F.lit(START), escape_role(F.col(role)), F.lit("\n"))
    body = escape(F.col(text))
    piece = F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                    F.struct(body.alias("text"), (F.col(role) == loss_role).alias("loss")),
                    F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    return (messages.select(conv, F.struct(F.col(msg).alias("m"), piece.alias("p")).alias("_m"))
            .groupBy(conv).agg(F.sort_array(F.collect_list("_m")).alias("_all"))
            .select(conv, F.flatten(F.transform("_all", lambda x: x["p"])).alias("segments"))
            .select(conv, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from formatted text alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.substring_index(F.substr(b, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped piece by piece."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


#: Pieces in which a streamed text arrives at most, and events that one message has at most in a log of turns.
PIECES, STEPS = 6, 16


def pieces(text: Column) -> Column:
    """``text`` cut into at most PIECES pieces of 16 characters or more; none of an empty text."""
    size = F.greatest(F.lit(16), F.ceil(F.length(text) / PIECES)).cast("int")
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), size)
    return F.filter(F.transform(starts, lambda i: F.substr(text, i, size)), lambda x: x != "")


def log_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """An event log whose final messages are the given turns: (conv_id, msg_id, seq, kind, role, text).

    The turns of a conversation go three ways in turn, by their place: written
    at once as a draft and edited; streamed in pieces; streamed as a draft,
    thrown away and streamed anew. A draft is the text with its front cut off.
    Only the event that opens a message carries its role. Rows that share
    conversation and turn number stay messages of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_text")
    said = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("_turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("_role"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("msg_id", F.row_number().over(order))

    def event(kind: str, body: Column | None = None, who: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.lit(None) if who is None else who).cast("string").alias("role"),
                        (F.lit(None) if body is None else body).cast("string").alias("text"))

    role_, text_ = F.col("_role"), F.col("_text")
    draft = F.substr(text_, F.floor(F.length(text_) / 2).cast("int") + 1)
    opened = lambda body: F.array(event("message", body, role_))
    streamed = lambda body: F.transform(pieces(body), lambda x: event("delta", x))
    way = F.col("msg_id") % 3
    log = (F.when(way == 0, F.concat(opened(draft), F.array(event("edit", text_))))
           .when(way == 1, F.concat(opened(F.lit("")), streamed(text_)))
           .otherwise(F.concat(opened(F.lit("")), streamed(draft), F.array(event("regenerate")), streamed(text_))))
    return (said.select("conv_id", "msg_id", F.posexplode(log).alias("_step", "_event"))
            .select("conv_id", "msg_id", (F.col("msg_id").cast("long") * STEPS + F.col("_step")).alias("seq"), "_event.*"))


def conversation_digests(events: DataFrame) -> DataFrame:
    """The digest columns of the registered query, read back from the formatted output of an event log."""
    out = render(fold_events(events))
    return (out.withColumn("_turns", read_turns(F.col("formatted"))).withColumn("_loss", loss_text(F.col("segments")))
            .select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                                                F.lit("\n"))), "").cast("binary"),
                           256).alias("turns_sha256"),
                    F.length("_loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
