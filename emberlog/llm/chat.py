"""Chat formatting by event-sourced reconstruction.

A log of events is partitioned by conversation and sorted by sequence. Streamed deltas,
edits and regenerations are folded into final messages, which are rendered with a
template that marks turns and escapes control strings inside texts reversibly.

Template: `<|role|>` role newline text `<|end|>` newline, per turn. Inside roles and texts
`\\` is doubled and `<|` becomes `<\\|`; a newline in a role becomes `<\\n|`. After
doubling, a lone backslash can only come from these two rules, so reading back is exact.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings.
OPEN, CLOSE = "<|role|>", "<|end|>\n"
OPEN_PATTERN = "<\\|role\\|>"
TRAINED = "assistant"

MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n|"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n|"), F.lit("\n")))


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the messages that a log of events amounts to.

    `events` has conv_id, seq, role, text and, if messages were streamed or changed, kind
    and message_id. A `message` starts a message, a `delta` adds to the one with its id, an
    `edit` replaces its text, and a `regenerate` drops what was there and starts again.
    An event without message_id is a message of its own; a null kind is a message. The
    place and role of a message are those of its first event. A null text is empty.
    Events of one seq are taken in the order of kind, role and text.
    """
    if not {"kind", "message_id"} <= set(events.columns):
        return events.select("conv_id", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    log = events.select(
        "conv_id",
        "seq",
        F.coalesce("kind", F.lit(MESSAGE)).alias("kind"),
        "message_id",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = log.where("message_id is null").select("conv_id", "seq", "role", "text")
    steps = log.where("message_id is not null").groupBy("conv_id", "message_id").agg(
        F.sort_array(
            F.collect_list(F.struct("seq", F.when(F.col("kind") == MESSAGE, 0).otherwise(1).alias("late"), "kind", "role", "text"))
        ).alias("steps")
    )
    # The text is that of the last event that sets it, and of the deltas after it.
    sets = F.transform("steps", lambda step, at: F.when(step["kind"] != DELTA, at + 1))
    begin = F.coalesce(F.array_max(sets), F.lit(1))
    parts = F.slice("steps", begin, F.size("steps") - begin + 1)
    folded = steps.select(
        "conv_id",
        F.col("steps")[0]["seq"].alias("seq"),
        F.col("steps")[0]["role"].alias("role"),
        F.array_join(F.transform(parts, lambda step: step["text"]), "").alias("text"),
    )
    return whole.unionByName(folded)


def format_conversations(events: DataFrame, trained: str = TRAINED) -> DataFrame:
    """(conv_id, formatted, segments): one row per conversation of a log of events.

    `segments` cuts `formatted` into (text, loss) pieces; loss is true for the texts of
    `trained` turns, markup excluded. A conversation is as long as its events; events with
    a null conv_id are one conversation. No events, no rows.
    """
    turns = (
        final_messages(events)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text"))).alias("turns"))
    )
    pieces = F.flatten(
        F.transform(
            "turns",
            lambda turn: F.array(
                F.struct(
                    F.concat(F.lit(OPEN), _escaped_role(turn["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")
                ),
                F.struct(escaped(turn["text"]).alias("text"), (turn["role"] == trained).alias("loss")),
                F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    cut = turns.select("conv_id", pieces.alias("segments"))
    return cut.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, texts as they were."""
    bodies = F.split(formatted, OPEN_PATTERN, -1)
    return F.transform(
        F.slice(bodies, 2, F.greatest(F.size(bodies) - 1, F.lit(0))),
        lambda body: F.struct(
            _unescaped_role(F.substring_index(body, "\n", 1)).alias("role"),
            unescaped(
                F.substr(
                    body,
                    F.char_length(F.substring_index(body, "\n", 1)) + 2,
                    F.char_length(body) - F.char_length(F.substring_index(body, "\n", 1)) - 1 - len(CLOSE),
                )
            ).alias("text"),
        ),
    )


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, as it was, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
