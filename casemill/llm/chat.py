"""Chat formatting from event logs (operator 2), in DataFrame functions only.

A log holds events of conversations: (conv_id, turn, seq, kind, role, text). ``message`` sets the text of a turn and
``edit`` replaces it, ``delta`` adds a streamed piece, ``regenerate`` drops what the turn had and every later turn,
and starts it anew. ``fold_events`` partitions the log by conversation, sorts it by sequence and folds the events into
final turns; ``render`` writes them with a template whose control strings cannot be forged by a text.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Inside texts and roles every
``<`` followed by any backslashes and ``|`` gets one more backslash, so no text holds ``<|``; taking one away again gives
the text back. In roles, backslashes and line ends are written ``\\b`` and ``\\n`` as well. The rendering is kept as
segments with a flag: the loss mask covers the texts of assistant turns and nothing else.

Null texts and roles are empty; null turns and sequences sort first; events of one sequence number are taken by kind,
role and text; an event that is there twice counts once; rows without a conversation make one of their own. Unknown
kinds count as messages. An empty log gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>): the final turns of every conversation, in order.

    A regeneration of a turn undoes all earlier events of that turn and of later ones. Of what remains, a turn has the
    text of its last message or edit, followed by the deltas since, and the role of its last event that names one.
    """
    first = F.lit(-(1 << 62))
    e = events.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), first).alias("turn"),
        F.coalesce(F.col("seq").cast("long"), first).alias("seq"),
        F.coalesce(F.col("kind").cast("string"), F.lit("message")).alias("kind"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    regenerated = F.max(F.when(F.col("kind") == "regenerate", F.col("seq")))
    up_to_turn = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_undone", regenerated.over(up_to_turn))
    e = e.where(F.col("_undone").isNull() | (F.col("seq") >= F.col("_undone")))
    turn = Window.partitionBy("conv_id", "turn")
    content = F.struct("seq", "kind", "role", "text")
    in_order = turn.orderBy("seq", "kind", "role", "text")
    e = e.withColumns({
        "_repeats": F.coalesce(F.lag(content).over(in_order) == content, F.lit(False)),
        "_set": F.max(F.when(~F.col("kind").isin("delta", "regenerate"), F.col("seq"))).over(turn),
    })
    e = e.where(~F.col("_repeats"))
    counts = F.col("_set").isNull() | (F.col("seq") >= F.col("_set"))
    streamed = F.col("kind") == "delta"
    pieces = F.array_sort(F.collect_list(F.when(counts, F.struct("seq", streamed.alias("late"), "text"))))
    turns = e.groupBy("conv_id", "turn").agg(
        F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))), F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def render(folded: DataFrame) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>): the formatted conversation is the segments one after the other."""

    def parts(t: Column) -> Column:
        head = F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == LEARNED).alias("loss")),
            F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")),
        )

    return folded.select("conv_id", F.flatten(F.transform("turns", parts)).alias("segments"))


def formatted(segments: str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns array<struct<role, text>>, learned): parsed from the formatted text and its mask."""
    out = rendered.select("conv_id", "segments", formatted().alias("formatted"))
    marks = F.split("formatted", r"<\|im_start\|>")
    marks = F.slice(marks, F.lit(2), F.size(marks))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        after = F.length(role) + 2
        body = F.substring(part, after, F.length(part) - after + 1 - len(END) - 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return out.select(
        "conv_id", "formatted", F.transform(marks, turn).alias("turns"), F.array_join(learned, "").alias("learned")
    )


def digest(read: DataFrame) -> DataFrame:
    """One row per conversation with the lengths and hashes of what was read back."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        sha(F.col("learned")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def conversation_events(rows: DataFrame) -> DataFrame:
    """Rows by turn as a log: every row is a message and a turn of its own, equal turns ordered by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    number = F.row_number().over(order).cast("long")
    return rows.select("conv_id", number.alias("turn"), number.alias("seq"), F.lit("message").alias("kind"), "role", "text")
