"""Chat formatting by event-sourced reconstruction, in DataFrame functions alone (operator 4).

A log row is an event of one message: ``delta`` appends text, ``edit`` replaces the message by its text,
``regenerate`` drops what the message holds so far. Messages are folded from their events by sequence number, each
message a group of its own, so a conversation of a third of all rows is folded by many tasks. A repeated event
(same message, sequence number, kind and text) counts once.

Each message is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. In role and text, a backslash is put into
every ``<|`` (after those that stand there already), so control strings of the template never stand inside a
text and taking one out restores it; a role's percent signs and line ends are percent-encoded too. The output
has one row per turn: its piece of the formatted conversation, where the piece starts, and the loss mask, the
span of an assistant's text. The formatted conversation is its pieces in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
EVENT = ("conv_id", "turn", "part", "seq", "kind", "role", "text")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def rows_as_events(rows: DataFrame) -> DataFrame:
    """The log of stored turns (conv_id, turn, role, text): each row streams its text in two deltas.

    Rows that share conversation and turn are messages of their own, in the order of role and text; null texts
    and roles are empty; a null conv_id is a conversation, a null turn comes first in its conversation.
    """
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    part = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    half = (F.char_length("text") / 2).cast("int")
    deltas = F.array(F.struct(F.lit(1).alias("seq"), F.expr("left(text, half)").alias("text")),
                     F.struct(F.lit(2).alias("seq"), F.expr("substring(text, half + 1)").alias("text")))
    return (rows.withColumn("part", part).withColumn("half", half)
            .select("conv_id", "turn", "part", "role", F.explode(deltas).alias("d"))
            .select("conv_id", "turn", "part", "d.seq", F.lit("delta").alias("kind"), "role", "d.text"))


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, text): the final message of every group of events.

    Order: sequence number, then kind and text for equal numbers. The role is that of the last event with one.
    Unknown kinds and null texts add nothing.
    """
    e = events.select(*EVENT[:3], F.struct(
        F.col("seq").cast("long").alias("seq"), "kind", F.coalesce("text", F.lit("")).alias("text"), "role").alias("e"))
    own = F.array_sort(F.array_distinct(F.collect_list("e")))
    folded = e.groupBy(*EVENT[:3]).agg(own.alias("es"))
    last = F.coalesce(F.array_max(F.transform("es", lambda x, i: F.when(x["kind"].isin("edit", "regenerate"), i))), F.lit(0))
    live = F.filter(F.col("es"), lambda x, i: (i >= F.col("last")) & x["kind"].isin("delta", "edit"))
    roles = F.filter(F.transform("es", lambda x: x["role"]), lambda r: r.isNotNull())
    return folded.withColumn("last", last).select(
        *EVENT[:3], F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, part, piece, start, loss_start, loss_end): the pieces of the formatted conversations.

    Positions are code points from the start of the conversation; a turn that is not trained on has null
    loss_start and loss_end.
    """
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    m = messages.select(*EVENT[:3], head.alias("head"), body.alias("body"), (F.col("role") == TRAINED_ROLE).alias("train"))
    m = m.select(*EVENT[:3], F.concat("head", "body", F.lit(END)).alias("piece"), F.char_length("head").alias("h"),
                 F.char_length("body").alias("b"), "train")
    before = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("start", F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0)))
    return m.select(*EVENT[:3], "piece", "start", F.when(F.col("train"), F.col("start") + F.col("h")).alias("loss_start"),
                    F.when(F.col("train"), F.col("start") + F.col("h") + F.col("b")).alias("loss_end"))


def format_log(events: DataFrame) -> DataFrame:
    """The pieces of every conversation of an event log; an empty log gives no rows."""
    return render(fold(events))


def read_back(pieces: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the pieces alone.

    A conversation's digests need its text in one row, as its formatted text would.
    """
    inner = F.col("piece").substr(F.lit(len(START) + 1), F.char_length("piece") - len(START) - len(END))
    role = F.substring_index("inner", "\n", 1)
    text = F.expr("substring(inner, char_length(substring_index(inner, '\n', 1)) + 2)")
    masked = F.col("piece").substr((F.col("loss_start") - F.col("start") + 1).cast("int"),
                                   (F.col("loss_end") - F.col("loss_start")).cast("int"))
    turns = pieces.withColumn("inner", inner).select("conv_id", F.struct(
        "turn", "part", F.concat(_unescape_role(role), F.lit("\n"), unescape(text), F.lit("\n")).alias("said"),
        unescape(masked).alias("loss"), F.char_length("piece").cast("long").alias("n")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.sum("t.n").alias("formatted_chars"))
    loss = F.array_join(F.transform("ts", lambda t: F.coalesce(t["loss"], F.lit(""))), "")
    said = F.array_join(F.transform("ts", lambda t: t["said"]), "")
    return whole.withColumn("loss", loss).select(
        "conv_id", F.size("ts").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
