"""Conversations in order of replies, with quotations linked and taken out.

A line that begins with one or more ``>`` is quoted, their number is its level; lines in a
row of the same level are a passage. Passages, and their lines, are reduced to letters and
digits in lower case and hashed. So are the messages' own lines and blocks of lines. A hash
belongs to the first message of the conversation that has it as its own, so a passage meets
one message for each of its hashes, however often its words recur. A passage goes back to
the earlier message that accounts for most of its letters; of equal ones, to the latest.

A message replies to the message its outermost linked passages go back to. Replies lead to
the first message of a thread, in as many joins as the depth has binary digits. A
conversation is its threads by their first turn, each in order of turns, so an answer comes
after what it answers.

DataFrame functions only. Conversations are never gathered: positions come from a range
partitioned sort, whose parts count their rows for each conversation.

Cases: null text is an empty message. Messages without conversation or turn are kept, link
to nothing, and are ordered with nulls first. Messages that share conversation and turn are
rows of their own with one reply link between them; equal rows stay as many as they are. A
quotation of something nobody said is removed and not linked. Messages of quotations only
become empty. An empty table gives an empty one. Extra columns are kept; those called like
a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import whole
from tickloom.workspace import settle

# What marks a quoted line, and a line that only announces a quotation.
QUOTED = r"^[ \t]*(?:>[ \t]?)+"
ANNOUNCED = r"^\s*(?:On|Am|Le|El)\b.*(?:wrote|schrieb|a écrit|escribió)\s*:\s*$"

RESULTS = ("reply_text", "n_quoted", "quote_depth", "reply_to", "thread", "position")


def lines_of(text: str | Column) -> Column:
    return F.split(F.regexp_replace(whole(text), r"\r\n?", "\n"), "\n")


def level_of(line: Column) -> Column:
    marks = F.regexp_extract(line, f"({QUOTED})", 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">")))


def bare(line: Column) -> Column:
    """A line as its letters and digits in lower case, one blank between words."""
    inner = F.regexp_replace(line, QUOTED, "")
    return F.lower(F.trim(F.regexp_replace(inner, r"[^\p{L}\p{N}]+", " ")))


def own_lines(lines: Column) -> Column:
    """Lines that are neither quoted nor announce the quotation that follows."""

    def own(line: Column, i: Column) -> Column:
        following = F.coalesce(F.get(lines, i + 1), F.lit(""))
        return ~line.rlike(QUOTED) & ~(line.rlike(ANNOUNCED) & following.rlike(QUOTED))

    return F.filter(lines, own)


def _runs(messages: DataFrame) -> DataFrame:
    """Lines of messages with the number of the run of equal level they are in; an own
    line without letters ends a run."""
    rows = messages.select("conv", "turn", "message", F.posexplode(lines_of("text")).alias("at", "line"))
    rows = rows.select("conv", "turn", "message", "at", level_of(F.col("line")).alias("level"), bare(F.col("line")).alias("bare"))
    in_order = Window.partitionBy("message").orderBy("at")
    kind = F.struct("level", (F.col("level") == 0) & (F.col("bare") == ""))
    edge = F.coalesce((kind != F.lag(kind).over(in_order)).cast("int"), F.lit(0))
    return rows.withColumn("edge", edge).withColumn("run", F.sum("edge").over(in_order))


def _hashes(runs: DataFrame) -> DataFrame:
    """Hashes of each line and each whole run, and the letters they stand for."""
    lines = runs.filter("bare <> ''").select("conv", "turn", "message", "run", "level", "at", "bare")
    in_order = F.array_sort(F.collect_list(F.struct("at", "bare")))
    blocks = lines.groupBy("conv", "turn", "message", "run", "level").agg(in_order.alias("x"))
    texts = F.array_distinct(F.concat(F.array(F.array_join("x.bare", " ")), F.col("x.bare")))
    each = blocks.select("conv", "turn", "message", "run", "level", F.explode(texts).alias("words"))
    return each.select("conv", "turn", "message", "run", "level", F.sha2("words", 256).alias("hash"), F.length("words").alias("letters"))


def quotation_links(conversations: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """For each message and quoted passage, the level and the turn it goes back to."""
    given = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    given = given.filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quoting = given.filter(F.col("text").rlike(r"(?:^|[\r\n])[ \t]*>"))
    quoting = settle(quoting.withColumn("message", F.monotonically_increasing_id()), "quoting")
    quoted = _hashes(_runs(quoting).filter("level > 0"))
    # Only conversations that quote at all have originals of interest.
    asked = settle(quoting.select("conv").distinct(), "quoting")
    originals = given.join(asked, "conv", "left_semi").withColumn("message", F.monotonically_increasing_id())
    own = _hashes(_runs(settle(originals, "originals")).filter("level = 0"))
    first = settle(own.groupBy("conv", "hash").agg(F.min("turn").alias("origin")), "first")
    met = settle(quoted, "quoted").join(first, ["conv", "hash"]).filter("origin < turn")
    said = met.groupBy("conv", "turn", "message", "run", "level", "origin").agg(F.sum("letters").alias("letters"))
    best = F.max_by(F.struct("origin", "letters"), F.struct("letters", "origin")).alias("best")
    found = said.groupBy("conv", "turn", "message", "run", "level").agg(best)
    return found.select("conv", "turn", "message", "run", "level", "best.origin", "best.letters")


def reply_links(links: DataFrame) -> DataFrame:
    """The turn each turn replies to, by its outermost linked passages."""
    said = links.groupBy("conv", "turn", "level", "origin").agg(F.sum("letters").alias("letters"))
    order = F.struct(-F.col("level"), "letters", "origin")
    return said.groupBy("conv", "turn").agg(F.max_by("origin", order).alias("reply_to"))


def threads(replies: DataFrame) -> DataFrame:
    """The first turn of the thread of each turn that replies: steps double until no step
    leads on."""
    ends = settle(replies.select("conv", "turn", F.col("reply_to").alias("thread")), "threads")
    while True:
        onward = ends.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        stepped = ends.join(onward, ["conv", "thread"], "left")
        moved = stepped.filter("next IS NOT NULL").isEmpty()
        if moved:
            return ends
        ends = settle(stepped.select("conv", "turn", F.coalesce("next", "thread").alias("thread")), "threads")


def reply_ordered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages without quotations (``reply_text``) and their ``position``, from 0, in
    their conversation; what they quote (``n_quoted`` lines, ``quote_depth``), the turn
    they reply to (``reply_to``) and the first turn of their ``thread``."""
    rows = conversations.drop(*(name for name in RESULTS if name not in (conv, turn, role, text)))
    replies = settle(reply_links(quotation_links(rows, conv, turn, text)), "replies")
    linked = replies.join(threads(replies), ["conv", "turn"])
    linked = settle(linked.toDF("_conv", "_turn", "reply_to", "_thread"), "linked")
    lines = lines_of(text)
    levels = F.transform(lines, level_of)
    shown = rows.withColumns(
        {
            "reply_text": F.trim(F.regexp_replace(F.array_join(own_lines(lines), "\n"), r"\n{3,}", "\n\n"), F.lit(" \t\n")),
            "n_quoted": F.size(F.filter(levels, lambda x: x > 0)),
            "quote_depth": F.array_max(levels),
        }
    )
    shown = shown.join(linked, (F.col(conv) == F.col("_conv")) & (F.col(turn) == F.col("_turn")), "left")
    shown = shown.withColumn("thread", F.coalesce("_thread", F.col(turn))).drop("_conv", "_turn", "_thread")
    return with_positions(shown, conv, ["thread", turn, role, "reply_text", text])


def with_positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Number the rows of each group from 0 in an order, without gathering a group."""
    number = F.monotonically_increasing_id()
    in_order = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = settle(in_order.withColumn("_number", number), "ordered")
    part = F.shiftright("_number", 33).alias("_part")
    parts = placed.groupBy(part, F.col(group).alias("_group")).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row for each part of the sort and group that has rows there.
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "starts")
    same = (F.shiftright("_number", 33) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    joined = placed.join(starts, same)
    position = F.col("_before") + F.col("_number") - F.col("_first")
    return joined.withColumn("position", position).drop("_number", "_part", "_group", "_first", "_before")
