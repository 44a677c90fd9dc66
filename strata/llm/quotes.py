"""Quotation linking and reply-ordered conversations (operator 6).

A message's lines carry quote levels (leading ``>`` marks, nested). Runs of
quoted lines are passages; their normalised text is hashed and joined to the
own passages of earlier messages of the same conversation. A message replies
to the latest original of its outermost matched quote; threads follow the
replies to their first message, and ``(thread, turn)`` is the reply order.

Main path: DataFrame functions only.

Defined results: null text counts as empty; messages without a resolved quote
start a thread of their own; a null conversation or turn never links; rows
that share conversation and turn are one position and get the same link;
unresolved quotes are taken out like the others. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bind, saved, whole

MARKS = r"^((?:[ \t]*>)+)"          # of a quoted line
QUOTED = r"(?m)^[ \t]*>"
ROOTS, TURNS = 64, 4096             # a transcript part: first turns, turns
RANGE = 1024            # turns whose passages meet in one window


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _body(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"[\s]+", " "))


def own_text(text: Column) -> Column:
    """The text without its quoted lines; blank lines at both ends go with them."""
    own = F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(MARKS)), "\n")
    return F.when(text.rlike(QUOTED), F.regexp_replace(own, r"^\n+|\n+$", "")).otherwise(text)


def _units(text: Column) -> Column:
    """``array<struct<level, h>>``: hashed paragraphs of a message, and their single lines.

    A paragraph is a run of lines of one level without a blank line. Runs are
    cut where the message is, so that only hashes move.
    """
    def name(level: Column, body: Column) -> Column:
        return F.struct(level.alias("level"), F.sha2(body.cast("binary"), 256).alias("h"))

    def starts(x: Column) -> Column:
        """Places at which a run begins: blank lines and lines of another level."""
        mark = F.transform(x, lambda line, i: F.when(
            (i == 0) | (line["body"] == "") | (line["level"] != F.get(x, i - 1)["level"]), i))
        return F.filter(mark, lambda i: i.isNotNull())

    def runs(x: Column, at: Column) -> Column:
        def one(first: Column, k: Column) -> Column:
            size = F.coalesce(F.get(at, k + 1), F.size(x)) - first
            bodies = F.filter(F.transform(F.slice(x, first + 1, size), lambda line: line["body"]),
                              lambda body: body != "")
            return F.when(F.size(bodies) > 0, name(F.get(x, first)["level"], F.array_join(bodies, " ")))
        return F.filter(F.transform(at, one), lambda u: u.isNotNull())

    lines = F.transform(F.split(text, "\n", -1), lambda line: F.struct(
        _level(line).alias("level"), _body(line).alias("body")))
    return bind(lines, lambda x: F.concat(
        bind(starts(x), lambda at: runs(x, at)),
        F.transform(F.filter(x, lambda line: line["body"] != ""), lambda line: name(line["level"], line["body"]))))


def passages(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, h)``: hashed paragraphs of every level, and their single lines."""
    return messages.select("conv_id", "turn", F.explode(F.array_distinct(_units(F.col("text")))).alias("u")) \
        .select("conv_id", "turn", "u.level", "u.h").distinct()


def reply_links(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to)`` of the messages whose quotes are resolved.

    An as-of window over (conversation, passage, range of turns) finds the
    latest earlier original, or the last one of the ranges before: rows grow
    with the passages, never with pairs of messages, and a passage that a huge
    conversation quotes throughout spreads over its ranges.
    """
    known = messages.where("conv_id is not null and turn is not null")
    quoting = known.where(F.col("text").rlike(QUOTED))
    quotes = saved(passages(quoting).where("level > 0"))
    if quotes.isEmpty():
        return quotes.select("conv_id", "turn", F.col("turn").alias("reply_to"))
    there = known.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi")
    own = passages(there).where("level = 0") \
        .join(quotes.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi")
    seen = quotes.unionByName(own).withColumn("own", (F.col("level") == 0).cast("int"))
    seen = seen.withColumn("part", F.floor(F.col("turn") / RANGE)) \
        .withColumn("original", F.when(F.col("own") == 1, F.col("turn")))
    before = Window.partitionBy("conv_id", "h", "part").orderBy("turn", "own") \
        .rowsBetween(Window.unboundedPreceding, 0)
    # one row per range: the last original of the ranges before
    earlier = Window.partitionBy("conv_id", "h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.groupBy("conv_id", "h", "part").agg(F.max("original").alias("top")) \
        .select("conv_id", "h", "part", F.max("top").over(earlier).alias("carried"))
    found = seen.withColumn("near", F.last("original", True).over(before)) \
        .join(carried, ["conv_id", "h", "part"]) \
        .withColumn("origin", F.coalesce("near", "carried")) \
        .where("own = 0 and origin < turn")
    return found.groupBy("conv_id", "turn").agg(
        F.min(F.struct(F.col("level"), F.bitwise_not(F.col("origin").cast("bigint")).alias("o"))).alias("top")) \
        .select("conv_id", "turn", F.bitwise_not("top.o").alias("reply_to"))


def thread_roots(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to, thread)``: pointers are doubled until all name a first message."""
    now = saved(links.withColumn("thread", F.col("reply_to")))
    while not now.isEmpty():
        up = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"),
                        F.col("thread").alias("above"))
        step = now.join(up, (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t")), "left")
        moved = saved(step.select("conv_id", "turn", "reply_to",
                                  F.coalesce("above", "thread").alias("thread"),
                                  F.col("above").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return now


def link_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per row: ``conv_id, turn, role, text`` (without quotes)``, quote_level, reply_to, thread``."""
    rows = conversations.select(F.col(f"`{conv_col}`").alias("conv_id"),
                                F.col(f"`{turn_col}`").alias("turn"),
                                F.col(f"`{role_col}`").alias("role"), whole(text_col).alias("text"))
    links = thread_roots(reply_links(rows)).select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "reply_to", "thread")
    level = F.when(F.col("text").rlike(QUOTED), F.array_max(F.transform(
        F.split("text", "\n", -1), _level))).otherwise(0)
    return rows.join(links, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left") \
        .select("conv_id", "turn", "role", own_text(F.col("text")).alias("text"),
                level.cast("int").alias("quote_level"),
                F.col("reply_to").cast("bigint").alias("reply_to"),
                F.coalesce("thread", "turn").cast("bigint").alias("thread"))


def transcripts(linked: DataFrame) -> DataFrame:
    """``(conv_id, roots, turns, messages, chat)``: linked messages in reply order as chat text.

    A conversation is cut into parts by first turn and turn, in this order,
    so that no list grows with the conversation.
    """
    line = F.struct("thread", "turn", "role", "text")
    parts = linked.groupBy("conv_id", F.floor(F.col("thread") / ROOTS).alias("roots"),
                           F.floor(F.col("turn") / TURNS).alias("turns")) \
        .agg(F.array_sort(F.collect_list(line)).alias("m"))
    return parts.select("conv_id", "roots", "turns", F.size("m").alias("messages"), F.array_join(
        F.transform("m", lambda x: F.concat(F.lit("<|"), F.coalesce(x["role"], F.lit("")),
                                            F.lit("|>\n"), x["text"])), "\n").alias("chat"))
