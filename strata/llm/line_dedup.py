"""Line dedup with content-defined line chunks (operator 3).

Every line is hashed; a rolling hash over the hashes of a line and the one
before it chooses where a chunk ends, so equal passages fall into the same
chunks whatever stands around them. A chunk of several lines that occurs more
than once in all documents stays at its first place (smallest id, then
position) and is removed everywhere else, after its bytes were compared.

``dedup_lines`` finds a passage only where chunk ends fall alike in all its
places; ``dedup_passages`` takes every repeated run of two or more lines.

Main path: DataFrame functions only.

Defined results: null text counts as empty and comes back empty; a null id
sorts after every other id; rows that agree in id and text are one document
and come back alike; chunks of one line, or without a visible character, are
never removed; the lines that stay keep their order and bytes. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, bind, bitmap_bits, dealt_join, native_marks, passes, saved, whole

CUT_MODULUS = 3     # one line in three ends a chunk
MULTIPLIER = 31     # of the rolling hash


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def line_chunks(text: Column) -> Column:
    """``array<struct<first, lines, chunk>>``: consecutive chunks of a text's lines."""
    def ends(h: Column) -> Column:
        """Numbers of the lines that end a chunk, in order; the last line always does."""
        mark = F.transform(h, lambda x, i: F.when(
            (i == F.size(h) - 1) | ((x + MULTIPLIER * F.coalesce(F.get(h, i - 1), F.lit(0)))
                                    % CUT_MODULUS == 0), i))
        return F.filter(mark, lambda i: i.isNotNull())

    def cut(lines: Column, e: Column) -> Column:
        def one(last: Column, k: Column) -> Column:
            first = F.coalesce(F.get(e, k - 1) + 1, F.lit(0))
            return F.struct(first.alias("first"), (last - first + 1).alias("lines"),
                            F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")
                            .alias("chunk"))
        return F.transform(e, one)

    return bind(F.split(text, "\n", -1), lambda lines: bind(
        F.transform(lines, line_hash), lambda h: bind(ends(h), lambda e: cut(lines, e))))


def repeated(units: DataFrame, counts: DataFrame) -> DataFrame:
    """``units`` whose hash is among the counted ones, and a few more."""
    bits = bitmap_bits(counts.count())
    return passes(units, native_marks(counts, "h", bits), "h", bits)


def with_removals(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` left-joined with the removals ``gone(gid, gkey, ...)`` of their id and text.

    Only rows that may have one move; the others get nulls where they are.
    """
    own = F.xxhash64("doc_id", "key")
    gone = saved(gone.withColumn("at", F.xxhash64("gid", "gkey")))
    bits = bitmap_bits(gone.count())
    marks, keyed = native_marks(gone, "at", bits), rows.withColumn("own", own)
    match = F.col("doc_id").eqNullSafe(F.col("gid")) & (F.col("key") == F.col("gkey"))
    near = passes(keyed, marks, "own", bits).join(gone.drop("at"), match, "left")
    rest = passes(keyed, marks, "own", bits, others=True).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in gone.drop("at").schema])
    return near.unionByName(rest).drop("own")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, text, n_lines, removed_lines``.

    Hashes of chunks are counted first; a bitmap of those that repeat goes to
    every task, so that only repeating chunks send their bytes. Documents
    without a removal do not move either.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole(text_col).alias("text")) \
        .withColumn("key", F.xxhash64("text"))
    several = rows.select("doc_id", "key", F.explode(line_chunks(F.col("text"))).alias("c")) \
        .where("c.lines > 1").select("doc_id", "key", "c.first", "c.chunk") \
        .where(F.col("chunk").rlike("[^\\s]")) \
        .withColumn("h", F.xxhash64("chunk"))
    # places of a chunk: rows that agree in id and text count once
    counts = several.groupBy("h").agg(
        F.min(F.struct("doc_id", "key", "first")).alias("a"),
        F.max(F.struct("doc_id", "key", "first")).alias("b")).where("a <> b").select("h")
    counts = saved(counts)
    again = saved(dealt_join(repeated(several, counts), counts, ["h"], "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "first", "key")
    keep = again.groupBy("h", "chunk").agg(F.min(place).alias("top"), F.max(place).alias("last")) \
        .where("top <> last").select("h", "chunk", "top")
    gone = dealt_join(again, keep, ["h", "chunk"]) \
        .where(place != F.col("top")) \
        .groupBy(F.col("doc_id").alias("gid"), F.col("key").alias("gkey")) \
        .agg(F.collect_set("first").alias("firsts"))
    joined = with_removals(rows, gone)
    stay = F.filter(line_chunks(F.col("text")),
                    lambda c: ~F.array_contains(F.col("firsts"), c["first"]))
    n = F.size(F.split("text", "\n", -1))
    out = joined.withColumn("stay", F.when(F.col("firsts").isNotNull(), stay))
    return out.select(
        "doc_id",
        F.when(F.col("firsts").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform("stay", lambda c: c["chunk"]), "\n")).alias("text"),
        n.cast("bigint").alias("n_lines"),
        F.when(F.col("firsts").isNull(), F.lit(0)).otherwise(
            n - F.aggregate("stay", F.lit(0), lambda s, c: s + c["lines"])).cast("bigint")
        .alias("removed_lines"))


def line_pairs(text: Column, long_words: int | None = None) -> Column:
    """``array<struct<first, last, name>>``: each line with a visible character and the next such one.

    ``name`` is the SHA-256 of the bytes from the one to the other, blank lines between included.
    Lines of ``long_words`` or more follow as units of their own.
    """
    def long(lines: Column) -> Column:
        alone = F.transform(lines, lambda x, i: F.when(F.regexp_count(x, F.lit(WORD)) >= long_words, F.struct(
            i.alias("first"), i.alias("last"), F.unhex(F.sha2(x.cast("binary"), 256)).alias("name"))))
        return F.filter(alone, lambda u: u.isNotNull())

    def pairs(lines: Column, seen: Column) -> Column:
        def one(first: Column, k: Column) -> Column:
            last = F.get(seen, k + 1)
            return F.struct(first.alias("first"), last.alias("last"), F.unhex(F.sha2(F.array_join(
                F.slice(lines, first + 1, last - first + 1), "\n").cast("binary"), 256)).alias("name"))
        return F.transform(F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0))), one)

    def visible(lines: Column) -> Column:
        return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(WORD), i)),
                        lambda i: i.isNotNull())

    return bind(F.split(text, "\n", -1), lambda lines: bind(
        visible(lines), lambda seen: pairs(lines, seen) if long_words is None
        else F.concat(pairs(lines, seen), long(lines))))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   long_words: int | None = None) -> DataFrame:
    """Per row: ``doc_id, text, n_lines, removed_lines``, without later places of repeated passages.

    A passage is two or more lines with a visible character and the blank
    lines between them, wherever it starts or ends in a document. Its pairs
    of neighbouring lines all repeat when it does, so every pair with an
    earlier place (smaller id, then position) goes with the lines it spans:
    what is left holds no later place of a repeated pair, and a line that
    goes has an equal line that stays. A repeated line whose neighbours
    differ stays, unless it has ``long_words`` or more: such a line goes
    wherever it has an earlier place. Other defined results are those of
    ``dedup_lines``.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole(text_col).alias("text")) \
        .withColumn("key", F.xxhash64("text"))
    pairs = rows.select("doc_id", "key", F.explode(line_pairs(F.col("text"), long_words)).alias("p")) \
        .select("doc_id", "key", "p.first", "p.last", "p.name").withColumn("h", F.xxhash64("name"))
    counts = saved(pairs.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h"))
    again = saved(dealt_join(repeated(pairs, counts), counts, ["h"], "left_semi"))
    # rows that agree in id and text are one document
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "first", "key")
    keep = again.groupBy("name").agg(F.min(place).alias("top"), F.max(place).alias("end")) \
        .where("top <> end").select("name", "top")
    gone = dealt_join(again, keep, ["name"]).where(place != F.col("top")) \
        .groupBy(F.col("doc_id").alias("gid"), F.col("key").alias("gkey")) \
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = with_removals(rows, gone)
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["first"], s["last"]))))
    out = joined.withColumn("stay", F.when(F.col("spans").isNotNull(), stay))
    return out.select(
        "doc_id",
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(bind(lines, lambda x: F.array_join(
            F.transform("stay", lambda i: F.get(x, i)), "\n"))).alias("text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.when(F.col("spans").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("stay"))
        .cast("bigint").alias("removed_lines"))
