"""Exact dedup through content-defined chunk recipes (operator 10).

A text without its white space is cut where its own characters say so, every
chunk becomes a 64-bit identifier, and a document is the ordered list of its
identifiers (its recipe). Chunk bytes move once, already merged per task, to
verify that an identifier stands for one byte string; after that only recipes
move, so long documents are never shuffled or compared whole.

Main path: DataFrame functions only.

Defined results: null text counts as empty; all texts without a visible
character are one group; null doc_id sorts after every other id; of rows that
agree in length and id one (any, they are alike in both) is kept. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, boxed, dealt_join, saved, whole

CHUNK_MIN, CHUNK_MAX = 256, 4096


def _class(modulus: int, rest: int) -> str:
    """The visible characters below U+0250 with ``code point % modulus == rest``."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x21, 0x250) if c % modulus == rest) + "]"


# A chunk ends after two characters of these classes once it has CHUNK_MIN
# characters: the end depends on nearby characters alone, so equal passages
# fall into step again wherever they stand. CHUNK_MAX bounds every chunk, also
# in scripts that the classes do not cover.
CUT = f"(?s).{{{CHUNK_MIN - 2},{CHUNK_MAX - 2}}}?{_class(8, 4)}{_class(4, 0)}|.{{1,{CHUNK_MAX}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CUT), F.lit(0))


def chunk_id(chunk: Column, bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if bits == 64 else F.pmod(h, F.lit(1 << bits)).cast("bigint")


def shared_identifiers(norms: DataFrame, bits: int = 64) -> DataFrame:
    """``(h, chunk, ordinal)`` of identifiers that stand for several byte strings.

    Chunks are merged per task on identifier and bytes before they move, so a
    passage in a third of all documents ships once per task.
    """
    distinct = norms.select(F.explode(F.array_distinct(chunks(F.col("norm")))).alias("chunk")) \
        .groupBy(chunk_id(F.col("chunk"), bits).alias("h"), "chunk").agg(F.count(F.lit(1)).alias("n"))
    clash = saved(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("texts"))
                  .where("texts > 1").select("h"))
    if clash.isEmpty():
        return clash.select("h", F.lit(0).alias("ordinal"), F.lit("").alias("chunk"))
    return distinct.join(clash, "h").groupBy("h").agg(F.collect_set("chunk").alias("all")) \
        .select("h", F.posexplode(F.array_sort("all")).alias("ordinal", "chunk"))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            bits: int = 64) -> DataFrame:
    """``(doc_id, n_chars, text_sha256, recipe, apart, row)`` per row.

    ``apart`` lists ``(position, ordinal)`` of the chunks whose identifier
    also stands for other bytes; with it a recipe names its bytes exactly.
    """
    norms = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole(text_col).alias("text")) \
        .select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                normalised(F.col("text")).alias("norm")) \
        .select("*", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    clash = saved(shared_identifiers(norms, bits))
    out = norms.select("doc_id", "n_chars", "text_sha256",
                       F.transform(chunks(F.col("norm")), lambda c: chunk_id(c, bits)).alias("recipe"))
    none = F.array().cast("array<struct<pos:int,ordinal:int>>")
    if clash.isEmpty():
        out = out.select("*", none.alias("apart"))
    else:
        found = norms.select("doc_id", "text_sha256",
                             F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk")) \
            .withColumn("h", chunk_id(F.col("chunk"), bits)).join(clash, ["h", "chunk"]) \
            .groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")) \
            .agg(F.array_sort(F.collect_set(F.struct("pos", "ordinal"))).alias("apart"))
        out = out.join(found, F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("text_sha256") == F.col("_sha")), "left") \
            .select("doc_id", "n_chars", "text_sha256", "recipe",
                    F.coalesce("apart", none).alias("apart"))
    return saved(out).withColumn("row", F.monotonically_increasing_id())


def _grouped(rows: DataFrame) -> DataFrame:
    # bitwise not turns the order of ids round without overflow
    first = F.struct("n_chars", F.col("doc_id").isNotNull().alias("has"),
                     F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    groups = rows.groupBy("recipe", "apart").agg(F.max(first).alias("top"),
                                                 F.count(F.lit(1)).alias("group_size"))
    return dealt_join(rows, groups, ["recipe", "apart"]).select(
        "doc_id", F.bitwise_not("top.id").alias("keep_id"), "group_size",
        (F.bitwise_not("top.row") == F.col("row")).alias("kept"), "text_sha256", "n_chars")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bits: int = 64) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256, n_chars``.

    Rows with equal recipes are one group; the row with the most code points
    in its original text, then the smallest id, stays. Groups form in a
    partial aggregate over recipes, and rows find their group in a join whose
    hot partitions can be split. ``bits`` shortens identifiers (for tests).
    """
    return _grouped(recipes(docs, id_col, text_col, bits))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns as they were."""
    rows = recipes(docs, id_col, text_col)
    kept = _grouped(rows).where("kept").select(F.col("doc_id").alias("k_id"),
                                               F.col("text_sha256").alias("k_sha"),
                                               F.col("n_chars").alias("k_chars"))
    # rows that repeat id, text and length are alike for the rule: one of them stays
    again = saved(rows.groupBy(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"),
                               F.col("n_chars").alias("k_chars"))
                  .agg(F.count(F.lit(1)).alias("k_n")).where("k_n > 1"))
    text = whole(text_col)
    keyed = docs.select(boxed(docs), F.col(f"`{id_col}`").alias("id"),
                        F.sha2(normalised(text).cast("binary"), 256).alias("sha"),
                        F.length(text).cast("bigint").alias("chars"))
    match = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("sha") == F.col("k_sha")) \
        & (F.col("chars") == F.col("k_chars"))
    out = keyed.join(kept, match, "left_semi")
    if not again.isEmpty():
        repeated = out.join(again, match, "left_semi").dropDuplicates(["id", "sha", "chars"])
        out = out.join(again, match, "left_anti").unionByName(repeated)
    return out.select("doc.*")
