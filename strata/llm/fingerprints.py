"""Document fingerprints by one-permutation MinHash (operator 5).

Every shingle of five words is hashed once; the top bits of the hash name a
bin and each bin keeps its smallest hash. Empty bins are filled by optimal
densification: bin i looks at bins drawn by a hash of (i, attempt), the same
for every document, and copies the first that is filled. The low-order bits
of all bins, packed, are the fingerprint; two fingerprints' share of equal
bins, corrected for bits that agree by chance, estimates the Jaccard
likeness of the shingle sets.

Main path: DataFrame functions only.

Defined results: null text is empty; a text of fewer than five words is one
shingle; a text without words has the fingerprint of no shingle (all bits
zero), like another such text by 1 and any other by 0; a null id sorts after
every other id; rows that agree in id and text are one document, rows that
share an id alone are ordered by a hash of their text; a table of one
document is its own next. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE, bind, saved, whole
from strata.sources.memory import local_relation

WORDS = 5           # in a shingle
BIN_BITS = 8        # 256 bins
BITS = 8            # kept of each bin
ATTEMPTS = 8        # drawn bins before all filled bins are compared
_BINS = 1 << BIN_BITS
_LOW = (1 << (64 - BIN_BITS)) - 1
_PER = 64 // BITS   # bins in one packed long


def shingles(text: Column, words: int = WORDS) -> Column:
    """Hashes of a text's word shingles, repeats included; words are hashed once."""
    def of(h: Column) -> Column:
        n = F.size(h)
        return F.when(n == 0, F.array().cast("array<bigint>")) \
            .when(n < words, F.array(F.xxhash64(h))) \
            .otherwise(F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(
                *[F.get(h, i + k) for k in range(words)])))
    split = F.filter(F.split(F.lower(text), SPACE, -1), lambda w: w != "")
    return bind(F.transform(split, lambda w: F.xxhash64(w)), of)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS)


def _value(h: Column) -> Column:
    return h.bitwiseAND(F.lit(_LOW))


def _minima(sorted_: Column) -> Column:
    """The smallest hash of every filled bin (hashes are sorted, so bins are runs)."""
    return F.filter(sorted_, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(sorted_, i - 1))))


def _dense(minima: Column) -> Column:
    """One long per bin in a fixed order of bins; an empty bin has value 0."""
    empty = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.lit(_BINS - 1).cast("bigint")),
                           F.transform(minima, _bin))
    return F.sort_array(F.concat(minima, F.transform(
        empty, lambda b: F.shiftleft(b, 64 - BIN_BITS))))


def _filled(dense: Column, minima: Column) -> Column:
    """Optimal densification: the value of every bin, drawn from filled bins where it is empty."""
    def fill(values: Column) -> Column:
        def one(v: Column, i: Column) -> Column:
            tries = [F.get(values, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(_BINS)).cast("int"))
                     for t in range(ATTEMPTS)]
            last = F.array_min(F.transform(minima, lambda m: F.struct(
                F.xxhash64(i, _bin(m)).alias("o"), _value(m).alias("v"))))["v"]
            return F.coalesce(v, *tries, last)
        return F.transform(values, one)

    return bind(F.transform(dense, lambda h: F.when(_value(h) != 0, _value(h))), fill)


def _packed(values: Column) -> Column:
    """Low-order bits of ``_PER`` bins in each of ``_BINS / _PER`` longs."""
    def group(g: Column) -> Column:
        out = None
        for k in range(_PER):
            bits = F.shiftleft(F.get(values, g * _PER + k).bitwiseAND(F.lit((1 << BITS) - 1)),
                               k * BITS)
            out = bits if out is None else out.bitwiseOR(bits)
        return out
    return F.transform(F.sequence(F.lit(0), F.lit(_BINS // _PER - 1)), group)


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The packed fingerprint as ``array<bigint>``; empty for a text without words."""
    return bind(F.sort_array(shingles(text, words)), lambda s: F.when(
        F.size(s) == 0, F.array().cast("array<bigint>")).otherwise(
        bind(_minima(s), lambda m: bind(_dense(m), lambda d: bind(_filled(d, m), _packed)))))


def as_text(packed: Column) -> Column:
    """Hex digits, as many for every text."""
    digits = F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")
    return F.rpad(digits, _BINS * BITS // 4, "0")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two packed fingerprints, 0 to 1."""
    def equal(x: Column, y: Column) -> Column:
        out = None
        for k in range(_PER):
            same = (F.shiftrightunsigned(x.bitwiseXOR(y), k * BITS)
                    .bitwiseAND(F.lit((1 << BITS) - 1)) == 0).cast("int")
            out = same if out is None else out + same
        return out
    matches = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    estimate = (matches / F.lit(float(_BINS)) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0) \
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0) \
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))


def next_documents(keys: DataFrame) -> DataFrame:
    """``keys(doc_id, th, ...)`` with ``next`` (a struct of its columns) in descending order of id.

    Keys are dealt by range and each range looks ahead by itself; a range's
    last key goes on with the first of the next range, of which there is one
    per partition.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("th")]
    ranged = saved(keys.repartitionByRange(*order)).withColumn("part", F.spark_partition_id())
    columns = F.struct(*keys.columns)
    ahead = Window.partitionBy("part").orderBy(*order)
    rows = ranged.withColumn("next", F.lead(columns).over(ahead)) \
        .withColumn("top", F.row_number().over(ahead) == 1)
    heads = sorted(r["part"] for r in ranged.select("part").distinct().collect())
    turn = local_relation(keys.sparkSession, list(zip(heads, heads[1:] + heads[:1])),
                          "part int, following int")
    firsts = rows.where("top").select(F.col("part").alias("following"), columns.alias("first")) \
        .join(turn, "following").select(F.col("part").alias("p"), "first")
    edges = rows.where("next is null").join(firsts, F.col("part") == F.col("p"))
    return rows.where("next is not null").select(*keys.columns, "next").unionByName(
        edges.select(*keys.columns, F.col("first").alias("next")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS) -> DataFrame:
    """Per row: ``doc_id, text hash, n_chars, packed`` (the operator without the edit)."""
    text = whole(text_col)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("th"),
                       F.length(text).cast("bigint").alias("n_chars"),
                       fingerprint(text, words).alias("packed"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        words: int = WORDS) -> DataFrame:
    """Fingerprints of every text, its edited text and their likeness (module docstring).

    Edited text: the last half of the code points gives way to the first as
    many of the next document. Numbers find the next document; only a text
    and the part it lends move, each once.
    """
    base = saved(fingerprints(docs, id_col, text_col, words))
    keys = base.groupBy("doc_id", "th").agg(F.any_value("n_chars").alias("n_chars"),
                                            F.any_value("packed").alias("packed"),
                                            F.count(F.lit(1)).alias("copies"))
    linked = saved(next_documents(keys).select(
        "doc_id", "th", "n_chars", "packed", "copies", F.col("next.doc_id").alias("next_id"),
        F.col("next.th").alias("next_th"),
        likeness(F.col("packed"), F.col("next.packed")).alias("near_next")))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole(text_col).alias("text")) \
        .withColumn("th", F.xxhash64("text"))
    need = linked.select(F.col("doc_id").alias("for_id"), F.col("th").alias("for_th"),
                         F.floor(F.col("n_chars") / 2).cast("int").alias("need"),
                         "next_id", "next_th")
    lent = texts.join(need, F.col("doc_id").eqNullSafe(F.col("next_id"))
                      & (F.col("th") == F.col("next_th"))) \
        .select("for_id", "for_th", F.expr("left(text, need)").alias("lent"))
    if not linked.where("copies > 1").isEmpty():
        lent = lent.dropDuplicates(["for_id", "for_th"])
    rows = linked.select(F.col("doc_id").alias("own_id"), F.col("th").alias("own_th"), "n_chars",
                         "packed", "near_next")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    out = texts.join(lent, F.col("doc_id").eqNullSafe(F.col("for_id"))
                     & (F.col("th") == F.col("for_th"))) \
        .join(rows, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("th") == F.col("own_th"))) \
        .select("doc_id", "n_chars", "packed", "near_next", F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), "lent").alias("edited"))
    out = out.select("*", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     fingerprint(F.col("edited"), words).alias("edited_packed"))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("packed")).alias("fingerprint"),
                      as_text(F.col("edited_packed")).alias("edited_fingerprint"),
                      likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
                      "near_next")
