"""Registered queries of the corpus operators and their SQL.

Each query applies its operator to its whole table with production
parameters. ``SQL`` has the DuckDB text where SQL can express the operator.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import ensure_checkpoint_dir
from strata.llm import (exact_dedup, fingerprints, jaccard_join, langid, line_dedup, mixing, packing,
                        prefix_trie, quality, quotes, structure, toxicity, warc)
from strata.llm.common import id_fold
from strata.llm.conversation_sql import PREFIX_TRIE, STRUCTURE
from strata.sources.tables import read_table

LONG_LINE = 50      # words of a line that is a passage of its own

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The public tokenizer that packing counts with."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def find_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package, whatever folder they start in.

    Operators' functions run in the workers and use the package's helpers. On
    a cluster the package is shipped (``--py-files``) or installed.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(p for p in [*known, root] if p)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return read_table(spark, sf_dir, name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(_documents(spark, sf_dir))


def op2_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir), tokenizer_path())


def op3_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(_documents(spark, sf_dir))


def op3_passage_dedup(spark, sf_dir):
    return line_dedup.dedup_passages(_documents(spark, sf_dir))


def op3_long_passages(spark, sf_dir):
    return line_dedup.dedup_passages(_documents(spark, sf_dir), long_words=LONG_LINE)


def op4_toxicity(spark, sf_dir):
    # of the rows that may be learned from, one in six fits the curve
    fits = [3, 7]
    out = toxicity.score_toxicity(
        _documents(spark, sf_dir), _table(spark, sf_dir, "labels"),
        learn=lambda i: (id_fold(i, 4) != 2) & ~id_fold(i, 16).isin(fits),
        calibrate=lambda i: id_fold(i, 16).isin(fits))
    return out.select("doc_id", (id_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      toxicity.predicted().alias("predicted"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(_documents(spark, sf_dir))


def op6_quotation_links(spark, sf_dir):
    return quotes.link_conversations(_table(spark, sf_dir, "conversations"))


def quoted_replies(conversations: DataFrame) -> DataFrame:
    """``conversations`` in which every message quotes the two before it, one level each."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))

    def quoted(back: int, marks: str) -> DataFrame:
        lines = F.concat(F.lit(marks), F.replace("text", F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))
        return rows.groupBy("conv_id", (F.col("turn") + back).alias("turn")).agg(F.max(lines).alias(f"q{back}"))

    out = rows.join(quoted(1, "> "), ["conv_id", "turn"], "left").join(quoted(2, ">> "), ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", F.concat(
        F.coalesce("q2", F.lit("")), F.coalesce("q1", F.lit("")), "text").alias("text"))


def op6_quoted_replies(spark, sf_dir):
    """The given conversations hold no quotes: the same operator where every message has some."""
    return quotes.link_conversations(quoted_replies(_table(spark, sf_dir, "conversations")))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> quality.Classifier:
    """Learned from labelled rows outside the held-out fold."""
    return quality.fit(docs, labels, learn=lambda i: id_fold(i, 5) != 0)


def op7_quality(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    out = quality.score_quality(docs, quality_classifier(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", (id_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_mixing(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir))


def op9_warc(spark, sf_dir):
    out = warc.archive(_table(spark, sf_dir, "pages"), ensure_checkpoint_dir(spark))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(_documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_language_id(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    out = langid.identify(docs, langid.fit(docs, learn=lambda i: id_fold(i, 5) != 0))
    return out.select("doc_id", F.coalesce(id_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")


def op12_structure_repair(spark, sf_dir):
    conversations = _table(spark, sf_dir, "conversations")
    return structure.repair_report(conversations, structure.damaged(conversations))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.shared_prefixes(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op3_passage_dedup": op3_passage_dedup,
    "op3_long_passages": op3_long_passages,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprints": op5_fingerprints,
    "op6_quotation_links": op6_quotation_links,
    "op6_quoted_replies": op6_quoted_replies,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_warc": op9_warc,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_language_id": op11_language_id,
    "op12_structure_repair": op12_structure_repair,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    # every pair that shares a shingle, then the smallest id over links
    "op1_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        x AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])
                 END AS x FROM w),
        n AS (SELECT doc_id, len(x) AS n FROM x),
        s AS (SELECT doc_id, unnest(x) AS h FROM x),
        p AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
          FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        e AS (
          SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
        r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.m)
        SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.m) AS component_id,
               (SELECT count(*) FROM e WHERE e.a = n.doc_id) AS n_links
        FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n""",
    # lines per document; chunk ends by the rolling hash; every place of a
    # chunk of several lines but the first goes
    "op3_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, i, line,
                 ('0x' || substr(md5(line), 1, 8))::BIGINT AS h
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
                FROM documents)),
        e AS (
          SELECT *, ((h + 31 * coalesce(lag(h) OVER d, 0)) % 3 = 0)::INT AS cut
          FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        g AS (
          SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) - cut AS chunk_no FROM e),
        c AS (
          SELECT doc_id, chunk_no, min(i) AS first, count(*) AS lines,
                 string_agg(line, chr(10) ORDER BY i) AS chunk
          FROM g GROUP BY doc_id, chunk_no),
        k AS (
          SELECT *, lines > 1 AND regexp_matches(chunk, '[^\s]')
                    AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, first) > 1 AS gone
          FROM c)
        SELECT doc_id,
               coalesce(string_agg(chunk, chr(10) ORDER BY first) FILTER (WHERE NOT gone), '') AS text,
               sum(lines)::BIGINT AS n_lines,
               coalesce(sum(lines) FILTER (WHERE gone), 0)::BIGINT AS removed_lines
        FROM k GROUP BY doc_id""",
    # pairs of neighbouring lines with a visible character; every place of a
    # pair but the first goes with the lines it spans
    "op3_passage_dedup": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
          FROM documents),
        v AS (
          SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j
          FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        p AS (
          SELECT v.doc_id, v.i, v.j, string_agg(l.line, chr(10) ORDER BY l.i) AS passage
          FROM v JOIN l ON l.doc_id = v.doc_id AND l.i BETWEEN v.i AND v.j GROUP BY ALL),
        k AS (
          SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1 AS gone FROM p),
        g AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM k WHERE gone)
        SELECT l.doc_id,
               coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text,
               count(*) AS n_lines, count(g.i) AS removed_lines
        FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id""",
    # quotes of earlier messages by paragraph or line, then threads
    "op6_quotation_links": r"""
        WITH RECURSIVE m AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
        l AS (
          SELECT conv_id, turn, i, line,
                 length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g'))
                   AS level,
                 trim(regexp_replace(lower(regexp_replace(line, '^((?:[ \t]*>)+)', '')),
                                     '\s+', ' ', 'g')) AS body
          FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m)),
        r AS (
          SELECT *, sum(br) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run
          FROM (SELECT *, (body = '' OR level <> coalesce(lag(level) OVER (
                           PARTITION BY conv_id, turn ORDER BY i), -1))::INT AS br FROM l)),
        u AS (
          SELECT conv_id, turn, level, body FROM r WHERE body <> ''
          UNION
          SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY i) FROM r
          WHERE body <> '' GROUP BY conv_id, turn, level, run),
        f AS (
          SELECT q.conv_id, q.turn, q.level, max(o.turn) AS origin
          FROM u q JOIN u o ON q.conv_id = o.conv_id AND q.body = o.body
               AND q.level > 0 AND o.level = 0 AND o.turn < q.turn
          GROUP BY q.conv_id, q.turn, q.level, q.body),
        p AS (
          SELECT conv_id, turn, max(origin) AS reply_to
          FROM (SELECT *, rank() OVER (PARTITION BY conv_id, turn ORDER BY level) AS k FROM f)
          WHERE k = 1 GROUP BY conv_id, turn),
        w AS (
          SELECT conv_id, turn, reply_to AS top FROM p
          UNION ALL
          SELECT w.conv_id, w.turn, p.reply_to FROM w
          JOIN p ON p.conv_id = w.conv_id AND p.turn = w.top),
        t AS (SELECT conv_id, turn, min(top) AS thread FROM w GROUP BY conv_id, turn),
        own AS (
          SELECT conv_id, turn, max(level) AS quote_level,
                 string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0) AS rest
          FROM l GROUP BY conv_id, turn)
        SELECT m.conv_id, m.turn, m.role,
               CASE WHEN own.quote_level = 0 THEN m.text
                    ELSE regexp_replace(coalesce(own.rest, ''), '^\n+|\n+$', '', 'g') END AS text,
               own.quote_level::INT AS quote_level, p.reply_to::BIGINT AS reply_to,
               coalesce(t.thread, m.turn)::BIGINT AS thread
        FROM m JOIN own USING (conv_id, turn) LEFT JOIN p USING (conv_id, turn)
        LEFT JOIN t USING (conv_id, turn)""",
    "op9_warc": r"""
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                 sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS html FROM pages),
        g AS (SELECT html, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY html)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < top THEN top END AS refers_to
        FROM p LEFT JOIN g ON p.payload_bytes >= 1000 AND p.html = g.html""",
    "op10_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, length(coalesce(text, '')) AS len,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
          FROM documents),
        k AS (
          SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                 first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id
          FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(norm) AS text_sha256 FROM k""",
    "op12_structure_repair": STRUCTURE,
    "op13_prefix_trie": PREFIX_TRIE,
}
# the same over messages that quote the two before them
SQL["op6_quoted_replies"] = SQL["op6_quotation_links"].replace("WITH RECURSIVE m AS (", r"""WITH RECURSIVE w0 AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
        quoted AS (
          SELECT a.conv_id, a.turn, a.role,
                 coalesce((SELECT max('>> ' || replace(b.text, chr(10), chr(10) || '>> ') || chr(10)) FROM w0 b
                           WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2), '')
                 || coalesce((SELECT max('> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10)) FROM w0 b
                              WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 1), '') || a.text AS text
          FROM w0 a),
        m AS (""").replace("AS text FROM conversations),\n        l AS", "AS text FROM quoted),\n        l AS")
# the same with long lines as units of their own
SQL["op3_long_passages"] = SQL["op3_passage_dedup"].replace(
    "k AS (\n          SELECT *,", f"""u AS (
          SELECT * FROM p UNION ALL
          SELECT doc_id, i, i, line FROM l
          WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {LONG_LINE}),
        k AS (
          SELECT *,""").replace("AS gone FROM p)", "AS gone FROM u)")
