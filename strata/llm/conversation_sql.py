"""DuckDB SQL of the conversation operators (12 and 13)."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text expression: every byte, then its eight bits."""
    return f"""xor(list_reduce(list_concat([4294967295::UBIGINT], flatten([
          [ascii(x)::UBIGINT, 999, 999, 999, 999, 999, 999, 999, 999] FOR x IN string_split({text}, '')])),
        lambda a, e: CASE WHEN e < 256 THEN xor(a, e)
                     ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""


# rows that share a turn: by role and text
_ORDER = """turn NULLS FIRST, left(role, 64), left(text, 64),
            sha256(octet_length(encode(role)) || ':' || role || text)"""

# sequences as lists; every node joined with all that begin with it
PREFIX_TRIE = f"""
    WITH t AS (
      SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY {_ORDER}) AS own FROM t GROUP BY c),
    h AS (SELECT *, ({crc32("c::VARCHAR")} % 9)::BIGINT AS h FROM o),
    r AS (
      SELECT h.c, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS s
      FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5),
    p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r),
    n AS (SELECT s[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs FROM p GROUP BY 1, 2),
    v AS (
      SELECT n.*, kids.n_children, (n_convs - 1) * CASE WHEN d = 0 THEN 0
             ELSE octet_length(encode(k[d].text)) END AS own_saved
      FROM n LEFT JOIN (SELECT k[1:d - 1] AS up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1) kids
        ON kids.up = n.k),
    a AS (SELECT k, unnest(range(0, d + 1)) AS e, n_children, own_saved FROM v),
    u AS (
      SELECT k[1:e] AS top, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves,
             sum(own_saved) AS saved_tokens FROM a GROUP BY 1),
    e AS (SELECT s, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM r GROUP BY s)
    SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs,
           coalesce(v.n_children, 0) AS n_children, u.n_leaves,
           u.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM v JOIN u ON u.top = v.k LEFT JOIN n up ON v.d > 0 AND up.k = v.k[1:v.d - 1]
    LEFT JOIN e ON e.s = v.k"""


def _best(*choices: str) -> str:
    return f"list_sort([{', '.join(choices)}])[1]"


def _step(state: str, kept: dict[str, str], turn: str) -> str:
    """The best edit of a message in a grammar state (0, s, u, a), before insertions."""
    keep = " ".join(f"WHEN f.ini = '{r}' THEN {{'c': b.{q}.c + cut, 'l': 'K', 'a': 'K' || b.{q}.a}}"
                    for r, q in kept.items())
    return _best(
        f"{{'c': b.{state}.c + 3, 'l': 'D', 'a': 'D' || b.{state}.a}}",
        f"CASE WHEN gone THEN far {keep} ELSE far END",
        f"CASE WHEN gone THEN far ELSE {{'c': b.{turn}.c + 2 + cut, 'l': 'R', 'a': 'R' || b.{turn}.a}} END")


def _insert(state: str, turn: str) -> str:
    return _best(state, f"{{'c': {turn}.c + 2, 'l': 'I', 'a': 'I' || {turn}.a}}")


# cost to go and audit of every rest of a conversation by grammar state, from
# the end; then the audit is walked from the first message
STRUCTURE = f"""
    WITH RECURSIVE src AS (
      SELECT coalesce(conv_id::VARCHAR, '') AS g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
      FROM conversations),
    k AS (SELECT *, {crc32("key")} % 20 AS k FROM src),
    dmg AS (
      SELECT g, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM k WHERE k <> 0),
    o AS (
      SELECT g, turn, role, text, left(role, 1) AS ini,
             right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS fin,
             row_number() OVER (PARTITION BY g ORDER BY {_ORDER}) AS i
      FROM dmg),
    w AS (
      SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth,
             lag(ini) OVER (PARTITION BY g ORDER BY i) AS before FROM o),
    f AS (
      SELECT *, CASE WHEN fin = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN fin NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS cut,
             {{'c': 1000000000::BIGINT, 'l': '~', 'a': ''}} AS far FROM w),
    b AS (
      SELECT g, max(i) AS i, {{'c': 0::BIGINT, 'l': '', 'a': ''}} AS q0, {{'c': 4::BIGINT, 'l': 'I', 'a': 'II'}} AS qs,
             {{'c': 2::BIGINT, 'l': 'I', 'a': 'I'}} AS qu, {{'c': 0::BIGINT, 'l': '', 'a': ''}} AS qa
      FROM f GROUP BY g
      UNION ALL
      SELECT g, i, {_insert("z0", "xu")}, {_insert("zs", "xu")}, xu, xa FROM (
        SELECT g, i, z0, zs, {_insert("zu", "za")} AS xu, {_insert("za", "zu")} AS xa FROM (
          SELECT b.g, b.i - 1 AS i,
                 {_step("q0", {"s": "qs", "u": "qu"}, "qu")} AS z0,
                 {_step("qs", {"u": "qu"}, "qu")} AS zs,
                 {_step("qu", {"a": "qa"}, "qa")} AS zu,
                 {_step("qa", {"u": "qu"}, "qu")} AS za
          FROM b JOIN f ON f.g = b.g AND f.i = b.i))),
    best AS (SELECT g, q0.c AS cost, q0.a AS audit FROM b WHERE i = 0),
    walk AS (
      SELECT g, audit, 1 AS p, 1::BIGINT AS i, '' AS was, []::VARCHAR[] AS lines FROM best
      UNION ALL
      SELECT x.g, audit, p + 1, x.i + (e <> 'I')::BIGINT,
             CASE WHEN e = 'D' THEN was WHEN e = 'K' THEN f.ini ELSE left(turn_role, 1) END,
             CASE WHEN e = 'D' THEN lines
                  ELSE list_append(lines, CASE e WHEN 'K' THEN f.role || ':' || f.text
                                                 WHEN 'R' THEN turn_role || ':' || f.text
                                                 ELSE turn_role || ':' END) END
      FROM (SELECT *, audit[p] AS e, CASE WHEN was = 'u' THEN 'assistant' ELSE 'user' END AS turn_role
            FROM walk WHERE p <= length(audit)) x
      LEFT JOIN f ON f.g = x.g AND f.i = x.i),
    done AS (SELECT g, sha256(array_to_string(lines, chr(10))) AS sha FROM walk WHERE p > length(audit)),
    s AS (
      SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'blank') AS blank,
             count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY g)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
           coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS g FROM conversations) c
    LEFT JOIN s USING (g) LEFT JOIN best USING (g) LEFT JOIN done USING (g)"""
