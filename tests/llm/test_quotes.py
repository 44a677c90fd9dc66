import random

from llm_cases import rows_of  # noqa: F401, F811

import pytest

from strata.llm import quotes as Q

ROWS = [
    (1, 0, "a", "Shall we meet?\nOn Monday perhaps.\n\nBring the plans."),
    (1, 1, "b", "> Shall we  meet?\n> on monday perhaps.\nYes, gladly."),
    (1, 2, "c", ">> Shall we meet?\n> yes, gladly.\nFine with me."),
    (1, 3, "a", "> Nobody wrote this.\nAnd so?"),
    (1, 4, "d", "A new subject."),
    (1, 5, "b", " > > yes, gladly.\n >Fine with me.\n\n> bring the plans.\nI will."),
    (2, 0, "a", "Yes, gladly."),
    (2, 1, "b", None), (2, 2, "b", ""), (2, 3, None, ">"), (2, 3, None, ">"),
    (None, 0, "a", "> Shall we meet?"), (3, None, "a", "> x"), (3, 1, "a", "> later words"),
    (3, 2, "a", "later words"),
    (4, 0, "a", "ok"), (4, 1, "a", "ok"), (4, 2, "b", "> ok\nno"), (4, 3, "b", "> no\nwell"),
    (4, 4, "b", "> well\nend"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def linked(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return Q.link_conversations(df.select("*", *[F.lit(1).alias(c) for c in ("h", "level", "key", "c", "t")]))


def test_links_threads_and_texts(spark):
    got = {(r["conv_id"], r["turn"], r["role"]): r for r in linked(spark).collect()}
    reply = {k[:2]: r["reply_to"] for k, r in got.items()}
    assert reply[1, 1] == 0 and reply[1, 2] == 1 and reply[1, 3] is None and reply[1, 4] is None
    assert reply[1, 5] == 2                     # the outermost quotes: turns 2 and 0, the later one
    assert reply[None, 0] is None and reply[3, 1] is None      # quotes look back only
    assert (reply[4, 2], reply[4, 3], reply[4, 4]) == (1, 2, 3)
    thread = {k[:2]: r["thread"] for k, r in got.items()}
    assert [thread[1, t] for t in range(6)] == [0, 0, 0, 3, 4, 0]
    assert thread[4, 4] == 1 and thread[4, 0] == 0
    text = {k[:2]: r["text"] for k, r in got.items()}
    assert text[1, 1] == "Yes, gladly." and text[1, 5] == "I will." and text[2, 1] == ""
    assert text[1, 0] == ROWS[0][3]
    level = {k[:2]: r["quote_level"] for k, r in got.items()}
    assert level[1, 2] == 2 and level[1, 5] == 2 and level[2, 3] == 1 and level[1, 4] == 0


def test_rows_stay_and_empty_table(spark):
    out = linked(spark)
    assert out.count() == len(ROWS)
    assert Q.link_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert "Python" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_transcripts_follow_the_replies(spark):
    parts = Q.transcripts(linked(spark))
    chat = {r["conv_id"]: r["chat"] for r in parts.where("conv_id = 1 or conv_id = 4").collect()}
    assert chat[4].split("\n") == ["<|a|>", "ok", "<|a|>", "ok", "<|b|>", "no", "<|b|>", "well",
                                   "<|b|>", "end"]
    assert chat[1].index("I will.") < chat[1].index("And so?") < chat[1].index("A new subject.")
    assert rows_of(parts.groupBy().sum("messages"))[0][0] == len(ROWS)


def test_sql_agrees_on_quoted_conversations(spark):
    import duckdb
    import pandas as pd
    from strata.llm.queries import SQL
    rows = [r for r in ROWS if None not in r[:2]]
    rows = [r for k, r in enumerate(rows) if r not in rows[:k]]
    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    con.execute("CREATE VIEW conversations AS SELECT conv_id::BIGINT conv_id, turn::BIGINT turn, role, text FROM t")
    want = con.execute("SELECT conv_id, turn, text, quote_level, reply_to, thread FROM ("
                       + SQL["op6_quotation_links"] + ") ORDER BY 1, 2").fetchall()
    got = rows_of(Q.link_conversations(spark.createDataFrame(rows, SCHEMA)),
                  "conv_id", "turn", "text", "quote_level", "reply_to", "thread")
    assert got == want


@pytest.mark.parametrize("turns", [1, 7, 1024])
def test_a_passage_quoted_throughout_one_conversation(spark, monkeypatch, turns):
    # one passage of one conversation holds most rows; originals stand in some ranges of turns only
    monkeypatch.setattr(Q, "RANGE", turns)
    r = random.Random(turns)
    rows, original, want = [], None, {}
    for t in sorted(r.sample(range(-50, 400), 200)):
        kind = r.random()
        if kind < 0.1 and t > -20:
            rows.append((1, t, "a", "the passage"))
            original = t
        else:
            rows.append((1, t, "b", f"> The  passage\nanswer {t}"))
            want[t] = original
    got = {x["turn"]: x["reply_to"] for x in Q.reply_links(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == {t: o for t, o in want.items() if o is not None} and len(got) > 100
