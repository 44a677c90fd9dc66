"""Conversation structure repair (operator 12): the cheapest edits to a legal role order.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.
Messages are kept (0), given the role user or assistant (2) or deleted (3; a
must for blank and repeated ones), and empty user or assistant messages go in
anywhere (2); a truncated message that stays adds 1. Of the cheapest edits the
ASCII-least word of their initials (D, I, K, R) is the *audit*.

In every state of that grammar each edit leads to one next state, so the best
audit of a conversation's rest depends on the state, on the signature of the
rest (role initial and fault of every message) and on nothing else:

1. Messages are numbered within their conversation (blocks of a range
   partitioning, see ``ordered``), faults found, and cut into chunks of at
   most 256 messages, each a word of signature letters.
2. Distinct words are read from their ends, in the order of their reversed
   text: a suffix-shared automaton (DAWG) whose nodes are the distinct
   suffixes. Cost-to-go and best audit are computed once per node and state
   for all conversations that share the suffix; a task keeps the nodes of one
   word.
3. A chunk that others follow enters with the cost-to-go of what follows, as
   a difference between states. For these chunks the automaton gives the cost
   from every state to every state; combined from the last chunk to the
   first (min-plus), it gives each chunk its costs to go, and the automaton
   is read again with these. Read from the first chunk on, the states at the
   borders pick each chunk's audit.

A conversation of any length thus meets in one task only as chunks, one small
row for 256 messages, streamed.

Defined results: null role or text is one space (blank; a role that is not
s, u or a); an empty role has no initial and can't be kept; a null turn comes
first and counts for no gap; rows without a conversation id are one
conversation without id; rows that share a turn are ordered by role and text
(the first 64 characters of each, then SHA-256). A conversation without rows
has zeros, an empty audit and the digest of the empty text. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import dealt_join, saved
from strata.llm.ordered import in_order, positions

CHUNK = 256
KEYS = ["none", "conv"]             # a missing id is a key of its own
_SPACES = " \t\n\x0b\f\r"
_FAR = 1 << 40                      # cost of what can't be reached

# States of the grammar: nothing read, system, user, assistant (as last role).
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
TURN = (USER, USER, ASSISTANT, USER)                    # where an inserted or renamed role leads
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER),
        "a": (None, None, ASSISTANT, None), "o": (None,) * 4}
LEGAL_END = (0, None, None, 0)

# --- the automaton --------------------------------------------------------

# cost to go, best audit, state after the audit and cost of the audit alone, per state
Node = tuple[tuple, tuple, tuple, tuple]


def _inserted(cost, audit, after, own, letter) -> Node:
    """Lets an insertion come first where it is cheaper, or as cheap and earlier in ASCII."""
    for _ in range(3):
        for q in STATES:
            t = TURN[q]
            if (cost[t] + 2, "I") < (cost[q], letter[q]):
                cost[q], letter[q] = cost[t] + 2, "I"
                audit[q], after[q], own[q] = "I" + audit[t], after[t], own[t] + 2
    return tuple(cost), tuple(audit), tuple(after), tuple(own)


def end_node(exit_: tuple | None) -> Node:
    """The end of a word: of the conversation (None), or with costs to go of what follows."""
    if exit_ is None:
        cost = [_FAR if x is None else x for x in LEGAL_END]
        return _inserted(cost, [""] * 4, list(STATES), [0] * 4, [""] * 4)
    return tuple(exit_), ("",) * 4, tuple(STATES), (0,) * 4


def grown(symbol: str, rest: Node) -> Node:
    """The node of a message and what follows it."""
    cost, audit, after, own = [_FAR] * 4, [""] * 4, list(STATES), [0] * 4
    letter = ["~"] * 4

    def offer(q: int, name: str, price: int, to: int) -> None:
        if (rest[0][to] + price, name) < (cost[q], letter[q]):
            cost[q], letter[q] = rest[0][to] + price, name
            audit[q], after[q], own[q] = name + rest[1][to], rest[2][to], rest[3][to] + price

    kind, cut = symbol.lower(), int(symbol.isupper())
    for q in STATES:
        offer(q, "D", 3, q)
        if kind != "x":
            if KEPT[kind][q] is not None:
                offer(q, "K", cut, KEPT[kind][q])
            offer(q, "R", 2 + cut, TURN[q])
    return _inserted(cost, audit, after, own, letter)


def read_back(words: Iterable[tuple[tuple | None, str]]) -> Iterator[Node]:
    """The first node of each ``(exit, reversed word)``; neighbours share their suffixes' nodes."""
    exit_, before, path = (), "", []
    for e, word in words:
        if not path or e != exit_:
            exit_, before, path = e, "", [end_node(e)]
        k = 0
        while k < min(len(word), len(before)) and word[k] == before[k]:
            k += 1
        del path[k + 1:]
        for symbol in word[k:]:
            path.append(grown(symbol, path[-1]))
        before = word
        yield path[-1]


_EXIT = [f"e{q}" for q in STATES]
_READ = ", ".join(f"cost{q} bigint, own{q} bigint, audit{q} string, after{q} bigint" for q in STATES)


def automaton(words: DataFrame) -> DataFrame:
    """``(last, e0..e3, word)`` -> these and cost to go, own cost, audit and next state per state."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, *exits, reverse = (c.to_pylist() for c in batch.columns)
            keys = [None if a else e for a, e in zip(last, zip(*exits))]
            cols: list[list] = [[] for _ in range(16)]
            for cost, audit, after, own in read_back(zip(keys, reverse)):
                for q in STATES:
                    for k, x in enumerate((cost, own, audit, after)):
                        cols[4 * q + k].append(x[q])
            names = [f"{n}{q}" for q in STATES for n in ("cost", "own", "audit", "after")]
            arrays = [pa.array(x, pa.string() if n.startswith("audit") else pa.int64())
                      for n, x in zip(names, cols)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])

    order = ["last", *_EXIT, "reverse"]
    ranged = words.withColumn("reverse", F.reverse("word")).select(*order).distinct() \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "last boolean, " + ", ".join(f"{e} bigint" for e in _EXIT)
                             + ", reverse string, " + _READ) \
        .withColumn("word", F.reverse("reverse")).drop("reverse")


# --- messages and chunks ------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a damaged copy of ``conversations`` holds them, by a hash of id and turn.

    Of 20 parts one is dropped, one loses its text, one its full stops, one
    stands twice, one gets the role user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    k = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return conversations.where(k != 0).select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(role).alias("role"),
        F.when(k == 1, "").when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")) \
        .drop("copy")


def _keys(conv_col: str) -> list[Column]:
    conv = F.col(f"`{conv_col}`").cast("bigint")
    return [conv.isNull().alias("none"), F.coalesce(conv, F.lit(0)).alias("conv")]


def messages(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(texts, marks)``: the messages in order, and a narrow row of each with its signature.

    marks: keys, ``row``, ``pos``, ``turn``, ``chunk``, ``initial`` (s, u, a
    or o), ``fault`` (blank, duplicate, truncated or null), ``symbol``.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" "))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" "))
    texts = in_order(
        rows.select(*_keys(conv_col), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
                    role.alias("role"), text.alias("text"),
                    F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
                    .alias("th")),
        KEYS, [F.col("turn").asc_nulls_first(), F.left("role", F.lit(64)).asc(),
               F.left("text", F.lit(64)).asc(), F.col("th").asc()])
    end = F.right(F.rtrim(F.col("text"), F.lit(_SPACES)), F.lit(1))
    first = F.left("role", F.lit(1))
    narrow = positions(texts.select(
        *KEYS, "row", "block", "turn", "th", F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("initial"),
        (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("open")), KEYS)
    seen = narrow.groupBy(*KEYS, "th").agg(F.min("row").alias("seen"))
    fault = F.when(F.col("blank"), "blank").when(F.col("row") > F.col("seen"), "duplicate") \
        .when(F.col("open"), "truncated")
    gone = F.col("fault").isin("blank", "duplicate")
    marks = dealt_join(narrow, seen, [*KEYS, "th"]).withColumn("fault", fault).select(
        *KEYS, "row", "pos", "turn", F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"), "initial", "fault",
        F.when(F.coalesce(gone, F.lit(False)), "x").when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial")).alias("symbol"))
    return texts, saved(marks)


def chunks(marks: DataFrame) -> DataFrame:
    """``(keys, chunk, word, illegal, last)``: the signature of each chunk."""
    # the last message of a full chunk also goes before the next one
    ahead = F.explode(F.when(F.col("pos") % CHUNK == 0, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0)))).alias("ahead")
    rows = marks.select(*KEYS, "chunk", "pos", "symbol", "initial", ahead)
    at = F.struct("pos", "symbol", "initial")
    put = rows.groupBy(*KEYS, (F.col("chunk") + F.col("ahead")).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.when(F.col("ahead") == 0, at))).alias("m"),
        F.max(F.when(F.col("ahead") == 1, F.col("initial"))).alias("before")).where(F.size("m") > 0)
    line = F.concat(F.coalesce("before", F.lit("")), F.array_join(F.transform("m", lambda x: x["initial"]), ""))
    pairs = F.when(F.length(line) > 1, F.sequence(F.lit(1), F.length(line) - 1)) \
        .otherwise(F.array().cast("array<int>"))
    lasts = marks.groupBy(*KEYS).agg(F.max("chunk").alias("end"))
    return saved(dealt_join(put.select(
        *KEYS, "chunk", F.array_join(F.transform("m", lambda x: x["symbol"]), "").alias("word"),
        F.size(F.filter(pairs, lambda i: ~F.substring(line, i, F.lit(2)).isin("su", "ua", "au")))
        .cast("bigint").alias("illegal")), lasts, KEYS)
        .select(*KEYS, "chunk", "word", "illegal", "end", (F.col("chunk") == F.col("end")).alias("last")))


def _streamed(rows: DataFrame, order: list, step, schema: str) -> DataFrame:
    """``step(state, values) -> (state, out)`` over the rows of each key in order, ``state`` None first.

    The columns after the keys are the values; rows of a key stream through one task.
    """
    names = rows.columns
    width = len(schema.split(", "))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for none, conv, *values in zip(*[c.to_pylist() for c in batch.columns]):
                if (none, conv) != key:
                    key, state = (none, conv), None
                state, row = step(state, values)
                out.append((none, conv, *row))
            if out:
                kinds = [pa.bool_(), pa.int64(), *[pa.string() if s.split()[1] == "string" else pa.int64()
                                                   for s in schema.split(", ")]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                    ["none", "conv", *[s.split()[0] for s in schema.split(", ")]])

    assert names[:2] == KEYS and width
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, *order) \
        .mapInArrow(run, "none boolean, conv bigint, " + schema)


def _combined(state, values):
    """One chunk back: its costs to go at the end, from those of the chunk after it."""
    chunk, last, *matrix = values
    exit_ = end_node(None)[0] if last else state
    cost = [min(matrix[4 * q + j] + exit_[j] for j in STATES) for q in STATES]
    low = min(cost)
    return [c - low for c in cost], (chunk, *exit_)


def _walked(state, values):
    """One chunk on: its audit from the state that the chunk before it left."""
    chunk, *per = values
    own, audit, after = per[3 * (state or START):3 * (state or START) + 3]
    return after, (chunk, state or START, audit, own)


def audits(parts: DataFrame) -> DataFrame:
    """``(keys, chunk, entry, audit, own)``: every chunk's share of its conversation's edits."""
    none = [F.lit(0).cast("bigint").alias(e) for e in _EXIT]
    single = parts.where("last AND chunk = 0")
    long = parts.where("end > 0").select(*KEYS, "chunk", "word", "last")
    # costs from every state to every state, one reading per exit
    unit = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), *[
        F.lit(0 if q == j else _FAR).cast("bigint").alias(_EXIT[q]) for q in STATES]) for j in STATES])).alias("u")
    words = long.select("word").distinct()
    read = automaton(words.select(F.lit(False).alias("last"), unit, "word").select("last", "u.*", "word").drop("j"))
    j = F.array_position(F.array(*_EXIT), F.lit(0).cast("bigint")) - 1
    matrix = read.groupBy("word").agg(*[F.min(F.when(j == k, F.col(f"cost{q}"))).alias(f"m{q}{k}")
                                        for q in STATES for k in STATES])
    cells = [f"m{q}{k}" for q in STATES for k in STATES]
    exits = _streamed(dealt_join(long, matrix, ["word"]).select(*KEYS, "chunk", "last", *cells),
                      [F.col("chunk").desc()], _combined,
                      "chunk bigint, " + ", ".join(f"{e} bigint" for e in _EXIT))
    entered = saved(long.join(exits, [*KEYS, "chunk"]))
    read = saved(automaton(single.select("last", *none, "word").unionByName(
        entered.select("last", *[F.when(F.col("last"), 0).otherwise(F.col(e)).alias(e) for e in _EXIT], "word"))))
    short = dealt_join(single.select(*KEYS, "chunk", "word"),
                       read.where("last").select("word", "audit0", "own0"), ["word"]) \
        .select(*KEYS, "chunk", F.lit(START).cast("bigint").alias("entry"), F.col("audit0").alias("audit"),
                F.col("own0").alias("own"))
    per = [f"{n}{q}" for q in STATES for n in ("own", "audit", "after")]
    on = ["last", *_EXIT, "word"]
    found = dealt_join(entered.withColumns({e: F.when(F.col("last"), 0).otherwise(F.col(e)) for e in _EXIT}),
                       read.select(*on, *per), on)
    walked = _streamed(found.select(*KEYS, "chunk", *per), [F.col("chunk")], _walked,
                       "chunk bigint, entry bigint, audit string, own bigint")
    return saved(short.unionByName(walked))


# --- what the edits give --------------------------------------------------------

_REPAIRED = "none boolean, conv bigint, chunk bigint, place bigint, edit string, role string, text string"


def repaired_messages(texts: DataFrame, marks: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``(keys, chunk, place, edit, role, text)`` of every message that the edits leave.

    Ordered by chunk and place (from 0 in each chunk); rows are dealt by
    ``by``, keys and chunk or the keys alone, and sorted within a partition.
    """
    body = texts.select("row", "role", "text").join(marks.select(*KEYS, "row", "chunk", "pos"), "row")
    rows = body.select(*KEYS, "chunk", "pos", "role", "text", F.lit(0).cast("bigint").alias("entry")).unionByName(
        found.select(*KEYS, "chunk", F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("role"),
                     F.col("audit").alias("text"), "entry"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a chunk's audit (pos 0) comes before its messages
        word, at, state, place, here = "", 0, START, 0, None
        for batch in batches:
            out = []

            def inserts():
                nonlocal at, state, place
                while at < len(word) and word[at] == "I":
                    state = TURN[state]
                    out.append((*here, place, "I", "user" if state == USER else "assistant", ""))
                    at, place = at + 1, place + 1

            for none, conv, chunk, pos, role, text, entry in zip(*[c.to_pylist() for c in batch.columns]):
                if not pos:
                    word, at, state, place, here = text, 0, entry, 0, (none, conv, chunk)
                    inserts()
                    continue
                edit = word[at]
                at += 1
                if edit != "D":
                    if edit == "R":
                        state = TURN[state]
                        role = "user" if state == USER else "assistant"
                    else:
                        state = KEPT[role[0]][state]
                    out.append((none, conv, chunk, place, edit, role, text))
                    place += 1
                inserts()
            if out:
                kinds = [pa.bool_(), *[pa.int64()] * 3, *[pa.string()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                                                 ["none", "conv", "chunk", "place", "edit", "role", "text"])

    return rows.select(*KEYS, "chunk", "pos", "role", "text", "entry").repartition(*by) \
        .sortWithinPartitions(*KEYS, "chunk", "pos").mapInArrow(run, _REPAIRED)


def line_digests(repaired: DataFrame) -> DataFrame:
    """``(keys, sha)``: SHA-256 of each conversation's ``role:text`` lines.

    ``repaired`` is dealt by the keys and sorted. A digest reads its input in
    order, so a conversation streams through one task, never held whole.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for none, conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                line = f"{role}:{text}".encode()
                if (none, conv) != key:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (none, conv), hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*done), (pa.bool_(), pa.int64(), pa.string()))],
                    ["none", "conv", "sha"])
        if key:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([digest.hexdigest()])],
                ["none", "conv", "sha"])

    return repaired.select(*KEYS, "role", "text").mapInArrow(run, "none boolean, conv bigint, sha string")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(messages, audits)``: the repaired conversations, and each chunk's edits and their cost."""
    texts, marks = messages(rows, conv_col, turn_col, role_col, text_col)
    found = audits(chunks(marks))
    return repaired_messages(texts, marks, found, [*KEYS, "chunk"]), found


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation of ``conversations``: faults, edits and digest of its ``rows``."""
    texts, marks = messages(rows)
    parts = chunks(marks)
    found = audits(parts)
    sha = line_digests(repaired_messages(texts, marks, found, KEYS))
    wide = F.col("turn").cast("decimal(38,0)")
    faults = marks.groupBy(*KEYS).agg(
        (F.max(wide) - F.min(wide) + 1).alias("span"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    turns = marks.where("turn IS NOT NULL").select(*KEYS, "turn").distinct() \
        .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("turns"))
    illegal = parts.groupBy(*KEYS).agg(F.sum("illegal").alias("illegal"))
    edits = found.groupBy(*KEYS).agg(F.sum("own").alias("cost"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = conversations.select(*_keys("conv_id")).distinct()
    for more in (faults, turns, illegal, edits, sha):
        out = out.join(more, KEYS, "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        F.coalesce((F.col("span") - F.col("turns")).cast("bigint"), zero).alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
