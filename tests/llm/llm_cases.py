"""Cases and helpers of the corpus operators' tests."""

import random
import re

import pytest

# Names that the operators use inside; as columns of the input they must not matter.
CLASHES = ["h", "n", "s", "key", "row", "word", "chunk", "first", "size", "p", "component", "kept",
           "target", "norm", "th", "weight", "score", "_xd_id", "_mx_id", "_jj_id"]
WORDS = [a + b for a in ("ba", "ke", "mi", "lo", "tu", "ra") for b in ("n", "sto", "lim", "é", "dor")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def colliding_words(n):
    """Two words of two letters whose polynomial hashes modulo 2**64 are equal from 1024 letters on."""
    order = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[k] for k in order), "".join("ba"[k] for k in order)


def edge_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty, long, repeated and tied rows."""
    a, b, long = prose(1, 60), prose(2, 80), prose(3, 30_000)
    rows = [
        (1, a), (2, a), (2, a), (3, a.replace(" ", "\n\t")), (4, a + " end"), (5, None), (6, ""),
        (7, " \t\n\x0b\f\r "), (8, "one"), (9, "one two"), (10, long), (11, long + " tail"),
        (12, b), (13, b.upper()), (None, b), (None, None), (14, "É Ω ß 漢字 漢字 " + b),
        (15, "x\n" * 50), (16, "\n".join([a, b, a, b])), (17, "one"), (2 ** 62, prose(4, 40)),
        (-5, prose(4, 40) + " more"), (18, "<|endoftext|> a's İ"),
    ]
    return [(i, t, "en" if k % 3 else None, [None, "s1", "s2"][k % 3], len(t or ""))
            for k, (i, t) in enumerate(rows)]


SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing_docs(spark, edge_docs):
    """The edge rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return edge_docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls first."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def shingle_set(text, k):
    """Brute-force shingles: A-Z lowered, k words each, a shorter text whole."""
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
