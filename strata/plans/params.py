"""Parameters of the registered queries (shared by the Spark plans and
the oracle SQL, so both sides always use the same values)."""

# Vocabulary for the documents table, order significant.
# Eight terms that occur (with case and punctuation neighbours that must
# not match) and one that does not.
DOC_TERMS = ("the", "The", "and", "of", "la", "de", "der", "und", "Scala")
COUNT_TERM = "the"


def two_letter_words() -> tuple[str, ...]:
    """A large vocabulary built by rule: every two-letter lowercase word
    ("aa" .. "zz", 676 terms), long enough to take the join path."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    return tuple(a + b for a in letters for b in letters)


VOCABULARY = two_letter_words()

# Categories for clustering = all order priorities, in order.
CATEGORIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# The first four alone, so that P7 drops an unknown tag.
KNOWN_CATEGORIES = CATEGORIES[:4]

# K-means parameters (spread, eta and cap as the reference;
# k is a multiple of the category count as the seeding requires).
SPREAD = 50000
KERNELS = 15
# The reference's own number of clusters.
MANY_KERNELS = 45
# Below the spread at which seeds are drawn over all categories.
NARROW_SPREAD = 400
# A run that the cap ends.
FEW_ITERATIONS = 2
ETA = 20.0
MAX_ITERATIONS = 120
SEED = 42

INDEX_BUCKETS = 64
POSTING_BLOCK = 1024
ANSWER_BLOCK = 1024
