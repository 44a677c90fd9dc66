"""Token expressions (P1, P2 building blocks).

A token is a run of characters between single blanks: newline and tab are
not separators, and matching is exact and case-sensitive, so ``Java,`` and
``JavaScript`` are not ``Java``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only token separator is one blank.
TOKEN_SEPARATOR = " "


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column) -> Column:
    """``array<string>`` of blank-separated tokens (regex ``' '`` is a literal blank)."""
    return F.split(_col(text), TOKEN_SEPARATOR, -1)


def contains_token(text: str | Column, term: str) -> Column:
    """True when ``term`` is one of the tokens of ``text``."""
    return F.array_contains(tokens(text), F.lit(term))


def term_array(terms: Sequence[str]) -> Column:
    """Literal ``array<string>`` holding the term list in its given order."""
    return F.array(*[F.lit(t) for t in terms]).cast("array<string>")


def matched_terms(text: str | Column, terms: Sequence[str]) -> Column:
    """Distinct terms of ``terms`` that occur as tokens of ``text``.

    ``array_intersect`` de-duplicates, so an article yields a term at most
    once however often it repeats it.
    """
    return F.array_intersect(tokens(text), term_array(terms))
