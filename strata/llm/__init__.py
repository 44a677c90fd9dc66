"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage; ``queries`` holds its
registered queries and their SQL, which ``__spark_entry__`` adds when the
subpackage is present.
"""
