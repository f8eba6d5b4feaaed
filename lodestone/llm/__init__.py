"""Operators that prepare text corpora for language-model training.

Nothing outside this subpackage imports it.  Each module holds one operator with a general interface plus the thin
query that applies it to a whole table; ``registry`` lists the queries and their SQL.
"""
