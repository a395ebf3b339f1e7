"""File-name glob patterns as Spark column predicates.

A glob is turned into a Java regex once on the driver; matching is then a
codegen'd ``rlike`` over the ``_source_file`` column, so routing thousands of
files costs one projection, not a Python loop.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_regex(pattern: str, case_sensitive: bool = False) -> str:
    """fnmatch-style glob (``*``, ``?``, ``[seq]``, ``[!seq]``) → Java regex.

    ``*`` crosses folder separators, as with ``fnmatch.fnmatch`` on a relative
    path. Case-insensitive by default (the routing result intended on every OS).
    """
    body = fnmatch.translate(pattern)  # Python's '(?s:...)\\Z'
    if body.endswith(r"\Z"):
        body = body[:-2] + "$"
    flags = "" if case_sensitive else "(?i)"
    return f"{flags}^{body}"


def glob_match(col: Column | str, pattern: str, case_sensitive: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(glob_regex(pattern, case_sensitive))


def match_count(col: Column | str, patterns: list[str], case_sensitive: bool = False) -> Column:
    """Number of patterns a path matches (0 = no match, >1 = ambiguous)."""
    terms = [glob_match(col, p, case_sensitive).cast("int") for p in patterns]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def matched_value(col: Column | str, mapping: dict[str, str], case_sensitive: bool = False) -> Column:
    """The value of the single matching pattern; null when 0 or >1 match."""
    patterns = list(mapping)
    n = match_count(col, patterns, case_sensitive)
    chosen = None
    for p in patterns:
        cond = glob_match(col, p, case_sensitive)
        chosen = F.when(cond, F.lit(mapping[p])) if chosen is None else chosen.when(cond, F.lit(mapping[p]))
    if chosen is None:
        return F.lit(None).cast("string")
    return F.when(n == 1, chosen)
