"""String column expressions (JVM-side, codegen'd)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The custom null markers used by the shipped cross-validation
# registry for sales files.
DEFAULT_NULL_MARKERS = ["", " ", "NA", "N/A", "NULL"]

# `(?U)` makes `\s` Unicode-aware in Java regex, so NBSP (U+00A0), tabs,
# line separators and the like are stripped too. `F.trim` only strips U+0020.
_EDGE_WS = r"(?U)^\s+|\s+$"


def strip_whitespace(col: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, _EDGE_WS, "")


_DIGIT = re.compile(r"[0-9]")
# Non-digit string forms Spark gives to special numbers.
_SPECIAL_NUMBERS = {"NaN", "Infinity", "-Infinity"}


def possible_markers(dtype: T.DataType | None, markers: list[str] | None) -> list[str]:
    """The markers the string form of a ``dtype`` value can equal at all.

    Numbers, dates and timestamps always print with a digit (or as NaN /
    Infinity), so text markers such as "" or "NA" can never match them and
    the per-row string cast is skipped for those columns.
    """
    markers = list(markers or [])
    if dtype is None or isinstance(dtype, T.StringType):
        return markers
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return [m for m in markers if _DIGIT.search(m) or m in _SPECIAL_NUMBERS]
    if isinstance(dtype, T.BooleanType):
        return [m for m in markers if m in ("true", "false")]
    return markers


def is_null_or_marker(col: Column | str, markers: list[str] | None, dtype: T.DataType | None = None) -> Column:
    """True where the value is null or its string form is one of ``markers``.

    Pass the column's ``dtype`` to drop markers its values cannot print as.
    """
    c = F.col(col) if isinstance(col, str) else col
    cond = c.isNull()
    markers = possible_markers(dtype, markers)
    if markers:
        str_form = c if isinstance(dtype, T.StringType) else c.cast("string")
        cond = cond | str_form.isin(markers)
    # comparisons against null give null; a null result means "not a marker"
    return F.coalesce(cond, F.lit(False))
