"""Column names as users write them: dots, backticks and blanks are part of a name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as Spark's name parser reads it back unchanged."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The top-level column called ``name``, whatever characters it holds."""
    return F.col(quoted(name))
