"""Row-wise column arithmetic (not aggregates). Nulls propagate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: str, denominator: str) -> Column:
    """True (floating) division; null where the denominator is 0 or null.

    Under ANSI mode a plain ``/ 0`` raises, so the zero case is guarded.
    """
    d = F.col(denominator)
    return F.when(d != 0, F.col(numerator).cast("double") / d.cast("double"))
