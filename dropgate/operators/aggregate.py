"""Registry-driven aggregation (``group_by`` + ``{column: sum|mean|count}``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.errors import RegistryError
from dropgate.functions.names import col as named, quoted

# The aggregation names a registry may use.
AGGREGATIONS = {
    "sum": F.sum,
    "mean": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
}


def aggregate(df: DataFrame, group_by: list[str], aggregations: dict[str, str],
              round_to: int | None = None) -> DataFrame:
    """``groupBy(group_by).agg(...)``; each output keeps its input column's name.

    Partial aggregation runs map-side, so a hot group is pre-combined in
    every task before the shuffle.
    """
    missing = [c for c in list(group_by) + list(aggregations) if c not in df.columns]
    if missing:
        raise RegistryError(f"aggregate: columns not found: {missing}")
    exprs = []
    for col, how in aggregations.items():
        fn = AGGREGATIONS.get(how)
        if fn is None:
            raise RegistryError(f"aggregate: unknown aggregation '{how}' for {col}")
        e = fn(named(col))
        if round_to is not None and how in ("sum", "mean"):
            e = F.round(e, round_to)
        exprs.append(e.alias(col))
    return df.groupBy(*map(quoted, group_by)).agg(*exprs)
