"""Join building blocks with explicit size and skew handling.

* ``bounded_size`` proves a row and byte bound with one aggregation that is
  combined in every task (counts and measured string lengths), so a broadcast
  hint is only ever put on a side whose size is checked and no task sees more
  than its own partition.
* ``hot_keys`` finds keys that hold more than a fraction of a side's rows
  with one pass of a frequent-items sketch (``approx_top_k``, combined
  map-side); the result is bounded by ``1 / fraction`` values.
* ``left_join`` first brings both sides of a key to one type, so that every
  physical choice compares the same values. It picks a broadcast hash join for
  a proven-small right side, else a sort-merge join where hot left keys are
  salted over several tasks (the right rows of those keys are replicated per
  salt). AQE's skew-join split stays on as a second line of defence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.functions.names import col as named, quoted
from dropgate.operators import membership

# Prefix of the library's own columns in frames that hold user data; user
# columns with it are refused when a file is read.
HIDDEN = "__dg__"

# Right sides with at most this many rows are broadcast. At ~100 bytes per
# mapping row this is a few hundred MB on the executors at worst.
BROADCAST_MAX_ROWS = 2_000_000
# ... and whose measured payload is at most this many bytes.
BROADCAST_MAX_BYTES = 256 << 20
# A key is "hot" when it holds more than this share of the left side's rows.
HOT_KEY_FRACTION = 0.001
# Number of tasks a hot key's rows are spread over.
SALT_BUCKETS = 64


def all_not_null(cols: list[str]) -> Column:
    out = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        out = out & F.col(c).isNotNull()
    return out


# Bytes per value of fixed-width types.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
          T.DecimalType: 16}


def _value_bytes(field: T.StructField) -> Column:
    c = named(field.name)
    t = field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    for kind, width in _WIDTH.items():
        if isinstance(t, kind):
            return F.lit(width)
    return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))  # nested values: their JSON size


def bounded_size(df: DataFrame, max_rows: int) -> tuple[int, int] | None:
    """(rows, payload bytes) if there are at most ``max_rows`` rows, else None.

    One map-side combined aggregation: the string lengths are measured, not
    estimated, so the byte figure is a real bound of what a broadcast would
    ship (before hash-table overhead).
    """
    width = sum((_value_bytes(f) for f in df.schema.fields), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()
    return (row["n"], row["b"]) if row["n"] <= max_rows else None


def provably_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    if max_rows <= 0:
        return False
    size = bounded_size(df, max_rows)
    return size is not None and size[1] <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """(broadcast(df), True) when its size is proven small, else (df, False)."""
    if provably_small(df, max_rows):
        return F.broadcast(df), True
    return df, False


def broadcast_distinct(raw: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``raw.distinct()``, broadcast when ``raw`` itself is proven small.

    The bound is checked on the projected input rows (distinct ≤ input), so
    the check never has to run the distinct's shuffle.
    """
    small = provably_small(raw, max_rows)
    d = raw.distinct()
    return F.broadcast(d) if small else d


def distinct_for(raw: DataFrame, asked: DataFrame, columns: list[str], max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``raw.distinct()`` as far as a join asks for it that looks up the keys of ``asked``.

    Broadcast when ``raw`` itself is proven small; a larger one is first
    reduced by a bit filter of the keys asked for (``membership``), so that
    only rows that may match are shuffled. Rows with a null key match nothing
    and may be left out.
    """
    if provably_small(raw, max_rows):
        return F.broadcast(raw.distinct())
    return membership.reduced(raw, columns, asked, columns).distinct()


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def common_key_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which two key columns are compared (None: they agree already).

    Text against a number compares as a number, text against a date or
    timestamp as that; text that does not parse is a null key, which never
    matches. Other unlike types compare as text.
    """
    if a == b:
        return None
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.StringType) and isinstance(y, _NUMBER):
            return T.LongType() if isinstance(y, _WHOLE) else y if isinstance(y, T.DecimalType) else T.DoubleType()
        if isinstance(x, T.StringType) and isinstance(y, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return y
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, _NUMBER) and isinstance(b, _NUMBER):
        if isinstance(a, T.DecimalType) and isinstance(b, (T.DecimalType, *_WHOLE)) or isinstance(b, T.DecimalType) and isinstance(a, _WHOLE):
            return T.DecimalType(38, max(getattr(a, "scale", 0), getattr(b, "scale", 0)))
        return T.DoubleType()
    return T.StringType()


def _typed_keys(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> tuple[list[Column], list[Column]]:
    lcols, rcols = [], []
    for lk, rk in zip(left_keys, right_keys, strict=True):
        t = common_key_type(left.schema[lk].dataType, right.schema[rk].dataType)
        lcols.append(left[quoted(lk)] if t is None else left[quoted(lk)].try_cast(t))
        rcols.append(right[quoted(rk)] if t is None else right[quoted(rk)].try_cast(t))
    return lcols, rcols


def hot_keys(df: DataFrame, keys: list[Column], fraction: float = HOT_KEY_FRACTION) -> list[int]:
    """Hashes of the (typed) key values that hold more than ``fraction`` of the rows.

    One pass with Spark's ``approx_top_k`` frequent-items sketch (merged
    map-side, so nothing like a full group-by is shuffled); the result is
    bounded by ``1 / fraction`` values. A false positive only salts one more
    key; a missed key is still split by AQE's skew join.
    """
    k = int(1 / fraction)
    present = keys[0].isNotNull()
    for c in keys[1:]:
        present = present & c.isNotNull()
    row = (df.filter(present).select(F.xxhash64(*keys).alias("hk"))
           .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(hk, {k}, {4 * k})").alias("top"))
           .first())
    threshold = max(int(row["n"] * fraction), 1)
    return [t["item"] for t in (row["top"] or []) if t["count"] > threshold]


def left_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
              max_broadcast_rows: int = BROADCAST_MAX_ROWS,
              salt_hot_keys: bool = True) -> DataFrame:
    """``left ⟕ right`` on left_keys = right_keys; right key columns are dropped.

    Null keys never match. Duplicate right keys multiply left rows (plain
    relational semantics). Keys of unlike types are compared in the type that
    ``common_key_type`` names, whichever join is picked. ``right`` must not
    share non-key column names with ``left`` (callers rename first).
    """
    rk = [f"{HIDDEN}rk{i}" for i in range(len(right_keys))]
    lcols, rcols = _typed_keys(left, right, left_keys, right_keys)
    r = right.select(*[c.alias(a) for c, a in zip(rcols, rk)],
                     *[quoted(c) for c in right.columns if c not in right_keys])
    r = r.filter(all_not_null(rk))
    r_small, is_small = maybe_broadcast(r, max_broadcast_rows)
    if is_small:
        return left.join(r_small, [lc == r_small[a] for lc, a in zip(lcols, rk)], "left").drop(*rk)

    hot = hot_keys(left, lcols) if salt_hot_keys else []
    if not hot:
        return left.join(r, [lc == r[a] for lc, a in zip(lcols, rk)], "left").drop(*rk)

    # Salted join: rows of hot keys get a deterministic salt from a hash of the
    # whole row (stable under task retries); matching right rows are
    # replicated once per salt value. Other keys keep salt 0. Both sides pick
    # the hot keys by the hash of the same typed values.
    lk = [f"{HIDDEN}lk{i}" for i in range(len(left_keys))]
    row_hash = F.xxhash64(*[left[quoted(c)] for c in left.columns])
    l2 = left.select("*", *[c.alias(a) for c, a in zip(lcols, lk)],
                     F.when(F.xxhash64(*lcols).isin(hot), F.pmod(row_hash, F.lit(SALT_BUCKETS)))
                     .otherwise(F.lit(0)).cast("long").alias(f"{HIDDEN}salt"))
    salts = F.when(F.xxhash64(*rk).isin(hot), F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1))).otherwise(F.array(F.lit(0)))
    r2 = r.withColumn(f"{HIDDEN}rsalt", F.explode(salts.cast("array<long>")))
    cond = [l2[x] == r2[a] for x, a in zip(lk, rk)] + [l2[f"{HIDDEN}salt"] == r2[f"{HIDDEN}rsalt"]]
    return l2.join(r2, cond, "left").drop(*rk, *lk, f"{HIDDEN}salt", f"{HIDDEN}rsalt")


def semi_join_small(df: DataFrame, keys_df: DataFrame, on: list[str], how: str = "left_semi",
                    max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Semi / anti join on a key list that is usually small (e.g. passing files)."""
    return df.join(broadcast_distinct(keys_df.select(*on), max_broadcast_rows), on=on, how=how)
