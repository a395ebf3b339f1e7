"""A bit filter of keys, applied to a large side before it is shuffled.

A key's hash names one bit; the bits of the keys of the small side are OR-ed
into lines of ``LINE`` bits by an aggregation that is combined in every task. A
row of the large side whose bit is unset has a key that the small side does
not hold, so it can be left out of a join that only asks about the small
side's keys. A set bit proves nothing: the exact join follows. Which rows the
filter lets through never changes a result, only how many rows are shuffled.

``reduced`` sizes the filter by an approximate distinct count of the keys
(about ``BITS_PER_KEY`` bits each: one row in 16 passes without a reason) and
holds it to ``MAX_BITS`` (32 MB on an executor); with more keys than bits it
would let nearly everything through and is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropgate.functions.names import col as named

LINE = 512
WORD = 64
BITS_PER_KEY = 16
MAX_BITS = 1 << 28

_BIT = "__dg__bit"
LINE_NO = "__dg__line"
WORDS = "__dg__words"

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def hashed_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which equal keys of both types have equal hashes; None where that isn't certain.

    Zeros of either sign and text of other collations are equal without having the same bytes.
    """
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return T.LongType()
    same = a == b and (a == T.StringType() or isinstance(a, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType,
                                                             T.BinaryType, T.DecimalType)))
    return a if same else None


def _bit(columns: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def lines_of(rows: DataFrame, bit: Column) -> DataFrame:
    """One row per line that has a bit set, with the line's words (``__dg__line``, ``__dg__words``)."""
    word, mask = F.shiftright(_BIT, 6).bitwiseAND(F.lit(LINE // WORD - 1)), F.expr(f"shiftleft(1L, cast({_BIT} & {WORD - 1} AS int))")
    words = [F.bit_or(F.when(word == i, mask).otherwise(F.lit(0).cast("long"))) for i in range(LINE // WORD)]
    return (rows.select(bit.alias(_BIT)).groupBy(F.shiftright(_BIT, 9).alias(LINE_NO)).agg(F.array(*words).alias(WORDS)))


def merged_lines(lines: DataFrame) -> DataFrame:
    """Lines of one number OR-ed."""
    return lines.groupBy(LINE_NO).agg(F.array(*[F.bit_or(F.get(WORDS, F.lit(i))) for i in range(LINE // WORD)]).alias(WORDS))


def bit_set(bit: Column, words: Column) -> Column:
    """Whether a bit is set in its line's words; false where there is no line."""
    word = F.get(words, F.shiftright(bit, 6).bitwiseAND(F.lit(LINE // WORD - 1)).cast("int"))
    return F.coalesce(F.getbit(word, bit.bitwiseAND(F.lit(WORD - 1)).cast("int")) == 1, F.lit(False))


def held_in(df: DataFrame, columns: list[Column], lines: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose bit is set; the filter has at most ``bits / LINE`` rows, so it is broadcast."""
    names = df.columns
    rows = df.withColumn(_BIT, _bit(columns, bits)).withColumn(LINE_NO, F.shiftright(_BIT, 9))
    return rows.join(F.broadcast(lines), LINE_NO).filter(bit_set(F.col(_BIT), F.col(WORDS))).select(*map(named, names))


def reduced(side: DataFrame, side_keys: list[str], keys: DataFrame, key_columns: list[str], max_bits: int = MAX_BITS) -> DataFrame:
    """``side`` without rows whose keys ``keys`` certainly doesn't hold (rows with a null key among them)."""
    to = [hashed_type(side.schema[a].dataType, keys.schema[b].dataType) for a, b in zip(side_keys, key_columns, strict=True)]
    if any(t is None for t in to):
        return side
    a = [named(c).cast(t) for c, t in zip(side_keys, to, strict=True)]
    b = [named(c).cast(t) for c, t in zip(key_columns, to, strict=True)]
    present, whole = F.lit(True), F.lit(True)
    for c, d in zip(a, b, strict=True):
        present, whole = present & d.isNotNull(), whole & c.isNotNull()
    keys = keys.filter(present)
    n = keys.agg(F.approx_count_distinct(F.xxhash64(*b))).first()[0]
    if n > max_bits:
        return side
    bits = min(max_bits, max(1, -(-n * BITS_PER_KEY // LINE)) * LINE)
    return held_in(side.filter(whole), a, lines_of(keys, _bit(b, bits)), bits)
