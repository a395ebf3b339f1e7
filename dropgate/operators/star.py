"""(X9) Star schema: a drop's rows as facts that point at dimension members.

A dimension holds one row per member and interval of validity: ``key`` (one
number per natural key for good), the natural key, the attributes,
``valid_from`` and ``valid_to`` (run ids; null while valid). A run merges the
members of its drop: new ones get keys after the highest one, changed ones
get a new row and their old one ends. Facts carry the member's key and their
run, so joining them back on key and interval gives the values of that run.

* Keys are numbered without a global sort: new members are sorted by ranges
  and each range starts at the sum of the ranges before it.
* Members are reduced before the join (partial aggregation), so a member that
  a third of all facts point at is one row there. Facts get keys through
  ``joins.left_join``: a broadcast under proof, else a salted join.
* A run that is repeated first takes back what it added, so it gives the
  same dimension again.

Defined results: null is a natural key like any other; of rows that disagree
on a member's attributes the greatest (in column order) counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropgate.functions.names import col as named, quoted
from dropgate.operators import joins
from dropgate.session import scratch_path

KEY, FROM, TO = "key", "valid_from", "valid_to"
_PART, _PLACE = f"{joins.HIDDEN}part", f"{joins.HIDDEN}place"


def numbered(df: DataFrame, order: list[str], start: int, out: str = KEY) -> DataFrame:
    """``df`` with consecutive numbers from ``start`` on in the order of ``order`` (unique values)."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    keys = [quoted(c) for c in order]
    (df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(_PART, (F.sum("n").over(Window.orderBy(_PART)) - F.col("n")).alias("before"))  # one row per range
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*keys))
    return (ranged.withColumn(_PLACE, place).join(F.broadcast(before), _PART)
            .withColumn(out, (F.lit(start - 1) + F.col("before") + F.col(_PLACE)).cast("long")).drop(_PART, _PLACE, "before"))


def _same(a: list[Column], b: list[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b, strict=True):
        out = out & x.eqNullSafe(y)
    return out


def merge_dimension(existing: DataFrame | None, rows: DataFrame, natural: list[str], attributes: list[str], run: str) -> DataFrame:
    """The dimension after the run ``run`` brought the members of ``rows``.

    Columns: key, natural key, attributes, valid_from, valid_to.
    """
    columns = [KEY, *natural, *attributes, FROM, TO]
    keys, values = [quoted(c) for c in natural], F.struct(*[named(c) for c in attributes])
    members = rows.groupBy(*keys).agg(F.max(values).alias("v")).select(*keys, *[F.col("v")[c].alias(c) for c in attributes])
    if existing is None:
        new = numbered(members, natural, 1)
        return new.withColumns({FROM: F.lit(run), TO: F.lit(None).cast("string")}).select(*map(quoted, columns))
    # what an earlier attempt of this run did is taken back
    known = existing.filter(F.col(FROM) != run).withColumn(TO, F.when(F.col(TO) != run, F.col(TO)))
    top = known.agg(F.max(KEY)).first()[0] or 0
    closed, valid = known.filter(F.col(TO).isNotNull()), known.filter(F.col(TO).isNull())
    v, m = valid.alias("v"), members.alias("m")
    of = lambda t, c: F.col(f"{t}.{quoted(c)}")
    on = _same([of("v", c) for c in natural], [of("m", c) for c in natural])
    came = m.join(v, on, "left").select(*[of("m", c).alias(c) for c in [*natural, *attributes]], of("v", KEY).alias(KEY),
                                        _same([of("m", c) for c in attributes], [of("v", c) for c in attributes]).alias("unchanged"))
    path = scratch_path(rows.sparkSession, "members")
    came.write.parquet(path)
    came = rows.sparkSession.read.parquet(path)
    changed = came.filter(F.col(KEY).isNotNull() & ~F.col("unchanged"))
    ended = valid.join(changed.select(KEY, F.lit(run).alias("ended")), KEY, "left").withColumn(TO, F.col("ended")).drop("ended")
    new = numbered(came.filter(F.col(KEY).isNull()).drop(KEY), natural, top + 1)
    started = [f.withColumns({FROM: F.lit(run), TO: F.lit(None).cast("string")}).select(*map(quoted, columns)) for f in (changed, new)]
    out = closed.select(*map(quoted, columns)).unionByName(ended.select(*map(quoted, columns)))
    return out.unionByName(started[0]).unionByName(started[1])


def facts(rows: DataFrame, dimension: DataFrame, natural: list[str], attributes: list[str], run: str, key: str = KEY) -> DataFrame:
    """``rows`` with the natural key and the attributes replaced by the member's key, and the run."""
    valid = dimension.filter((F.col(FROM) <= run) & (F.col(TO).isNull() | (F.col(TO) > run)))
    nulls = [f"{joins.HIDDEN}null{i}" for i in range(len(natural))]
    mark = {n: named(c).isNull() for n, c in zip(nulls, natural, strict=True)}
    # null is a member's key too: it is compared as a flag beside a filled value
    fill = lambda df: df.withColumns(mark | {f"{n}v": F.coalesce(named(c).cast("string"), F.lit("")) for n, c in zip(nulls, natural, strict=True)})
    on = [x for n in nulls for x in (n, f"{n}v")]
    out = joins.left_join(fill(rows), fill(valid).select(*on, F.col(KEY).alias(f"{joins.HIDDEN}member")), on, on)
    rest = [named(c) for c in rows.columns if c not in natural and c not in attributes]
    return out.select(*rest, F.col(f"{joins.HIDDEN}member").alias(key), F.lit(run).alias("run"))


def joined_back(fact: DataFrame, dimension: DataFrame, key: str = KEY) -> DataFrame:
    """The facts with the natural key and the attributes that were valid in their run."""
    f, d = fact.alias("f"), dimension.alias("d")
    on = (F.col(f"f.{quoted(key)}") == F.col(f"d.{KEY}")) & (F.col(f"d.{FROM}") <= F.col("f.run")) & (
        F.col(f"d.{TO}").isNull() | (F.col(f"d.{TO}") > F.col("f.run")))
    return f.join(d, on, "left").select(*[F.col(f"f.{quoted(c)}") for c in fact.columns if c != key],
                                        *[F.col(f"d.{quoted(c)}") for c in dimension.columns if c not in (KEY, FROM, TO)])
