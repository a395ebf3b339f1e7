"""Exact top-k by inner product as a Voronoi kNN join.

Vectors are grouped by their nearest pivot (pivots are sampled vectors, about
the square root of the number of vectors, as far as ``PIVOT_VALUES`` allows).
Each cell's summary is its radius and its number of members; neighbouring small
cells form a bin of about ``BLOCK_ROWS`` vectors. In a first pass every query is
solved in its own bin, which bounds its k-th best score from below. For a cell
with pivot p and radius r no member scores more than <q, p> + |q| r, so a query
is sent only to the other bins with a cell whose bound reaches its own k-th
best; there it is solved locally. The best k over the bins are exact.

A large cell is dealt over blocks of about ``BLOCK_ROWS`` vectors, so a vector
that makes up a third of all rows is many blocks. Queries form groups of about
``QUERY_BLOCK`` from neighbouring bins (a popular bin is several groups), and a
bin's vectors are replicated to those groups that have a query for it. A block
returns at most k rows per query. Lengths that get no pivots (they have at most
a block of vectors, or are not among the ``LENGTHS`` most frequent) are a
single bin, so what the driver and the tasks hold does not grow with the number
of lengths.

Defined results: each component x becomes floor(256 x); vectors that are null,
or hold null or non-finite components, take no part; vectors of another length
than a query's are not its candidates, and an empty vector has score 0 with
empty ones. Every row counts for itself: a query's own row is no candidate of
it, further rows with its id and vector are. Ties go to the smaller id, null
ids last. Fewer candidates than k give fewer rows. Scores are exact integers;
components and scores beyond the range of a long are the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dropgate.llm.common import written

PIVOT_VALUES = 1 << 22  # numbers in all pivots together, at most: every task holds them
LENGTHS = 1024          # lengths of vectors that get pivots, at most
BLOCK_ROWS = 8192
QUERY_BLOCK = 32_768
SMALL_SIDE = 500_000    # counted rows up to which a side of numbers is broadcast
CHUNK_VALUES = 1 << 22  # numbers in a matrix of distances or scores
SCALE = 256
EPS = 2.3e-16
LONG = 1 << 63


def quantised(rows: DataFrame, key: Column, vector: Column) -> DataFrame:
    """id and v (array of floor(256 x)) of the rows that take part, with a number of the row."""
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    out = rows.select(key.cast("long").alias("id"), F.when(vector.isNotNull() & finite, v).alias("v")).filter("v is not null")
    # the numbers are those written: what reads the table again sees the same
    return written(out.withColumn("row", F.monotonically_increasing_id()), "knn-rows")


def _integers(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(values) else np.zeros((len(column), 0), np.int64)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def best_of(x: np.ndarray, row: np.ndarray, q: np.ndarray, q_row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) places of each query's best k of ``x``; ties go to the vector that stands first.

    Sums that double precision may not hold are bounded in it first; those that
    may be among the best are summed as Python integers.
    """
    whole, asked = x.astype(np.float64), q.astype(np.float64)
    by_row = np.argsort(row)
    place = np.minimum(np.searchsorted(row[by_row], q_row), len(row) - 1)
    own = np.where(row[by_row][place] == q_row, by_row[place], -1)
    exact = _largest(x) * _largest(q) * max(1, x.shape[1]) < 1 << 53
    width = np.sqrt((whole * whole).sum(1).max()) if len(x) else 0.0
    out = []
    step = max(1, CHUNK_VALUES // max(1, len(x)))
    for lo in range(0, len(q), step):
        s = asked[lo: lo + step] @ whole.T
        if not exact:
            s = s.clip(-float(LONG), float(LONG))
        mine = own[lo: lo + step]
        s[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf
        least = np.partition(s, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(s), -np.inf)
        if not exact:
            least = least - 2 * EPS * (x.shape[1] + 8) * width * np.sqrt((asked[lo: lo + step] ** 2).sum(1))
        i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
        if exact:
            score = s[i, j].astype(np.int64)
        else:
            sums = (sum(a * b for a, b in zip(q[lo + m].tolist(), x[n].tolist(), strict=True)) for m, n in zip(i, j, strict=True))
            score = np.array([max(-LONG, min(LONG - 1, t)) for t in sums], np.int64)
        order = np.lexsort((j, ~score, i))  # ~ turns the order of integers round
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((lo + i[rank < k], j[rank < k], score[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


@dataclass
class Cells:
    """The cells of one length: pivots in an order of neighbours, and once the members are known, bins of them."""
    pivots: np.ndarray
    radius: np.ndarray | None = None
    members: np.ndarray | None = None
    first: np.ndarray | None = None    # first cell of each bin
    blocks: np.ndarray | None = None   # of each bin

    def chunk(self) -> int:
        return max(1, CHUNK_VALUES // len(self.pivots))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and a distance that is not less than the one to its pivot."""
        d2 = (x * x).sum(1)[:, None] - 2 * x @ self.pivots.T + (self.pivots ** 2).sum(1)[None]
        cell = d2.argmin(1)
        size = np.sqrt((x * x).sum(1)) + np.sqrt((self.pivots ** 2).sum(1))[cell]
        return cell, np.sqrt(np.maximum(0, d2[np.arange(len(x)), cell]) + 2 * EPS * (x.shape[1] + 8) * size * size)

    def bound(self, q: np.ndarray) -> np.ndarray:
        """What no vector of a cell outscores, per query and cell."""
        norm, size = np.sqrt((q * q).sum(1)), np.sqrt((self.pivots ** 2).sum(1))
        room = self.radius * (1 + 1e-9) + 2 * EPS * (q.shape[1] + 8) * (size + self.radius) + 1e-6
        return np.maximum(q @ self.pivots.T + norm[:, None] * room[None], -float(LONG))

    def fill(self, block_rows: int) -> None:
        """Small cells in turn until a bin is full; a large cell is a bin of several blocks."""
        first, sizes = [0], [0]
        for c, n in enumerate(self.members.tolist()):
            if sizes[-1] and sizes[-1] + n > block_rows:
                first.append(c), sizes.append(0)
            sizes[-1] += n
        self.first = np.array(first)
        self.blocks = np.array([-(-n // block_rows) for n in sizes])

    def bin_of(self) -> np.ndarray:
        return np.searchsorted(self.first, np.arange(len(self.pivots)), "right") - 1


def _neighbours(pivots: np.ndarray) -> np.ndarray:
    """The pivots, those near the same one of a few of them beside each other."""
    few = pivots[:: max(1, int(np.sqrt(len(pivots))))]
    parts = [Cells(few).nearest(pivots[lo: lo + 4096]) for lo in range(0, len(pivots), 4096)]
    return pivots[np.lexsort((np.concatenate([d for _, d in parts]), np.concatenate([c for c, _ in parts])))]


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else df


def choose_pivots(data: DataFrame, pivots: int | None, block_rows: int) -> dict[int, Cells]:
    """Cells of the most frequent lengths with more than a block of vectors; ``pivots`` a length, else about the root of their number."""
    spark = data.sparkSession
    counts = (data.filter(F.col("dim") > 0).groupBy("dim").count().filter(F.col("count") > block_rows)
              .orderBy(F.desc("count"), "dim").limit(LENGTHS).collect())
    room, wanted = PIVOT_VALUES, {}
    for dim, n in counts:
        m = min(pivots or int(np.ceil(np.sqrt(n))), room // dim)
        if m > 1:
            wanted[dim], room = (m, min(1.0, 1.5 * m / n)), room - m * dim
    if not wanted:
        return {}
    shares = spark.createDataFrame([(d, s) for d, (_, s) in wanted.items()], "dim int, share double")
    u = F.xxhash64("row", "v")
    drawn = (data.join(F.broadcast(shares), "dim").withColumn("u", u)
             .filter((F.col("u") / float(LONG) + 1) / 2 <= F.col("share")).select("dim", "u", "v"))
    got, out = drawn.toArrow(), {}
    dims, order = got["dim"].to_numpy(), got["u"].to_numpy()
    for dim, (m, _) in wanted.items():
        at = np.flatnonzero(dims == dim)
        at = at[np.argsort(order[at], kind="stable")][:m]
        if len(at):
            out[dim] = Cells(_neighbours(np.unique(_integers(got["v"].take(pa.array(at))).astype(np.float64), axis=0)))
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, pivots: int | None = None, block_rows: int = BLOCK_ROWS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for tables of (id, v, row): a query's own row is that of its number."""
    spark = vectors.sparkSession
    vectors, asked = (t.select("id", "v", "row", F.size("v").alias("dim")) for t in (vectors, queries))
    cells = choose_pivots(vectors, pivots, block_rows)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, cell, dist = b.column(3).to_numpy(), np.zeros(len(b), np.int32), np.zeros(len(b))
            for dim in np.unique(dims).tolist():
                if dim not in cells:
                    continue
                at, step = np.flatnonzero(dims == dim), cells[dim].chunk()
                for lo in range(0, len(at), step):
                    some = at[lo: lo + step]
                    cell[some], dist[some] = cells[dim].nearest(_integers(b.column(1).take(pa.array(some))).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(dist)], names=["id", "v", "row", "dim", "cell", "dist"])

    kind = "id long, v array<bigint>, row long, dim int, cell int, dist double"
    data = written(vectors.mapInArrow(assigned, kind), "knn-cells")
    asked = written(asked.mapInArrow(assigned, kind).drop("dist"), "knn-queries")
    # radius and members of the cells of pivots: at most as many rows as pivots
    known = [F.col("dim").isin(list(cells))] if cells else [F.lit(False)]
    for c in cells.values():
        c.radius, c.members = np.zeros(len(c.pivots)), np.zeros(len(c.pivots), np.int64)
    for dim, cell, radius, members in data.filter(*known).groupBy("dim", "cell").agg(F.max("dist"), F.count("*")).collect():
        cells[dim].radius[cell], cells[dim].members[cell] = radius, members
    bins = []
    for dim, c in cells.items():
        c.fill(block_rows)
        bins += [(dim, i, int(g), int(c.blocks[g])) for i, g in enumerate(c.bin_of())]
    bins = spark.createDataFrame(bins, "dim int, cell int, bin int, blocks int")
    # the other lengths: one bin each
    plain = data.filter(~known[0]).groupBy("dim").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    bins = written(bins.unionByName(plain.select("dim", F.lit(0).alias("cell"), F.lit(0).alias("bin"), "blocks")), "knn-bins")
    blocked = data.join(_small(bins), ["dim", "cell"]).select(
        "id", "v", "row", "dim", "bin", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"))
    # a query with a length that no vector has finds no bin, and has no candidates
    asked = asked.join(_small(bins), ["dim", "cell"])
    # query groups: bins in turn until a group is full; a popular bin is several groups
    held = asked.groupBy("dim", "bin").agg(F.count("*").alias("n"))
    groups, g, filled = [], 0, 0
    for dim, b, n in sorted(held.filter(*known).collect()):
        parts = -(-n // query_block)
        if filled and (filled + n > query_block):
            g, filled = g + 1, 0
        groups.append((dim, b, g, parts))
        g, filled = (g, filled + n) if parts == 1 else (g + parts, 0)
    groups = spark.createDataFrame(groups, "dim int, bin int, g int, parts int").unionByName(
        held.filter(~known[0]).select("dim", "bin", F.lit(0).alias("g"), F.ceil(F.col("n") / query_block).cast("int").alias("parts")))
    asked = asked.join(_small(groups), ["dim", "bin"]).select(
        "id", "v", "row", "dim", "bin", "blocks", (F.col("g") + F.pmod(F.xxhash64("row"), "parts")).cast("int").alias("qblock"))
    asked = written(asked, "knn-asked")

    found = "qrow long, qid long, vid long, score long"

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        """Best k of a block of vectors for each query of a group."""
        order = pa.compute.sort_indices(left, [("id", "ascending"), ("row", "ascending")], null_placement="at_end")
        left = left.take(order)
        i, j, score = best_of(_integers(left["v"]), left["row"].to_numpy(), _integers(right["v"]), right["row"].to_numpy(), k)
        i, j = pa.array(i), pa.array(j)
        return pa.table({"qrow": right["row"].take(i), "qid": right["id"].take(i), "vid": left["id"].take(j), "score": pa.array(score)})

    def solved(targets: DataFrame, needed: DataFrame) -> DataFrame:
        keys = ("dim", "bin", "block", "qblock")
        data_side = blocked.join(_small(written(needed, "knn-needed")), ["dim", "bin"]).select(*keys, "id", "v", "row")
        return data_side.groupBy(*keys).cogroup(targets.groupBy(*keys)).applyInArrow(
            lambda a, b: solve(a, b) if len(a) and len(b) else pa.table({n: pa.array([], pa.int64()) for n in ("qrow", "qid", "vid", "score")}), found)

    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    best = Window.partitionBy("qrow").orderBy(F.desc("score"), F.col("vid").asc_nulls_last())
    own = solved(asked.select("dim", "bin", every, "qblock", "id", "v", "row"), asked.select("dim", "bin", "qblock").distinct())
    first = written(own.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "knn-own")
    kth = first.filter(F.col("rank") == k).select(F.col("qrow").alias("row"), F.col("score").alias("kth"))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bins but a query's own that may hold one of its best k."""
        for b in batches:
            dims, home = b.column(2).to_numpy(), b.column(3).to_numpy()
            least = b.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            least = np.where(np.isnan(least), -np.inf, np.nextafter(least, -np.inf))
            for dim in np.unique(dims).tolist():
                c = cells[dim]
                at, step = np.flatnonzero(dims == dim), c.chunk()
                for lo in range(0, len(at), step):
                    some = at[lo: lo + step]
                    bound = c.bound(_integers(b.column(1).take(pa.array(some))).astype(np.float64))
                    bound = np.maximum.reduceat(np.where(c.members[None] > 0, bound, -np.inf), c.first, axis=1)
                    send = (bound >= least[some][:, None]) & (bound > -np.inf)
                    send[np.arange(len(some)), home[some]] = False
                    i, g = np.nonzero(send)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some[i])), pa.array(g.astype(np.int32)), pa.array(c.blocks[g].astype(np.int32))],
                                                     names=["row", "bin", "blocks"])

    waiting = asked.filter(*known).join(kth, "row", "left").select("row", "v", "dim", "bin", "kth")
    sent = written(waiting.mapInArrow(others, "row long, bin int, blocks int"), "knn-sent")
    sent = sent.join(asked.select("row", "id", "v", "dim", "qblock"), "row")
    rest = solved(sent.select("dim", "bin", every, "qblock", "id", "v", "row"), sent.select("dim", "bin", "qblock").distinct())
    both = first.drop("rank").unionByName(rest)
    return both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        F.col("qid").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vid").alias("vec_id"), "score")


def op5(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    vectors = quantised(embeddings, F.col("vec_id"), F.col("embedding"))
    return top_k(vectors, vectors.filter(F.col("id") % every == 0), k)
