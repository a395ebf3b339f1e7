"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are hashed into blocks of about ``block_words`` words.
A source's quota, in blocks, follows from its target: whole passes over all
its blocks (epochs), then blocks in a fixed random order up to the target; the
last block and in it the last document are cut at the target, so the words
taken meet it.

The quotas of all sources are then split among the output shards by a binary
tree: a node that covers some shards holds a vector of block quotas and gives
its left half a multivariate-hypergeometric draw. Leaves so hold what a
uniform shuffle of all blocks would have given them, and the running offsets
of the tree make the shards' blocks disjoint. A task grows one subtree; the
path down to it is drawn again from seeds, so tasks need nothing from each
other. Within a shard documents are ordered by a hash.

A source may hold a third of all rows: its documents meet only as block sums.
Joins on the source take the source's table as the small side; joins on
blocks have one row per block on one side, so Spark can split the other.

Defined results: sources in code point order, null last, get the weights in
turn; a null or empty text has no words and is taken 0 words; a source without
words has target 0; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dropgate.llm.common import free_names, n_words, written

BLOCK_WORDS = 50_000
BLOCK_DOCS = 20_000
RANGE_BLOCKS = 65_536    # blocks of a source that a task sums at a time
SHARD_BLOCKS = 64        # blocks of an output shard, on average
SUBTREE_SHARDS = 64      # shards that one task grows
SMALL_SIDE = 200_000     # sources up to which their table is broadcast (at most about 20 MB)
SEED = 20231


def _key(source: Column) -> list[Column]:
    """Null-safe equality key of a source."""
    return [source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("source_key")]


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """no_source, source_key, source_size, n_docs, w, target; from rows with the key and ``size``.

    The share of a source is min(max_epochs * size, level * w): reshared excess
    goes to the others by weight until none is above its bound. Each round
    fixes the sources that exceed it and gets the next level from two sums.
    """
    per = written(sizes.groupBy("no_source", "source_key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "mix-sources")
    # rank in code point order: count per range, then rank inside ranges
    ranged = written(per.repartitionByRange("no_source", "source_key").withColumn("part", F.spark_partition_id()), "mix-ranges")
    before = (ranged.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("no_source", "source_key"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") % len(weights)) + 1).cast("int"))
    ranked = written(ranged.join(F.broadcast(before), "part")  # one row per shuffle partition
                     .withColumn("rank", F.col("before") + inside - 1).withColumn("w", w)
                     .withColumn("bound", (F.col("source_size") * max_epochs).cast("double")), "mix-ranks")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, fixed = 0.0, -1
    while True:
        over = F.col("bound") <= level * F.col("w")
        n, capped, free = ranked.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, F.col("bound")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("w")))).first()
        if n == fixed or not free:
            break
        fixed, level = n, (total - capped) / free
    return ranked.select("rank", "no_source", "source_key", "source_size", "n_docs",
                         F.least("bound", F.lit(level) * F.col("w")).alias("target"))


def _subtree(lo: int, hi: int, quota: np.ndarray, shards: int, seed: int):
    """(shard, start, count) of the shards lo..hi-1: each source's slots, by splitting from the root."""
    capacity = int(quota.sum())

    def room(a: int, b: int) -> int:  # blocks of the shards a..b-1, equal up to one
        return capacity * b // shards - capacity * a // shards

    def grow(a: int, b: int, start: np.ndarray, left: np.ndarray):
        if b <= lo or a >= hi:
            return
        if b - a == 1:
            yield a, start, left
            return
        mid = (a + b) // 2
        rng = np.random.Generator(np.random.PCG64([seed, a, b]))
        draw = rng.multivariate_hypergeometric(left, room(a, mid), method="marginals")
        yield from grow(a, mid, start, draw)
        yield from grow(mid, b, start + draw, left - draw)

    yield from grow(0, shards, np.zeros(len(quota), np.int64), quota)


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """rank, shard, start, count: the slots [start, start + count) of each source that a shard takes.

    ``quotas``: rank and quota (blocks) of every source. Each subtree's task
    gets the vector of quotas, one number per source.
    """
    tasks = -(-shards // SUBTREE_SHARDS)

    def leaves(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        lo = int(key[0]) * SUBTREE_SHARDS
        ranks, out = pdf["rank"].to_numpy(), []
        for shard, start, count in _subtree(lo, min(lo + SUBTREE_SHARDS, shards), pdf["quota"].to_numpy(np.int64), shards, seed):
            some = np.flatnonzero(count)
            out.append(pd.DataFrame({"rank": ranks[some], "shard": shard, "start": start[some], "count": count[some]}))
        return pd.concat(out) if out else pd.DataFrame({"rank": [], "shard": [], "start": [], "count": []})

    every = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    return (quotas.select("rank", "quota", every.alias("subtree")).groupBy("subtree")
            .applyInPandas(leaves, "rank long, shard long, start long, count long"))


def _permuted(slot: Column, blocks: Column, rank: Column, seed: int) -> Column:
    """A fixed random order of 0..blocks-1: a step prime to ``blocks`` from a random start.

    Steps are primes; one divides ``blocks`` only if blocks is its multiple,
    and then the next one is taken.
    """
    first, second = 2_147_483_647, 998_244_353
    step = F.when(blocks % first == 0, F.lit(second)).otherwise(F.lit(first))
    return F.pmod((slot % blocks) * (step % blocks) + F.pmod(F.xxhash64(rank, F.lit(seed)), blocks), blocks)


def _places(sources: DataFrame, range_blocks: int) -> DataFrame:
    """A row per block of every source, with its ``place`` and the ``range`` of places it lies in."""
    ranges = sources.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / range_blocks))).alias("range"))
    first = F.col("range") * range_blocks
    last = F.least(F.col("blocks"), first + range_blocks) - 1
    return ranges.repartition("rank", "range").withColumn("place", F.explode(F.sequence(first, last)))


def _before(table: DataFrame) -> DataFrame:
    """``before``: the words of a source's blocks at earlier places. Places are summed within their
    range, and ranges by one row each, so no task holds all blocks of a source."""
    table = written(table, "mix-places")
    earlier = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (table.groupBy("rank", "range").agg(F.sum("block_words").alias("words"))
              .select("rank", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before_range")))
    inside = Window.partitionBy("rank", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (table.withColumn("before", F.coalesce(F.sum("block_words").over(inside), F.lit(0))).join(ranges, ["rank", "range"])
            .withColumn("before", F.col("before") + F.col("before_range")).drop("range", "before_range"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, source: str = "source",
        block_words: int = BLOCK_WORDS, block_docs: int = BLOCK_DOCS, shard_blocks: int = SHARD_BLOCKS,
        seed: int = SEED, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """``docs`` (a source, ``size``, a row hash ``row_hash`` and what is to be carried), source_size, target and ``draws``.

    draws: an array of (epoch, shard, order, words) per document; ``words`` is the
    size but for a source's last document, which is cut at the target.
    """
    sizes = docs.select(*_key(F.col(source)), "size")
    targets = source_targets(sizes, weights, max_epochs)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words), F.ceil(F.col("n_docs") / block_docs)).cast("long")
    goal = F.floor(F.col("target") + 0.5).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    sources = written(targets.withColumn("blocks", blocks).withColumn("full", full)
                      .withColumn("rest", goal - F.col("full") * F.col("source_size")), "mix-targets")
    small = sources.count() <= SMALL_SIDE
    side = F.broadcast(sources) if small else sources
    (key1, key2) = ("no_source", "source_key")
    keyed = docs.select("*", *_key(F.col(source))).join(side.drop("n_docs"), [key1, key2], "inner")
    keyed = keyed.withColumn("block", F.pmod(F.col("row_hash"), F.col("blocks")))

    # place of each block in its source's order, and the words before it there
    sums = keyed.groupBy("rank", "block").agg(F.sum("size").alias("block_words"))
    table = _before(_places(sources.select("rank", "blocks", "full", "rest"), range_blocks)
                    .withColumn("block", _permuted(F.col("place"), F.col("blocks"), F.col("rank"), seed))
                    .join(sums, ["rank", "block"], "left").withColumn("block_words", F.coalesce("block_words", F.lit(0))))
    # of the last pass: the words this block still gives
    gives = F.greatest(F.lit(0), F.least(F.col("block_words"), F.col("rest") - F.col("before")))
    table = written(table.withColumn("gives", gives).withColumn("passes", F.col("full") + (F.col("before") < F.col("rest")).cast("long")), "mix-blocks")

    quotas = table.groupBy("rank").agg(F.sum("passes").alias("quota"))
    n_slots = int(table.agg(F.sum("passes")).first()[0] or 0)
    shards = max(1, -(-n_slots // shard_blocks))
    slots = (split_quotas(quotas.filter("quota > 0"), shards, seed)
             .select("rank", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("count") - 1)).alias("slot")))
    # slots of a source: epoch by epoch, blocks in order; the last pass ends at the last giving block
    n_gives = table.groupBy("rank").agg(F.max("blocks").alias("blocks"))
    slots = slots.join(F.broadcast(n_gives) if small else n_gives, "rank")
    slots = slots.select("rank", "shard", F.floor(F.col("slot") / F.col("blocks")).alias("epoch"),
                         (F.col("slot") % F.col("blocks")).alias("place"))
    drawn = slots.groupBy("rank", "place").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("slots"))
    plan = written(table.join(drawn, ["rank", "place"], "left").select(
        "rank", "block", "full", "gives", "block_words",
        F.coalesce("slots", F.array().cast("array<struct<epoch:bigint,shard:bigint>>")).alias("slots")), "mix-plan")

    keyed = keyed.drop("full", "rest", "blocks").join(plan, ["rank", "block"], "inner")
    whole = keyed.filter((F.col("gives") == 0) | (F.col("gives") >= F.col("block_words"))).withColumn(
        "last", F.when(F.col("gives") > 0, F.col("size")).otherwise(0))
    # the one cut block of a source: its documents in a random order up to the target
    inside = Window.partitionBy("rank", "block").orderBy("row_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = keyed.filter((F.col("gives") > 0) & (F.col("gives") < F.col("block_words"))).withColumn(
        "last", F.greatest(F.lit(0), F.least(F.col("size"), F.col("gives") - F.coalesce(F.sum("size").over(inside), F.lit(0)))))
    both = whole.unionByName(cut)
    draws = F.filter(F.transform("slots", lambda s: F.struct(
        s["epoch"].alias("epoch"), s["shard"].alias("shard"), F.xxhash64(F.col("row_hash"), s["epoch"], s["shard"]).alias("order"),
        F.when(s["epoch"] < F.col("full"), F.col("size")).otherwise(F.col("last")).cast("long").alias("words"))),
        lambda d: d["words"] > 0)
    return both.withColumn("draws", draws).drop(
        "rank", "block", key1, key2, "full", "gives", "block_words", "slots", "last")


def cut_text(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    parts = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    return F.regexp_replace(F.array_join(F.slice(parts, F.lit(1), words.cast("int")), ""), r"[\x20\x09-\x0D]+$", "")


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """The mixed documents themselves, shard by shard in shuffled order, with the columns of ``docs``.

    A document comes once per epoch that takes it; the last document of a
    source's last pass ends at the target.
    """
    (row,) = free_names(docs, "_row")
    inner = docs.select("source", "text", F.struct(*[F.col(c) for c in docs.columns]).alias(row))
    inner = inner.withColumn("size", n_words(F.col("text"))).withColumn("row_hash", F.xxhash64(row))
    mixed = mix(inner, weights, max_epochs).select(row, "size", F.explode("draws").alias("d"))
    names = {c: F.col(row)[c].alias(c) for c in docs.columns}
    text = F.when(F.col("d.words") < F.col("size"), cut_text(F.col(row)["text"], F.col("d.words"))).otherwise(F.col(row)["text"])
    columns = [text.alias(c) if c == "text" else (F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else x)
               for c, x in names.items()]
    return (mixed.repartition(F.col("d.shard")).sortWithinPartitions("d.shard", "d.order").select(*columns))


def op1(docs: DataFrame) -> DataFrame:
    sizes = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                                F.xxhash64("doc_id", "source", "text").alias("row_hash")), "mix-sizes")
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    # beyond the contract: the source, and where each draw goes (pass, shard of the tree, place in the shard's order, words)
    return mix(sizes).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "draws")
