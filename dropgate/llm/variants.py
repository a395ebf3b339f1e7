"""Spelling variants by a dictionary of trie-node pairs.

All words stand in two tries, one of the words and one of the reversed words,
whose nodes are numbered. A word with a gap before its i-th code point is the
pair (node of the prefix before it, node of the suffix from it on): a *seam*.
The same word without its i-th code point is the pair (node of the prefix,
node of the suffix after it): a *hole*. Then, exactly,

* two words with one hole differ by that one code point,
* a word whose hole is another one's seam is that word with one more.

So all neighbours meet in a join of integer pairs. A hole belongs to at most
one word per code point that can stand there, a seam to one word, so no group
grows with the corpus. A word with equal code points in a row has the same
text for each hole in the row; only the first counts as a deletion, so every
pair of near words meets exactly once.

Numbers: the words are sorted by ranges, and each task numbers the nodes of
its range in order, a node when its first word comes. A prefix that reaches
over the bounds of ranges is numbered in each; one row per range (its first
and last word) is enough to give all of them the first one's number. A word is
known by the number of its last node, which rises in code-point order.

Defined results: a null text has no words, a null id counts as an empty one in
the hash, repeated rows count each. Words of any length are handled whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm.common import written

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RANGE_BITS = 40  # of a node's number within its range of words

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
SLIP = 31  # one in so many (document, run) pairs loses a code point


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the corpus's words and how often they occur."""
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), run.alias("run"))
    rows = rows.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(h % slip == 0, cut).otherwise(F.col("run")) if slip else F.col("run")
    return (rows.select(word.alias("word")).filter(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on the path of each word of a sorted range: word, numbers from the root (0) down."""
    before, path, base, made = "", [0], None, 0
    for b in batches:
        sizes, flat = [], []
        for word, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if base is None:
                base = (part + 1) << RANGE_BITS
            shared = len(os.path.commonprefix((before, word)))
            fresh = len(word) - shared
            path = path[: shared + 1] + list(range(base + made, base + made + fresh))
            made += fresh
            before = word
            sizes.append(len(path))
            flat += path
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                                         names=["word", "part", "nodes"])


def shared_paths(ends: list[tuple]) -> list[tuple[int, list[int]]]:
    """(range, numbers) of the prefixes that a range's first word shares with the word before it.

    ``ends``: (range, first word, last word, nodes of the last word) of each
    range in order. The nodes of a range's first word are its first ones.
    """
    out, before, path = [], None, [0]
    for part, first, last, nodes in ends:
        base = (part + 1) << RANGE_BITS
        known = path[: len(os.path.commonprefix((before, first))) + 1] if before is not None else [0]
        out.append((part, known))
        # own nodes of the range that stand for a known prefix take its number
        path = [known[x - base + 1] if 0 < x < base + len(known) - 1 else x for x in nodes]
        before = last
    return out


def trie(vocabulary: DataFrame, name: str) -> DataFrame:
    """word, nodes: the numbers of the nodes from the root to the word, alike for alike prefixes."""
    spark = vocabulary.sparkSession
    ranges = vocabulary.select("word").repartitionByRange("word").sortWithinPartitions("word")
    own = written(ranges.select("word", F.spark_partition_id().cast("long").alias("part"))
                  .mapInArrow(_numbered, "word string, part long, nodes array<long>"), name)
    # one row per range of words
    ends = (own.groupBy("part").agg(F.min("word").alias("first"), F.max_by(F.struct("word", "nodes"), "word").alias("last"))
            .select("part", "first", "last.word", "last.nodes").orderBy("part").collect())
    known = spark.createDataFrame(shared_paths([tuple(r) for r in ends]), "part long, known array<long>")
    base = F.shiftleft(F.col("part") + 1, RANGE_BITS)
    number = F.transform("nodes", lambda x: F.when((x > 0) & (x < base + F.size("known") - 1),
                                                   F.get("known", (x - base + 1).cast("int"))).otherwise(x))
    return own.join(F.broadcast(known), "part").select("word", number.alias("nodes"))


def entries(vocabulary: DataFrame) -> DataFrame:
    """id, word, n, ahead, back, lead: each word with its nodes in both tries, from the root.

    ``id`` is the word's last node; ids rise with the words in code-point order.
    ``lead``: whether a code point is the first of equal ones in a row.
    """
    ahead = trie(vocabulary, "variants-ahead")
    back = trie(vocabulary.select(F.reverse("word").alias("word")), "variants-back").select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    points = F.split("word", "")
    lead = F.zip_with(points, F.concat(F.array(F.lit("")), points), lambda x, before: x != before)
    both = vocabulary.join(ahead, "word").join(back, "word")
    return written(both.select(F.element_at("nodes", -1).alias("id"), "word", "n", F.col("nodes").alias("ahead"), "back", lead.alias("lead")),
                   "variants-entries")


def pairs(table: DataFrame) -> DataFrame:
    """p, s, hole, lead, id, n: the node pairs of every word's holes and seams."""
    size = F.size("ahead") - 1
    pair = lambda i, skip: (F.get("ahead", i).alias("p"), F.get("back", size - i - skip).alias("s"))
    hole = lambda i: F.struct(*pair(i, 1), F.lit(True).alias("hole"), F.get("lead", i).alias("lead"))
    seam = lambda i: F.struct(*pair(i, 0), F.lit(False).alias("hole"), F.lit(False).alias("lead"))
    every = F.concat(F.transform(F.sequence(F.lit(0), size - 1), hole), F.transform(F.sequence(F.lit(0), size), seam))
    return table.select("id", "n", F.explode(every).alias("e")).select("e.p", "e.s", "e.hole", "e.lead", "id", "n")


def near_pairs(table: DataFrame) -> DataFrame:
    """id, other: every pair of near words of ``entries``, both ways round."""
    every = pairs(table)
    holes = every.filter("hole").select("p", "s", "id", "lead")
    seams = every.filter("NOT hole").select("p", "s", F.col("id").alias("other"))
    replaced = holes.join(holes.select("p", "s", F.col("id").alias("other")), ["p", "s"]).filter("id <> other")
    longer = holes.filter("lead").join(seams, ["p", "s"])
    return replaced.select("id", "other").union(longer.select("id", "other")).union(longer.select("other", "id"))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n, near, best_n, best: what each word meets in its node pairs' groups.

    Rows come by group: its holes, the most frequent first, then the seam.
    """
    rest = None
    for b in batches:
        rows = np.stack([c.cast(pa.int64()).to_numpy() for c in b.columns])
        rows = rows if rest is None else np.concatenate([rest, rows], 1)
        last = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(0))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
        rest = rows[:, cut:]
        yield _groups(rows[:, :cut])
    if rest is not None:
        yield _groups(rest)


def _groups(rows: np.ndarray) -> pa.RecordBatch:
    p, s, hole, lead, id_, n = rows
    names, many = ["id", "n", "near", "best_n", "best"], len(p)
    if not many:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 5, names=names)
    start = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    size = np.diff(np.append(start, many))
    last = start + size - 1
    seam = np.where(hole[last] == 0, last, -1)
    holes = size - (seam >= 0)
    group = np.repeat(np.arange(len(start)), size)
    at, first = np.arange(many), start[group]
    # a hole meets the group's other holes and, if it leads, the seam
    other = np.where(at == first, np.where(holes[group] > 1, first + 1, -1), first)
    joint = np.where((lead == 1) & (seam[group] >= 0), seam[group], -1)
    better = (joint >= 0) & ((other < 0) | (n[joint] > n[other]) | ((n[joint] == n[other]) & (id_[joint] < id_[other])))
    best = np.where(better, joint, other)
    near = holes[group] - 1 + (joint >= 0)
    # the seam meets the holes that lead
    leads = np.add.reduceat(lead, start)
    top = np.minimum.reduceat(np.where(lead == 1, at, many), start)
    its = hole == 0
    near[its] = leads[group[its]]
    best[its] = np.where(leads[group[its]] > 0, top[group[its]], -1)
    some = np.flatnonzero(near > 0)
    best = best[some]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (id_[some], n[some], near[some], n[best], id_[best])], names=names)


def neighbours(table: DataFrame) -> DataFrame:
    """id, n, n_near and the most frequent near word (best_n, best) of every word that has one."""
    groups = pairs(table).repartition("p", "s").sortWithinPartitions("p", "s", F.desc("hole"), F.desc("n"), "id")
    met = groups.select("p", "s", "hole", "lead", "id", "n").mapInArrow(_met, "id long, n long, near long, best_n long, best long")
    first = F.max(F.struct("best_n", (-F.col("best")).alias("minus")))
    return met.groupBy("id", "n").agg(F.sum("near").alias("n_near"), first.alias("first")).select(
        "id", "n", "n_near", F.col("first.best_n").alias("best_n"), (-F.col("first.minus")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """id, root of every (id, form): following forms to the last one.

    Each step skips as far as known: chains halve in length each round, and a
    form's count is ``FORM_RATIO`` times its word's, so they are short.
    """
    at = written(forms.select("id", F.col("form").alias("root")), "variants-roots")
    while True:
        step = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        on = at.join(step, "root", "left")
        if on.filter(F.col("further").isNotNull()).isEmpty():
            return at
        at = written(on.select("id", F.coalesce("further", "root").alias("root")), "variants-roots")


def variants(docs: DataFrame, form_ratio: int = FORM_RATIO, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word; ``rules`` as for ``words``."""
    vocabulary = written(words(docs, key=key, text=text, **rules), "variants-words")
    table = entries(vocabulary)
    near = written(neighbours(table), "variants-near")
    has = near.filter(F.col("best_n") >= F.col("n") * form_ratio).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    of = table.select("id", "word")
    known = (has.join(roots(has), "id")
             .join(of.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
             .join(of.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
             .select("id", "form_word", "root_word", "form_n"))
    out = table.select("id", "word", "n").join(near.select("id", "n_near"), "id", "left").join(known, "id", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op13(docs: DataFrame) -> DataFrame:
    return variants(docs)
