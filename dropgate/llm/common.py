"""Helpers that several operators share."""

from __future__ import annotations

import random
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.session import scratch_path

# A word: a run of characters that are neither blanks nor ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder, read it back.

    Unlike ``checkpoint()`` this runs the plan once, keeps columns prunable
    and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Working column names that clash with none of ``df``'s columns."""
    have, out = {c.lower() for c in df.columns}, []
    for w in wanted:
        name = w
        while name.lower() in have:
            name = f"{w}_{''.join(random.choices(string.ascii_lowercase, k=4))}"
        have.add(name.lower())
        out.append(name)
    return out


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo; never for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, limit: int) -> DataFrame:
    """doc_id, y and text of at most ``limit`` labelled documents that are not held out.

    The sample is the rows with the least hash of the id. Rows without an id or a
    label take no part; of several labels of an id the largest counts.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    sample = (ids.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
