"""Token counts by the whole-token shortcut.

Offline, every string of the vocabulary is proven or refuted as a *whole
token*: a pre-token that the merges turn into exactly that one token. Counting
then looks the pieces of a text up in the proven set; only the others are
merged, once per distinct piece and worker (a bounded cache).

Texts are cut where no merge can cross: the byte-level pattern always ends a
pre-token before a blank that follows a non-blank, and around a line break
between non-blanks. Texts with other or repeated white space, or with a
special token's string, are merged whole instead.

Defined results: a null or empty text has 0 bytes and 0 tokens. Texts are
counted whole whatever their length; repeated rows are counted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.llm import bpe

CACHE_ENTRIES = 400_000  # of a worker; emptied when full, so memory stays bounded
CACHED_LENGTH = 48       # longer pieces rarely come again

# white space besides blank and line break
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token, proven on every entry.

    Entries that are not valid UTF-8 alone (parts of characters) can never be
    a whole piece of text.
    """
    enc, proven = bpe.encoder(path), set()
    for raw, i in enc.strings.items():
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if enc.ids(s).tolist() == [i]:
            proven.add(s)
    return frozenset(proven)


class _Counts(dict):
    """piece -> tokens: whole tokens are preset to 1, the rest merged on a miss."""

    def __init__(self, path: str, lead: str):
        self.enc, self.lead = bpe.encoder(path), lead
        self.whole = {s[len(lead):]: 1 for s in whole_tokens(path) if s.startswith(lead)}
        super().__init__(self.whole)

    def __missing__(self, piece: str) -> int:
        n = self.enc.count(self.lead + piece)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.whole)
            self[piece] = n
        return n


class Counter:
    def __init__(self, path: str):
        self.enc = bpe.encoder(path)
        self.first, self.rest = _Counts(path, ""), _Counts(path, " ")

    def cuttable(self, text: str) -> bool:
        return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text
                    or _OTHER_SPACE.search(text) or self.enc.has_special(text))

    def count(self, text: str) -> int:
        if not self.cuttable(text):
            return self.enc.count(text)
        n, first, rest = 0, self.first, self.rest.__getitem__
        for k, line in enumerate(text.split("\n")):
            head, *tail = line.split(" ")
            n += (first["\n"] if k else 0) + first[head] + sum(map(rest, tail))
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes and n_tokens of every text."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for b in batches:
            n = [count(t) for lo in range(0, len(b), 256) for t in b.column(2).slice(lo, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             names=[key, "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long")


def op7(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    return token_counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
