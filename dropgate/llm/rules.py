"""Quality rules as a bitmask ledger (DataFrame functions only).

``ledger`` evaluates every rule once per document and stores the failures as
bits of one long plus the measurements behind them. A policy is a versioned
set of rules, itself a bitmask; applying one, changing one and measuring what
each rule contributes (``ablations``) are bitwise operations over the ledger
and never touch the texts again.

Defined results: a null or empty text has no words, so every count is 0 and
``too_few_words`` fails. Repeated rows each keep their own ledger row. Very
long texts are handled whole: the n-gram test costs O(n log n) per document.
Other columns pass through ``ledger`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropgate.llm.common import free_names, words

SYMBOLS = r"[#*$%&|<>]"
SHOUTED = r"\p{Lu}{4,}"  # runs of capitals
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouted",
            "n_lines_with_words")



def _rules() -> dict[int, tuple[str, Column]]:
    c = F.col
    return {
        0: ("too_few_words", c("n_words") < 20),
        1: ("repeated_ngrams", 100 * c("n_repeat_words") > 30 * c("n_words")),
        2: ("many_symbols", 100 * c("n_symbols") > 30 * c("n_words")),
        3: ("duplicate_lines", (c("n_dup_lines") >= 5) & (100 * c("n_dup_lines") > 40 * c("n_lines_with_words"))),
        4: ("shouting", 100 * c("n_shouted") > 50 * c("n_words")),
        5: ("overlong_words", c("word_chars") > 30 * c("n_words")),
    }


# version -> rules a document must pass; versions are only ever added
POLICIES = {
    "base": ("too_few_words", "repeated_ngrams"),
    "v1": ("too_few_words", "repeated_ngrams", "many_symbols", "duplicate_lines"),
    "v2": ("too_few_words", "repeated_ngrams", "many_symbols", "duplicate_lines", "shouting", "overlong_words"),
}


def policy_mask(version: str) -> int:
    bit = {name: b for b, (name, _) in _rules().items()}
    return sum(1 << bit[r] for r in POLICIES[version])


def _with(value: Column, body) -> Column:
    """Bind ``value`` once: lambdas re-evaluate outer expressions per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(ws: Column) -> Column:
    """Words inside WINDOW-word windows that occur twice or more in ``ws``."""
    n = F.size(ws)

    def from_hashes(h: Column) -> Column:
        # (hash, position) sorted: equal windows are neighbours
        def from_sorted(s: Column) -> Column:
            def twice(x, j):
                before = (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
                after = F.get(s, j + 1)["h"] == x["h"]
                return before | F.coalesce(after, F.lit(False))

            starts = F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))
            return _with(starts, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                F.lit(0), lambda a, x: a + x))

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_with(pairs, from_sorted))

    def from_word_hashes(wh: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(wh) - WINDOW),
                             lambda i: F.xxhash64(*[F.get(wh, i + k) for k in range(WINDOW)]))
        return _with(hashes, from_hashes)

    return F.when(n <= WINDOW, F.lit(0)).otherwise(
        _with(F.transform(ws, lambda w: F.xxhash64(w)), from_word_hashes))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of MEASURES (existing columns of these names are replaced)."""
    ws_col, lines_col = free_names(df, "_words", "_lines")
    keep = [c for c in df.columns if c not in MEASURES]
    t = F.col(text)
    # lines with a word; a line differs from another by any character
    with_word = F.filter(F.split(F.coalesce(t, F.lit("")), "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    base = df.select(*keep, words(t).alias(ws_col), with_word.alias(lines_col))
    w, lines = F.col(ws_col), F.col(lines_col)
    total = F.coalesce(F.length(F.array_join(w, "")), F.lit(0))
    return base.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        total.cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(t, F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
        F.coalesce(F.regexp_count(t, F.lit(SHOUTED)), F.lit(0)).cast("long").alias("n_shouted"),
        F.size(lines).cast("long").alias("n_lines_with_words"),
    )


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with MEASURES and ``failed_rules``: bit b is set when rule b fails."""
    m = measures(df, text)
    bits = None
    for b, (_, fails) in _rules().items():
        bit = F.when(fails, F.lit(1 << b)).otherwise(F.lit(0)).cast("long")
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return m.withColumn("failed_rules", bits)


def apply_policy(led: DataFrame, version: str, into: str = "kept") -> DataFrame:
    return led.withColumn(into, F.col("failed_rules").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablations(led: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents it fails, and those that only it fails.

    The ledger is first counted per distinct mask (at most 2^rules rows), so
    the per-rule expansion runs over masks, not documents.
    """
    mask = policy_mask(version)
    per_mask = led.groupBy(F.col("failed_rules").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << b).cast("long").alias("bit"))
                      for b, (name, _) in _rules().items() if mask >> b & 1])
    return (per_mask.select("m", "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
                 F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this")))


def keep_good(docs: DataFrame, version: str = "v2") -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    (row,) = free_names(docs, "_row")
    packed = docs.select("text", F.struct(*[F.col(c) for c in docs.columns]).alias(row))
    good = apply_policy(ledger(packed), version).filter("kept")
    return good.select(*[F.col(row)[c].alias(c) for c in docs.columns])


def op6(docs: DataFrame, version: str = "v2") -> DataFrame:
    led = apply_policy(apply_policy(ledger(docs.select("doc_id", "text")), version), "base", into="base_ok")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~F.col("base_ok")).alias("base_failed"), "kept", "failed_rules", "n_shouted")
