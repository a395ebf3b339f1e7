"""Route files (rows carrying ``_source_file``) to targets by pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropgate.functions.globs import glob_match, match_count, matched_value
from dropgate.operators.messages import msg


def match_patterns(files: DataFrame, patterns: list[str], path_col: str = "_source_file",
                   case_sensitive: bool = False) -> DataFrame:
    """Adds ``n_matches`` and ``matched_pattern`` (null unless exactly one)."""
    return files.withColumns({
        "n_matches": match_count(path_col, patterns, case_sensitive),
        "matched_pattern": matched_value(path_col, {p: p for p in patterns}, case_sensitive),
    })


def route(df: DataFrame, mapping: dict[str, str], path_col: str = "_source_file",
          case_sensitive: bool = False, target_col: str = "target") -> DataFrame:
    """Adds ``target`` (folder of the single matching pattern, else null)."""
    return df.withColumn(target_col, matched_value(path_col, mapping, case_sensitive))


def routing_findings(files: DataFrame, patterns: list[str], path_col: str = "_source_file",
                     case_sensitive: bool = False) -> DataFrame:
    """One finding per file: unmatched / ambiguous files fail."""
    m = match_patterns(files, patterns, path_col, case_sensitive)
    names = F.concat_ws(", ", F.filter(F.array(*[F.when(glob_match(path_col, p, case_sensitive), F.lit(p))
                                                 for p in patterns]), lambda x: x.isNotNull()))
    text = (F.when(F.col("n_matches") == 0,
                  F.concat(F.lit(msg("no_pattern")), F.col(path_col)))
           .when(F.col("n_matches") > 1,
                 F.concat(F.lit(msg("many_patterns")), F.col(path_col), F.lit(": "), names)))
    return m.select(path_col, F.lit("pattern_match").alias("check"), F.lit(None).cast("string").alias("column"),
                    F.lit("fail").alias("severity"), (F.col("n_matches") == 1).alias("passed"),
                    F.when(F.col("n_matches") == 1, 0).otherwise(1).cast("long").alias("n_bad"),
                    text.alias("message"), F.lit(None).cast("array<string>").alias("samples"))
