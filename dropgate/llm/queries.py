"""The subpackage's queries, each bound to the whole tables of a corpus folder."""

from __future__ import annotations

import public_tokenizers

from dropgate.llm import alignment, htmltext, langid, mixing, neardup, oracle, packing, quality, rules, substrings, tokencount, topk, toxicity, variants
from dropgate.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {
    "op1_mixing": lambda spark, d: mixing.op1(table(spark, d, "documents")),
    "op2_toxicity": lambda spark, d: toxicity.op2(table(spark, d, "documents"), table(spark, d, "labels")),
    "op3_near_dedup": lambda spark, d: neardup.op3(table(spark, d, "documents")),
    "op4_quality": lambda spark, d: quality.op4(table(spark, d, "documents"), table(spark, d, "labels")),
    "op5_topk_search": lambda spark, d: topk.op5(table(spark, d, "embeddings")),
    "op6_quality_rules": lambda spark, d: rules.op6(table(spark, d, "documents")),
    "op7_token_counts": lambda spark, d: tokencount.op7(table(spark, d, "documents"), VOCABULARY),
    "op8_packing": lambda spark, d: packing.op8(table(spark, d, "documents"), VOCABULARY),
    "op9_html_text": lambda spark, d: htmltext.op9(table(spark, d, "pages")),
    "op10_substring_dedup": lambda spark, d: substrings.op10(table(spark, d, "documents")),
    "op11_alignment": lambda spark, d: alignment.op11(table(spark, d, "documents"), VOCABULARY, PIECES),
    "op12_language_id": lambda spark, d: langid.op12(table(spark, d, "documents")),
    "op13_variants": lambda spark, d: variants.op13(table(spark, d, "documents")),
}

ORACLE_SQL: dict[str, str] = {
    "op3_near_dedup": oracle.NEAR_DEDUP,
    "op5_topk_search": oracle.TOPK,
    "op6_quality_rules": oracle.RULES,
    "op10_substring_dedup": oracle.SUBSTRINGS,
    "op13_variants": oracle.VARIANTS,
}
