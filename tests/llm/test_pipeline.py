import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from dropgate.llm import neardup, rules, substrings
from dropgate.llm.common import table
from llm.conftest import SF


def test_stages_in_order(spark, tmp_root):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_root}/{name}")
        docs = spark.read.parquet(f"{tmp_root}/{name}")
        assert docs.columns == columns
        seen.append(docs.count())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mixing", "packing"]
    assert seen[0] < table(spark, SF, "documents").count() and seen[1] < seen[0]
    # each stage left nothing for itself to find
    first = spark.read.parquet(f"{tmp_root}/quality_rules")
    assert rules.keep_good(first).count() == seen[0]
    second = spark.read.parquet(f"{tmp_root}/near_dedup")
    assert neardup.keep_one(second).count() == seen[1]
    third = spark.read.parquet(f"{tmp_root}/substring_dedup")
    assert substrings.op10(third).selectExpr("sum(n_removed)").first()[0] == 0
    # the windows hold the last stage's input, piece by piece
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.selectExpr("sum(n_tokens)").first()[0] == want


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["sequence_id", "tokens", "n_tokens", "pieces"]
    assert out.filter("n_tokens > 1024 OR (size(tokens) <> 1024 AND size(tokens) <> n_tokens)").count() == 0


def through(spark, docs):
    """All stages, each one's result written and read again, as run() does."""
    from dropgate.llm.common import written
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, None)
        assert out.columns == docs.columns
        docs = written(out, f"test-{name}")
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, None)


def test_odd_rows_and_clashing_columns(spark, odd_docs, odd_rows):
    kept, windows = through(spark, odd_docs)
    texts = {t for _, t, _ in odd_rows if t}
    rows = kept.select("doc_id", "text").collect()
    assert rows and all(r.text and any(r.text in t or r.text.split()[0] in t for t in texts) for r in rows)
    assert windows.count() > 0


def test_no_documents(spark, no_docs):
    kept, windows = through(spark, no_docs)
    assert kept.collect() == [] and windows.collect() == []
