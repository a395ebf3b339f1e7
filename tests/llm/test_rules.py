import re

import pytest
from oracle_compare import compare, duck

from dropgate.llm import queries, rules
from llm.conftest import SF, shape

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    ws = WORD.findall(t)
    grams = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    covered = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force(odd_docs, odd_rows):
    got = {(r.doc_id, r.text): tuple(r[c] for c in rules.MEASURES[:5]) for r in rules.measures(odd_docs).collect()}
    for i, t, _ in odd_rows:
        if t is None or len(t) < 40_000:
            assert got[i, t] == brute(t), i


def test_ledger_policies_and_ablations(odd_docs, odd_rows):
    led = rules.ledger(odd_docs)
    assert led.count() == len(odd_rows)
    rows = rules.apply_policy(led, "v2").collect()
    for r in rows:
        assert r.kept == (r.failed_rules == 0)
        assert bool(r.failed_rules & 1) == (r.n_words < 20)
    got = {r.rule: (r.fails, r.only_this) for r in rules.ablations(led, "v2").collect()}
    for bit, (name, _) in rules._rules().items():
        assert got[name] == (sum(r.failed_rules >> bit & 1 for r in rows), sum(r.failed_rules == 1 << bit for r in rows))


def test_keep_good_keeps_columns(odd_docs):
    good = rules.keep_good(odd_docs)
    assert good.columns == odd_docs.columns
    assert all(r.text and len(r.text.split()) >= 20 for r in good.collect())


def test_empty(no_docs):
    assert rules.op6(no_docs).count() == 0
    assert rules.ablations(rules.ledger(no_docs), "v1").count() == 0


def test_native_plan(odd_docs):
    plan = rules.op6(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    ok, msg = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name])
    assert ok, msg


def test_reruns_agree(odd_docs):
    assert shape(rules.op6(odd_docs)) == shape(rules.op6(odd_docs.repartition(5)))
