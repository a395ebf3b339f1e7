import random

import pytest

SF = "/root/testdata/sf0.001"


def sentence(rng, n):
    return [rng.choice(("the", "a", "Lorem", "ipsum", "dolor", "éa", "über", "wörld")) + str(rng.randrange(400)) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(5)
    rows, passage = [], sentence(rng, 60)
    long = sentence(rng, 30_000)
    base = sentence(rng, 200)
    rows += [(i, " ".join(sentence(rng, rng.randrange(1, 300))), f"s{i % 3}") for i in range(40)]
    rows += [(50 + i, " ".join(base[:i * 7] + ["changed"] + base[i * 7 + 1:]), "s1") for i in range(12)]  # near copies
    rows += [(70 + i, "\n".join([" ".join(sentence(rng, 30)), " ".join(passage), " ".join(sentence(rng, 20))]), "s2") for i in range(5)]
    rows += [(80, " ".join(long), "s0"), (81, " ".join(long[:15_000] + ["x"] + long[15_000:]), "s0")]
    rows += [(90, rows[3][1], "s0"), (90, rows[3][1], "s0"), (90, rows[3][1], "s0"), (91, rows[3][1].upper(), "s0")]
    rows += [(100, None, "s0"), (101, "", None), (102, " \n\t ", ""), (103, "one", "s1"), (104, "ONE", "s1"), (105, "one two", None)]
    rows += [(None, rows[5][1], "s1"), (None, None, None), (None, " ".join(sentence(rng, 80)), "é")]
    rows += [(110, "same line of five words\n" * 30, "s1"), (111, "REP! " * 100, "s1"), (112, "a|b # * " * 40, "s2"), (113, "ab" * 5000, "s2")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with further columns, some named as the operators' own."""
    out = [(i, t, s, None if t is None else len(t), "en", 7, 1, "z", 3.0, True, False, 5, "t") for i, t, s in odd_rows]
    return spark.createDataFrame(out, "doc_id long, text string, source string, n_chars long, lang string, size int, rank int, "
                                      "row string, n_words double, kept boolean, "
                                      "stays boolean, k int, tag string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def shape(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
