"""(X9) Dimension merge and facts: keys, intervals, nulls, repeats."""

from dropgate.operators import star

N, A = ["id", "country"], ["name", "size"]
SCHEMA = "id int, country string, name string, size int, amount double"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def dim(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keys_stay_and_intervals_close(spark, tmp_root):
    one = rows(spark, (1, "a", "x", 1, 5.0), (1, "a", "x", 1, 6.0), (2, "a", "y", None, 1.0), (None, "b", "z", 3, 2.0))
    two = rows(spark, (1, "a", "x", 1, 7.0), (2, "a", "y", 9, 1.5), (0, "c", "new", 4, 3.0), (None, "b", "z", 3, 9.0))
    d1 = star.merge_dimension(None, one, N, A, "r1")
    d1.write.parquet(f"{tmp_root}/d1")
    d1 = spark.read.parquet(f"{tmp_root}/d1")
    assert dim(d1) == sorted([(1, None, "b", "z", 3, "r1", None), (2, 1, "a", "x", 1, "r1", None), (3, 2, "a", "y", None, "r1", None)], key=repr)
    d2 = star.merge_dimension(d1, two, N, A, "r2")
    d2.write.parquet(f"{tmp_root}/d2")
    d2 = spark.read.parquet(f"{tmp_root}/d2")
    assert dim(d2) == sorted([(1, None, "b", "z", 3, "r1", None), (2, 1, "a", "x", 1, "r1", None), (3, 2, "a", "y", None, "r1", "r2"),
                              (3, 2, "a", "y", 9, "r2", None), (4, 0, "c", "new", 4, "r2", None)], key=repr)
    # the run once more, on its own result
    assert dim(star.merge_dimension(d2, two, N, A, "r2")) == dim(d2)
    # a repeat that brings other rows replaces what the first attempt did
    assert dim(star.merge_dimension(d2, one, N, A, "r2")) == dim(d1)
    facts = star.facts(one, d2, N, A, "r1").union(star.facts(two, d2, N, A, "r2"))
    assert facts.columns == ["amount", "key", "run"] and facts.filter("key is null").count() == 0
    back = star.joined_back(facts, d2).select(*SCHEMA.replace(" int", "").replace(" string", "").replace(" double", "").split(", "))
    assert dim(back) == dim(one.union(two))


def test_disagreeing_rows_and_odd_names(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 0)], "`a.b` int, `c``d` string, v int")
    d = star.merge_dimension(None, df, ["a.b"], ["c`d"], "r")
    assert dim(d) == [(1, 1, "y", "r", None)]
    assert dim(star.facts(df, d, ["a.b"], ["c`d"], "r")) == [(0, 1, "r"), (1, 1, "r")]


def test_numbers_follow_the_order_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("CAST(pmod(id * 7919, 5000) AS int) AS x")
    got = star.numbered(df, ["x"], 10).collect()
    assert sorted((r.x, r.key) for r in got) == [(k, k + 10) for k in range(5000)]


def test_no_rows(spark):
    none = rows(spark, (1, "a", "x", 1, 5.0)).limit(0)
    d = star.merge_dimension(None, none, N, A, "r")
    assert d.collect() == [] and star.facts(none, d, N, A, "r").collect() == []
