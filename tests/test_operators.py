"""Unit tests per operator on small in-memory frames (nulls, NaN, missing
columns, wrong types, duplicate keys)."""

import fnmatch
import math

import pytest
from pyspark.sql import functions as F

from dropgate.errors import RegistryError, TransformError
from dropgate.functions.globs import glob_regex
from dropgate.functions.strings import strip_whitespace
from dropgate.operators import checks as C
from dropgate.operators import joins
from dropgate.operators.aggregate import aggregate
from dropgate.operators.routing import match_patterns, routing_findings
from dropgate.operators.snapshot import new_ids, snapshot_union
from dropgate.operators.transforms import TRANSFORMS, TransformContext, apply_chain, compile_chain, enrich


def _t(spark, df, fn, **params):
    return TRANSFORMS[fn](df, TransformContext(), **params)


# ---------------------------------------------------------------- functions

@pytest.mark.parametrize("pattern", ["*sales*", "*_sales_*", "*sales*FR*", "test_*.csv", "a?c", "[!x]*", "*"])
def test_glob_matches_fnmatch(spark, pattern):
    paths = ["SALES/FR_sales_x.csv", "FR_sales_data.csv", "sales_data.csv", "test_1.csv", "abc", "xyz",
             "US/US_inventory_a.csv", "a/b/c"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r["p"] for r in df.filter(F.col("p").rlike(glob_regex(pattern, case_sensitive=True))).collect()}
    assert got == {p for p in paths if fnmatch.fnmatchcase(p, pattern)}


def test_glob_case_insensitive_default(spark):
    df = spark.createDataFrame([("SALES/FR_sales_x.csv",)], "p string")
    m = match_patterns(df, ["*sales*FR*", "*inventory*"], path_col="p").first()
    assert m["n_matches"] == 1 and m["matched_pattern"] == "*sales*FR*"
    m2 = match_patterns(df, ["*sales*FR*"], path_col="p", case_sensitive=True).first()
    assert m2["n_matches"] == 0


def test_routing_rejects(spark):
    df = spark.createDataFrame([("a_sales_inventory.csv",), ("none.csv",), ("x_sales.csv",)], "_source_file string")
    f = {r["_source_file"]: r for r in routing_findings(df, ["*sales*", "*inventory*"]).collect()}
    assert f["x_sales.csv"]["passed"]
    assert not f["none.csv"]["passed"] and "no registry pattern" in f["none.csv"]["message"]
    assert not f["a_sales_inventory.csv"]["passed"] and "several registry patterns" in f["a_sales_inventory.csv"]["message"]


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("  a b\t\n",), (None,), ("  ",)], "s string")
    assert [r[0] for r in df.select(strip_whitespace("s")).collect()] == ["a b", None, ""]


# ---------------------------------------------------------------- transforms

def test_case_transform_rules(spark):
    df = spark.createDataFrame([("aB",)], "x string")
    with pytest.raises(TransformError):
        _t(spark, df, "case_transform", columns=["x"], to_uppercase=True, to_lowercase=True)
    with pytest.raises(TransformError):
        _t(spark, df, "case_transform", columns=["x"])
    assert _t(spark, df, "case_transform", columns=["x", "missing"], to_lowercase=True).first()[0] == "ab"


def test_arithmetic(spark):
    df = spark.createDataFrame([(2147483647, 2, 10.0, 0.0), (3, None, 9.0, 3.0)], "a int, b int, n double, d double")
    out = _t(spark, df, "multiply_columns", columns_to_multiply=["a", "b"], output_column="m")
    assert [r["m"] for r in out.collect()] == [4294967294, None]  # widened to long, null propagates
    out = _t(spark, df, "divide_columns", numerator_column="n", denominator_column="d", output_column="q")
    assert [r["q"] for r in out.collect()] == [None, 3.0]  # zero denominator -> null
    out = _t(spark, df, "subtract_columns", minuend_column="n", subtrahend_columns=["d", "d"], output_column="s")
    assert [r["s"] for r in out.collect()] == [10.0, 3.0]
    out = _t(spark, df, "sum_columns", columns_to_sum=["a", "b"], output_column="t")
    assert [r["t"] for r in out.collect()] == [2147483649, None]
    with pytest.raises(TransformError):
        _t(spark, df.withColumn("s", F.lit("x")), "multiply_columns", columns_to_multiply=["a", "s"], output_column="m")
    with pytest.raises(TransformError):
        _t(spark, df, "multiply_columns", columns_to_multiply=["a", "zz"], output_column="m")


def test_drop_rename_filter_nulls(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5)], "k int, s string, v int")
    with pytest.raises(TransformError):
        _t(spark, df, "drop_columns", columns=["nope"])
    assert _t(spark, df, "drop_columns", columns=["s"]).columns == ["k", "v"]
    assert _t(spark, df, "rename_columns", column_mapping={"s": "t"}).columns == ["k", "t", "v"]
    assert _t(spark, df, "filter_rows", column="k", operator=">=", value=2).count() == 1
    with pytest.raises(TransformError):
        _t(spark, df, "filter_rows", column="k", operator="~", value=2)
    assert _t(spark, df, "drop_nulls", subset=["s"]).count() == 1
    assert _t(spark, df, "drop_nulls").count() == 0


def test_enrich_semantics(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (4, "w")], "k long, name string")
    m = spark.createDataFrame([(1, "A", "n1"), (2, "B", "n2"), (2, "C", "n3"), (None, "N", "nn")],
                              "key long, attr string, name string")
    out = enrich(df, m, "k", "key", ["attr", "name"], hit_column="__hit")
    rows = sorted((r["k"], r["attr"], r["name"], r["name_right"], r["__hit"]) for r in out.collect()
                  if r["k"] is not None)
    assert rows == [(1, "A", "x", "n1", True), (2, "B", "y", "n2", True), (2, "C", "y", "n3", True),
                    (4, None, "w", None, None)]
    assert out.filter(F.col("k").isNull()).first()["attr"] is None  # null keys never match
    with pytest.raises(TransformError):
        enrich(df, m, "k", "key", [])


def test_salted_join_equals_plain(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k long, v long")
    right = spark.createDataFrame([(1, "hot"), (3, "three"), (6, "six")], "rk long, a string")
    plain = left.join(right, left.k == right.rk, "left").select("k", "v", "a")
    salted = joins.left_join(left, right, ["k"], ["rk"], max_broadcast_rows=0).select("k", "v", "a")
    assert sorted(plain.collect()) == sorted(salted.collect())
    hashed = lambda *v: left.select(F.xxhash64(*[F.lit(x).cast("long") for x in v])).first()[0]
    assert joins.hot_keys(left, [left["k"]], fraction=0.1) == [hashed(1)]
    two = left.withColumn("k2", F.col("k") * 2)
    assert joins.hot_keys(two, [two["k"], two["k2"]], fraction=0.1) == [hashed(1, 2)]
    r2 = right.withColumn("rk2", F.col("rk") * 2)
    plain2 = two.join(r2, (two.k == r2.rk) & (two.k2 == r2.rk2), "left").select("k", "v", "a")
    salted2 = joins.left_join(two, r2, ["k", "k2"], ["rk", "rk2"], max_broadcast_rows=0).select("k", "v", "a")
    assert sorted(plain2.collect()) == sorted(salted2.collect())


def test_chain_order_and_unknown(spark):
    with pytest.raises(RegistryError):
        compile_chain([{"function": "nope"}, {"function": "also_nope"}])
    spec = [{"name": "b", "function": "case_transform", "order": 2, "params": {"columns": ["s"], "to_uppercase": True}},
            {"name": "a", "function": "strings_strip_whitespace", "order": 1, "params": {"columns": ["s"]}},
            {"name": "c", "function": "drop_columns", "params": {"columns": ["missing"]}}]
    df = spark.createDataFrame([(" ab ",)], "s string")
    out, log = apply_chain(df, spec, TransformContext())
    assert [n for n, _, _ in log] == ["a", "b", "c"] and log[2][1] is False
    assert out.first()[0] == "AB"


# ---------------------------------------------------------------- checks

def _f(findings, check=None):
    return [r for r in findings.collect() if check is None or r["check"] == check]


def test_value_range_nulls_pass_nan_fails(spark):
    df = spark.createDataFrame([("f", 1.0), ("f", None), ("f", float("nan")), ("f", -1.0)], "_source_file string, x double")
    f = {r["check"]: r for r in _f(C.run_checks(df, {"value_range": {"x": {"min": 0, "max": 10}}}))}
    assert f["value_range.min"]["n_bad"] == 1 and not f["value_range.min"]["passed"]
    assert f["value_range.max"]["n_bad"] == 1  # NaN sorts above every number in Spark
    missing = _f(C.run_checks(df, {"value_range": {"nope": {"min": 0}}}))
    assert len(missing) == 1 and not missing[0]["passed"]


def test_null_check_markers_and_samples(spark):
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(["a", None, "NA", " ", "b", "NULL", "", "N/A", None])],
                               "_source_file string, id long, v string")
    f = _f(C.run_checks(df, {"check_null_values": {"columns": ["v"], "custom_null_values": ["", " ", "NA", "N/A", "NULL"]}},
                        sample_cols=["id"]))[0]
    assert f["n_bad"] == 7 and f["samples"] == ["1", "2", "3", "5", "6"]
    legacy = _f(C.run_checks(df, {"check_null_values": {"check_null_values": ["v"]}}))[0]
    assert legacy["n_bad"] == 2


def test_hierarchy_null_is_a_value(spark):
    df = spark.createDataFrame([("a", "X"), ("a", None), ("b", "Y"), ("b", "Y")], "lo string, hi string")
    v = C.hierarchy_violations(df, ["hi"], ["lo"]).collect()
    assert [(r["lo"], r["n_higher"]) for r in v] == [("a", 2)]


def test_missing_ids_nulls_pass(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "id long")
    m = spark.createDataFrame([(1,)], "pid long")
    assert [r[0] for r in C.missing_ids(df, "id", m, "pid").collect()] == [2]


def test_key_overlap_and_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k long")
    right = spark.createDataFrame([(2,), (9,)], "k long")
    r = C.key_overlap(left, right, ["k"]).first()
    assert (r["n_keys"], r["n_matched"], r["n_unmatched"]) == (3, 1, 2)
    d = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b")], "x long, y string")
    assert C.duplicate_row_count(d, ["x", "y"]).first()["dup_count"] == 3


def test_schema_checks_per_file(spark):
    df = spark.createDataFrame([("f1", 1, 2)], "_source_file string, a long, b long")
    keys = spark.createDataFrame([("f1", ["a", "b"]), ("f2", ["a"]), ("f3", [])],
                                 "_source_file string, __columns array<string>")
    f = C.run_checks(df, {"required_columns": ["a", "b"], "additional_columns": ["a"], "is_empty_dataframe": None},
                     keys_df=keys)
    got = {(r["_source_file"], r["check"]): (r["passed"], r["n_bad"]) for r in f.collect()}
    assert got[("f1", "required_columns")] == (True, 0)
    assert got[("f2", "required_columns")] == (False, 1)
    assert got[("f1", "additional_columns")] == (False, 1)
    assert got[("f3", "is_empty_dataframe")] == (False, 1)
    assert got[("f1", "is_empty_dataframe")] == (True, 0)


def test_unknown_check(spark):
    df = spark.createDataFrame([("f", 1)], "_source_file string, a long")
    with pytest.raises(RegistryError):
        C.run_checks(df, {"nope": None})


def test_column_types(spark):
    df = spark.createDataFrame([("f", "1", "x"), ("f", "2.5", None), ("f", None, "3")], "_source_file string, a string, b string")
    f = {r["column"]: r for r in _f(C.run_checks(df, {"column_types": {"a": "double", "b": "long"}}))}
    assert f["a"]["passed"] and f["b"]["n_bad"] == 1


# ---------------------------------------------------------------- sets / aggregation

def test_snapshot_sets(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    old = spark.createDataFrame([(2,), (5,)], "pid long")
    assert sorted(r[0] for r in new_ids(ids, old, "id").collect()) == [1]
    assert sorted(r[0] for r in snapshot_union(ids, old, "id").collect()) == [1, 2, 5]


def test_aggregate_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "g string, v double")
    out = {r["g"]: r["v"] for r in aggregate(df, ["g"], {"v": "sum"}).collect()}
    assert out == {"a": 3.0, "b": None}
    with pytest.raises(RegistryError):
        aggregate(df, ["g"], {"v": "median"})


def test_partition_count_independent(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("_source_file"),
                                  (F.col("id") % 13).cast("double").alias("x"))
    spec = {"value_range": {"x": {"min": 2, "max": 10}}}
    a = sorted(map(tuple, C.run_checks(df, spec).select("_source_file", "check", "n_bad").collect()))
    b = sorted(map(tuple, C.run_checks(df.repartition(17), spec).select("_source_file", "check", "n_bad").collect()))
    assert a == b


def test_mapping_cleaning_pushed_before_join(spark):
    from dropgate.operators.transforms import _mapping_cleaning
    from dropgate.sources.catalog import Catalog

    facts = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 4.0), (None, 1.0)], "k long, q double")
    m = spark.createDataFrame([(1, "  ab ", " x"), (2, "cd\u00a0", "y ")], "mk long, name string, brand string")
    enrich_t = {"name": "e", "function": "enrich_with_mapping", "order": 1,
                "params": {"mapping_file": "m", "df_join_column": ["k"], "mapping_key_column": ["mk"],
                           "columns_to_add": ["name", "brand"]}}
    strip_t = {"name": "s", "function": "strings_strip_whitespace", "order": 2,
               "params": {"columns": ["name", "brand", "other"]}}
    upper_t = {"name": "u", "function": "case_transform", "order": 4,
               "params": {"columns": ["name"], "to_uppercase": True}}
    filt_t = {"name": "f", "function": "filter_rows", "order": 3,
              "params": {"column": "name", "operator": "!=", "value": "AB"}}
    steps = compile_chain([enrich_t, strip_t, upper_t])
    ops, rw = _mapping_cleaning(facts.columns, steps, 0)
    assert [o[0] for o in ops] == ["strings_strip_whitespace", "case_transform"]
    assert rw[1]["columns"] == ["other"] and rw[2]["columns"] == []
    # a filter on `name` between the two blocks pushing the later upper-case
    steps2 = compile_chain([enrich_t, strip_t, filt_t, upper_t])
    ops2, _ = _mapping_cleaning(facts.columns, steps2, 0)
    assert [o[0] for o in ops2] == ["strings_strip_whitespace"]

    class Cat(Catalog):
        def exists(self, name):
            return True

        def read(self, name, version=None):
            return m

    for spec, expect in (([enrich_t, strip_t, upper_t], {1: ("AB", "x"), 2: ("CD", "y"), 3: (None, None)}),
                         ([enrich_t, strip_t, filt_t, upper_t], {1: ("AB", "x"), 2: ("CD", "y")})):
        out, log = apply_chain(facts, spec, TransformContext(catalog=Cat(spark)))
        assert all(ok for _, ok, _ in log)
        got = {r["k"]: (r["name"], r["brand"]) for r in out.collect() if r["k"] is not None}
        assert got == expect


def test_markers_by_type(spark):
    from pyspark.sql import types as T
    from dropgate.functions.strings import is_null_or_marker, possible_markers
    assert possible_markers(T.DoubleType(), ["", "NA", "0", "NaN"]) == ["0", "NaN"]
    assert possible_markers(T.StringType(), ["", "NA"]) == ["", "NA"]
    df = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (1.5,)], "x double")
    got = [r[0] for r in df.select(is_null_or_marker("x", ["", "NA", "NaN"], T.DoubleType())).collect()]
    assert got == [False, True, True, False]


def test_sales_inventory_consistency_and_referential(spark, tmp_root):
    from dropgate.sources.catalog import Catalog, TableSpec
    cat = Catalog(spark, {"static.mappings.inventory_snapshot": TableSpec(path=f"{tmp_root}/snap"),
                          "static.mappings.product_mapping": TableSpec(path=f"{tmp_root}/map")})
    sales = spark.createDataFrame([("f1", "P1"), ("f1", "P2"), ("f2", "P9"), ("f3", None)],
                                  "_source_file string, product_id string")
    spec = {"sales_inventory_consistency": ["product_id"],
            "validate_product_ids": {"product_id_column": "product_id", "product_id_master_column": "product_id"}}
    missing = {(r["check"], r["passed"]) for r in C.run_checks(sales, spec, catalog=cat).collect()}
    assert missing == {("sales_inventory_consistency", False), ("validate_product_ids", False)}
    spark.createDataFrame([("P1",), ("P2",)], "product_id string").write.parquet(f"{tmp_root}/snap")
    spark.createDataFrame([("P1",), ("P2",), ("P3",)], "product_id string").write.parquet(f"{tmp_root}/map")
    f = C.run_checks(sales, spec, catalog=cat)
    got = {}
    for r in f.collect():
        got.setdefault((r["_source_file"], r["check"]), []).append((r["passed"], r["n_bad"], r["samples"]))
    assert got[("f1", "sales_inventory_consistency")] == [(True, 0, None)]
    assert got[("f2", "sales_inventory_consistency")] == [(False, 1, None)]
    assert (False, 1, ["P9"]) in got[("f2", "validate_product_ids")]
    assert all(p for p, _, _ in got[("f1", "validate_product_ids")])
    assert all(p for p, _, _ in got[("f3", "validate_product_ids")])  # null ids pass


def test_enrich_report_distinct_examples(spark):
    from dropgate.sources.catalog import Catalog

    facts = spark.createDataFrame([("f", 9), ("f", 9), ("f", 9), ("f", 8), ("f", 1), ("g", 1)],
                                  "_source_file string, k long")
    m = spark.createDataFrame([(1, "a")], "mk long, name string")

    class Cat(Catalog):
        def exists(self, name):
            return True

        def read(self, name, version=None):
            return m

    report = C.CheckContext(df=facts, key="_source_file")
    ctx = TransformContext(catalog=Cat(spark), report=report)
    out, log = apply_chain(facts, [{"name": "e", "function": "enrich_with_mapping",
                                    "params": {"mapping_file": "m", "df_join_column": ["k"],
                                               "mapping_key_column": ["mk"], "columns_to_add": ["name"]}}], ctx)
    report.df = out
    f = {r["_source_file"]: r for r in C.evaluate(report).collect()}
    assert f["f"]["n_bad"] == 4 and f["f"]["samples"] == ["8", "9"]
    assert f["g"]["n_bad"] == 0 and f["g"]["samples"] is None


def test_text_report_bounded(spark):
    from dropgate.plans.findings import text_report
    rows = [("r", "s", "f", "check_hierarchy", "c", "fail", False, 1, f"v{i:03d}", None) for i in range(7)]
    rows.append(("r", "s", "g", "x", None, "fail", True, 0, None, None))
    from dropgate.plans.findings import FINDINGS_SCHEMA
    df = spark.createDataFrame(rows, FINDINGS_SCHEMA)
    rep = {r["source_file"]: r["report"] for r in text_report(df, max_lines=3).collect()}
    assert list(rep) == ["f"]
    assert rep["f"].split("\n") == ["check_hierarchy: v000", "check_hierarchy: v001", "check_hierarchy: v002",
                                    "(+4 more failing findings in the findings table)"]


def test_value_range_text_bounds_and_underscore_columns(spark):
    df = spark.createDataFrame([("f", "2025-01-05", "x"), ("f", "2024-12-31", "y")],
                               "_source_file string, date string, _extra string")
    f = {r["check"]: r for r in C.run_checks(df, {"value_range": {"date": {"min": "2025-01-01"}}}).collect()}
    assert f["value_range.min"]["n_bad"] == 1
    keys = spark.createDataFrame([("f", ["date", "_extra"])], "_source_file string, __columns array<string>")
    a = C.run_checks(df, {"additional_columns": ["date"]}, keys_df=keys).first()
    assert not a["passed"] and a["n_bad"] == 1


def test_broadcast_proof_counts_bytes(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, None)], "k long, s string")
    assert joins.bounded_size(df, 10) == (2, 8 + 4 + 8)
    assert joins.bounded_size(df, 1) is None
    assert joins.provably_small(df, 10, max_bytes=100)
    assert not joins.provably_small(df, 10, max_bytes=10)
