"""Sources and catalog: header groups, empty / hidden files, BOM, malformed
rows, typed reads, named tables, versions, runs."""

import os

import pytest
from pyspark.sql import functions as F

from dropgate.errors import RegistryError, TableNotFoundError
from dropgate.operators import checks as C
from dropgate.plans.registry import Registry
from dropgate.plans.stages import Preboarding
from dropgate.sources.catalog import Catalog, TableSpec, list_runs
from dropgate.sources.files import infer_types, list_files, read_drop, typed


def _write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture()
def drop(tmp_root):
    _write(tmp_root, "a/x_sales_1.csv", "id;price;name\n1;2.5;a\n2;3;b\n")
    _write(tmp_root, "b/x_sales_1.csv", "﻿name;id;price\nc;3;4\n")       # same base name, other folder, BOM
    _write(tmp_root, "y_sales_2.csv", "id;price\n5;oops\n6;7;8\n")            # type fault, malformed row
    _write(tmp_root, "empty_sales.csv", "")
    _write(tmp_root, "_hidden.csv", "id\n9\n")
    _write(tmp_root, "notes.txt", "hello")
    return tmp_root


def test_listing(spark, drop):
    f = {r["_source_file"]: (r["size"], r["format"]) for r in list_files(spark, drop).collect()}
    assert set(f) == {"a/x_sales_1.csv", "b/x_sales_1.csv", "y_sales_2.csv", "empty_sales.csv", "notes.txt"}
    assert f["empty_sales.csv"] == (0, "csv") and f["notes.txt"][1] is None


def test_header_groups_align_by_name(spark, drop):
    ds = read_drop(spark, drop)
    rows = {(r["_source_file"], r["id"]): (r["price"], r["name"]) for r in ds.df.collect()}
    assert rows[("b/x_sales_1.csv", "3")] == ("4", "c")
    assert rows[("a/x_sales_1.csv", "1")] == ("2.5", "a")
    cols = {r["_source_file"]: r["__columns"] for r in ds.files.collect()}
    assert cols["b/x_sales_1.csv"] == ["name", "id", "price"]
    assert cols["empty_sales.csv"] == []


def test_checks_on_drop(spark, drop):
    ds = read_drop(spark, drop)
    f = C.run_checks(ds.df, {"is_empty_dataframe": None, "required_columns": ["id", "price", "name"],
                             "column_types": {"price": "double"}, "malformed_rows": None}, keys_df=ds.files)
    bad = {(r["_source_file"], r["check"]) for r in f.filter(~F.col("passed")).collect()}
    assert ("empty_sales.csv", "is_empty_dataframe") in bad
    assert ("y_sales_2.csv", "required_columns") in bad
    assert ("y_sales_2.csv", "column_types") in bad
    assert ("y_sales_2.csv", "malformed_rows") in bad
    assert ("notes.txt", "is_empty_dataframe") in bad
    assert not [b for b in bad if b[0].endswith("x_sales_1.csv")]


def test_typed_and_inference(spark, drop):
    ds = read_drop(spark, drop)
    t = typed(ds.df, {"id": "long", "price": "double"})
    assert dict(t.dtypes)["id"] == "bigint"
    assert t.filter(F.col("_source_file") == "y_sales_2.csv").filter(F.col("id") == 5).first()["price"] is None
    assert infer_types(ds.df.filter(F.col("_source_file") != "y_sales_2.csv"), ["id", "price", "name"]) == \
        {"id": "long", "price": "double", "name": "string"}


def test_catalog(spark, tmp_root):
    cat = Catalog(spark, {"static.t": TableSpec(path=f"{tmp_root}/t", required=True),
                          "static.v": TableSpec(path=f"{tmp_root}/v", versioned=True),
                          "static.missing": TableSpec(path=f"{tmp_root}/nope", required=True)})
    assert not cat.exists("D.static.t")
    with pytest.raises(TableNotFoundError):
        cat.read("static.missing")
    cat.write("static.t", spark.range(3))
    cat.write("static.t", spark.range(3, 5), mode="append")
    assert cat.read("D.static.t").count() == 5
    req = {r["table"]: r["present"] for r in cat.required_tables().collect()}
    assert req == {"static.missing": False, "static.t": True}
    cat.write_version("static.v", spark.range(2), "20250101_000000")
    cat.write_version("static.v", spark.range(2, 3), "20250102_000000")
    cat.write_version("static.v", spark.range(2, 3), "20250102_000000")  # retried version: replaced, not doubled
    assert cat.read("static.v").count() == 3
    assert cat.read("static.v", version="20250101_000000").count() == 2
    cat.delete("static.t")
    assert not cat.exists("static.t")


def test_list_runs(spark, tmp_root):
    for r in ["20250101_000000", "20250102_000000", "20250103_000000"]:
        spark.range(1).write.parquet(f"{tmp_root}/runs/run_id={r}")
    runs = [(r["run_id"], r["run_index"]) for r in list_runs(spark, f"{tmp_root}/runs").orderBy("run_index").collect()]
    assert runs == [("20250101_000000", -3), ("20250102_000000", -2), ("20250103_000000", -1)]
    assert len(list_runs(spark, f"{tmp_root}/runs", limit=2).collect()) == 2


def test_registry_compile():
    with pytest.raises(RegistryError):
        Registry({"*": {"validators": {"nope": None, "also": None}}}, kind="validate")
    with pytest.raises(RegistryError):
        Registry({"*": {"transforms": [{"function": "nope"}]}}, kind="transform")
    with pytest.raises(RegistryError):
        Registry({"*": {"group_by": ["a"], "aggregations": {"b": "median"}}}, kind="aggregate")
    with pytest.raises(RegistryError):
        Registry({}, kind="validate")
    assert Registry({"*sales*": "SALES"}, kind="dispatch").targets == {"*sales*": "SALES"}


def test_aggregate_step_and_clear_input(spark, tmp_root):
    inp = f"{tmp_root}/in"
    _write(inp, "s_sales_1.csv", "store;qty\n1;2\n1;3\n2;5\n")
    _write(inp, "s_sales_2.csv", "store;qty\n1;10\n")
    pb = Preboarding(spark, f"{tmp_root}/out", run_id="r1")
    steps = [("0_validator", "validate", {"*sales*": {"validators": {"is_empty_dataframe": None},
                                                      "schema": {"qty": "long"}}}),
             ("agg", "aggregate", {"*sales*": {"group_by": ["_source_file", "store"],
                                               "aggregations": {"qty": "sum"}}})]
    pb.run(inp, steps, clear_input=True)
    out = {(r["_source_file"], r["store"]): r["qty"] for r in spark.read.parquet(pb.staging("agg") + "/*").collect()}
    assert out == {("s_sales_1.csv", "1"): 5, ("s_sales_1.csv", "2"): 5, ("s_sales_2.csv", "1"): 10}
    assert list_files(spark, inp).count() == 0


def test_parquet_drop_and_csv_delivery(spark, tmp_root):
    inp = f"{tmp_root}/in"
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, x double").coalesce(1).write.parquet(f"{inp}/a_sales_1")
    spark.createDataFrame([(3, 50.0)], "id long, x double").coalesce(1).write.parquet(f"{inp}/b_sales_2")
    pb = Preboarding(spark, f"{tmp_root}/out", run_id="r1", delivery_format="csv")
    steps = [("check", "validate", {"*sales*": {"validators": {"value_range": {"x": {"max": 10}}}}}),
             ("deliver", "dispatch", {"a_*": "A", "b_*": "B"})]
    outs = pb.run(inp, steps)
    assert outs[0].summary == {"files": 2, "passed": 1, "failed": 1}
    assert [f.split("/")[0] for f in outs[0].passed] == ["a_sales_1"]
    out = spark.read.option("header", "true").option("sep", ";").csv(pb.staging("deliver") + "/group=A")
    assert sorted(int(r["id"]) for r in out.collect()) == [1, 2]


def test_unreadable_file_is_isolated(spark, tmp_root):
    inp = f"{tmp_root}/in"
    spark.createDataFrame([(1, 2.0)], "id long, x double").coalesce(1).write.parquet(f"{inp}/good_sales")
    _write(inp, "bad_sales.parquet", "this is not parquet at all")
    _write(inp, "broken_sales.csv", "")
    pb = Preboarding(spark, f"{tmp_root}/out", run_id="r1")
    steps = [("check", "validate", {"*sales*": {"validators": {"value_range": {"x": {"max": 10}}}}}),
             ("deliver", "dispatch", {"*sales*": "OUT"})]
    outs = pb.run(inp, steps)
    bad = {(r["source_file"], r["check"]) for r in pb.findings().filter(~F.col("passed")).collect()}
    assert ("bad_sales.parquet", "read_file") in bad
    assert outs[0].summary["files"] == 3
    assert [p.split("/")[0] for p in outs[0].passed] == ["good_sales"]


def test_parquet_columns_per_file(spark, tmp_root):
    from dropgate.sources.files import read_drop
    inp = f"{tmp_root}/in"
    spark.createDataFrame([(1, 2.0)], "id long, x double").coalesce(1).write.parquet(f"{inp}/a_sales")
    spark.createDataFrame([(3,)], "id long").coalesce(1).write.parquet(f"{inp}/b_sales")
    ds = read_drop(spark, inp)
    cols = {f.source.split("/")[0]: f.columns for f in ds.infos}
    assert cols == {"a_sales": ["id", "x"], "b_sales": ["id"]}
    f = C.run_checks(ds.df, {"required_columns": ["id", "x"]}, keys_df=ds.files)
    got = {r["_source_file"].split("/")[0]: r["passed"] for r in f.collect()}
    assert got == {"a_sales": True, "b_sales": False}


def test_group_folders_do_not_collide(spark, tmp_root):
    inp = f"{tmp_root}/in"
    _write(inp, "one/x.csv", "id;v\n1;a\n")
    _write(inp, "one_x.csv", "id;v\n2;b\n")
    pb = Preboarding(spark, f"{tmp_root}/out", run_id="r1")
    # both patterns reduce to the folder name "one_x.csv"
    steps = [("t", "transform", {"one/x.csv": {"transforms": [{"function": "blank"}]},
                                 "one_x.csv": {"transforms": [{"function": "blank"}]}}),
             ("d", "dispatch", {"*": "ALL"})]
    pb.run(inp, steps)
    out = spark.read.parquet(pb.staging("d") + "/*")
    assert sorted(r["id"] for r in out.collect()) == ["1", "2"]


def test_transform_fails_only_files_lacking_columns(spark, tmp_root):
    inp = f"{tmp_root}/in"
    _write(inp, "a_sales.csv", "price;qty\n2;3\n")
    _write(inp, "b_sales.csv", "price\n5\n")          # no qty: cannot multiply
    pb = Preboarding(spark, f"{tmp_root}/out", run_id="r1")
    steps = [("0", "validate", {"*": {"validators": {"is_empty_dataframe": None},
                                      "schema": {"price": "double", "qty": "double"}}}),
             ("t", "transform", {"*sales*": {"transforms": [
                 {"function": "multiply_columns", "params": {"columns_to_multiply": ["price", "qty"],
                                                             "output_column": "total"}}]}}),
             ("d", "dispatch", {"*": "OUT"})]
    outs = pb.run(inp, steps)
    t = {o.step: o for o in outs}["t"]
    assert t.summary == {"files": 2, "passed": 1, "failed": 1} and t.passed == ["a_sales.csv"]
    out = spark.read.parquet(pb.staging("d") + "/*").collect()
    assert [(r["price"], r["qty"], r["total"]) for r in out] == [(2.0, 3.0, 6.0)]


def test_large_drops_are_dealt_in_parts(spark, tmp_root, monkeypatch):
    from dropgate.plans import drop_queries
    monkeypatch.setattr(drop_queries, "PART_ROWS", 500)
    rows = spark.range(4000).select(F.col("id").alias("a.b"), F.when(F.col("id") % 9 != 0, F.col("id") % 2).alias("k"))
    drop_queries._dealt_in_parts(rows, "k", "`a.b`", f"{tmp_root}/parts")
    files = spark.read.option("header", "true").option("sep", ";").csv(f"{tmp_root}/parts")
    named = files.select("k", F.input_file_name().alias("file"))
    parts = {r["k"]: r["n"] for r in named.groupBy("k").agg(F.count_distinct("file").alias("n")).collect()}
    assert set(parts) == {None, 0, 1} and parts[0] > 1 and parts[1] > 1
    assert sorted(map(int, (r[0] for r in files.select("`a.b`").collect()))) == list(range(4000))
