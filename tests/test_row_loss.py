"""Nothing of a drop gets lost between files, layouts, patterns and key types."""

import os

import pytest
from pyspark.sql import functions as F

from dropgate.operators import checks as C
from dropgate.operators import joins
from dropgate.plans.registry import Registry
from dropgate.plans.stages import Preboarding, _new_names
from dropgate.sources.catalog import Catalog, TableSpec
from dropgate.sources.files import FileInfo, read_drop


def write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def deliver(spark, root, steps, catalog=None, run_id="r"):
    pb = Preboarding(spark, f"{root}/out", run_id=run_id, catalog=catalog)
    pb.run(f"{root}/in", steps)
    return pb, spark.read.option("mergeSchema", "true").parquet(f"{pb.staging(steps[-1][0])}/*")


def test_layouts_names_and_hidden_looking_columns(spark, tmp_root):
    write(tmp_root, "in/p/sales.csv", "id;x;__note\n1;a;n1\n2;b;n2\n")
    write(tmp_root, "in/q/sales.csv", "id;y;group\n3;c;g3\n4;d;g4\n")
    write(tmp_root, "in/bad.txt", "no table")
    _, out = deliver(spark, tmp_root, [("check", "validate", {"*sales*": {"validators": {"is_empty_dataframe": None}}}),
                                       ("route", "dispatch", {"*sales*": "S"}), ("deliver", "dispatch", {"S/*": "OUT"})])
    rows = {r["id"]: r for r in out.collect()}
    assert sorted(rows) == ["1", "2", "3", "4"]
    assert rows["1"]["__note"] == "n1" and rows["4"]["group"] == "g4"
    assert len({r["_source_file"] for r in rows.values()}) == 2


def test_new_names_are_unique():
    files = [FileInfo(s) for s in ("a/x.csv", "b/x.csv", "x.csv", "c/y.csv", "T/a/x.csv")]
    names = _new_names([(f, "T") for f in files])
    assert len(set(names.values())) == len(files) and names["c/y.csv"] == "T/y.csv"


def test_faulty_files_fail_alone(spark, tmp_root):
    write(tmp_root, "in/good.csv", 'id;"a;b";t\n1;"say ""x""";"two\nlines"\n')
    write(tmp_root, "in/twice.csv", "id;ID\n1;2\n")
    write(tmp_root, "in/reserved.csv", "id;__dg__salt\n1;2\n")
    long = "c" * (1 << 20)
    write(tmp_root, "in/long_header.csv", f"id;{long}\n9;z\n")
    spark.createDataFrame([(5,)], "id long").coalesce(1).write.parquet(f"{tmp_root}/in/p1")
    spark.createDataFrame([("test",)], "id string").coalesce(1).write.parquet(f"{tmp_root}/in/p2")
    ds = read_drop(spark, f"{tmp_root}/in")
    errors = {f.source: f.error for f in ds.infos if f.error}
    assert set(errors) == {"twice.csv", "reserved.csv"}
    assert {r["id"] for r in ds.df.select("id").collect()} == {"1", "5", "test", "9"}
    row = ds.df.filter("id = '1'").first()
    assert row["a;b"] == 'say "x"' and row["t"] == "two\nlines"
    pb, out = deliver(spark, tmp_root, [("d", "dispatch", {"*": "OUT"})])
    assert out.count() == 4
    assert pb.outputs[0].summary == {"files": 6, "passed": 4, "failed": 2}


def test_schema_never_erases(spark, tmp_root):
    write(tmp_root, "in/a.csv", "price\n1.5\ntest\n")
    write(tmp_root, "in/b.csv", "price\n2.5\n")
    pb, out = deliver(spark, tmp_root, [("v", "validate", {"*": {"validators": {"value_range": {"price": {"min": 0}}}, "schema": {"price": "double"}}}),
                                        ("d", "dispatch", {"*": "OUT"})])
    assert [r["price"] for r in out.collect()] == [2.5]
    bad = {(r["check"], r["n_bad"]) for r in pb.findings().filter("NOT passed").collect()}
    assert bad == {("column_types", 1), ("value_range.number", 1)}


@pytest.mark.parametrize("rows", [0, joins.BROADCAST_MAX_ROWS])
def test_unlike_key_types_join_alike(spark, rows):
    left = spark.createDataFrame([("007" if i % 2 else f"{i:03d}", 1, i) for i in range(200)] + [("x", 1, 999)], "k string, j int, v int")
    right = spark.createDataFrame([(7, 1, "seven"), (10, 1, "ten")], "rk int, rj long, a string")
    out = joins.left_join(left, right, ["k", "j"], ["rk", "rj"], max_broadcast_rows=rows)
    assert out.filter("a = 'seven'").count() == 100
    assert out.filter("a = 'ten'").count() == 1
    assert out.count() == 201 and out.columns == ["k", "j", "v", "a"]


def test_size_proof_has_no_single_partition_limit(spark):
    df = spark.range(1000).repartition(8).withColumn("s", F.lit("abc"))
    assert joins.bounded_size(df, 1000) == (1000, 1000 * 11)
    assert joins.bounded_size(df, 999) is None


def test_snapshot_of_two_patterns_and_versions(spark, tmp_root):
    write(tmp_root, "in/a.csv", "id\n1\n2\n")
    write(tmp_root, "in/b.csv", "id;z\n3;q\n4;q\n")
    cat = Catalog(spark, {"ids": TableSpec(path=f"{tmp_root}/ids", versioned=True)})
    save = [{"function": "save_inventory_snapshot", "params": {"snapshot_file": "ids", "product_id_column": "id"}}]
    steps = [("t", "transform", {"a*": {"transforms": save}, "b*": {"transforms": save}})]
    for _ in range(2):  # a re-run of the same run changes nothing
        pb, _ = deliver(spark, tmp_root, steps, cat, run_id="001")
        assert {r["id"] for r in cat.read("ids").collect()} == {"1", "2", "3", "4"}
        assert [(r["version"], r["n_rows"]) for r in cat.versions("ids").collect()] == [("001", 4)]
    notes = pb.findings().filter("check = 'save_inventory_snapshot' AND message IS NOT NULL").collect()
    assert {r["message"] for r in notes} == {"ids: 4 id(s) added, 4 known in all"} and len(notes) == 2


def test_snapshot_holds_ids_that_later_steps_drop(spark, tmp_root):
    write(tmp_root, "in/a.csv", "id;n\n1;x\n2;\n3;y\n")
    write(tmp_root, "in/b.csv", "id;n\n4;y\n5;y\n")
    cat = Catalog(spark, {t: TableSpec(path=f"{tmp_root}/{t}", versioned=True) for t in ("first", "middle", "last")})
    save = lambda t, c="id": {"function": "save_inventory_snapshot", "params": {"snapshot_file": t, "product_id_column": c}}
    chain = [save("first"), {"function": "filter_rows", "params": {"column": "n", "operator": "is_not_null"}},
             {"function": "filter_rows", "params": {"column": "id", "operator": "!=", "value": "5"}},
             {"function": "rename_columns", "params": {"column_mapping": {"id": "key"}}}, save("middle", "key"),
             {"function": "filter_rows", "params": {"column": "n", "operator": "==", "value": "x"}}, save("last", "key"),
             {"function": "drop_nulls", "params": {}}]
    steps = [("t", "transform", {"*": {"transforms": chain}})]
    for _ in range(2):  # a re-run of the same run changes nothing
        _, out = deliver(spark, tmp_root, steps, cat, run_id="001")
        got = {t: sorted(r[0] for r in cat.read(t).collect()) for t in ("first", "middle", "last")}
        assert got["first"] == ["1", "2", "3", "4", "5"] and got["last"] == ["1"]
        assert got["middle"] == [r["id"] for r in read_drop(spark, f"{tmp_root}/in").df.filter("n IS NOT NULL AND id <> '5'").orderBy("id").collect()]
        assert [r["key"] for r in out.collect()] == ["1"]


def test_key_checks_honour_each_files_columns(spark, tmp_root):
    spark.createDataFrame([("1",)], "id string").write.parquet(f"{tmp_root}/m")
    cat = Catalog(spark, {"m": TableSpec(path=f"{tmp_root}/m")})
    write(tmp_root, "in/a.csv", "id;h\n1;x\n")
    write(tmp_root, "in/b.csv", "h\nx\n")
    ds = read_drop(spark, f"{tmp_root}/in")
    spec = {"validate_product_ids": {"product_id_column": "id", "product_id_master_column": "id", "master_table": "m"},
            "check_hierarchy": {"higher_level_columns": ["h"], "lower_level_columns": ["id"]}}
    got = {(r["_source_file"], r["check"]): r["passed"] for r in C.run_checks(ds.df, spec, keys_df=ds.files, catalog=cat).collect()}
    assert got == {("a.csv", "validate_product_ids"): True, ("b.csv", "validate_product_ids"): False,
                   ("a.csv", "check_hierarchy"): True, ("b.csv", "check_hierarchy"): False}


def test_samples_keep_the_callers_k(spark):
    @C.check("ten_examples")
    def ten(ctx, params=None):
        n = F.coalesce(ctx.agg(F.count(F.lit(1))), F.lit(0))
        ctx.finding(None, passed=F.lit(False), n_bad=n, message=F.lit("x"))
        ctx.sample(None, F.lit(True), k=10)

    df = spark.range(30).withColumn("_source_file", F.lit("f"))
    assert len(C.run_checks(df, {"ten_examples": None}, sample_cols=["id"]).first()["samples"]) == 10
    C.CHECKS.pop("ten_examples")


def test_report_counts_survive_later_steps(spark, tmp_root):
    spark.createDataFrame([("1", "one")], "k string, name string").write.parquet(f"{tmp_root}/m")
    cat = Catalog(spark, {"m": TableSpec(path=f"{tmp_root}/m")})
    write(tmp_root, "in/a.csv", "id\n1\n2\n3\n")
    enrich = {"name": "e", "order": 1, "function": "enrich_with_mapping",
              "params": {"mapping_file": "m", "df_join_column": "id", "mapping_key_column": "k", "columns_to_add": ["name"]}}
    for later in ({"function": "drop_nulls", "params": {"subset": ["name"]}},
                  {"function": "rename_columns", "params": {"column_mapping": {"name": "n", "id": "i"}}},
                  {"function": "drop_columns", "params": {"columns": ["name", "id"]}}):
        pb, _ = deliver(spark, tmp_root, [("t", "transform", {"*": {"transforms": [enrich, {**later, "order": 2}]}})], cat)
        (f,) = pb.findings().filter("check = 'e' AND n_bad > 0").collect()
        assert f["n_bad"] == 2 and "2 of 3" in f["message"] and f["samples"] == ["2", "3"]


def test_short_delivery_keeps_the_input(spark, tmp_root, monkeypatch):
    """Input is cleared only when the last step wrote what its files brought."""
    from dropgate.errors import UndeliveredRowsError
    from dropgate.plans import stages
    write(tmp_root, "in/a.csv", "x;y\n1;2\n3;4\n")
    write(tmp_root, "in/b.csv", 'x;y\n1;"2\n')  # never closed
    steps = [("deliver", "dispatch", {"*.csv": "OUT"})]
    run = stages.Preboarding(spark, f"{tmp_root}/one", run_id="r")
    with monkeypatch.context() as m:
        m.setattr(stages.Preboarding, "rows_written", lambda self, step: 1)
        with pytest.raises(UndeliveredRowsError):
            run.run(f"{tmp_root}/in", steps, clear_input=True)
    assert sorted(os.listdir(f"{tmp_root}/in")) == ["a.csv", "b.csv"]
    run = stages.Preboarding(spark, f"{tmp_root}/two", run_id="r")
    run.run(f"{tmp_root}/in", steps, clear_input=True)
    assert os.listdir(f"{tmp_root}/in") == ["b.csv"]  # the unread file stays
    assert run.read_step("deliver").df.count() == 2


def test_file_with_fewer_landed_rows_fails(spark, tmp_root):
    from dropgate.plans.stages import Preboarding
    from dropgate.sources.files import read_drop
    write(tmp_root, "in/a.csv", "x;y\n1;2\n3;4\n")
    write(tmp_root, "in/b.csv", "x;y\n5;6\n")
    ds = read_drop(spark, f"{tmp_root}/in")
    ds.df = ds.df.filter("x <> '3'")  # a row that gets lost
    run = Preboarding(spark, f"{tmp_root}/out", run_id="r")
    landed = run.land(ds, ["*"], f"{tmp_root}/landing")
    out = run.validate(landed, Registry({"*": {"validators": {"is_empty_dataframe": None}}}, "validate"), "check")
    assert out.passed == ["b.csv"]
    assert run.findings().filter("check = 'read_file'").first().message == "only 1 of the 2 records counted in the file were landed"
