"""End-to-end run of the example registries over the seeded fixture drop."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from dropgate.operators.joins import HIDDEN
from dropgate.plans.stages import Preboarding, restore
from dropgate.registries import default_steps
from dropgate.sources.catalog import Catalog, TableSpec, list_runs, read_run, resolve_run

RUN = "20300101_000000"
GOOD = {"NORTH/shipments/north_shipments_good.csv": 35, "NORTH/shipments/north_shipments_twice.csv": 16,
        "NORTH/stock/north_stock_good.csv": 30, "SOUTH/stock/south_stock_good.csv": 12,
        "SOUTH/shipments/a/south_shipments_good.csv": 24, "SOUTH/shipments/b/south_shipments_good.csv": 18}


def catalog(spark, root):
    csv = {"escape": '"', "multiLine": "true"}
    return Catalog(spark, {"static.parts": TableSpec(path=f"{FIXTURES}/static/parts.csv", format="csv", required=True, options=csv),
                           "static.seen_parts": TableSpec(path=f"{root}/seen", versioned=True)})


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipe"))
    cat = catalog(spark, root)
    pb = Preboarding(spark, root, catalog=cat, run_id=RUN)
    outs = pb.run(f"{FIXTURES}/input", default_steps(), backup_root=f"{root}/backup")
    return pb, outs, cat, root


def _failed(pb):
    f = pb.findings().filter(~F.col("passed"))
    return {(r["step"], os.path.basename(r["source_file"]), r["check"]) for r in f.collect()}


def delivered(spark, pb):
    out = spark.read.option("mergeSchema", "true").parquet(pb.staging("deliver") + "/*")
    # the relative paths below a target keep files of one name apart
    return {k.replace("SHIPMENTS/", ""): n for k, n in out.groupBy("_source_file").count().collect()}


def test_step_summaries(run):
    pb, outs, _, _ = run
    s = {o.step: o.summary for o in outs}
    assert s["check_input"] == {"files": 15, "passed": 9, "failed": 6}
    assert s["complete"] == {"files": 9, "passed": 9, "failed": 0}
    assert s["check_limits"] == {"files": 9, "passed": 7, "failed": 2}
    assert s["deliver"] == {"files": 7, "passed": 6, "failed": 1}


def test_case_table(run):
    pb, _, _, _ = run
    bad = _failed(pb)
    assert {b for b in bad if not b[2].endswith((".id", ".violation"))} == {
        ("check_input", "north_shipments_text_weight.csv", "column_types"),
        ("check_input", "south_shipments_no_part.csv", "required_columns"),
        ("check_input", "south_shipments_no_part.csv", "validate_product_ids"),
        ("check_input", "south_shipments_empty.csv", "is_empty_dataframe"),
        ("check_input", "south_shipments_empty.csv", "required_columns"),
        ("check_input", "south_shipments_empty.csv", "validate_product_ids"),
        ("check_input", "south_shipments_same_column.csv", "read_file"),
        ("check_input", "south_shipments_same_column.csv", "is_empty_dataframe"),
        ("check_input", "south_shipments_same_column.csv", "required_columns"),
        ("check_input", "south_shipments_same_column.csv", "additional_columns"),
        ("check_input", "north_shipments_unknown_part.csv", "validate_product_ids"),
        ("check_input", "south_stock_moved_shelf.csv", "check_hierarchy"),
        ("check_limits", "north_shipments_gap.csv", "check_null_values"),
        ("check_limits", "south_shipments_many_boxes.csv", "value_range.max"),
        ("deliver", "shipments_no_region.csv", "pattern_match"),
    }
    names = {(b[1], b[2]) for b in bad}
    assert ("south_shipments_same_column.csv", "read_file") in names
    assert ("north_shipments_unknown_part.csv", "validate_product_ids.id") in names
    assert not any("good" in b[1] or "twice" in b[1] for b in bad)


def test_one_verdict_per_check(run):
    pb, _, _, _ = run
    f = pb.findings().filter(~F.col("check").rlike("[.](id|violation)$"))
    assert f.groupBy("step", "source_file", "check", "column").count().filter("count > 1").count() == 0


def test_delivery(run, spark):
    pb, _, _, _ = run
    assert delivered(spark, pb) == GOOD
    sales = spark.read.parquet(pb.staging("deliver") + "/group=NORTH_shipments")
    assert not [c for c in sales.columns if c.startswith(HIDDEN)]
    assert dict(sales.dtypes)["boxes"] == "bigint"
    for r in sales.collect():
        assert r.label == r.label.strip() and r.maker.isupper()
        assert r.total_weight == pytest.approx(r.boxes * r.box_weight)
    remarks = {r.remark for r in spark.read.option("mergeSchema", "true").parquet(pb.staging("deliver") + "/*").select("remark").collect()}
    assert {'said "urgent"', "line one\nline two", "a;b"} <= remarks


def test_snapshot_and_backup(run, spark):
    pb, _, cat, root = run
    assert {r["version"]: r["n_rows"] for r in cat.versions("static.seen_parts").collect()} == {RUN: 15}
    note = pb.findings().filter(F.col("check") == "save_inventory_snapshot").select("message").distinct().collect()
    assert "static.seen_parts: 15 id(s) added, 15 known in all" in {r.message for r in note}
    assert [r["run_id"] for r in list_runs(spark, f"{root}/backup").collect()] == [RUN]
    assert resolve_run(spark, f"{root}/backup", -1) == RUN
    assert read_run(spark, f"{root}/backup", "-1").count() == restore(spark, f"{root}/backup", RUN).count() > 0
    with pytest.raises(FileNotFoundError):
        restore(spark, f"{root}/backup", "nope")


def test_transform_report(run):
    pb, _, _, _ = run
    rows = pb.findings().filter((F.col("step") == "complete") & (F.col("check") == "part_data")).collect()
    assert rows and all(r["passed"] and r["n_bad"] == 0 for r in rows)


def test_rows_delivered_or_rejected(run, spark):
    """Every input row is either delivered or belongs to a file that failed a step."""
    pb, _, _, root = run
    raw = restore(spark, f"{root}/backup", RUN)
    per_file = {r["_source_file"]: r["count"] for r in raw.groupBy("_source_file").count().collect()}
    bad = {r["source_file"].rsplit("/", 1)[-1] for r in pb.findings().filter(~F.col("passed")).collect()}
    rejected = sum(n for s, n in per_file.items() if s.rsplit("/", 1)[-1] in bad)
    assert sum(GOOD.values()) + rejected == sum(per_file.values())


def test_reports(run, spark):
    pb, _, _, _ = run
    lines = spark.read.text(pb.reports_path)
    assert lines.count() == pb.findings().filter(~F.col("passed")).count()
    assert pb.clear_reports()


def test_rerun_is_idempotent(run, spark):
    """Re-running the same run id replaces its outputs; the snapshot version is not doubled."""
    pb, _, cat, root = run
    again = Preboarding(spark, root, catalog=cat, run_id=RUN)
    again.run(f"{FIXTURES}/input", default_steps(), backup_root=f"{root}/backup")
    assert {r["version"]: r["n_rows"] for r in cat.versions("static.seen_parts").collect()} == {RUN: 15}
    assert delivered(spark, again) == GOOD


def test_restore_from_backup(run, spark):
    """A run over the backup gives what the first run gave, files without rows included."""
    pb, outs, cat, root = run
    other = Preboarding(spark, f"{root}/other", catalog=catalog(spark, f"{root}/other"), run_id="again")
    got = other.run(None, default_steps(), backup_root=f"{root}/backup", restore_from=-1)
    assert [o.summary for o in got] == [o.summary for o in outs]
    assert delivered(spark, other) == GOOD
