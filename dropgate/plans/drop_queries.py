"""Queries over drops of files: places of CSV records, odd names, accounting of
rows, published tables and the star schema, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropgate.operators import checks as C
from dropgate.operators import star
from dropgate.operators.transforms import TransformContext, apply_chain
from dropgate.plans.findings import write_reports
from dropgate.plans.registry import Registry
from dropgate.plans.stages import Preboarding
from dropgate.session import scratch_path
from dropgate.sources.catalog import Catalog, TableSpec
from dropgate.sources.files import OFFSET, RECORD, SOURCE, list_files, read_drop
from dropgate.sources.publish import Publication


PART_ROWS = 1_000_000  # of a file that is dealt out in parts


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _dealt(df: DataFrame, k: str, order: str, path: str, **options: str) -> None:
    """``df`` as one CSV file per value of ``k``, in the order of ``order``."""
    (df.repartition(k).sortWithinPartitions(k, order).write.partitionBy(k)
     .options(header="true", sep=";", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **options).csv(path))


def _dealt_in_parts(df: DataFrame, k: str, order: str, path: str) -> None:
    """As ``_dealt``, but a value of ``k`` is as many files as its rows take (``PART_ROWS`` each, about), one after the other."""
    n = max(2, -(-df.count() // PART_ROWS))
    (df.repartitionByRange(n, k, order).sortWithinPartitions(k, order).write.partitionBy(k)
     .options(header="true", sep=";", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))


def _renamed(spark: SparkSession, path: str, names: dict[str, str]) -> str:
    """The files of ``path``/<folder> as files with the given names below another folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    to = f"{path}-named"
    for folder, name in names.items():
        if not fs.exists(p(f"{path}/{folder}")):
            continue
        for s in fs.listStatus(p(f"{path}/{folder}")):
            if str(s.getPath().getName()).startswith("part-"):
                target = p(f"{to}/{name}")
                fs.mkdirs(target.getParent())
                fs.rename(s.getPath(), target)
    return to


def csv_record_places(spark, sf):
    """(S1, S5, L1) Documents as eight CSV files, every value quoted, with the line breaks and quotes of
    their texts: record number and byte offset of each in its file."""
    root = scratch_path(spark, "places")
    d = _t(spark, sf, "documents").select("doc_id", "text", "lang", F.pmod("doc_id", F.lit(8)).alias("k"))
    _dealt(d, "k", "doc_id", root, quoteAll="true")
    rows = read_drop(spark, root).df
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(RECORD).alias("record"), F.col(OFFSET).alias("byte_offset"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha"))


def unclosed_quotes(spark, sf):
    """(S5) Orders as six CSV files; in every other one the last record opens a quote that is never
    closed. Those files fail with its place and none of their rows is read; the others are read whole."""
    root = scratch_path(spark, "unclosed")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.pmod("o_orderkey", F.lit(6)).alias("k"))
    last = o.groupBy("k").agg(F.max("o_orderkey").alias("last"))
    o = o.join(F.broadcast(last), "k")  # six rows
    text = F.when((F.col("k") % 2 == 1) & (F.col("o_orderkey") == F.col("last")), F.concat(F.lit('"'), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    _dealt(o.select("o_orderkey", text.alias("priority"), "k"), "k", "o_orderkey", root, quote="")
    ds = read_drop(spark, root)
    k = F.regexp_extract("source", r"k=(\d+)/", 1).cast("long").alias("k")
    files = spark.createDataFrame([(f.source, f.error) for f in ds.infos if f.format == "csv"], "source string, error string")
    n = ds.df.groupBy(F.col(SOURCE).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    return files.join(n, "source", "left").select(k, F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "error")


# File names that paths, globs and URIs treat in special ways.
ODD_NAMES = ["my documents.csv", "p%20q.csv", "docs[1].csv", "d{a}.csv", "ümläut é.csv", "a+b.csv", "sub dir/100%.csv", "x#y~z.csv"]


def odd_file_names(spark, sf):
    """(S4, R2) Documents in files with blanks, percent signs, brackets, braces and umlauts in their names,
    through a dispatch: every row arrives, under its file's name."""
    root = scratch_path(spark, "odd")
    d = _t(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"), F.pmod("doc_id", F.lit(8)).alias("k"))
    _dealt(d, "k", "doc_id", root)
    drop = _renamed(spark, root, {f"k={i}": n for i, n in enumerate(ODD_NAMES)})
    run = Preboarding(spark, scratch_path(spark, "odd-run"), run_id="odd")
    run.run(drop, [("deliver", "dispatch", {"*.csv": "ALL"})])
    return run.read_step("deliver").df.select(F.col("doc_id").cast("long").alias("doc_id"), "text_sha", F.col(SOURCE).alias("file"))


def column_case(spark, sf):
    """(U2, R2) Orders in files whose headers differ only in the case of letters: patterns of their own
    keep their spelling, one target holds one readable table, and no value is lost."""
    root = scratch_path(spark, "case")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.pmod("o_orderkey", F.lit(3)).alias("k"))
    for i, names in enumerate((["ID", "Status", "price"], ["id", "status", "Price"], ["Id", "STATUS", "PRICE"])):
        _dealt(o.filter(F.col("k") == i).toDF(*names, "k"), "k", names[0], f"{root}-{i}")
        _renamed(spark, f"{root}-{i}", {f"k={i}": f"orders_{i}.csv"})
    drop = scratch_path(spark, "case-drop")
    for i in range(3):
        _moved(spark, f"{root}-{i}-named/orders_{i}.csv", f"{drop}/orders_{i}.csv")
    run = Preboarding(spark, scratch_path(spark, "case-run"), run_id="case")
    run.run(drop, [("check", "validate", {"*_0.csv": {"validators": {"required_columns": ["ID", "Status"]}},
                                          "*_1.csv": {"validators": {"required_columns": ["id", "status"]}}, "*_2.csv": {}}),
                   ("deliver", "dispatch", {"*.csv": "ALL"})])
    whole = spark.read.parquet(f"{run.staging('deliver')}/group=ALL")
    return whole.select(F.col("id").cast("long").alias("o_orderkey"), F.col("status").alias("o_orderstatus"),
                        F.col("price").cast("double").alias("o_totalprice"), F.col(SOURCE).alias("file"))


def _moved(spark, a: str, b: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(a).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p(a)):
        fs.mkdirs(p(b).getParent())
        fs.rename(p(a), p(b))


def aggregate_layouts(spark, sf):
    """(X6) Orders in files of two layouts and two patterns whose readable names are the same: one result
    per pattern over all its files, both delivered."""
    drop = scratch_path(spark, "layouts")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.pmod("o_orderkey", F.lit(4)).alias("k"))
    _dealt(o.filter("k < 2"), "k", "o_orderkey", f"{drop}/a")
    _dealt(o.filter("k >= 2").select("o_totalprice", "o_orderstatus", F.lit("x").alias("more"), "o_orderkey", "k"), "k", "o_orderkey", f"{drop}/b")
    named = scratch_path(spark, "layouts-named")
    for folder, k, name in (("a", 0, "sales_0.csv"), ("a", 1, "1_sales1.csv"), ("b", 2, "sales_2.csv"), ("b", 3, "3_sales3.csv")):
        at = _renamed(spark, f"{drop}/{folder}", {f"k={k}": f"{k}.csv"})
        _moved(spark, f"{at}/{k}.csv", f"{named}/{name}")
    sums = {"group_by": ["o_orderstatus"], "aggregations": {"o_totalprice": "sum", "o_orderkey": "count"}}
    run = Preboarding(spark, scratch_path(spark, "layouts-run"), run_id="layouts")
    run.run(named, [("sum", "aggregate", {"sales_*": sums, "*_sales*": sums}), ("deliver", "dispatch", {"*": "OUT"})])
    return run.read_step("deliver").df.select("o_orderstatus", F.round("o_totalprice", 2).alias("total"), F.col("o_orderkey").alias("n_orders"))


def odd_column_names(spark, sf):
    """(S1, T1, T5, V6-V8, X6) Line items whose columns hold dots, backticks, quotes and blanks in their
    names, through checks, enrichment, arithmetic, aggregation and delivery."""
    root = scratch_path(spark, "names")
    li = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("part.key"), F.col("l_quantity").alias("qty `n`"), F.col("l_extendedprice").alias("unit price"),
                                          F.col("l_returnflag").alias('flag "x".y'), F.col("l_orderkey").alias("o"), F.pmod("l_orderkey", F.lit(2)).alias("k"))
    _dealt_in_parts(li, "k", "o", root)
    part = _t(spark, sf, "part").select(F.col("p_partkey").alias("p.key"), F.col("p_brand").alias("brand`s"))
    parts = scratch_path(spark, "names-part")
    part.write.parquet(parts)
    run = Preboarding(spark, scratch_path(spark, "names-run"), run_id="names", catalog=Catalog(spark, {"parts": TableSpec(path=parts)}))
    run.run(root, [
        ("check", "validate", {"*": {"validators": {
            "required_columns": ["part.key", "qty `n`"], "value_range": {"qty `n`": {"min": 0, "max": 100}}, "check_null_values": ["unit price", 'flag "x".y'],
            "validate_product_ids": {"product_id_column": "part.key", "product_id_master_column": "p.key", "master_table": "parts"},
            "check_hierarchy": {"higher_level_columns": ["part.key"], "lower_level_columns": ["part.key"]}},
            "schema": {"qty `n`": "double", "unit price": "double", "part.key": "long"}}}),
        ("add", "transform", {"*": {"transforms": [
            {"function": "enrich_with_mapping", "params": {"mapping_file": "parts", "df_join_column": "part.key", "mapping_key_column": "p.key", "columns_to_add": ["brand`s"]}},
            {"function": "case_transform", "params": {"columns": ["brand`s"], "to_lowercase": True}},
            {"function": "multiply_columns", "params": {"columns_to_multiply": ["qty `n`", "unit price"], "output_column": "total.sum"}},
            {"function": "drop_columns", "params": {"columns": ["unit price"]}}]}}),
        ("sum", "aggregate", {"*": {"group_by": ["brand`s", 'flag "x".y'], "aggregations": {"total.sum": "sum", "qty `n`": "sum"}}}),
        ("deliver", "dispatch", {"*": "OUT"})])
    out = run.read_step("deliver").df
    return out.select(F.col("`brand``s`").alias("brand"), F.col('`flag "x".y`').alias("flag"), F.round("`total.sum`", 2).alias("total"), F.col("`qty ``n```").alias("quantity"))


def sample_record_numbers(spark, sf):
    """(L1) Documents as four CSV files: samples of rows without a language are their record numbers."""
    root = scratch_path(spark, "samples")
    d = _t(spark, sf, "documents").select("doc_id", F.when(F.pmod("doc_id", F.lit(7)) != 3, F.col("lang")).alias("lang"), F.pmod("doc_id", F.lit(4)).alias("k"))
    _dealt(d, "k", "doc_id", root)
    ds = read_drop(spark, root)
    found = C.run_checks(ds.df, {"check_null_values": ["lang"]}, keys_df=ds.files)
    return found.select(F.regexp_extract(SOURCE, r"k=(\d+)/", 1).cast("long").alias("k"), "n_bad", F.array_join("samples", ",").alias("records"))


def formats_listed(spark, sf):
    """(S3, S4) Customers as CSV, Parquet and text files in nested folders: files and formats found, and rows of the readable ones."""
    root = scratch_path(spark, "formats")
    c = _t(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("line"), F.pmod("c_custkey", F.lit(3)).alias("k"))
    c.filter("k = 0").select("c_custkey").coalesce(1).write.option("header", "true").csv(f"{root}/a/b")
    c.filter("k = 1").select("c_custkey").coalesce(1).write.parquet(f"{root}/a/c")
    c.filter("k = 2").select("line").coalesce(1).write.text(f"{root}/d")
    listed = list_files(spark, root).select(F.regexp_extract(SOURCE, r"^(.*)/[^/]+$", 1).alias("folder"), "format")
    n = read_drop(spark, root).df.groupBy(F.regexp_extract(SOURCE, r"^(.*)/[^/]+$", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.join(n, "folder", "left").select("folder", "format", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def tables_present(spark, sf):
    """(S7, S8, K4) Required tables: present ones with their rows, one that never was, one that was deleted."""
    gone = scratch_path(spark, "gone")
    tables = {n: TableSpec(path=f"{sf.rstrip('/')}/{n}.parquet", required=True) for n in ("orders", "customer", "events")}
    catalog = Catalog(spark, tables | {"never": TableSpec(path=f"{gone}-never", required=True), "gone": TableSpec(path=gone, required=True)})
    catalog.write("gone", _t(spark, sf, "nation"))
    was = catalog.read("gone").count()
    catalog.delete("gone")
    rows = None
    for n in tables:
        one = catalog.read(n).agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("n_rows"))
        rows = one if rows is None else rows.union(one)
    rows = rows.union(spark.createDataFrame([("gone", was)], "table string, n_rows long"))
    return catalog.required_tables().join(rows, "table", "left").select("table", "present", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def reports_cleared(spark, sf):
    """(K5, K6) Findings of line items written as text reports, counted, cleared and listed again."""
    run = Preboarding(spark, scratch_path(spark, "reports"), run_id="r")
    li = _t(spark, sf, "lineitem").withColumn("source_file", F.concat("l_returnflag", "l_linestatus"))
    found = C.run_checks(li, {"value_range": {"l_quantity": {"max": 40}, "l_discount": {"max": 0.09}}}, key="source_file")
    found = found.select(F.lit("r").alias("run_id"), F.lit("check").alias("step"), "*")
    write_reports(found, run.reports_path)
    lines = spark.read.text(run.reports_path).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_lines"))
    kept = scratch_path(spark, "report-counts")
    lines.write.parquet(kept)
    cleared = run.clear_reports()
    left = list_files(spark, run.reports_path).count()
    return spark.read.parquet(kept).select("source_file", "n_lines", F.lit(cleared).alias("cleared"), F.lit(left).alias("n_left"))


def missing_functions(spark, sf):
    """(X3) A registry for the tables' line flags that names functions nobody registered: all are reported before any read."""
    flags = [r[0] for r in _t(spark, sf, "lineitem").select("l_returnflag").distinct().orderBy("l_returnflag").collect()]
    out = []
    for kind, body in (("validate", lambda f: {"validators": {f"no_such_check_{f}": None, "is_empty_dataframe": None}}),
                       ("transform", lambda f: {"transforms": [{"function": f"no_such_step_{f}"}, {"function": "blank"}]})):
        try:
            Registry({f"*{f}*": body(f) for f in flags}, kind)
        except Exception as e:  # noqa: BLE001 - its text is the result
            out += [(kind, f, f"no_such_{'check' if kind == 'validate' else 'step'}_{f}" in str(e)) for f in flags]
    return spark.createDataFrame(out, "kind string, flag string, reported boolean")


def published_table(spark, sf):
    """(K1, K2) Orders published by status: an overwrite, an append, a write that dies halfway and a
    writer that comes too late. Readers see the first two only."""
    from dropgate.errors import ConcurrentWriteError
    path = scratch_path(spark, "published")
    catalog = Catalog(spark, {"orders": TableSpec(path=path, published=True)})
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    is_f = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    catalog.write("orders", o)
    catalog.write("orders", o.filter(is_f))
    late, (seen, _) = Publication(spark, path), Publication(spark, path).current()
    catalog.write("orders", o.filter(~is_f), mode="append")
    try:
        catalog.write("orders", o.withColumn("o_totalprice", F.raise_error(F.lit("killed halfway")).cast("double")))
        raise AssertionError("the write went through")
    except ConcurrentWriteError:
        raise
    except Exception as e:  # noqa: BLE001 - the injected failure
        if "killed halfway" not in str(e):
            raise
    try:
        late.publish(seen, [])
        raise AssertionError("the late writer went through")
    except ConcurrentWriteError:
        pass
    return catalog.read("orders")


STAR = {"natural": ["o_custkey"], "attributes": ["c_name", "c_mktsegment"]}


def _star(spark, sf):
    """Orders with their customers in two runs; between them a third of the customers change segment, and the second run is repeated."""
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey").join(c, "o_custkey")
    first = o.filter(F.pmod("o_orderkey", F.lit(2)) == 0)
    second = o.filter(F.coalesce(F.pmod("o_orderkey", F.lit(2)) != 0, F.lit(True))).withColumn(
        "c_mktsegment", F.when(F.pmod("o_custkey", F.lit(3)) == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")))
    catalog = Catalog(spark, {"dim": TableSpec(path=scratch_path(spark, "dim"), published=True),
                              "fact": TableSpec(path=scratch_path(spark, "fact"), published=True, versioned=True)})
    for run, rows in (("run1", first), ("run2", second), ("run2", second)):
        known = catalog.read("dim") if catalog.exists("dim") else None
        catalog.write("dim", star.merge_dimension(known, rows, run=run, **STAR))
        catalog.write_version("fact", star.facts(rows, catalog.read("dim"), run=run, **STAR), run)
    return catalog


def star_joined_back(spark, sf):
    """(X9) Facts of both runs joined back to the dimension give the rows that came in."""
    catalog = _star(spark, sf)
    return star.joined_back(catalog.read("fact"), catalog.read("dim")).select("o_orderkey", "o_totalprice", "run", "o_custkey", "c_name", "c_mktsegment")


def star_dimension(spark, sf):
    """(X9) The dimension after both runs: stable keys, intervals of validity."""
    return _star(spark, sf).read("dim")


def incremental_backup(spark, sf):
    """(R5, R6) Orders as six files backed up three times: as they are, unchanged, and with the prices of
    two files changed. What each run stored, and what it restores."""
    from dropgate.plans.backups import Backups
    root = scratch_path(spark, "increments")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.pmod("o_orderkey", F.lit(6)).alias("k"))
    backups, out = Backups(spark, f"{root}/backups"), None
    for run, change in (("run1", F.lit(0)), ("run2", F.lit(0)), ("run3", (F.col("k") < 2).cast("int"))):
        at = f"{root}/{run}"
        _dealt(o.withColumn("o_totalprice", (F.col("o_totalprice") + change).cast("decimal(20,2)")), "k", "o_orderkey", at)
        drop = _renamed(spark, at, {f"k={i}": f"orders_{i}.csv" for i in range(6)})
        got = backups.store(read_drop(spark, drop), run)
        back = backups.restore(run).groupBy(F.col(SOURCE).alias("file")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("total"))
        back = back.select(F.lit(run).alias("run"), "file", "n_rows", "total", F.lit(got["files"]).alias("files_stored"))
        out = back if out is None else out.union(back)
    return out


def chain_of_types(spark, sf):
    """(U2, S2) Orders in Parquet files whose columns have unlike types: the union has the least type that loses nothing."""
    root = scratch_path(spark, "types")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.pmod("o_orderkey", F.lit(2)).alias("k"))
    o.filter("k = 0").select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.col("o_custkey").cast("int").alias("n"), "day").write.parquet(f"{root}/a")
    o.filter("k <> 0").select("o_orderkey", F.col("o_custkey").cast("decimal(12,2)"), F.col("o_totalprice").alias("n"), F.col("day").cast("string")).write.parquet(f"{root}/b")
    df = read_drop(spark, root).df
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select("o_orderkey", F.col("o_custkey").cast("long").alias("o_custkey"), F.col("n").alias("n"), "day",
                     *[F.lit(kinds[c]).alias(f"{c}_type") for c in ("o_orderkey", "o_custkey", "n", "day")])


def transform_chain_odd_names(spark, sf):
    """(T2, T6-T8, X5, X7) Row-wise transforms over supplier columns with dots and backticks in their names."""
    s = _t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit(" "), "s_name", F.lit("\t")).alias("na.me"), F.col("s_acctbal").alias("bal`"))
    out, log = apply_chain(s, [
        {"function": "strings_strip_whitespace", "params": {"columns": ["na.me"]}},
        {"function": "sum_columns", "params": {"columns_to_sum": ["bal`", "s_suppkey"], "output_column": "a.b"}},
        {"function": "subtract_columns", "params": {"minuend_column": "a.b", "subtrahend_columns": ["bal`"], "output_column": "c.d"}},
        {"function": "divide_columns", "params": {"numerator_column": "c.d", "denominator_column": "s_suppkey", "output_column": "q"}},
        {"function": "rename_columns", "params": {"column_mapping": {"na.me": "name"}}},
        {"function": "filter_rows", "params": {"column": "bal`", "operator": ">", "value": 0}},
        {"function": "drop_nulls", "params": {"subset": ["a.b"]}}], TransformContext())
    failed = [e for _, ok, e in log if not ok]
    if failed:
        raise ValueError("; ".join(failed))
    return out.select("s_suppkey", "name", F.round("q", 6).alias("q"))


QUERIES = {f.__name__: f for f in (
    csv_record_places, unclosed_quotes, odd_file_names, column_case, aggregate_layouts, odd_column_names, sample_record_numbers, formats_listed,
    tables_present, reports_cleared, missing_functions, published_table, star_joined_back, star_dimension,
    incremental_backup, chain_of_types, transform_chain_odd_names)}

_NAMES = ", ".join("'" + n.rsplit("/", 1)[-1] + "'" for n in ODD_NAMES)

ORACLE_SQL = {
    "csv_record_places": """
      WITH r AS (SELECT doc_id, text, doc_id % 8 AS k,
                        strlen('"' || doc_id || '";"' || replace(coalesce(text, ''), '"', '""') || '";"' || coalesce(lang, '') || '"') + 1 AS size FROM documents)
      SELECT doc_id, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS record,
             (strlen('"doc_id";"text";"lang"') + 1 + coalesce(sum(size) OVER (PARTITION BY k ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS byte_offset,
             sha256(coalesce(text, '')) AS text_sha FROM r""",
    "unclosed_quotes": """
      WITH r AS (SELECT o_orderkey % 6 AS k, strlen(o_orderkey || ';' || o_orderpriority) + 1 AS size, o_orderkey,
                        max(o_orderkey) OVER (PARTITION BY o_orderkey % 6) AS last FROM orders)
      SELECT k, CASE WHEN k % 2 = 1 THEN 0 ELSE count(*) END AS n_rows,
             CASE WHEN k % 2 = 1 THEN 'a quote is never closed: in record ' || count(*) || ', which starts at byte ' ||
               (strlen('o_orderkey;priority') + 1 + sum(CASE WHEN o_orderkey < last THEN size ELSE 0 END))::BIGINT END AS error
      FROM r GROUP BY k""",
    "odd_file_names": f"SELECT doc_id, sha256(text) AS text_sha, 'ALL/' || [{_NAMES}][doc_id % 8 + 1] AS file FROM documents",
    "column_case": "SELECT o_orderkey, o_orderstatus, o_totalprice, 'ALL/orders_' || (o_orderkey % 3) || '.csv' AS file FROM orders",
    "aggregate_layouts": """
      SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(*) AS n_orders FROM orders GROUP BY o_orderstatus, o_orderkey % 2""",
    "odd_column_names": """
      SELECT lower(p_brand) AS brand, l_returnflag AS flag, round(sum(l_quantity * l_extendedprice), 2) AS total, sum(l_quantity) AS quantity
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "sample_record_numbers": """
      WITH r AS (SELECT doc_id % 4 AS k, lang IS NULL OR doc_id % 7 = 3 AS bad, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS record FROM documents),
      s AS (SELECT k, bad, record, row_number() OVER (PARTITION BY k, bad ORDER BY record) AS n FROM r)
      SELECT k, count(*) FILTER (bad) AS n_bad, string_agg(record::VARCHAR, ',' ORDER BY record) FILTER (bad AND n <= 5) AS records FROM s GROUP BY k""",
    "formats_listed": """
      SELECT ['a/b', 'a/c', 'd'][k + 1] AS folder, ['csv', 'parquet', NULL][k + 1] AS format, CASE WHEN k < 2 THEN n ELSE 0 END AS n_rows
      FROM (SELECT c_custkey % 3 AS k, count(*) AS n FROM customer GROUP BY 1)""",
    "tables_present": """
      SELECT 'orders' AS "table", true AS present, count(*) AS n_rows FROM orders UNION ALL SELECT 'customer', true, count(*) FROM customer
      UNION ALL SELECT 'events', true, count(*) FROM events UNION ALL SELECT 'never', false, 0 UNION ALL SELECT 'gone', false, count(*) FROM nation""",
    "reports_cleared": """
      SELECT l_returnflag || l_linestatus AS source_file, max((l_quantity > 40)::INT) + max((l_discount > 0.09)::INT) AS n_lines, true AS cleared, 0 AS n_left
      FROM lineitem GROUP BY 1 HAVING max((l_quantity > 40)::INT) + max((l_discount > 0.09)::INT) > 0""",
    "missing_functions": "SELECT kind, flag, true AS reported FROM (SELECT DISTINCT l_returnflag AS flag FROM lineitem), (VALUES ('validate'), ('transform')) AS t(kind)",
    "published_table": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "star_joined_back": """
      SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 'run1' ELSE 'run2' END AS run, o_custkey, c_name,
             CASE WHEN o_orderkey % 2 <> 0 AND o_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "star_dimension": """
      WITH o AS (SELECT o_custkey, c_name, c_mktsegment, bool_or(o_orderkey % 2 = 0) AS one, bool_or(o_orderkey % 2 <> 0) AS two
                 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
      k AS (SELECT *, row_number() OVER (ORDER BY NOT one, o_custkey) AS key FROM o)
      SELECT key, o_custkey, c_name, c_mktsegment, 'run1' AS valid_from, CASE WHEN two AND o_custkey % 3 = 0 THEN 'run2' END AS valid_to FROM k WHERE one
      UNION ALL SELECT key, o_custkey, c_name, CASE WHEN o_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END, 'run2', NULL
      FROM k WHERE two AND (NOT one OR o_custkey % 3 = 0)""",
    "incremental_backup": """
      SELECT run, 'orders_' || (o_orderkey % 6) || '.csv' AS file, count(*) AS n_rows, stored AS files_stored,
             sum((o_totalprice + CASE WHEN run = 'run3' AND o_orderkey % 6 < 2 THEN 1 ELSE 0 END)::DECIMAL(20, 2))::DOUBLE AS total
      FROM orders, (VALUES ('run1', 6), ('run2', 0), ('run3', 2)) AS t(run, stored) GROUP BY run, o_orderkey % 6, stored""",
    "chain_of_types": """
      SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::DOUBLE ELSE o_totalprice END AS n, strftime(o_orderdate, '%Y-%m-%d') AS day,
             'bigint' AS o_orderkey_type, 'decimal(12,2)' AS o_custkey_type, 'double' AS n_type, 'string' AS day_type FROM orders""",
    "transform_chain_odd_names": """
      SELECT s_suppkey, s_name AS name, round((s_acctbal + s_suppkey - s_acctbal) / nullif(s_suppkey, 0), 6) AS q FROM supplier WHERE s_acctbal > 0""",
}
