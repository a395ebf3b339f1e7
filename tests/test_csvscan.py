"""Parallel CSV scan: any split of a quoted file gives the records of the whole."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from dropgate.sources import csvscan
from dropgate.sources.files import CORRUPT, OFFSET, RECORD, SOURCE, read_drop


@pytest.fixture()
def small_splits(spark):
    """Many ranges per file."""
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def random_csv(rng, n, newline="\n"):
    """(text, rows, offsets): values with separators, quotes and line breaks."""
    out, rows, offsets = "a;b;c" + newline, [], []
    for _ in range(n):
        row = ["".join(rng.choice('x;"\n é1') for _ in range(rng.choice((0, 1, 3, 12, 150 if rng.random() < 0.1 else 2)))) for _ in range(3)]
        offsets.append(len(out.encode()))
        rows.append([v or None for v in row])  # empty values are nulls, quoted or not
        out += ";".join('"' + v.replace('"', '""') + '"' if v == "" or set(v) & set(';"\n') or rng.random() < 0.2 else v for v in row) + newline
        if rng.random() < 0.1:
            out += newline  # empty lines are no records
    return out, rows, offsets


def read(spark, root):
    ds = read_drop(spark, root)
    rows = ds.df.select(SOURCE, RECORD, OFFSET, *[c for c in ds.df.columns if not c.startswith(("_", "__dg__"))], F.col(CORRUPT)).collect()
    return ds, sorted(map(tuple, rows))


@pytest.mark.parametrize("seed", range(4))
def test_random_files_in_many_ranges(spark, tmp_root, small_splits, seed):
    rng = random.Random(seed)
    want = []
    for k in range(3):
        text, rows, offsets = random_csv(rng, 30 if k else 90)
        if k == 2:
            text = text.rstrip("\n")  # no line break at the end
        write(tmp_root, f"f{k}.csv", text)
        want += [(f"f{k}.csv", i + 1, o, *r, None) for i, (r, o) in enumerate(zip(rows, offsets, strict=True))]
    assert spark.read.text(tmp_root).rdd.getNumPartitions() > 10
    ds, got = read(spark, tmp_root)
    assert got == sorted(want)
    assert {f.source: f.rows for f in ds.infos} == {"f0.csv": 90, "f1.csv": 30, "f2.csv": 30}


def test_same_as_one_task(spark, tmp_root, small_splits):
    text, rows, _ = random_csv(random.Random(9), 120)
    path = write(tmp_root, "in/one.csv", text)
    one = spark.read.options(header="true", sep=";", escape='"', multiLine="true", quote='"').csv(path).collect()
    got = read(spark, f"{tmp_root}/in")[1]
    assert [tuple("" if v is None else v for v in r[3:6]) for r in got] == [tuple("" if v is None else v for v in r) for r in one]
    assert [tuple(r) for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r][1:] == [tuple("" if v is None else v for v in r) for r in one]


def test_shuffled_ranges(spark, tmp_root, small_splits, monkeypatch):
    """With too many ranges for a broadcast the lines are put in order again."""
    text, rows, offsets = random_csv(random.Random(4), 80)
    write(tmp_root, "f.csv", text)
    monkeypatch.setattr(csvscan, "MAX_BROADCAST_RANGES", 0)
    assert read(spark, tmp_root)[1] == [("f.csv", i + 1, o, *r, None) for i, (r, o) in enumerate(zip(rows, offsets, strict=True))]


@pytest.mark.parametrize("line,inside,after", [
    ("a;b", False, False), ("a;b", True, True), ('a;"b', False, True), ('b";c', True, False), ('b"";c', True, True), ('a"b;c', False, False),
    ('5" pipe;"x', False, True), ('"a""', False, True), ('"a"""', False, False), ('"a"junk;"b', False, True), ('x";"y";"z', True, True), ('";"', False, False),
    ('";"', True, True), ('"', False, True), ('"', True, False), ('""', False, False), ('""', True, True), (' "a', False, False)])
def test_state_after_a_line(line, inside, after):
    assert csvscan.ends_inside(line.encode(), inside, b";") is after


def test_changed_ranges_are_an_error(spark, tmp_root, small_splits):
    text, _, _ = random_csv(random.Random(4), 80)
    write(tmp_root, "f.csv", text)
    rows = read_drop(spark, tmp_root).df
    spark.conf.set("spark.sql.files.maxPartitionBytes", "70")
    with pytest.raises(Exception, match="no state is known for the range"):
        rows.collect()


def test_unclosed_quote_fails_its_file_only(spark, tmp_root, small_splits):
    write(tmp_root, "good.csv", 'a;b\n1;"x\ny"\n2;z\n')
    write(tmp_root, "bad.csv", 'a;c\n1;"p\n2;q\n3;r\n4;s\n')
    write(tmp_root, "stray.csv", 'a;c\n1;5" pipe\n2;q\n')
    ds, got = read(spark, tmp_root)
    assert {f.source: f.error for f in ds.infos} == {
        "good.csv": None, "stray.csv": None, "bad.csv": "a quote is never closed: in record 1, which starts at byte 4"}
    assert sorted(r[0] for r in got) == ["good.csv", "good.csv", "stray.csv", "stray.csv"]


def test_malformed_records_name_their_place(spark, tmp_root):
    from dropgate.operators.checks import run_checks
    write(tmp_root, "f.csv", 'a;b\n1;2\n"3\n";4\n5;6;7\n8\n')
    ds = read_drop(spark, tmp_root)
    (row,) = run_checks(ds.df, {"malformed_rows": None}, keys_df=ds.files).collect()
    assert not row.passed and row.n_bad == 2 and "the first is record 3, at byte 15" in row.message and row.samples == ["3", "4"]


def test_crlf_header_mark_and_empty_files(spark, tmp_root):
    write(tmp_root, "f.csv", '﻿a;"b ""x"""\r\n1;"two\r\nlines"\r\n\r\n3;4\r\n')
    write(tmp_root, "blank.csv", "\n\n")
    write(tmp_root, "none.csv", "")
    write(tmp_root, "header.csv", "a;b")
    ds = read_drop(spark, tmp_root)
    assert {f.source: (f.columns, f.rows, f.error) for f in ds.infos} == {
        "f.csv": (["a", 'b "x"'], 2, None), "blank.csv": ([], 0, None), "none.csv": ([], 0, None), "header.csv": (["a", "b"], 0, None)}
    assert [tuple(r) for r in ds.df.select("a", F.col('`b "x"`')).orderBy("a").collect()] == [("1", "two\r\nlines"), ("3", "4")]


def test_odd_file_names(spark, tmp_root):
    names = ["my sales.csv", "p%20q.csv", "sales[1].csv", "s{1}.csv", "a+b.csv", "Umläut é.csv", "sub dir/100%.csv", "star*.csv", "que?.csv", "x#y.csv"]
    for k, n in enumerate(names):
        write(tmp_root, n, f"a;b\n{k};{n}\n")
    spark.createDataFrame([(99, "pq")], "a int, b string").coalesce(1).write.parquet(f"{tmp_root}/pq [x] %41")
    ds = read_drop(spark, tmp_root)
    rows = [tuple(r) for r in ds.df.select(SOURCE, "a", "b", RECORD).collect()]
    (parquet,) = [r for r in rows if r[2] == "pq"]
    assert parquet[0].startswith("pq [x] %41/part-") and parquet[3] == 1
    assert sorted(r for r in rows if r[2] != "pq") == sorted((n, str(k), n, 1) for k, n in enumerate(names))
    assert {r[0] for r in rows} == {f.source for f in ds.infos if f.format}
    one = ds.rows_of(["sales[1].csv", "p%20q.csv"])
    assert sorted(r[0] for r in one.select(SOURCE).collect()) == ["p%20q.csv", "sales[1].csv"]


def test_parquet_row_numbers(spark, tmp_root):
    spark.range(50).coalesce(1).write.parquet(f"{tmp_root}/p")
    rows = read_drop(spark, tmp_root).df.select("id", RECORD).collect()
    assert sorted((r[0] + 1) for r in rows) == sorted(r[1] for r in rows)


def test_ranges_are_small_whatever_the_session_allows(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, kept in (("128m", "8388608"), ("134217728b", "8388608"), ("1g", "8388608"), ("8m", "8m"), ("70", "70")):
            spark.conf.set(key, given)
            csvscan.fixed_ranges(spark)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)
