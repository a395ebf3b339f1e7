"""Incremental backups: contents stored once, restored as they were."""

import os

import pytest

from dropgate.plans.backups import Backups, addresses
from dropgate.sources.files import SOURCE, read_drop


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r[c] for c in (SOURCE, "a", "b")) for r in df.collect()), key=repr)


def test_unchanged_contents_are_referred_to(spark, tmp_root):
    drop, backups = f"{tmp_root}/in", Backups(spark, f"{tmp_root}/b")
    put(drop, "x.csv", "a;b\n1;2\n1;2\n3;\n")
    put(drop, "same.csv", "a;b\n1;2\n3;\n1;2\n")  # the same rows in another order
    put(drop, "y.csv", "b;a;c\n9;8;7\n")
    put(drop, "empty.csv", "")
    ds = read_drop(spark, drop)
    assert backups.store(ds, "r1") == {"files": 2, "rows": 4}
    assert backups.store(read_drop(spark, drop), "r2") == {"files": 0, "rows": 0}
    put(drop, "x.csv", "a;b\n1;2\n3;\n")  # one copy of a row less
    assert backups.store(read_drop(spark, drop), "r3") == {"files": 1, "rows": 2}
    assert backups.store(read_drop(spark, drop), "r3") == {"files": 1, "rows": 2}  # the run once more
    first = [("same.csv", "1", "2"), ("same.csv", "1", "2"), ("same.csv", "3", None), ("y.csv", "8", "9")]
    assert rows(backups.restore("r1")) == rows(backups.restore("r2")) == sorted(first + [("x.csv", "1", "2"), ("x.csv", "1", "2"), ("x.csv", "3", None)], key=repr)
    assert rows(backups.restore("r3")) == sorted(first + [("x.csv", "1", "2"), ("x.csv", "3", None)], key=repr)
    assert backups.runs() == ["r3", "r2", "r1"]
    with pytest.raises(FileNotFoundError, match="r3"):
        backups.restore("r9")


def test_addresses_tell_values_and_columns_apart(spark):
    df = spark.createDataFrame([("f", 1, None), ("g", None, 1), ("h", 1, None), ("i", 2, None)], f"{SOURCE} string, a int, b int")
    by = {r[SOURCE]: r[1] for r in addresses(df).collect()}
    assert by["f"] == by["h"] and len({by["f"], by["g"], by["i"]}) == 3
