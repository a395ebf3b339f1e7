"""Published tables: readers see whole states only."""

import os

import pytest
from pyspark.sql import functions as F

from dropgate.errors import ConcurrentWriteError, TableNotFoundError
from dropgate.sources.catalog import Catalog, TableSpec
from dropgate.sources.publish import Publication


@pytest.fixture()
def catalog(spark, tmp_root):
    return Catalog(spark, {"t": TableSpec(path=f"{tmp_root}/t", published=True), "c": TableSpec(path=f"{tmp_root}/c", published=True, format="csv"),
                           "v": TableSpec(path=f"{tmp_root}/v", published=True, versioned=True)})


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_overwrite_append_and_missing(spark, catalog):
    assert not catalog.exists("t")
    with pytest.raises(TableNotFoundError):
        catalog.read("t")
    catalog.write("t", spark.range(3))
    old = catalog.read("t")
    catalog.write("t", spark.range(3, 5), mode="append")
    assert ids(catalog.read("t")) == [0, 1, 2, 3, 4] and ids(old) == [0, 1, 2]
    catalog.write("t", spark.range(7, 8))
    assert ids(catalog.read("t")) == [7] and ids(old) == [0, 1, 2]  # a reader keeps the state it began with


def test_write_that_dies_leaves_the_table(spark, catalog, tmp_root):
    catalog.write("t", spark.range(3))
    bad = spark.range(100).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        catalog.write("t", bad)
    assert ids(catalog.read("t")) == [0, 1, 2]
    table = Publication(spark, f"{tmp_root}/t")
    assert len(table.unnamed()) == 1 and table.clean() == 1 and ids(catalog.read("t")) == [0, 1, 2]


def test_torn_manifest_is_not_read(spark, catalog, tmp_root):
    catalog.write("t", spark.range(3))
    with open(f"{tmp_root}/t/_manifests/{2:020d}.json", "w") as f:
        f.write('{"folders": ["_data/no')
    assert ids(catalog.read("t")) == [0, 1, 2]
    catalog.write("t", spark.range(1))
    assert ids(catalog.read("t")) == [0] and os.path.exists(f"{tmp_root}/t/_manifests/{3:020d}.json")


def test_one_of_two_writers_wins(spark, catalog, tmp_root):
    catalog.write("t", spark.range(3))
    a, b = Publication(spark, f"{tmp_root}/t"), Publication(spark, f"{tmp_root}/t")
    seen_a, seen_b = a.current()[0], b.current()[0]
    a.publish(seen_a, a.folders())
    with pytest.raises(ConcurrentWriteError):
        b.publish(seen_b, [])
    assert ids(catalog.read("t")) == [0, 1, 2]


def test_versions(spark, catalog):
    catalog.write_version("v", spark.range(3), "001")
    catalog.write_version("v", spark.range(3, 4), "002")
    catalog.write_version("v", spark.range(10, 12), "001")  # a version once more
    catalog.write_version("v", spark.range(0), "003")
    assert ids(catalog.read("v")) == [3, 10, 11] and ids(catalog.read("v", version="001")) == [10, 11]
    assert {(r.version, r.n_rows) for r in catalog.versions("v").collect()} == {("001", 2), ("002", 1), ("003", 0)}


def test_csv_values_come_back(spark, catalog, tmp_root):
    rows = [('a "b"; c', "two\nlines"), (" x ", None)]
    catalog.write("c", spark.createDataFrame(rows, "p string, q string").coalesce(1))
    assert sorted(map(tuple, catalog.read("c").collect())) == sorted(rows)
    plain = Catalog(spark, {"m": TableSpec(path=f"{tmp_root}/m.csv", format="csv")})
    with open(f"{tmp_root}/m.csv", "w") as f:
        f.write('k;v\n1;"a ""b""; c"\n2;"two\nlines"\n')
    assert sorted(map(tuple, plain.read("m").collect())) == [("1", 'a "b"; c'), ("2", "two\nlines")]
