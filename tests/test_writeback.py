import pathlib

import pytest

from loglattice.operators import writeback as W
from loglattice.sources import files

DOC = "_id string, year int, _index string, enriched struct<note: string, department: string>"
ROWS = [
    ("1", 1, "a", ("x", "old")), ("2", 2, "a", None), (None, 1, "a", ("z", "z")), ("1", 1, "b", ("y", "old")), ("9", 2, "b", None), ("9", 2, None, None),
]
UPDATE = "_id string, _index string, update struct<department: string, last_name: string>"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame(ROWS, DOC)
    files.write_partitions(docs, path, ["_index"])
    return path, docs.schema


def parts(path):
    return {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}


def result(df):
    rows = df.select("_index", "_id", "enriched.*").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("mode, note", [("merge", "x"), ("replace", None)])
def test_only_touched_partitions_are_rewritten(spark, table, mode, note):
    path, schema = table
    before = parts(path)
    # Repeated, null and unknown keys, and a dataset that is not stored.
    updates = spark.createDataFrame([("1", "a", ("d", "n")), ("1", "a", ("d", "n")), (None, "a", ("q", "q")), ("7", "a", ("q", "q")), ("1", "zz", ("q", "q"))], UPDATE)
    out = W.update_documents(spark, path, schema, updates, "enriched", mode)
    want = sorted([
        ("a", "1", note, "d", "n"), ("a", "2", None, None, None), ("a", None, "z", "z", None), ("b", "1", "y", "old", None),
        ("b", "9", None, None, None), (None, "9", None, None, None),
    ], key=repr)
    assert result(out) == want
    after = parts(path)
    assert {f for f in after if "_index=b" in f} == {f for f in before if "_index=b" in f}
    assert not {f for f in after & before if "_index=a" in f} and not [f for f in after if "zz" in f]
    # The same updates again, over the table as it is now.
    assert result(W.update_documents(spark, path, out.schema, updates, "enriched", mode)) == want


def test_no_updates_change_nothing(spark, table):
    path, schema = table
    before = parts(path)
    out = W.update_documents(spark, path, schema, spark.createDataFrame([], UPDATE), "enriched")
    assert out.count() == len(ROWS) and parts(path) == before


def test_publishing_may_be_repeated(spark, table):
    path, schema = table
    updates = spark.createDataFrame([("1", "a", ("d", "n"))], UPDATE)
    staged, new = W.stage_update(spark.read.schema(schema).parquet(path), updates, "enriched")
    first = result(W.publish_update(spark, staged, new, path))
    assert result(W.publish_update(spark, staged, new, path)) == first


def test_partitions_outside_the_key(spark, tmp_path):
    path = str(tmp_path / "by-year")
    docs = spark.createDataFrame(ROWS[:5], DOC)
    files.write_partitions(docs, path, ["_index", "year"])
    before = parts(path)
    updates = spark.createDataFrame([("2", "a", ("d", "n"))], UPDATE)
    out = W.update_documents(spark, path, docs.schema, updates, "enriched", partitions=["_index", "year"])
    assert out.where("_id = '2'").first().enriched.department == "d" and out.count() == 5
    assert {f.split("/part")[0] for f in before - parts(path)} == {"_index=a/year=2"}
