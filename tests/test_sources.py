import os
from datetime import datetime, timezone

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from loglattice.operators import shares
from loglattice.plans import documents
from loglattice.sources import files


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "out")


def test_roster_files_round_trip(spark, path):
    hr = spark.createDataFrame(
        [("10.0.0.1", "A", "B, \"x\"", "sales", "sdr", "2020-01-01"), ("bad", None, "C", "legal", "compliance", "2021-02-03")],
        "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string",
    )
    for fmt in ("csv", "parquet"):
        files.write_roster(hr, path + fmt, fmt)
        back = files.read_roster(spark, path + fmt, fmt)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, hr.collect()))
        assert set(back.dtypes) == set(hr.dtypes)
    header = [open(os.path.join(path + "csv", f)).readline() for f in os.listdir(path + "csv") if f.startswith("part")]
    assert header[0].strip() == "IP_Address,First_Name,Last_Name,Department,Sub-Department,Start_Date"


def test_dotted_names_are_renamed_at_the_edge(spark):
    df = spark.createDataFrame([("a", "b")], "`client.ip` string, `@timestamp` string")
    out = files.to_snake(df, files.EVENT_NAMES)
    assert out.columns == ["client_ip", "event_ts"]
    assert files.from_snake(out, files.EVENT_NAMES).columns == ["client.ip", "@timestamp"]


def test_partitions_are_replaced_one_by_one(spark, path):
    tx = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2)], "accountID int, year int, month int").withColumn(
        "timestamp", F.make_timestamp("year", "month", F.lit(5), F.lit(0), F.lit(0), F.lit(0))
    )
    files.write_partitions(tx, path, ["year", "month"], sort_by="timestamp")
    files.write_partitions(tx.where("month = 2").withColumn("accountID", F.lit(9)), path, ["year", "month"])
    back = files.read_transactions(spark, path)
    assert sorted((r.accountID, r.month) for r in back.collect()) == [(1, 1), (9, 2)]
    pruned = files.months_between(back, datetime(2020, 2, 1, tzinfo=timezone.utc), datetime(2020, 2, 28, tzinfo=timezone.utc))
    assert [r.accountID for r in pruned.collect()] == [9]
    scan = next(line for line in plan_text(pruned).splitlines() if "FileScan" in line)
    assert "PartitionFilters: []" not in scan and "PushedFilters: []" not in scan


def test_messages_keep_line_breaks(spark, path):
    df = spark.createDataFrame([("one\ntwo",), ('{"a":\n1}',)], "message string")
    files.write_parquet(df, path, row_group_bytes=1 << 20)
    assert files.read_messages(spark, path).where(F.col("message").contains("\n")).count() == 2
    files.write_ndjson(df, path + "nd")
    assert spark.read.text(path + "nd").count() == 2


def test_ndjson(spark, path):
    files.write_ndjson(spark.createDataFrame([('{"order_id":"O",\n"quantity":2}',)], "message string"), path)
    assert files.read_ndjson(spark, path, documents.ORDER_DDL).select("order_id", "quantity").first() == ("O", 2)


def test_ids_repeat_between_reads(spark, path):
    files.write_parquet(spark.range(50).withColumnRenamed("id", "n"), path)
    first, second = (
        {r.n: r._id for r in files.with_ids(spark.read.parquet(path), "logs-a").collect()} for _ in range(2)
    )
    assert first == second and len(set(first.values())) == 50
    keyed = files.with_ids(spark.createDataFrame([("k",)], "_id string"), "logs-b").first()
    assert (keyed._id, keyed._index) == ("k", "logs-b")


def test_patterns_and_aliases(spark):
    catalog = {
        "logs-a": lambda s: s.createDataFrame([(1,)], "x int"),
        "logs-b": lambda s: s.createDataFrame([(2, "y")], "x int, y string"),
        "alerts-000001": lambda s: s.createDataFrame([(3,)], "x int"),
    }
    out = files.read_dataset(spark, "logs-*", catalog)
    assert sorted((r.x, r.y, r._index) for r in out.collect()) == [(1, None, "logs-a"), (2, "y", "logs-b")]
    alias = files.read_dataset(spark, "alerts", catalog, {"alerts": ["alerts-000001"]}).first()
    assert alias._index == "alerts-000001"
    assert files.read_dataset(spark, "logs-a", catalog).columns == ["x", "_index"]
    with pytest.raises(ValueError):
        files.read_dataset(spark, "none-*", catalog)


def test_object_store_settings():
    conf = files.s3_conf("http://store:9000", "eu-west-1")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "Anonymous" in conf["spark.hadoop.fs.s3a.aws.credentials.provider"]
    assert len(files.s3_conf("https://store", anonymous=False)) == 4


def test_json_results(spark):
    df = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    assert files.results_json(df).first()[0] == '{"a":1,"b":[1,2]}'


def test_shares_profile_and_order(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "p string, c string")
    assert {r.p: r.share for r in shares.share_of_total(df, "p").collect()} == {"a": 0.5, "b": 0.25, None: 0.25}
    within = {(r.p, r.c): r.share for r in shares.share_in_parent(df, "p", "c").collect()}
    assert within == {("a", "x"): 0.5, ("a", "y"): 0.5, ("b", "x"): 1.0, (None, "x"): 1.0}
    row = shares.conditional_share(df, {"xs": F.col("c") == "x"}).first()
    assert (row.checked, row.xs, row.xs_pct) == (4, 3, 75.0)
    empty = shares.conditional_share(df.where("false"), {"xs": F.col("c") == "x"}).first()
    assert (empty.checked, empty.xs_pct) == (0, 0.0)
    prof = shares.profile(df, "c", "p", {"ps": "p"}).first()
    assert (prof.rows, prof.columns, prof.raw_bytes, prof.first_ts, prof.ps) == (4, 2, 3, "x", 2)
    nums = spark.range(1000).select((F.col("id") * 37 % 1000).alias("t"))
    assert [r.t for r in shares.first_rows(nums, 3, "t").collect()] == [0, 1, 2]
    assert [r.t for r in shares.time_sorted(nums, "t", partitions=4).collect()] == list(range(1000))


@pytest.fixture()
def small_splits(spark):
    """Splits of the size given, whatever the files' sizes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def choose(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)
        spark.conf.set(names[2], 1)

    yield choose
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("fmt", ["csv", "json", "text"])
def test_rows_are_numbered_in_any_format_and_split(spark, path, small_splits, fmt):
    lines = {"csv": lambda i: f"{i},same", "json": lambda i: f'{{"n":{i},"word":"same"}}', "text": lambda i: f"{i}"}[fmt]
    os.makedirs(path)
    sizes = {"a": 3, "b": 1000, "c": 0, "d": 257}
    for name, n in sizes.items():
        with open(f"{path}/{name}.{fmt}", "w") as f:
            f.write(("n,word\n" if fmt == "csv" else "") + "".join(lines(i) + ("\n" * (1 + (i % 50 == 7)) if fmt != "text" else "\n") for i in range(n)))
    results = []
    for size in ("37b", "500b", "1m"):
        small_splits(size)
        reader = spark.read.schema("value string" if fmt == "text" else "n int, word string")
        df = reader.csv(path, header=True) if fmt == "csv" else reader.json(path) if fmt == "json" else reader.text(path)
        df = df.withColumnRenamed("value", "n")
        if size == "37b":
            assert df.rdd.getNumPartitions() > 20
        rows = files.with_row_numbers(df).collect()
        assert len(rows) == sum(sizes.values()) and all(int(r["n"]) == r["row_number"] for r in rows)
        ids = files.with_ids(df, "logs-x").collect()
        assert len({r["_id"] for r in ids}) == len(ids) and {r["_index"] for r in ids} == {"logs-x"} and ids[0].asDict().keys() == {*df.columns, "_id", "_index"}
        results.append(sorted((int(r["n"]), r["_id"]) for r in ids))
        over_all = files.with_row_numbers(df, "at", within_file=False).collect()
        assert sorted(r["at"] for r in over_all) == list(range(len(over_all)))
    assert results[0] == results[1] == results[2]


def test_a_filter_on_ids_reads_the_same_ids(spark, path):
    spark.range(0, 500, 1, 4).selectExpr("id", "'x' as word").write.csv(path)
    df = spark.read.schema("id long, word string").csv(path)
    whole = {r["id"]: r["_id"] for r in files.with_ids(df, "i").collect()}
    some = files.with_ids(df, "i").where("id % 7 = 3").select("_id", "id").collect()
    assert all(whole[r["id"]] == r["_id"] for r in some) and len(some) == 71
