from datetime import datetime

from pyspark.sql import functions as F

from loglattice.functions import ip, scalars


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_addresses_are_strict(spark):
    texts = ["10.31.100.12", "bad", "", "1.2.3.256", "1.2.3.", "01.2.3.4", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(ip.to_ip("t"), ip.ip_to_long("t")).collect()]
    assert got == [("10.31.100.12", 169829388)] + [(None, None)] * 6


def test_address_round_trip_and_range(spark):
    df = spark.createDataFrame([("10.30.254.255",), ("10.30.255.0",), ("10.50.255.0",), ("10.50.255.1",)], "t string")
    rows = df.select("t", ip.long_to_ip(ip.ip_to_long("t")), ip.in_range("t")).collect()
    assert all(r[0] == r[1] for r in rows)
    assert [r[2] for r in rows] == [False, True, True, False]
    low, high = ip._bound(ip.CLIENT_RANGE[0]), ip._bound(ip.CLIENT_RANGE[1])
    assert high - low + 1 == 1_310_721


def test_ipv6_only_on_request(spark):
    row = one(spark, ip.to_ip(F.lit("fe80::1")).alias("a"), ip.to_ip(F.lit("fe80::1"), True).alias("b"))
    assert row.a is None and row.b == "fe80::1"


def test_case_null_is_false(spark):
    null = F.lit(None).cast("string")
    row = one(
        spark,
        scalars.case([(null == "x", F.lit(1)), (F.lit(True), F.lit(2))]).alias("a"),
        scalars.case([(null == "x", F.lit(1))]).alias("b"),
    )
    assert row.a == 2 and row.b is None


def test_values_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "b"), ("n", None)], "k string, v string")
    got = dict(df.groupBy("k").agg(scalars.distinct_values("v")).collect())
    assert got == {"a": ["b", "x"], "n": None}


def test_names_ids_and_lists(spark):
    row = one(
        spark,
        scalars.full_name(F.lit("A"), F.lit(None).cast("string")).alias("n"),
        scalars.parse_id_list(F.lit(" a, b ,,c")).alias("ids"),
        scalars.id_ok(F.lit("ORDER-00000001"), "order").alias("ok"),
        scalars.id_ok(F.lit("ORDER-1"), "order").alias("bad"),
        scalars.replace_pattern(F.lit("from x\nFROM y meta"), r"^(from \w+)(?!\s+meta)", "$1 meta", "im").alias("r"),
    )
    assert row.n == "A " and row.ids == ["a", "b", "c"] and row.ok and not row.bad
    assert row.r == "from x meta\nFROM y meta"


def test_time_and_money(spark):
    ts = F.lit(datetime(2024, 1, 5, 15, 30, 1, 234567))
    row = one(
        spark,
        scalars.iso_millis(ts).alias("iso"),
        scalars.hour_band(ts).alias("peak"),
        scalars.hour_band(F.lit(datetime(2024, 1, 6, 15))).alias("weekend"),
        scalars.hour_band(F.lit(datetime(2024, 1, 5, 13))).alias("shoulder"),
        scalars.hour_band(F.lit(datetime(2024, 1, 5, 9))).alias("overnight"),
        scalars.business_hour(F.lit(datetime(2024, 1, 5, 13))).alias("on"),
        scalars.business_hour(F.lit(datetime(2024, 1, 5, 12))).alias("off"),
        scalars.money(F.lit(10.6), F.lit("JPY")).alias("yen"),
        scalars.money(F.lit(10.126), F.lit("EUR")).alias("euro"),
        scalars.to_usd(F.lit(1000.0), F.lit(0.006579)).alias("usd"),
        scalars.season_factor(ts).alias("season"),
    )
    assert row.iso == "2024-01-05T15:30:01.234Z"
    assert (row.peak, row.weekend, row.shoulder, row.overnight) == ("peak", "weekend", "shoulder", "overnight")
    assert row.on and not row.off
    assert (row.yen, row.euro, row.usd, row.season) == (11.0, 10.13, 6.58, 1.0)


def test_mean_score(spark):
    df = spark.createDataFrame([([(0.2,), (0.5,)],), ([],)], "rules array<struct<score: double>>")
    assert [r[0] for r in df.select(scalars.mean_score(F.col("rules"), "score")).collect()] == [0.35, 0.0]


def test_address_edges(spark):
    texts = [("10.0.0.1\n",), ("10.0.0.1",), ("::1",), ("fe80::a:1",), ("a:b",), ("1:2:3:4:5:6:7:8",), ("1:2:3:4:5:6:7",), (":::",), ("1::2::3",)]
    df = spark.createDataFrame(texts, "t string")
    got = {r.t: (r.a, r.b) for r in df.select("t", ip.to_ip("t").alias("a"), ip.to_ip("t", allow_ipv6=True).alias("b")).collect()}
    assert [t for (t,) in texts if got[t][0]] == ["10.0.0.1"]
    assert [t for (t,) in texts if got[t][1]] == ["10.0.0.1", "::1", "fe80::a:1", "1:2:3:4:5:6:7:8"]
    numbers = spark.createDataFrame([(None,), (2**32 - 1,), (2**32,), (-1,)], "n long").select(ip.long_to_ip("n").alias("t"))
    assert [r.t for r in numbers.collect()] == [None, "255.255.255.255", None, None]
