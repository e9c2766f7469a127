import random

from pyspark.sql import functions as F

from loglattice.operators import correlate as C

LOG = "_id string, _index string, client_ip string, host_ip string, destination_ip string, source_ip string, event_module string"
HR = "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string"


def logs(spark, *rows):
    """rows: (_id, client_ip, module[, host_ip])"""
    full = [(r[0], "logs-a", r[1], r[3] if len(r) > 3 else None, None, None, r[2]) for r in rows]
    return spark.createDataFrame(full, LOG)


def roster(spark, *ips):
    return spark.createDataFrame([(ip, f"F{i}", "L", "sales", "sdr", "2020-01-01") for i, ip in enumerate(ips)], HR)


def test_netflow_ignores_other_modules(spark):
    out = C.netflow_roster(
        logs(spark, ("1", "10.0.0.1", "proxysg"), ("2", "10.0.0.2", "network_traffic"), ("3", "10.0.0.2", None)),
        roster(spark, "10.0.0.1", "10.0.0.2"),
    ).collect()
    assert [(r.client_ip, r.log_events, r.hr_matches, r.first_name) for r in out] == [("10.0.0.2", 1, 1, ["F1"])]


def test_five_modules_counts_and_filters(spark):
    rows = [("1", "10.0.0.1", "proxysg"), ("2", "10.0.0.1", "system"), ("3", "10.0.0.1", "strange"), ("4", "10.0.0.2", "email")]
    hr = roster(spark, "10.0.0.1", "10.0.0.2", "not-an-ip")
    out = C.five_module_roster(logs(spark, *rows), hr, "10.0.0.1").collect()
    assert [(r.client_ip, r.log_events) for r in out] == [("10.0.0.1", 2)]
    assert C.five_module_roster(logs(spark, *rows), hr).count() == 2


def test_document_ids_hold_uncounted_rows(spark):
    data, hr = logs(spark, ("a", "10.0.0.1", "email"), ("b", "10.0.0.1", None), ("b", "10.0.0.1", None), ("c", "10.0.0.3", "email")), roster(spark, "10.0.0.1")
    groups = C.document_roster(data, hr)
    out = groups.first()
    assert out.log_events == 1 and out.dataset == ["email"] and out["index"] == ["logs-a"]
    assert sorted(map(tuple, C.documents_of(groups, data).collect())) == [("10.0.0.1", "a"), ("10.0.0.1", "b")]


def test_a_busy_address_is_one_row(spark):
    rows = [(f"d{i}", "10.0.0.1", "email") for i in range(200)] + [("x", "10.0.0.2", "email")]
    data, hr = logs(spark, *rows), roster(spark, "10.0.0.1", "10.0.0.2")
    groups = C.document_roster(data, hr)
    assert sorted((r.client_ip, r.log_events) for r in groups.collect()) == [("10.0.0.1", 200), ("10.0.0.2", 1)]
    assert sorted(r._id for r in C.documents_of(groups, data).collect()) == sorted(r[0] for r in rows)


def test_lookup_counts_roster_rows_as_events(spark):
    out = C.lookup_exact(logs(spark, ("a", "10.0.0.9", "email")), roster(spark, "10.0.0.1"), "10.0.0.1").collect()
    assert [(r.client_ip, r.log_events, r.hr_matches) for r in out] == [("10.0.0.1", 1, 1)]


def test_lookup_of_invalid_text_keeps_a_null_key(spark):
    out = C.lookup_exact(logs(spark, ("a", "10.0.0.9", "email")), roster(spark, "not-an-ip"), "not-an-ip").collect()
    assert [(r.client_ip, r.log_events, r.hr_matches) for r in out] == [(None, 1, 1)]


def test_other_fields_match_only_in_the_wider_lookup(spark):
    data = logs(spark, ("a", "10.0.0.9", "email", "10.0.0.1"), ("b", None, "email", "10.0.0.1"))
    hr = roster(spark, "10.0.0.1")
    exact = C.lookup_v5_exact(data, hr, "10.0.0.1").collect()
    assert [(r.client_ip, r.log_events) for r in exact] == [("10.0.0.1", 1)]
    wide = C.lookup_any_ip(data, hr, "10.0.0.1")
    assert [(r.client_ip, r.log_events) for r in wide.collect()] == [("10.0.0.1", 3)]
    assert sorted(r._id for r in C.documents_of(wide, C.documents_at(data, "10.0.0.1")).collect()) == ["a", "b"]


def test_repeated_roster_rows_do_not_multiply_events(spark):
    rng = random.Random(7)
    rows = [(str(i), f"10.0.0.{rng.randrange(5)}", rng.choice(["network_traffic", "email", None])) for i in range(300)]
    ips = [f"10.0.0.{rng.randrange(8)}" for _ in range(40)]
    out = {r.client_ip: (r.log_events, r.hr_matches) for r in C.netflow_roster(logs(spark, *rows), roster(spark, *ips)).collect()}
    want = {}
    for ip in set(ips):
        flows = sum(1 for r in rows if r[1] == ip and r[2] == "network_traffic")
        if flows:
            want[ip] = (flows, ips.count(ip))
    assert out == want


def test_three_datasets(spark):
    a = spark.createDataFrame([("k", "x")], "key string, v string")
    b = spark.createDataFrame([("k", 1), ("m", 1)], "key string, n int")
    c = spark.createDataFrame([("k",)], "key string")
    out = C.correlate(
        [a, b, c], "key", [("A", F.col("v").isNotNull()), ("B", F.col("n").isNotNull())],
        {"a": ["A"], "b": ["B"], "any": None}, {"v": "v"},
    ).collect()
    assert [tuple(r) for r in out] == [("k", 1, 1, 3, ["x"])]
