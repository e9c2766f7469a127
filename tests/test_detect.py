import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from loglattice.operators import joins
from loglattice.plans import audits, detect
from loglattice.plans.messages import parse_messages

T0 = datetime(2024, 1, 5, tzinfo=timezone.utc)
HR = "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string"


def at(**kw):
    return T0 + timedelta(**kw)


@pytest.mark.parametrize("max_listed", [0, 100])
def test_interval_tags(spark, max_listed):
    events = spark.createDataFrame(
        [(1, at(hours=1)), (2, at(hours=3)), (3, at(hours=3, seconds=1)), (4, at(hours=2)), (5, at(hours=-1)), (6, None)],
        "id int, ts timestamp",
    )
    intervals = spark.createDataFrame(
        [(1, at(hours=1), at(hours=3), "recon"), (2, at(minutes=90), at(hours=9), "exfil")],
        "seq int, start_ts timestamp, end_ts timestamp, phase string",
    )
    out = joins.tag_intervals(events, intervals, ["id"], max_listed=max_listed)
    assert "NestedLoop" not in plan_text(out)
    got = {r.id: (r.phase, r.in_any) for r in out.collect()}
    assert got == {1: ("recon", True), 2: ("recon", True), 3: ("exfil", True), 4: ("recon", True), 5: (None, False), 6: (None, False)}


@pytest.mark.parametrize("bucket", [1, 60, 100_000])
def test_travel_is_the_same_for_any_bucket(spark, bucket):
    home, away = (39.7, -105.0), (46.8, 23.6)
    rows = [("a", at(seconds=10 * i), *(away if i % 7 == 3 else home)) for i in range(60)]
    rows += [("a", at(seconds=30), *away)] * 50  # copies of one position
    rows += [("b", at(hours=0), *home), ("b", at(hours=40), *away), ("c", at(hours=1), *home), ("c", at(hours=1), *away)]
    df = spark.createDataFrame(rows, "client_ip string, ts timestamp, lat double, lon double")
    out = detect.impossible_travel(df, 800.0, bucket_seconds=bucket).collect()
    assert sum(r.client_ip == "a" for r in out) == 2 * len([i for i in range(60) if i % 7 == 3]) - 1  # no way back from the last
    assert not any(r.client_ip == "b" for r in out)
    assert [r.kmh for r in out if r.client_ip == "c"] == [None]


def test_account_activity_never_multiplies(spark):
    logs = spark.createDataFrame([(1, at(hours=h)) for h in range(5)] + [(2, T0)], "account_id bigint, ts timestamp")
    tx = spark.createDataFrame(
        [(1, at(days=d), 10.0) for d in (-2, -1, 0, 1, 2)] * 3, "account_id bigint, ts timestamp, amount double"
    )
    got = {r.account_id: (r.log_events, r.transactions, r.amount) for r in joins.account_activity(logs, tx).collect()}
    assert got == {1: (5, 9, 90.0), 2: (1, 0, 0.0)}


def test_dimensions_never_multiply(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a")], "id int, name string")
    assert sorted(str(r.name) for r in joins.dim_enrich(facts, {"k": (dim, "id", ["name"])}).collect()) == ["None", "None", "a", "a"]


def test_archive_meets_live_without_overlap_or_gap(spark):
    tx = spark.createDataFrame([(i, at(hours=i)) for i in range(-5, 5)], "id int, timestamp timestamp")
    both = joins.archive_and_live(tx, tx, T0)
    assert both.count() == both.select("id").distinct().count() == 10
    assert {r.data_origin for r in both.where("id = 0").collect()} == {"live"}


def test_coverage_and_persons(spark):
    logs = spark.createDataFrame([("10.0.0.1", T0), ("10.0.0.9", T0), (None, T0)], "client_ip string, ts timestamp")
    hr = spark.createDataFrame([("10.0.0.1", "A", "B", "d", "s", "2023-12-31"), ("10.0.0.2", "C", "D", "d", "s", "x")], HR)
    got = {(r.ip, r.coverage) for r in joins.roster_coverage(logs, hr).collect()}
    assert got == {("10.0.0.9", "external"), ("10.0.0.2", "silent")}
    row = joins.events_to_persons(logs, hr).collect()
    assert [(r.client_ip, r.last_name, r.tenure_days) for r in row] == [("10.0.0.1", "B", 5)]


def test_probe_rules(spark):
    samples = {
        "/api/v2/../../etc/passwd": ["path_traversal"], "/q?x=' OR '1'='1": ["sql_injection"], "/.env": ["hidden_file"],
        "/actuator/heapdump": ["admin_surface"], "/api/v2/accounts": [],
    }
    df = spark.createDataFrame([(k,) for k in samples], "u string")
    got = {r.u: r.t for r in df.select("u", detect.probe_tags(F.col("u"), F.lit("curl/8")).alias("t")).collect()}
    assert got == samples
    assert df.select(detect.probe_tags(F.lit("/"), F.lit("sqlmap/1.8"))).first()[0] == ["scanner_agent"]


def test_bursts_and_rates(spark):
    rows = [("a", at(minutes=m), 401, f"u{m}", m) for m in range(4)] + [("b", at(hours=1), 401, "u", 1), ("a", at(hours=2), 200, "u", 1)]
    df = spark.createDataFrame(rows, "client_ip string, ts timestamp, http_status int, user_name string, account_id int")
    assert [(r.client_ip, r.n) for r in detect.status_burst(df, 3).collect()] == [("a", 4)]
    assert detect.status_burst(df, 3, "5 minutes", "1 minute").count() > 1
    for exact in (True, False):
        assert [r.users for r in detect.stuffing(df, 3, 3, exact=exact).collect()] == [4]
        assert [r.accounts for r in detect.enumeration(df, 4, exact=exact).collect()] == [4]
    counts = [10, 11, 9, 10, 11, 9, 60, 60, 60]
    many = [("k", at(hours=h, seconds=i)) for h, n in enumerate(counts) for i in range(n)]
    series = spark.createDataFrame(many, "kind string, ts timestamp")
    spikes = detect.rate_spikes(series, ["kind"], 3600, 6, 3.0).collect()
    assert [r.n for r in spikes][:1] == [60] and len(spikes) == 1
    change = detect.change_points(series, ["kind"], 3600, 3).first()
    assert change.gap == 50.0 and change.bucket == int(at(hours=6).timestamp()) // 3600


def test_silence_counts_as_zero(spark):
    quiet = [("k", at(hours=0))] + [("k", at(hours=19, seconds=i)) for i in range(500)]
    series = spark.createDataFrame(quiet, "kind string, ts timestamp")
    assert [r.n for r in detect.rate_spikes(series, ["kind"], 3600, 24, 3.0).collect()] == [500]
    ended = [("k", at(hours=h, seconds=i)) for h in range(6) for i in range(30)] + [("k", at(hours=12))]
    change = detect.change_points(spark.createDataFrame(ended, "kind string, ts timestamp"), ["kind"], 3600, 3).first()
    assert change.gap == 30.0 and change.bucket == int(at(hours=6).timestamp()) // 3600


def test_change_points_see_silent_boundaries(spark):
    rng = random.Random(3)
    counts = {"late": {0: 1, 50: 1, 100: 100}, "two": {0: 3, 100: 9}, "short": {0: 1, 4: 7}}
    counts |= {f"r{i}": {0: 1} | {rng.randrange(40): rng.randrange(1, 30) for _ in range(rng.randrange(1, 6))} for i in range(12)}
    rows = [(k, at(seconds=3600 * b)) for k, series in counts.items() for b, n in series.items() for _ in range(n)]
    found = detect.change_points(spark.createDataFrame(rows, "kind string, ts timestamp"), ["kind"], 3600, 5).collect()
    zero = int(at(hours=0).timestamp()) // 3600
    got = {r.kind: (r.bucket - zero, r.gap) for r in found}
    for k, series in counts.items():
        n = lambda a, b, series=series: sum(series.get(i, 0) for i in range(a, b))
        gaps = {b: abs(n(b, b + 5) - n(b - 5, b)) / 5 for b in range(5, max(series) - 3)}
        assert (k in got) == bool(gaps), k
        if gaps:
            assert got[k][1] == max(gaps.values()) == gaps[got[k][0]], k
    assert got["late"] == (96, 20.0)


def test_campaign_lines_are_seen_in_every_shape(spark):
    lines = [
        "2024-01-05 10:11:12,345 WARN  [exec-1] c.x.Auth - Authentication failed user=u1 clientIp=10.0.0.7 reason=BAD_CREDENTIALS",
        "Jan  5 10:11:13 siem CEF:0|Vendor|Core|4.2|101|Failed Login|7|src=10.0.0.7 suser=u2 outcome=failure",
        "Jan  5 10:11:14 app-01 sshd[200]: Failed password for invalid user u3 from 10.0.0.7 port 30001 ssh2",
        "2024-01-05 10:11:15,345 WARN  [exec-1] c.x.Auth - Authentication failed user=u4 reason=BAD_CREDENTIALS",
        '2024/01/05 10:11:16 [error] 12#0: *1 ModSecurity: Access denied with code 403 (phase 2). [id "942100"] [msg "SQL"] [severity "CRITICAL"] '
        '[data "1 UNION SELECT x"], client: 10.0.0.8, server: api, request: "GET /a HTTP/1.1"',
    ]
    events = parse_messages(spark.createDataFrame([(x,) for x in lines], "message string"), datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert [(r.client_ip, r.failures, r.users) for r in detect.stuffing(events, 3, 3, "1 day", exact=True).collect()] == [("10.0.0.7", 3, 3)]
    assert [(r.client_ip, r.rule) for r in detect.probe_hits(events).collect()] == [("10.0.0.8", "sql_injection")]
    rows = [("10.0.0.9", at(hours=1), 1800, {"rows": "1800000"}), (None, at(hours=1), 10**9, {"rows": "1"}), ("10.0.0.9", at(hours=30), None, {"rows": "2000000"})]
    moved = spark.createDataFrame(rows, "client_ip string, ts timestamp, bytes bigint, kv map<string,string>")
    assert [r.exported_rows for r in detect.exfil(moved, 10**6, min_rows=10**6).orderBy("window_start").collect()] == [1800000, 2000000]


def test_baselines(spark):
    hist = spark.createDataFrame([(1, float(v)) for v in range(90, 111)] + [(2, 5.0)], "account_id int, amount double")
    now = spark.createDataFrame([(1, 500.0), (2, 5.0), (3, 1.0)], "account_id int, amount double")
    rows = {r.account_id: r for r in detect.account_baseline(hist, now).collect()}
    assert rows[1].z > 10 and rows[1].base_p95 == 109.0 and rows[2].z is None and rows[3].base_n is None
    assert [r.account_id for r in detect.account_baseline(hist, now, 3.0).collect()] == [1]


def test_roster_range_and_mix(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), ("10.0.0.4",), ("10.0.0.4",), ("x",)], "ip_address string")
    row = audits.roster_range(df).first()
    assert (row.rows, row.addresses, row.is_unique, row.is_contiguous) == (4, 3, False, False)
    staff = spark.range(100).select(
        F.expr("case when id < 35 then 'sales' when id < 55 then 'engineering' when id < 70 then 'marketing' "
               "when id < 85 then 'support' when id < 93 then 'finance' when id < 97 then 'legal' else 'leadership' end").alias("department")
    )
    assert all(r.within for r in audits.department_mix(staff).collect())
