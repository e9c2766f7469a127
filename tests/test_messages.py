from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loglattice.plans.messages import classify, kv_map, parse_messages
from loglattice.registry import derived, rendered

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
TRACE = (
    "2024-01-05 10:11:12,345 ERROR [t-1] c.x.Y - Unhandled exception accountId=3 clientIp=10.31.0.77\n"
    "java.net.SocketTimeoutException: Read timed out\n\tat a.b.c(D.java:1)\n\tat e.f(G.java:2)\n"
    "Caused by: x.Y: reset\n\t... 12 common frames omitted"
)
# kind, message, expected columns
CASES = [
    ("log4j", "2024-01-05 10:11:12,345 WARN  [exec-4] c.x.Login - Repeated failed login user=bob clientIp=10.31.0.9 attempts=5",
     {"level": "WARN", "client_ip": "10.31.0.9", "user_name": "bob", "service": "c.x.Login"}),
    ("log4j", '2024-01-05 10:11:12,345 DEBUG [exec-4] c.x.Acct - Cache miss key=acct:77:balance ttl=30s', {"account_id": 77}),
    ("log4j", "2024-01-05 10:11:12,345 INFO  [exec-4] c.x.Acct - Balance inquiry accountId=9 clientIp=10.31.0.9 elapsed=41ms",
     {"duration_ms": 41.0, "account_id": 9}),
    ("log4j", "2024-01-05 10:11:12,345 WARN  [exec-4] c.x.Login - Authentication failed user=root clientIp=10.31.0.9 "
     "reason=BAD_CREDENTIALS attempt=3", {"user_name": "root"}),
    ("log4j", "2024-01-05 10:11:12,345 WARN  [exec-1] c.x.Job - Bulk export requested rows=9000 clientIp=10.31.0.9 "
     "principal=admin format=csv", {"user_name": "admin", "client_ip": "10.31.0.9"}),
    ("nginx", '10.31.0.7 - - [05/Jan/2024:10:11:12 +0000] "GET /api?accountId=77 HTTP/1.1" 403 512 "-" "curl/8" rt=0.123',
     {"client_ip": "10.31.0.7", "http_status": 403, "bytes": 512, "account_id": 77, "duration_ms": 123.0, "user_name": None}),
    ("syslog", "Jan  5 10:11:12 app-01 sshd[77]: Failed password for invalid user admin from 10.31.0.5 port 4444 ssh2",
     {"client_ip": "10.31.0.5", "user_name": "admin", "ts": datetime(2024, 1, 5, 10, 11, 12)}),
    ("syslog", "Dec 31 10:11:12 app-01 sshd[77]: Disconnected from authenticating user root 10.31.0.6 port 4444 [preauth]",
     {"client_ip": "10.31.0.6", "user_name": "root", "ts": datetime(2023, 12, 31, 10, 11, 12)}),
    ("syslog", "Jan 15 10:11:12 app-01 systemd[77]: Started Session 12 of user carol.", {"client_ip": None, "user_name": "carol"}),
    ("haproxy", "Jan  5 10:11:12 edge-01 haproxy[901]: 10.31.0.8:31000 [05/Jan/2024:10:11:12.345] fe_https~ be_auth/srv1 "
     '1/2/3/4/5 401 1234 - - ---- 1/1/0/0/0 0/0 "POST /login HTTP/2.0"',
     {"client_ip": "10.31.0.8", "duration_ms": 5.0, "url_path": "/login", "ts": datetime(2024, 1, 5, 10, 11, 12, 345000)}),
    ("envoy", '[2024-01-05T10:11:12.345Z] "GET /health HTTP/2" 200 - 10 2000 33 30 "10.31.0.4" "ua x" "abc" "auth.svc" '
     '"10.42.1.9:8080"', {"client_ip": "10.31.0.4", "bytes": 2000, "duration_ms": 33.0}),
    ("kafka", "2024-01-05 10:11:12,345 INFO  [Consumer clientId=consumer-1] group=fp topic=txn partition=3 offset=1000 lag=17",
     {"level": "INFO"}),
    ("postgres", "2024-01-05 10:11:12.345 UTC [99] ledger@ledger_api LOG:  duration: 1234.500 ms  statement: SELECT 1",
     {"duration_ms": 1234.5, "level": "LOG", "user_name": "ledger"}),
    ("cef", "Jan  5 10:11:12 siem CEF:0|V|Core|4.2|101|Failed Login|5|src=10.31.0.3 suser=bob dst=10.42.1.17 dpt=443 "
     "cs1Label=accountId cs1=55 cs2Label=sessionId cs2=xx outcome=failure", {"client_ip": "10.31.0.3", "account_id": 55}),
    ("cef", "Jan  5 10:11:12 siem CEF:0|V|DLP|4.2|402|Anomalous Data Access Volume|7|src=10.31.0.3 suser=bob dst=10.42.1.17 "
     "cs1Label=bytes cs1=123456789 outcome=success", {"bytes": 123456789, "account_id": None}),
    ("hikari", "2024-01-05T10:11:12.345Z | app-01 | HikariPool-1 | pool stats: total=50 active=48 idle=2 waiting=9", {}),
    ("gc", "[2024-01-05T10:11:12.345+0000] GC(#12) Pause Full (System.gc()) 3000M->2500M(8192M) 12.5ms", {"duration_ms": 12.5}),
    ("iis", "2024-01-05 10:11:12 10.42.3.22 GET /api accountId=9 443 - 10.31.0.2 agent+x - 200 0 0 45",
     {"client_ip": "10.31.0.2", "account_id": 9, "duration_ms": 45.0}),
    ("redis", "12:M 05 Jan 2024 10:11:12.345 * Client id=7 addr=10.31.0.1:3333 scheduled to be closed", {"client_ip": "10.31.0.1"}),
    ("waf", '2024/01/05 10:11:12 [error] 12#0: *34 ModSecurity: Access denied with code 403 (phase 2). Matched "Operator `Rx`" '
     '[id "942100"] [msg "SQL Injection"] [severity "CRITICAL"] [data "\' OR \'1\'=\'1"], client: 10.31.0.99, server: api.x, '
     'request: "GET /api HTTP/1.1"', {"client_ip": "10.31.0.99", "http_status": 403, "level": "CRITICAL"}),
    ("stacktrace", TRACE, {"frames": ["a.b.c(D.java:1)", "e.f(G.java:2)"], "caused_by": "x.Y", "account_id": 3}),
    ("jsonish", '{"ts":"2024-01-05T10:11:12.345Z","svc":"auth","lvl":"warn","msg":"ok","accountId":5,"clientIp":"10.31.0.11",'
     '"traceId":"t","durationMs":12,"status":401}', {"level": "WARN", "http_status": 401, "client_ip": "10.31.0.11"}),
    ("otel_span", '{\n "resource":{"attributes":{"service.name":"auth"}},\n "span":{"startTimeUnixNano":1704449472345678901,'
     '"endTimeUnixNano":1704449472355678901,"attributes":{"client":{"address":"10.31.0.12"},"enduser":{"id":"u","accountId":8}}}}',
     {"service": "auth", "ts": datetime(2024, 1, 5, 10, 11, 12, 345678), "duration_ms": 10.0, "account_id": 8}),
    ("order", '{"order_id":"ORDER-00000001","order_date":"2024-01-05T10:11:12.345Z","status":"pending"}', {"http_status": None}),
    ("unknown", "garbage", {"ts": None}),
    ("json_other", "{ broken", {"ts": None}),
    ("kafka", "2024-01-05 10:11:12,345 INFO [Consumer clientId=cut-off", {"ts": None, "level": None}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[1]) for i, c in enumerate(CASES)], "i int, message string")
    return {r.i: r for r in parse_messages(df, AS_OF, with_doc=True).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_samples(parsed, i):
    kind, message, expected = CASES[i]
    row = parsed[i]
    assert row.kind == kind and row.message == message
    assert {c: row[c] for c in expected} == expected
    if kind not in ("unknown", "json_other") and expected.get("ts", 1) is not None:
        assert row.ts is not None


def test_every_row_is_kept(parsed):
    assert len(parsed) == len(CASES)


def test_doc_only_for_json(parsed):
    assert [parsed[i].doc is not None for i in range(len(CASES))] == [
        c[0] in ("jsonish", "otel_span", "order") for c in CASES
    ]


def test_classify_agrees(spark):
    df = spark.createDataFrame([c[:2] for c in CASES], "want string, message string")
    assert df.where(classify("message") != F.col("want")).count() == 0


def test_explicit_year(spark):
    df = spark.createDataFrame([("Dec 31 10:11:12 app-01 sshd[77]: x",)], "message string")
    assert parse_messages(df, AS_OF, year=2020).first().ts == datetime(2020, 12, 31, 10, 11, 12)


def test_repeated_keys_keep_the_first_value(spark):
    df = spark.createDataFrame([('a=1 b="two words" a=3 plain c.d=x=y',)], "t string")
    assert df.select(kv_map(F.col("t"))).first()[0] == {"a": "1", "b": "two words", "c.d": "x=y"}


def test_filters_on_parsed_columns_stay_cheap(spark):
    facts = derived.frame(spark, "/root/testdata/sf0.001", "line_facts")
    parsed = parse_messages(rendered.mixed(facts), AS_OF)
    hot = parsed.where("client_ip is not null and http_status = 401 and account_id > 5 and kv['agent'] is not null")
    text = hot._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
    assert "PythonUDF" not in text and hot.count() >= 0


def test_one_scan_no_shuffle(spark):
    facts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("text").alias("message"))
    plan = parse_messages(facts, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
