"""Attack phases: evidence per line, and chains of phases in order."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loglattice.plans import campaigns
from loglattice.plans.messages import parse_messages

T0 = datetime(2024, 1, 5, 10, tzinfo=timezone.utc)
NGINX = '10.1.1.1 - {user} [05/Jan/2024:10:00:00 +0000] "GET {url} HTTP/1.1" {status} {size} "-" "{agent}" rt=0.010'


def nginx(url="/api/v2/cards", status=200, size=10, agent="Mozilla/5.0", user="-"):
    return NGINX.format(url=url, status=status, size=size, agent=agent, user=user)


LOG4J = "2024-01-05 10:00:00,000 WARN  [exec-1] c.b.X - "
LINES = [
    (nginx("/.env", 404), "recon"), (nginx("/phpmyadmin/", 401), "recon"), (nginx(agent="sqlmap/1.8"), "recon"), (nginx(), None),
    (nginx("/api/v2/auth/login", 401, agent="Hydra/9.5"), "stuffing"), (nginx("/api/v2/cards", 401), None), (nginx("/api/v2/accounts?accountId=7", 403), "enumeration"),
    (nginx("/api/v2/accounts?accountId=7", 200), None), (nginx("/api/v2/accounts?accountId=7", 200, agent="Go-http-client/1.1"), "recon"),
    (nginx("/export", 200, 5_000_000, user="root"), "exfil"), (nginx("/export", 403, 900), None),
    (LOG4J + "Authentication failed user=root clientIp=10.1.1.1 reason=BAD_CREDENTIALS attempt=3", "stuffing"),
    (LOG4J + "Unauthorized account access attempt accountId=5 clientIp=10.1.1.1 principal=root", "enumeration"),
    (LOG4J + "Bulk export requested rows=6000 clientIp=10.1.1.1 format=csv", "exfil"), (LOG4J + "Bulk export requested rows=600 clientIp=10.1.1.1", None),
    (LOG4J + "Balance inquiry accountId=5 clientIp=10.1.1.1 elapsed=5ms", None),
    ("Jan  5 10:00:00 siem CEF:0|B|Auth|4.2|205|Excessive Authentication Failures|8|src=10.1.1.1 suser=root cs1Label=accountId cs1=5 outcome=failure", "stuffing"),
    ("Jan  5 10:00:00 siem CEF:0|B|DLP|4.2|402|Anomalous Data Access Volume|7|src=10.1.1.1 suser=root cs1Label=bytes cs1=20000000 outcome=success", "exfil"),
    ('{"ts":"2024-01-05T10:00:00.000Z","svc":"a","lvl":"warn","accountId":5,"clientIp":"10.1.1.1","durationMs":2,"status":403}', "enumeration"),
    ('2024/01/05 10:00:00 [error] 1#0: *1 ModSecurity: Access denied with code 403 (phase 2). [id "942100"] [msg "SQL"] [severity "CRITICAL"] '
     '[data "/api?accountId=5"], client: 10.1.1.1, server: s, request: "GET / HTTP/1.1"', "recon"),
    (LOG4J + "Authentication failed user=root clientIp=- reason=BAD_CREDENTIALS", "none"), ("no format at all", None), (None, None),
]


def test_every_shape_is_evidence_of_its_phase(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(LINES)], "id int, message string")
    got = parse_messages(df, datetime(2024, 2, 1, tzinfo=timezone.utc)).select("id", "client_ip", campaigns.attack_phase().alias("phase")).collect()
    assert {r["id"]: r["phase"] for r in got if r["client_ip"]} == {i: p for i, (m, p) in enumerate(LINES) if p != "none" and m and "10.1.1.1" in m}
    parsed = parse_messages(df, datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert campaigns.evidence(parsed).count() == sum(p not in (None, "none") for _, p in LINES)


def brute(marks, limit, bucket=60):
    """Every chain by nested loops over distinct buckets."""
    out = {}
    for key in {k for k, _, _ in marks}:
        at = {p: sorted({int((t - T0).total_seconds() + T0.timestamp()) // bucket for k, t, q in marks if k == key and q == p}) for p in campaigns.PHASES}
        ends = {}
        for x in at["exfil"]:
            starts = [r for r in at["recon"] if any(r <= s and any(s <= e <= x for e in at["enumeration"]) for s in at["stuffing"])]
            if starts and (x - max(starts)) * bucket <= limit:
                ends[x] = max(starts)
        if ends:
            first = min(ends)
            out[key] = (ends[first] * bucket, first * bucket, len(ends))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_chains_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    marks = [(f"10.0.0.{rng.randrange(30)}", T0 + timedelta(seconds=rng.randrange(40_000)), rng.choice(campaigns.PHASES)) for _ in range(300)]
    df = spark.createDataFrame(marks, "client_ip string, ts timestamp, phase string")
    want = brute(marks, 9_000)
    got = campaigns.ordered_phases(df, 9_000).collect()
    assert {r["client_ip"]: (int(r["started"].timestamp()), int(r["finished"].timestamp()), r["chains"]) for r in got} == want and want
    hits = {p: sum(q == p for k, _, q in marks if k == got[0]["client_ip"]) for p in campaigns.PHASES}
    assert {p: got[0][f"hits_{p}"] for p in campaigns.PHASES} == hits


def test_order_limit_and_thresholds(spark):
    def at(key, *steps):
        return [(key, T0 + timedelta(minutes=m), p) for m, p in steps]

    marks = (
        at("in order", (0, "recon"), (5, "stuffing"), (9, "enumeration"), (20, "exfil")) + at("reversed", (0, "exfil"), (5, "enumeration"), (9, "stuffing"), (20, "recon"))
        + at("too slow", (0, "recon"), (5, "stuffing"), (9, "enumeration"), (90, "exfil")) + at("gap", (0, "recon"), (9, "enumeration"), (20, "exfil"))
        + at("later start", (0, "recon"), (50, "recon"), (55, "stuffing"), (60, "enumeration"), (90, "exfil"))
        + at("stale middle", (0, "recon"), (1, "stuffing"), (2, "enumeration"), (85, "recon"), (90, "exfil"))
        + at("one bucket", (0, "exfil"), (0, "enumeration"), (0, "stuffing"), (0, "recon")) + at(None, (0, "recon"))
    )
    df = spark.createDataFrame(marks, "client_ip string, ts timestamp, phase string")
    assert {r["client_ip"] for r in campaigns.ordered_phases(df, 3600).collect()} == {"in order", "later start", "one bucket"}
    assert campaigns.ordered_phases(df, 3600, min_hits=2).count() == 0
    assert campaigns.ordered_phases(df.where("false"), 3600).count() == 0
    two = campaigns.ordered_phases(df, 3600, phases=("exfil", "recon")).collect()
    assert {r["client_ip"] for r in two} == {"reversed", "one bucket"}


def test_one_shuffle_of_reduced_rows(spark):
    df = spark.range(1000).select(F.concat(F.lit("10.0.0."), F.col("id") % 9).alias("client_ip"), F.timestamp_seconds(F.col("id") % 50).alias("ts"), F.element_at(F.array(*map(F.lit, campaigns.PHASES)), (F.col("id") % 4 + 1).cast("int")).alias("phase"))
    plan = plan_text(campaigns.ordered_phases(df, 3600))
    assert plan.count("Exchange hashpartitioning(client_ip") == 2 and plan.count("Exchange") == 2 and "partial_count" in plan
