"""Mergeable distinct counts, distances of distributions, and activity around log days."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loglattice.operators import joins, quantiles
from loglattice.plans import audits, sketches

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENT = "client_ip string, ts timestamp, user_name string, account_id long, http_status int, url_path string, bytes long, kv map<string,string>"


def made(spark, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["10.0.0.1", "10.0.0.2", None]), T0 + timedelta(minutes=rng.randrange(6000)), rng.choice([None, *"abcdef"]), rng.randrange(3000), rng.choice([200, 401, 403]),
             rng.choice(["/x", "/.env"]), rng.randrange(50), {"agent": rng.choice(["nmap", "m"])}) for _ in range(4000)]
    return rows, spark.createDataFrame(rows, EVENT)


def test_days_are_united_from_hours(spark):
    rows, events = made(spark)
    got = {(r["client_ip"], r["day"]): r for r in sketches.daily(sketches.hourly(events)).collect()}
    groups = {}
    for r in rows:
        if r[0]:
            groups.setdefault((r[0], r[1].date()), []).append(r)
    assert got.keys() == groups.keys()
    for key, held in groups.items():
        r, accounts = got[key], len({x[3] for x in held})
        assert (r["events"], r["bytes"]) == (len(held), sum(x[6] for x in held))
        assert r["users"] == len({x[2] for x in held if x[2]}) and abs(r["accounts"] - accounts) <= sketches.ERROR * accounts
        assert r["refused"] == sum(x[4] in (401, 403) for x in held) and r["probes"] == sum(x[5] == "/.env" or x[7]["agent"] == "nmap" for x in held)
    assert "Expand" not in plan_text(sketches.daily(sketches.hourly(events)))
    assert sketches.daily(sketches.hourly(events.where("false"))).count() == 0


@pytest.mark.parametrize("minimum", [5, 300, 401, 100_000])
def test_windows_near_the_threshold_are_counted(spark, minimum):
    rows, events = made(spark, 2)
    got = {(r["client_ip"], r["window"].date()) for r in sketches.at_least(sketches.hourly(events), events, "accounts", "account_id", minimum, F.date_trunc("day", "hour")).collect()}
    groups = {}
    for r in rows:
        if r[0]:
            groups.setdefault((r[0], r[1].date()), set()).add(r[3])
    assert got == {k for k, v in groups.items() if len(v) >= minimum}


def brute_distance(own, rest):
    points = sorted({*own, *rest})
    share = lambda values, x: sum(v <= x for v in values) / len(values)
    gaps = [share(rest, x) - share(own, x) for x in points]
    return max(0, *gaps), max(0, *(-g for g in gaps))


@pytest.mark.parametrize("seed", range(2))
def test_distance_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(g, float(rng.randrange(25) + shift)) for g, shift, n in (("a", 0, 60), ("b", 4, 30), ("c", -9, 9), ("d", 40, 3), (None, 2, 20)) for _ in range(n)] + [("e", None), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["rest"], r["above"], r["below"]) for r in quantiles.distance_from_rest(df, "g", "v").collect()}
    assert got.keys() == set("abcd")
    for g, (n, rest, above, below) in got.items():
        own, other = [v for k, v in rows if k == g and v is not None], [v for k, v in rows if k != g and v is not None]
        want = brute_distance(own, other)
        assert (n, rest) == (len(own), len(other)) and (above, below) == (pytest.approx(want[0]), pytest.approx(want[1]))
    assert {r["g"] for r in quantiles.distance_from_rest(df, "g", "v", F.col("g") == "b").collect()} == {"b"}
    alone = spark.createDataFrame([("a", 1.0)], "g string, v double")
    assert quantiles.distance_from_rest(alone, "g", "v").count() == 0 and quantiles.distance_from_rest(alone.where("false"), "g", "v").count() == 0


def test_one_persona_is_remarkable(spark):
    rng = random.Random(5)
    rows = [(a, rng.lognormvariate(4, 1)) for a in (2, 4, 100, 101) for _ in range(200)] + [(6, rng.lognormvariate(6, 1)) for _ in range(50)] + [(8, 1.0)] * 50 + [(10, None)]
    got = {r["accountID"]: r["remarkable"] for r in audits.audit_personas(spark.createDataFrame(rows, "accountID int, event_amount double")).collect()}
    assert got == {2: False, 4: False, 6: True, 8: False}


@pytest.mark.parametrize("days", [0, 1, 20])
def test_activity_around_log_days(spark, days):
    rng = random.Random(9)
    day = lambda n: T0 + timedelta(days=n, hours=rng.randrange(24))
    logs = [(rng.choice([1, 2, 3, None]), day(rng.randrange(60))) for _ in range(80)]
    moves = [(rng.choice([1, 2, 9, None]), day(rng.randrange(60)), rng.randrange(1000) / 4) for _ in range(300)]
    frames = spark.createDataFrame(logs, "account_id long, ts timestamp"), spark.createDataFrame(moves, "account_id long, ts timestamp, amount double")
    got = {(r["account_id"], r["day"]): (r["log_events"], r["transactions"], r["amount"]) for r in joins.account_activity(*frames, days=days).collect()}
    want = {}
    for a, t in logs:
        if a is not None:
            near = [m for b, u, m in moves if b == a and abs((u.date() - t.date()).days) <= days]
            want[a, t.date()] = (sum(x == a and u.date() == t.date() for x, u in logs), len(near), sum(near))
    assert got == want and all(isinstance(k[1], date) for k in got)
    plan = plan_text(joins.account_activity(*frames, days=days))
    assert "Generate" not in plan and "Window" in plan
