import os
import sys
from types import SimpleNamespace

import pytest
from conftest import plan_text

import __spark_entry__ as entry
from loglattice.session import fits_broadcast, scratch_dir

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
SF = "/root/testdata/sf0.001"


def test_entry_and_keys(spark):
    assert entry.entry(spark).columns[:3] == ["client_ip", "log_events", "hr_matches"]
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(entry.CORE) <= set(oracle) <= set(queries)


@pytest.mark.parametrize("name", ["logs_n_hr", "good_asof", "lookup_any_ip", "bulk_enrich_range", "roster_coverage", "audit_roster",
                                  "status_burst_sliding", "rate_spikes", "symbol_baseline"])
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from check_queries import TABLES, rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cur.fetchall())


@pytest.mark.parametrize("name", ["logs_n_hr", "ranked_enrich_logs", "ranked_enrich_logs_large_roster", "bulk_enrich_range",
                                  "ip_risk", "interval_tags", "top_talkers", "dept_share", "travel"])
def test_plans_have_no_loops_or_python(spark, name):
    text = plan_text(entry.queries()[name](spark, SF))
    for bad in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert bad not in text


def test_correlation_shuffles_each_side_once(spark):
    text = plan_text(entry.queries()["logs_n_hr"](spark, SF)).split("== Initial Plan ==")[-1]
    assert text.count("Exchange hashpartitioning(client_ip") == 2


def test_key_filter_reaches_both_sides(spark):
    plan = entry.queries()["ip_search"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union"):]
    assert union.count("10.31.0.42") >= 2


def test_broadcast_is_measured(spark):
    df = spark.range(1000).selectExpr("repeat('x', 100) AS t")
    assert fits_broadcast(df, 200_000) and not fits_broadcast(df, 100_000)
    assert fits_broadcast(df.where("false"), 1)


class _Session:
    """Only what ``scratch_dir`` asks of a session."""

    def __init__(self, master, shared=None):
        self.sparkContext, self.conf = SimpleNamespace(master=master), self
        self.shared = shared

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.shared or default


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(_Session("yarn", "/shared/dir"), "x").startswith("/shared/dir/x-")
    assert os.path.isdir(os.path.dirname(scratch_dir(spark, "x")))
    with pytest.raises(ValueError):
        scratch_dir(_Session("yarn"), "x")
