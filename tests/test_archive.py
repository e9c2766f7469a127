"""The archive layout: no shuffle of the archive, and only the years asked for are read."""

import re

from conftest import plan_text
from loglattice.sources import archive

TX = "accountID int, year int, event_amount double"


def above(plan: str, mark: str) -> list[str]:
    """The operators between the root of the plan and the first line with ``mark``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth, found = len(lines[at]), []
    for line in lines[at::-1]:
        indent = re.search(r"[A-Za-z]", line).start()
        if indent < depth:
            depth, found = indent, [line.strip(" :+-"), *found]
    return found[:-1]


def test_only_asked_years_are_read_and_nothing_is_shuffled(spark, tmp_path):
    rows = [(a, y, float(a + y)) for a in range(50) for y in range(2010, 2020) for _ in range(3)] + [(None, 2018, 5.0)]
    name = archive.store_archive(spark.createDataFrame(rows, TX), str(tmp_path / "archive"), buckets=4)
    spark.createDataFrame([(7, 2019, 1.0), (7, 2020, 1.0), (8, 2015, 1.0), (99, 2019, 1.0), (None, 2019, 1.0), (9, 2010, 1.0)], TX).write.parquet(str(tmp_path / "recent"))
    recent = spark.read.schema(TX).parquet(str(tmp_path / "recent")).where("event_amount < 3")
    out = archive.recent_accounts(spark.table(name), recent)
    plan = plan_text(out)
    path = above(plan, "Bucketed: true")
    assert "dynamicpruning" in plan.lower()
    assert any("BroadcastHashJoin" in step for step in path) and sum("HashAggregate" in step for step in path) == 2
    assert not any("Exchange" in step for step in path)
    got = {r["accountID"]: (r["recent_n"], r["archive_n"], r["last_year"], r["archive_amount"]) for r in out.collect()}
    assert got == {7: (2, 6, 2018, 3.0 * (2 * 7 + 2017 + 2018)), 8: (1, 6, 2014, 3.0 * (2 * 8 + 2013 + 2014))}
    archive.drop_archive(spark, name)
    assert not spark.catalog.tableExists(name)
