"""What one task holds does not grow with the input."""

import re

from conftest import plan_text
from loglattice.operators import asof
from pyspark.sql import functions as F


def test_equal_intervals_count_once_and_their_blocks_are_dealt_out(spark, monkeypatch):
    kept, tasks, inner = {}, {}, asof.stored

    def stored(df, purpose):
        tasks[purpose] = [int(n) for n in re.findall(r"rangepartitioning\(a#.*?, (\d+)\)", plan_text(df))]
        kept[purpose] = inner(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(asof, "stored", stored)
    monkeypatch.setattr(asof, "_TASK_ROWS", 500, raising=False)
    rows = [(i, 10, 20, f"p{i % 3}") for i in range(5, 400)] + [(5, 10, 20, "a"), (None, 30, 40, "n"), (1, 30, 40, "o"), (9, 15, 35, None)] + [(500 + i, 100 + i, 103 + i, "s") for i in range(200)]
    table = spark.createDataFrame(rows, "seq long, lo long, hi long, phase string")
    spans = table.select("seq", "phase", F.timestamp_micros("lo").alias("start_ts"), F.timestamp_micros("hi").alias("end_ts"))
    got = {r["t"]: r["hit"] and tuple(r["hit"]) for r in asof.disjoint_segments(spans).collect()}
    want = {10: (5, "a"), 15: (5, "a"), 21: (9, None), 30: (None, "n"), 36: (None, "n"), 41: None, 101: (500, "s"), 200: (597, "s"), 303: None}
    assert {t: got[t] for t in want} == want
    assert kept["spans"].count() == 203
    levels = kept["bounds"].count().bit_length()
    assert tasks["blocks"] == [-(-203 * 2 * levels // 500)]
