"""The cells of all fingerprints are shuffled, whatever the size of the fingerprints' own files."""

from conftest import plan_text
from loglattice.llm import simhash


def test_cells_are_never_broadcast(spark, tmp_path):
    prints = [0, 1, 3, 7, 1 << 40, 5 << 60, (1 << 62) - 1]
    spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "fp long").write.parquet(str(tmp_path / "prints"))
    found = simhash.links(spark.read.parquet(str(tmp_path / "prints")))
    plan = plan_text(found)
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    unsigned = {tuple(sorted(x % (1 << 64) for x in row)) for row in found.collect()}
    assert unsigned == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
