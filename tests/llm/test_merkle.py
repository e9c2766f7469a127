"""Merkle manifest against a tree built in Python, and on made cases."""

import hashlib
import zlib

import pytest

from loglattice.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    out = ""
    for field in merkle.FIELDS:
        value = row[field]
        if lower and field == "text" and value is not None:
            value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return digest(out)


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        at //= 16
    return out


def brute(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))):
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([leaf(r) for r in groups[s]]) for s in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for i, s in enumerate(names):
        for k, r in enumerate(groups[s]):
            path = siblings(trees[i], k) + siblings(top, i)
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            folded = leaf(r, bad)
            for left, right in path:
                folded = digest(left, folded, right)
            proof = digest(*(x for p in path for x in p))
            out.append((r["doc_id"], leaf(r), trees[i][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in names) for r in merkle.verify(df).collect()), key=str)


def test_query_equals_a_tree_in_python(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.merkle_manifest(spark, sf)
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {"a": 273, "": 5, None: 33, "é": 2}, {f"s{i:03}": 1 + i % 3 for i in range(70)}, {"a": 4097, "b": 3}])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(k * 7919 % 100_003, f"Text {s} {k}", None if k % 4 == 0 else "en", s, k) for s, n in sizes.items() for k in range(n)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert run(table) == brute(table.collect())


def test_edges(spark):
    long = "Äß漢 Word " * 20_000
    rows = [(1, "Same", "en", "x", 4)] * 40 + [(2, None, None, None, None), (None, "No ID", "en", "x", 5), (None, "no id", "en", None, 5), (3, "", "", "", 0), (-5, long, "de", "x", len(long))]
    rows += [(1, "Other", "en", "x", 5), (10, "lower only", "en", "z", 10)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = run(table.repartition(5).selectExpr("*", "'t' as tree", "1 as size", "'d' as digest", "0 as lo", "'r' as root", "3 as part"))
    assert got == brute(table.collect())
    assert merkle.verify(table.where("false")).count() == 0


def test_one_group_is_ranked_in_several_parts(spark):
    held = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = spark.range(5000).selectExpr("id as doc_id", "'s' as source", "sha2(cast(id as string), 256) as digest")
    spark.conf.set(held, "false")
    try:
        placed, before = merkle.ranked(rows, ["source", "doc_id", "digest"])
        assert before.count() > 1
    finally:
        spark.conf.set(held, "true")
    ranks = placed.join(before, "part").selectExpr("doc_id", "before + place as rank").collect()
    assert all(r["doc_id"] == r["rank"] for r in ranks) and len(ranks) == 5000
