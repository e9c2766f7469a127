"""Embedding whitening against NumPy's own decompositions, and on made cases."""

import numpy as np
import pytest

from loglattice.llm import queries, whitening

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    x = np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    centred = x - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], directions[:, ::-1]


def by_component(rows, n):
    out = {}
    for r in rows:
        out.setdefault(r["component"], {})[r["vec_id"]] = r
    assert all(len(v) == n for v in out.values())
    return out


def test_query_equals_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids = [r["vec_id"] for r in table]
    n, deviation, centred, values, directions = brute([r["embedding"] for r in table])
    got = by_component(queries.embedding_whitening(spark, SF).collect(), n)
    assert sorted(got) == list(range(1, 9))
    for k, rows in got.items():
        want = centred @ directions[:, k - 1] / np.sqrt(values[k - 1])
        have = np.array([rows[i]["whitened"] for i in ids])
        have *= np.sign(have @ want)
        assert np.abs(have - want).max() < 1e-8
        assert [rows[i]["deviation"] for i in ids] == deviation
        assert {rows[i]["n"] for i in ids} == {n} and rows[ids[0]]["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-10)
        assert rows[ids[0]]["identity_error"] < 1e-10


def test_nulls_other_lengths_ties_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    fine = [[float(x) for x in rng.normal(size=4)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(fine)] + [(0, fine[0]), (None, fine[1])]
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [1.0, float("nan"), 2.0, 3.0]), (93, [1.0, float("-inf"), 2.0, 3.0]), (94, []), (95, [1.0, 2.0])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], SCHEMA + ", deviation string, id string").repartition(5)
    got = whitening.whiten(table).collect()
    n, deviation, centred, values, _ = brute(fine + [fine[0], fine[1]])
    assert len(got) == 4 * n and {r["n"] for r in got} == {n}
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviation)
    assert {r["component"]: r["explained"] for r in got} == {k + 1: pytest.approx(v / values.sum()) for k, v in enumerate(values)}
    assert {r["vec_id"] for r in got if r["vec_id"] is None or r["vec_id"] >= 90} == {None}


def test_no_variance_and_empty_tables(spark):
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], SCHEMA)).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in same] == [(None, None, None, 0)] * 4
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], SCHEMA)).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True)} and line[0]["identity_error"] < 1e-10
    for rows in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_large_entries_have_exact_deviations(spark):
    rows = [(i, [float(2**30 * i), 1.0]) for i in range(5)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(5)] == brute([v for _, v in rows])[1] and max(got.values()) > 2**63


@pytest.mark.parametrize("name", ["random", "graded", "cluster", "ties", "identity", "diagonal", "one rank", "few rows", "one dimension"])
def test_solver_equals_svd(name):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    matrix = {
        "random": rng.normal(size=(300, 64)), "graded": np.diag(np.logspace(0, -12, 40)) @ q, "cluster": np.diag(np.r_[1 + 1e-10 * np.arange(10), np.logspace(-1, -6, 30)]) @ q,
        "ties": np.diag(np.r_[np.ones(10), np.full(30, 0.5)]) @ q, "identity": np.eye(16), "diagonal": np.diag(np.arange(16.0)), "one rank": np.ones((6, 20)),
        "few rows": rng.normal(size=(5, 20)), "one dimension": rng.normal(size=(9, 1)),
    }[name]
    dims = matrix.shape[1]
    squares, vectors = whitening.leading(whitening._triangle(matrix, dims), 8)
    want = np.concatenate([np.linalg.svd(matrix, compute_uv=False) ** 2, np.zeros(dims)])[: len(squares)]
    assert np.abs(squares - want).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max() < 1e-11
    assert np.linalg.norm(matrix.T @ (matrix @ vectors) - vectors * squares, axis=0).max() <= 1e-12 * want[0]


def test_small_singular_values_are_accurate():
    rng = np.random.default_rng(2)
    diagonal, above = np.exp(rng.normal(0, 6, 30)), np.exp(rng.normal(-3, 6, 29))
    got = np.sqrt(whitening.squared_singular_values(diagonal, above))
    # the product of the singular values of a bidiagonal is that of its diagonal, exactly
    assert np.log(got).sum() == pytest.approx(np.log(diagonal).sum(), abs=1e-10)
