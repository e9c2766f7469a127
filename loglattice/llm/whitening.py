"""Embedding whitening by a bidiagonal qd solver.

Blocks of centred rows are reduced by QR to one triangle each; triangles are stacked and reduced again, a few at a time, until one R of dims
x dims remains. Householder reflections bring R to an upper bidiagonal B. The dqds transforms of its squared entries give the singular values
to high relative accuracy, and for each of the leading ones a twisted factorisation of B'B less the value gives the vector, which the
reflections carry back. Covariances are never formed: their condition would be the square of R's.

Only R, of a size set by the dimension, reaches the driver; every task holds one block of ``BLOCK_ROWS`` rows and at most ``FAN_IN`` triangles.

Rows whose vector is null or holds null or non-finite entries are dropped. The dimension is the most frequent length of the other vectors,
the greater one of a tie; vectors of other lengths, and empty ones, are dropped as well. Entries saturate where 1024 times them passes 2**52.
Null ids and repeated rows each give their own rows. A direction without variance has a null ``whitened`` and takes no part in
``identity_error``, which is null without any variance; ``explained`` is then null too. An empty table has no rows. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm.common import column, materialise

#: Grid of the entries, and components returned.
SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
BLOCK_ROWS, FAN_IN = 4096, 8
EPS = np.finfo(np.float64).eps


def to_grid(values: np.ndarray) -> np.ndarray:
    """``floor(1024 * c) + 100000`` in whole numbers."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -(2.0**52), 2.0**52).astype(np.int64) + OFFSET


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and grid values of the valid rows of (id, vector) batches, block by block."""
    for batch in batches:
        for start in range(0, len(batch), BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            lists = part.column(1)
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
            firsts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
            rows = np.flatnonzero(sizes == dims)
            block = values[firsts[rows][:, None] + np.arange(dims)]
            fine = np.isfinite(block).all(axis=1)
            yield part.column(0).take(pa.array(rows[fine])), to_grid(block[fine])


def dimension(vectors: DataFrame) -> int:
    """The most frequent length of the valid vectors of ``vectors(id, vector)``; zero without any."""
    entries = F.col("vector").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    sizes = vectors.where("vector is not null").where(~bad).groupBy(F.size("vector").alias("dims")).count()
    top = sizes.where("dims > 0").orderBy(F.desc("count"), F.desc("dims")).first()  # one row per length
    return top["dims"] if top else 0


def totals(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Number of valid rows, and the exact sum of each dimension's grid values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, np.zeros(dims, np.int64)
        for _, block in _matrices(batches, dims):
            count, sums = count + len(block), sums + block.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims)), pa.array(np.concatenate([[count], sums]))], names=["dim", "value"])

    sums = vectors.mapInArrow(run, "dim long, value long").groupBy("dim").agg(F.sum("value").alias("value")).collect()  # dims + 1 rows
    found = {r["dim"]: r["value"] for r in sums}
    return found.get(-1, 0), np.array([found.get(d, 0) for d in range(dims)], np.int64)


def _triangle(matrix: np.ndarray, dims: int) -> np.ndarray:
    r = np.linalg.qr(matrix, mode="r")
    return np.vstack([r, np.zeros((dims - len(r), dims))]) if len(r) < dims else r


def reduced(vectors: DataFrame, dims: int, mean: np.ndarray) -> np.ndarray:
    """R of the centred rows: one triangle a task, then ``FAN_IN`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((dims, dims))
        for _, block in _matrices(batches, dims):
            r = _triangle(np.vstack([r, block - mean]), dims)
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(x).reshape(dims, dims) for x in sorted(frame["r"])])
        return pd.DataFrame({"id": [int(frame["id"].iloc[0]) // FAN_IN], "r": [_triangle(stacked, dims).tobytes()]})

    parts = vectors.mapInArrow(run, "r binary")
    numbered = parts.withColumn("id", F.shiftrightunsigned(F.monotonically_increasing_id(), 33)).select("id", "r")
    triangles = materialise(numbered, "triangles")
    left = (triangles.agg(F.max("id")).first()[0] or 0) + 1
    while left > 1:
        triangles = triangles.groupBy(F.floor(F.col("id") / FAN_IN)).applyInPandas(merge, "id long, r binary")
        left = -(-left // FAN_IN)
        triangles = materialise(triangles, "triangles") if left > FAN_IN else triangles
    row = triangles.first()
    return np.frombuffer(row["r"]).reshape(dims, dims) if row else np.zeros((dims, dims))


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and the new first entry, with (I - beta v v') x = (first, 0, ...)."""
    norm = np.linalg.norm(x)
    if norm == 0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, x[0] if len(x) else 0.0
    v = x.copy()
    first = -np.copysign(norm, x[0])
    v[0] -= first
    return v, 2 / (v @ v), first


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """Diagonal and superdiagonal of B = U' R V, and the reflections that make up V."""
    a, n = r.copy(), len(r)
    right = []
    for k in range(n):
        v, beta, first = _reflector(a[k:, k].copy())
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        a[k:, k] = 0
        a[k, k] = first
        if k + 1 < n:
            v, beta, first = _reflector(a[k, k + 1 :].copy())
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            a[k, k + 1 :] = 0
            a[k, k + 1] = first
            right.append((v, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One differential qd transform with shift, and the least d: negative if the shift was too large."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least = d
    for k in range(n - 1):
        new_q[k] = d + e[k]
        if new_q[k] <= 0:
            return new_q, new_e, -1.0 if shift else 0.0
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The eigenvalues of B'B, falling, by dqds with deflation; B has no zero on either diagonal."""
    pending, found = [(diagonal.astype(float) ** 2, above.astype(float) ** 2, 0.0)], []
    while pending:
        q, e, moved = pending.pop()
        if len(q) == 1:
            found.append(moved + q[0])
            continue
        for _ in range(60 * len(q) + 60):
            small = np.flatnonzero(e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:])))
            if len(small):
                cut = small[-1] + 1
                pending += [(q[:cut], e[: cut - 1], moved), (q[cut:], e[cut:], moved)]
                break
            if q[0] < q[-1]:  # converge at the small end: the reversed array has the same values
                q, e = q[::-1].copy(), e[::-1].copy()
            # Least eigenvalue of the last two rows and columns, a little below: too large only now and then.
            half, off = (q[-2] + e[-1] + q[-1]) / 2, q[-2] * q[-1]
            shift = off / (half + np.sqrt(max(half * half - off, 0.0))) if half > 0 else 0.0
            shift *= 1 - 1e-3 if e[-1] > 1e-3 * q[-1] else 1 - e[-1] / max(q[-1], 1e-300) - 1e-12
            while True:
                new_q, new_e, least = _dqds(q, e, shift)
                if least >= 0:
                    break
                shift = shift / 4 if shift > 1e-3 * q[-1] else 0.0
            q, e, moved = new_q, new_e, moved + shift
        else:
            raise RuntimeError("dqds did not converge")
    return np.sort(found)[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """A unit vector z with B'B z = value z nearly: factorisations from both ends meet at the row of the least pivot."""
    n = len(diagonal)
    main = diagonal**2 - value
    main[1:] += above**2
    off = diagonal[:-1] * above
    tiny = EPS * max(np.abs(diagonal).max() ** 2, 1e-300) * 1e-3
    down, up = main.copy(), main.copy()
    for k in range(n - 1):
        down[k] = down[k] if abs(down[k]) > tiny else np.copysign(tiny, down[k])
        down[k + 1] -= off[k] ** 2 / down[k]
    for k in range(n - 1, 0, -1):
        up[k] = up[k] if abs(up[k]) > tiny else np.copysign(tiny, up[k])
        up[k - 1] -= off[k - 1] ** 2 / up[k]
    twist = int(np.argmin(np.abs(down + up - main)))
    z = np.zeros(n)
    z[twist] = 1
    for k in range(twist - 1, -1, -1):
        z[k] = -off[k] / down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -off[k] / up[k + 1] * z[k]
    return z / np.linalg.norm(z)


def _improved(z: np.ndarray, close: list[np.ndarray]) -> np.ndarray:
    """``z`` without its parts along the vectors of close values."""
    for _ in range(2):
        for w in close:
            z = z - (w @ z) * w
        z = z / np.linalg.norm(z)
    return z


def leading(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest squared singular values of ``r`` and their right vectors as columns, each with its largest entry positive."""
    dims = len(r)
    scale = np.abs(r).max() if r.size else 0.0
    if not scale > 0:
        return np.zeros(min(top, dims)), np.eye(dims)[:, :top]
    diagonal, above, right = bidiagonalise(r / scale)
    size = max(np.abs(diagonal).max(), np.abs(above).max() if len(above) else 0.0)
    diagonal = np.where(np.abs(diagonal) < EPS * EPS * size, EPS * EPS * size, diagonal)  # a backward error below rounding keeps pivots alive
    cuts = [0, *(np.flatnonzero(np.abs(above) <= EPS * EPS * size) + 1), dims]
    pairs = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        values = squared_singular_values(diagonal[a:b], above[a : b - 1])
        done: list[tuple[float, np.ndarray]] = []
        for value in values[:top]:
            z = twisted_vector(diagonal[a:b], above[a : b - 1], value)
            close = [w for v, w in done if v - value <= 1e-3 * v]
            if close:
                z = _cluster_vector(diagonal[a:b], above[a : b - 1], value, z, close)
            done.append((value, z))
            pairs.append((value, a, z))
    pairs = sorted(pairs, key=lambda p: (-p[0], p[1]))[:top]
    vectors = np.zeros((dims, len(pairs)))
    for k, (_, a, z) in enumerate(pairs):
        vectors[a : a + len(z), k] = z
    for k in range(len(right) - 1, -1, -1):
        v, beta = right[k]
        vectors[k + 1 :] -= beta * np.outer(v, v @ vectors[k + 1 :])
    squares = np.array([p[0] for p in pairs]) * scale**2
    vectors = _completed(vectors, determined(squares, dims))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return squares, vectors * signs


def determined(squares: np.ndarray, dims: int) -> np.ndarray:
    """Which of the falling squared singular values stand above rounding, so that the data determine their directions."""
    return squares > (dims * EPS) ** 2 * max(squares[0], 1e-300)


def _completed(vectors: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The columns without a direction of their own replaced by ones that are orthonormal to all others."""
    missing = np.flatnonzero(~known)
    if not len(missing):
        return vectors
    kept = vectors[:, known]
    whole = np.linalg.qr(np.hstack([kept, np.eye(len(vectors))]))[0]
    out = vectors.copy()
    out[:, missing] = whole[:, kept.shape[1] : kept.shape[1] + len(missing)]
    return out


def _cluster_vector(diagonal: np.ndarray, above: np.ndarray, value: float, start: np.ndarray, close: list[np.ndarray]) -> np.ndarray:
    """A vector of a value among close ones: inverse iteration kept orthogonal to those found, from a start outside their span."""
    n = len(diagonal)
    matrix = np.diag(diagonal**2) + np.diag(np.concatenate([[0.0], above**2]))
    matrix += np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
    z = start - sum((w @ start) * w for w in close)
    z = _improved(z if np.linalg.norm(z) > 1e-8 else np.random.default_rng(n).normal(size=n), close)
    shifted = matrix - (value * (1 + 4 * EPS)) * np.eye(n) + EPS * np.abs(matrix).max() * np.eye(n) * 1e-2
    for _ in range(3):
        z = _improved(np.linalg.solve(shifted, z), close)
    return z


def _deviation(block: np.ndarray, count: int, sums: np.ndarray) -> list[int]:
    """Exact sums of (n * x - S)**2, in Python's whole numbers where 64 bits may not hold them."""
    reach = max(abs(int(block.max())), abs(int(block.min()))) * count + int(np.abs(sums).max()) if block.size else 0
    if reach * reach * block.shape[1] < 2**63:
        return ((count * block - sums) ** 2).sum(axis=1).tolist()
    own = count * block.astype(object) - sums.astype(object)
    return (own * own).sum(axis=1).tolist()


def whiten(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", top: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per valid row and component; deviation as a wide decimal."""
    spark = rows.sparkSession
    vectors = rows.select(column(vec_id).alias("id"), column(embedding).alias("vector"))
    id_type = vectors.schema["id"].dataType.simpleString()
    dims = dimension(vectors)
    count, sums = totals(vectors, dims) if dims else (0, np.zeros(0, np.int64))
    if not count:
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    mean = sums / count
    r = reduced(vectors, dims, mean)
    squares, directions = leading(r, top)
    trace = float((r**2).sum())
    alive = determined(squares, dims)
    scaled = directions[:, alive] / np.sqrt(squares[alive] / count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _matrices(batches, dims):
            values = (block - mean) @ scaled
            deviation = pa.array([*map(str, _deviation(block, count, sums))], pa.string())
            yield pa.RecordBatch.from_arrays([ids, deviation, pa.array(list(values), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    projected = materialise(vectors.mapInArrow(run, f"vec_id {id_type}, deviation string, w array<double>"), "projected")
    error = _identity_error(projected, int(alive.sum()))
    facts = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.lit(float(s / trace) if trace else None).cast("double").alias("explained")) for k, s in enumerate(squares)])
    out = projected.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), "w", F.explode(facts).alias("f"))
    return out.select(
        "vec_id", F.col("f.component").alias("component"), F.lit(count).cast("long").alias("n"), "deviation", F.get("w", F.col("f.component") - 1).alias("whitened"),
        F.col("f.explained").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(projected: DataFrame, width: int) -> float | None:
    """Largest absolute entry of the covariance of ``w`` minus the identity, centred before multiplying."""
    if not width:
        return None
    means = projected.agg(*[F.avg(F.col("w")[k]).alias(f"m{k}") for k in range(width)]).first()
    own = [F.col("w")[k] - F.lit(means[k]) for k in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    found = projected.agg(*[F.avg(own[i] * own[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))
