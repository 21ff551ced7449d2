"""Whitening of embeddings along the leading components of their covariance.

The covariance is summed exactly in integers on the executors. Its leading
eigenvectors come from contour integration (the FEAST method): the spectrum is
cut into intervals, a quadrature of solves with the complex shifted covariance
projects a block of vectors onto each interval, and a Rayleigh-Ritz step takes
the components out. Counts by inertia say how many eigenvalues lie in an
interval, so none is missed. The matrix has the square of a vector's length,
whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import query, table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0**40  # scaled entries of this size or more are treated as not finite
BLOCK = 4096  # rows whose products are summed at once: exact in doubles
LIMB = 20  # bits of the pieces that large entries are cut into
POINTS = 12  # of the quadrature on the half contour
IN_SLICE = 4  # eigenvalues of an interval, unless they lie close together
ROUNDS = 40


# --- eigenvectors of a symmetric matrix

def inertia(a: np.ndarray) -> tuple[int, int]:
    """(positive, negative) eigenvalues of a symmetric matrix, by factors L D L' with diagonal pivoting."""
    a, n, k, plus, minus = a.copy(), len(a), 0, 0, 0
    bound = (1 + 17**0.5) / 8
    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if k + 1 < n else k
        lam = below.max(initial=0.0)
        if lam == 0 and a[k, k] == 0:
            k += 1
            continue
        two = False
        if abs(a[k, k]) < bound * lam:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            sigma = row.max()
            if abs(a[k, k]) * sigma < bound * lam * lam:
                two = abs(a[r, r]) < bound * sigma
                s = k + 1 if two else k
                a[[s, r]] = a[[r, s]]
                a[:, [s, r]] = a[:, [r, s]]
        if two:
            block, cols = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            det, trace = block[0, 0] * block[1, 1] - block[0, 1]**2, block[0, 0] + block[1, 1]
            plus += 1 if det < 0 else 2 * (trace > 0)
            minus += 1 if det < 0 else 2 * (trace < 0)
            a[k + 2:, k + 2:] -= cols @ np.linalg.solve(block, cols.T)
            k += 2
        else:
            plus, minus = plus + (a[k, k] > 0), minus + (a[k, k] < 0)
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k + 1:, k] / a[k, k])
            k += 1
    return int(plus), int(minus)


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``."""
    return inertia(a - shift * np.eye(len(a)))[0]


def slices(a: np.ndarray, wanted: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """Intervals (lo, hi, eigenvalues in it) from the top down that hold at least ``wanted`` eigenvalues above ``low``.

    An interval is halved until it holds few eigenvalues or is narrow; its
    borders keep some distance from the eigenvalues next to them.
    """

    def clear(x: float, width: float) -> tuple[float, int]:
        for k in range(24):  # a border within a thousandth of an eigenvalue is moved
            y = x + width * (k // 2 + 1) / 50 * (-1)**k * (k > 0)
            n = above(a, y - width / 1000)
            if n == above(a, y + width / 1000):
                return y, n
        return x, above(a, x)

    out, stack = [], [(low, high, above(a, low), 0)]
    while stack and sum(n for *_, n in out) < wanted:
        lo, hi, n_lo, n_hi = stack.pop()
        if n_lo == n_hi:
            continue
        if n_lo - n_hi <= IN_SLICE or hi - lo <= 1e-9 * high:
            out.append((lo, hi, n_lo - n_hi))
            continue
        mid, n_mid = clear((lo + hi) / 2, hi - lo)
        stack += [(lo, mid, n_lo, n_mid), (mid, hi, n_mid, n_hi)]  # the upper one is next
    return out


def in_interval(a: np.ndarray, lo: float, hi: float, count: int) -> np.ndarray:
    """Orthonormal vectors that span the eigenvectors of the ``count`` eigenvalues in the interval."""
    d, norm = len(a), np.abs(a).sum(1).max()
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    node, weight = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(0.5j * np.pi * (1 + node))
    size = min(d, max(2 * count, count + 4))
    block, last = np.random.default_rng(12).standard_normal((d, size)), np.inf
    for _ in range(ROUNDS):
        q = np.zeros_like(block)
        for t, w in zip(turn, weight):
            q += 0.5 * w * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - a, block)).real
        q = np.linalg.qr(q)[0]
        value, turned = np.linalg.eigh(q.T @ a @ q)
        block = q @ turned
        inside = (value > lo) & (value <= hi)
        if inside.sum() == count:
            error = np.linalg.norm(a @ block[:, inside] - block[:, inside] * value[inside], axis=0).max() / norm
            if error < 1e-15 or error < 1e-11 and error > last / 2:
                return block[:, inside]
            last = error
        elif inside.sum() > count or size < d:  # Ritz values that are none: more room
            more = np.random.default_rng(size).standard_normal((d, min(d, size + 4) - size))
            block, size, last = np.hstack([block, more]), min(d, size + 4), np.inf
    raise RuntimeError("the contour integration did not settle")


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and unit eigenvectors of a covariance; fewer if its rank is lower."""
    norm = np.abs(a).sum(1).max(initial=0.0)
    if norm == 0 or not np.isfinite(norm):
        return np.zeros(0), np.zeros((len(a), 0))
    unit = a / norm
    low, high = len(a) * 1e-15, 1.0 + 1e-3
    k = min(k, above(unit, low))
    if k == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    cut = slices(unit, k, low, high)
    basis = np.linalg.qr(np.hstack([in_interval(unit, *s) for s in cut]))[0]
    value, turned = np.linalg.eigh(basis.T @ unit @ basis)
    found = above(unit, cut[-1][0])
    if found != basis.shape[1] or found < k:
        raise RuntimeError(f"{basis.shape[1]} components, {found} eigenvalues by inertia")
    order = np.argsort(-value)[:k]
    return value[order] * norm, basis @ turned[:, order]


# --- sums over the rows

def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, not finite or too large; false, never null."""
    ok = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST / SCALE), F.lit(False)))
    return F.coalesce(ok & (F.size(vector) > 0), F.lit(False))


def matrix(batch: pa.RecordBatch, centre: np.ndarray) -> np.ndarray:
    """x - centre in integers, one row per vector."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, len(centre)) + (OFFSET - centre)


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles of at most 20 bits that add up to ``y``, each times 2 ** 20 of the one before."""
    out = []
    while True:
        last = np.abs(y).max(initial=0) < 1 << LIMB
        part = y if last else y & (1 << LIMB) - 1
        out.append(part.astype(float))
        if last:
            return out
        y = y - part >> LIMB


def exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of outer products of the rows, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), BLOCK):
        parts = limbs(y[at:at + BLOCK])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j)
    return total


def _moments(rows: DataFrame, centre: list[int], products: bool) -> DataFrame:
    """(i, j, total): sums of y_i (j = -1) or of y_i * y_j, y = x - centre; each task adds up its rows first."""
    at = np.array(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(at), len(at) if products else 1), object)
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch, at)
                total += exact_products(y) if products else (y >> 32).sum(0)[:, None].astype(object) * 2**32 + (y & 2**32 - 1).sum(0)[:, None]
        i, j = np.triu_indices(len(at)) if products else (np.arange(len(at)), np.zeros(len(at), int))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j if products else j - 1, pa.int32()),
             pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "total"])

    return rows.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Doubles next to the exact covariance, from sums over rows that are centred at whole numbers."""
    out = np.zeros((len(sums), len(sums)))
    for (i, j), p in products.items():
        out[i, j] = out[j, i] = float(Fraction(n * p - sums[i] * sums[j], n * n))
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: the id, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, has no entry, or holds an entry that is null,
    not finite or of size 2 ** 30 or more are dropped; so are rows whose length
    is not that of most rows (of equally many, the longer). Repeated rows and
    ids, also null ones, count and stay as they are; other columns are not
    read. Components of zero variance cannot be whitened and are left out: an
    empty table, a single row or equal rows give no rows. ``deviation`` is null
    where it does not fit a long; ``deviation_exact`` has it as a decimal.
    Passes: count and sums, products of centred rows, covariance of the result, output.
    """
    typed = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    id_type = typed.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"
    lengths = typed.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    d, n = lengths.d, lengths.n
    used = typed.where(F.size("vector") == d)
    first = {r.i: int(r.total) for r in _moments(used, [OFFSET] * d, False).collect()}
    total = [first[i] + OFFSET * n for i in range(d)]
    centre = [round(Fraction(t, n)) for t in total]
    rest = [t - n * c for t, c in zip(total, centre)]
    v = covariance(n, rest, {(r.i, r.j): int(r.total) for r in _moments(used, centre, True).collect()})
    value, vectors = leading(v, components)
    k, mean, around = len(value), np.array([r / n for r in rest]), np.array(centre)
    if k == 0:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    turn = vectors / np.sqrt(value)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = (matrix(batch, around) - mean) @ turn
                out += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out)), pa.int32()), pa.array(out)], ["i", "total"])

    added = used.mapInArrow(sums, "i int, total double").groupBy("i").agg(F.sum("total").alias("total"))
    got = np.array([r.total for r in added.orderBy("i").collect()]) / n
    error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    explained = value / np.trace(v)
    fixed = sum(r * r for r in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = matrix(batch, around)
            w = ((y - mean) @ turn).ravel()
            small = int(np.abs(y).max()) * max(map(abs, rest), default=0) * d < 2**62 and int(np.abs(y).max())**2 * d < 2**62
            own, by = (y, np.array(rest)) if small else (y.astype(object), np.array(rest, object))
            # the sum of (n x - S) ** 2 over the dimensions, with x = centre + y and S = n centre + rest
            far = [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip((own * own).sum(1), (own * by).sum(1))]
            each = np.repeat(np.arange(len(far)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(far)), pa.int32()),
                pa.array(np.full(len(each), n)), pa.array([f if f < 2**63 else None for f in far], pa.int64()).take(pa.array(each)),
                pa.array([Decimal(f) if f < 10**38 else None for f in far], pa.decimal128(38, 0)).take(pa.array(each)), pa.array(w),
                pa.array(np.tile(explained, len(far))), pa.array(np.full(len(each), error))],
                ["id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"])

    return used.mapInArrow(run, schema).withColumnRenamed("id", id_col)


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
