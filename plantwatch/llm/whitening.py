"""Whitening of embeddings on their leading principal components, found by contour integration.

Executors sum the moments of the distinct vectors. The eigenpairs of the covariance V that are wanted
lie above some number; inertia counts (signs of the pivots of V - sI, from a tridiagonal form of V)
find intervals that hold them and whose ends lie in gaps of the spectrum. For each interval, solves
with V shifted to points of a circle around it, summed by quadrature, project a random block onto its
eigenvectors (FEAST); Rayleigh-Ritz in the projected space gives eigenpairs, and the steps repeat until
their residuals vanish and their number equals the interval's inertia count, so none is missed.

The solver works on one V (dimension squared numbers, whatever the number of rows) in a task of its own
for each length of vectors; everything that grows with the rows stays distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwatch.llm.common import read_table, saved

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues wanted of one interval at most, unless a cluster has more.
IN_INTERVAL = 8
#: Points of the half circle (the other half is its mirror image) and rounds of projection.
POINTS, ROUNDS = 8, 40
#: Largest residual accepted, as a share of the norm of V.
SMALL_RESIDUAL = 1e-12
#: Eigenvalues under this share of the trace count as zero: their components cannot be scaled to one.
NOTHING = 1e-12
#: Numbers of fitted models (means and components) that are sent to the tasks at once.
SENT_NUMBERS = 4_000_000


# ---- the eigenvalue solver -------------------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the inertia of v under every shift (reflections)."""
    a = v.copy()
    n = len(a)
    beside = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        w = a[k + 1 :, k].copy()
        beside[k] = -np.copysign(np.linalg.norm(w), w[0])
        w[0] -= beside[k]
        if (size := np.linalg.norm(w)) == 0:
            continue
        w /= size
        rest = a[k + 1 :, k + 1 :]
        p = rest @ w
        q = p - (w @ p) * w
        rest -= 2 * (np.outer(w, q) + np.outer(q, w))
    return np.diagonal(a).copy(), beside**2


def counts_above(three: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each number: the positive pivots of the elimination of the shifted matrix."""
    diagonal, squares = three
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - at
    count = (pivot > 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[i] - at - squares[i - 1] / pivot
        count += pivot > 0
    return count


def nth_values(three: tuple[np.ndarray, np.ndarray], count: int, low: float, high: float) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection on inertia counts."""
    nth = np.arange(1, count + 1)
    lows, highs = np.full(count, low), np.full(count, high)
    for _ in range(60):
        middle = (lows + highs) / 2
        enough = counts_above(three, middle) >= nth
        lows, highs = np.where(enough, middle, lows), np.where(enough, highs, middle)
    return (lows + highs) / 2


def intervals(v: np.ndarray, wanted: int, each: int = IN_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count): intervals that together hold at least the ``wanted`` largest eigenvalues above zero.

    About ``each`` to an interval, whose lower end lies in the widest gap near there; a cluster of
    equal ones stays together, however many they are.
    """
    three = tridiagonal(v)
    bound = float(np.abs(v).sum(1).max())
    floor = NOTHING * float(np.trace(v))
    rank = int(counts_above(three, np.array([floor]))[0])
    if not rank:
        return []
    values = np.append(nth_values(three, rank, floor, 1.01 * bound), floor)
    gaps = values[:-1] - values[1:]  # gaps[n - 1] lies behind the nth value
    found, done, high = [], 0, values[0] + 0.05 * bound
    while done < min(wanted, rank):
        first = min(done + each, wanted, rank)
        last = min(first + each // 2, rank)
        while last < rank and gaps[first - 1 : last].max() < 1e-9 * bound:
            last += 1
        end = first + int(gaps[first - 1 : last].argmax())
        low = (values[end - 1] + values[end]) / 2
        found.append((low, high, int(counts_above(three, np.array([low]))[0]) - done))
        done, high = end, low
    return found


def project(v: np.ndarray, low: float, high: float, block: np.ndarray, points: int) -> np.ndarray:
    """The block's parts in the eigenvectors whose values lie in the interval, by Gauss quadrature on its circle."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(points)
    out, eye = np.zeros_like(block), np.eye(len(v))
    for node, weight in zip(nodes, weights):
        turn = radius * np.exp(1j * np.pi / 2 * (1 - node))
        out += weight / 2 * np.real(turn * np.linalg.solve((centre + turn) * eye - v, block.astype(complex)))
    return out


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of v in (low, high), smallest first, as exact as rounding allows.

    ``count`` is the interval's inertia count: a result with another number of pairs is not accepted.
    """
    size, points = min(len(v), count + count // 2 + 8), POINTS
    rng = np.random.default_rng(0)
    block = rng.standard_normal((len(v), size))
    scale = np.abs(v).sum(1).max()
    best, least = None, np.inf
    for turn in range(1, ROUNDS + 1):
        basis, _ = np.linalg.qr(project(v, low, high, block, points))
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        block = basis @ turned
        inside = (values > low) & (values < high)
        worst = np.abs(v @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0) / scale
        if inside.sum() == count and worst < least:
            best, least = (values[inside], block[:, inside]), worst
        elif least < SMALL_RESIDUAL:
            return best  # nothing but rounding is left
        if turn % 8 == 0:  # slow, or not all found yet: more points, more room
            points, size = points * 2, min(len(v), size * 2)
            block = np.hstack([block, rng.standard_normal((len(v), size - block.shape[1]))])
    if least < SMALL_RESIDUAL:
        return best
    raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues in ({low}, {high}), residual {least}")


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above zero, falling, and unit eigenvectors as columns; fewer, if the rank is."""
    parts = [feast(v, *interval) for interval in intervals(v, wanted)] if len(v) else []
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    basis, _ = np.linalg.qr(np.hstack([vectors for _, vectors in parts]))
    values, turned = np.linalg.eigh(basis.T @ v @ basis)  # one last Rayleigh-Ritz over all intervals
    return values[::-1][:wanted], (basis @ turned)[:, ::-1][:, :wanted]


# ---- on Spark --------------------------------------------------------------------------------------


def whole_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the vector as longs, of the rows whose vector is there, not empty, and has finite entries only.

    Entries too large for a long become the largest or smallest that fits.
    """
    vector = F.col(column).cast("array<double>")
    fine = (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    most = F.lit((1 << 63) - 1 - SHIFT)
    whole = F.transform(vector, lambda c: F.least(F.floor(c * SCALE), most) + SHIFT)
    return embeddings.where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the batch's vectors, one for each length."""
    column = batch.column("x")
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[ends[:-1][rows][:, None] + np.arange(size)].reshape(len(rows), size)


def _whole_sum(x: np.ndarray) -> list[int]:
    """Exact sums of columns."""
    if not len(x) or np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0**62:
        return x.sum(0).tolist()
    return x.astype(object).sum(0).tolist()


def column_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and S, exact, for each length of vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch):
                n, s = totals.get(x.shape[1], (0, [0] * x.shape[1]))
                totals[x.shape[1]] = (n + len(rows), [a + b for a, b in zip(s, _whole_sum(x))])
        yield pa.RecordBatch.from_pydict({
            "size": pa.array(list(totals), pa.int64()), "n": pa.array([n for n, _ in totals.values()], pa.int64()),
            "s": pa.array([[Decimal(i) for i in s] for _, s in totals.values()], pa.list_(pa.decimal128(38, 0))),
        })

    parts = fit.select("x").mapInArrow(partial, "size bigint, n bigint, s array<decimal(38,0)>")
    at = parts.select("size", "n", F.posexplode("s").alias("i", "s")).groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found: dict[int, tuple[int, list[int]]] = {}
    for row in at.orderBy("size", "i").toLocalIterator():
        found.setdefault(row["size"], (row["n"], []))[1].append(int(row["s"]))
    return found


def summed_products(fit: DataFrame, centred) -> DataFrame:
    """size, i, row: for each length, the sum of y y^T over the vectors by its rows; ``centred`` gives y of a matrix of vectors.

    Each task passes on one matrix per length; rows of one number are added up in a task of their own.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                y = centred(x)
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + y.T @ y
        for size, total in totals.items():
            yield pa.RecordBatch.from_pydict({"size": [size] * len(total), "i": list(range(len(total))), "row": list(total)})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"size": [group["size"][0]], "i": [group["i"][0]], "row": [np.sum(np.stack(list(group["row"])), axis=0)]})

    parts = fit.select("x").mapInArrow(partial, "size bigint, i bigint, row array<double>")
    return parts.groupBy("size", "i").applyInPandas(added, "size bigint, i bigint, row array<double>")


def batches_of(sums: dict[int, tuple[int, list[int]]], wanted: int, limit: int = SENT_NUMBERS) -> list[list[int]]:
    """The lengths, in groups whose models have at most ``limit`` numbers (or one length each)."""
    out, room = [], 0
    for size in sorted(sums):
        need = size * (wanted + 1)
        if not out or need > room:
            out.append([])
            room = limit
        out[-1].append(size)
        room -= need
    return out


def fitted(fit: DataFrame, sums: dict[int, tuple[int, list[int]]], wanted: int = COMPONENTS) -> DataFrame:
    """size, component (from 1), value, share (of the trace) and vector, fitted for each length in one task each."""
    counts = {size: n for size, (n, _) in sums.items()}
    means = {size: np.array([float(s) / n for s in total]) for size, (n, total) in sums.items()}

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        size = int(group["size"].iloc[0])
        v = np.stack(list(group.sort_values("i")["row"])) / counts[size]
        values, vectors = leading((v + v.T) / 2, wanted)
        return pd.DataFrame({
            "size": size, "component": np.arange(1, len(values) + 1, dtype=np.int32), "value": values,
            "share": values / np.trace(v) if len(values) else values, "vector": pd.Series(list(vectors.T), dtype=object),
        })

    products = summed_products(fit, lambda x: x.astype(np.float64) - means[x.shape[1]])
    return products.groupBy("size").applyInPandas(solve, "size bigint, component int, value double, share double, vector array<double>")


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null where it is no long."""
    far = np.abs(x.astype(np.float64) * n - np.array(s, np.float64)).max(initial=0)
    if far * far * max(1, x.shape[1]) < 2.0**62 and np.abs(x.astype(np.float64)).max(initial=0) * n < 2.0**62:
        return ((x * n - np.array(s, np.int64)) ** 2).sum(1).tolist()
    exact = ((x.astype(object) * n - np.array(s, object)) ** 2).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def whitened(embeddings: DataFrame, wanted: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, or holds a null or a number that is not finite, go. Repeated rows and
    null vec_ids stay; the fit counts each distinct vector once. Vectors of another length are another
    space, with a fit of their own. Components whose eigenvalue is zero (see NOTHING) have no whitened
    form: with fewer distinct vectors than components, or vectors that lie in fewer dimensions, there are
    fewer components, for a single vector and for empty ones none. Ties between eigenvalues: any
    basis of their space. ``deviation`` is null where it passes a long. Other columns are ignored.
    """
    rows = whole_vectors(embeddings, column)
    fit = saved(rows.select("x").distinct(), "fit")
    sums = column_sums(fit)
    models = saved(fitted(fit, sums, wanted), "models")
    out = None
    for sizes in batches_of(sums, wanted):
        part = _whitened_part(rows, fit, models.where(F.col("size").isin(sizes)), {s: sums[s] for s in sizes}, wanted)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else embeddings.sparkSession.createDataFrame([], _DDL)


_DDL = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _whitened_part(rows: DataFrame, fit: DataFrame, models: DataFrame, sums: dict, wanted: int) -> DataFrame:
    known: dict[int, list] = {}
    for row in models.orderBy("size", "component").collect():  # at most SENT_NUMBERS numbers, see batches_of
        known.setdefault(row["size"], []).append((row["value"], row["share"], np.array(row["vector"])))
    scaled = {size: np.stack([v / value**0.5 for value, _, v in found], 1) for size, found in known.items()}
    means = {size: np.array([float(s) / n for s in total]) for size, (n, total) in sums.items()}

    def turned(x: np.ndarray) -> np.ndarray:
        size = x.shape[1]
        return (x.astype(np.float64) - means[size]) @ scaled[size] if size in scaled else np.zeros((len(x), 0))

    own = F.size("x").isin(list(known))
    again = summed_products(fit.where(own), turned).collect()  # one row for each length and component
    off = {size: 0.0 for size in known}
    for row in again:
        size, i = row["size"], row["i"]
        values = np.array(row["row"]) / sums[size][0]
        values[i] -= 1
        off[size] = max(off[size], float(np.abs(values).max()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch):
                size = x.shape[1]
                n, s = sums[size]
                y = turned(x)
                k = y.shape[1]
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").take(pa.array(np.repeat(at, k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(x) * k, n, np.int64)),
                    "deviation": pa.array([d for d in deviations(x, n, s) for _ in range(k)], pa.int64()),
                    "whitened": pa.array(y.ravel()),
                    "explained": pa.array(np.tile([share for _, share, _ in known.get(size, [])], len(x)), pa.float64()),
                    "identity_error": pa.array(np.full(len(x) * k, off.get(size, 0.0))),
                })

    return rows.where(own).mapInArrow(run, _DDL)


def op13_whitening(spark, folder: str) -> DataFrame:
    return whitened(read_table(spark, folder, "embeddings"))
