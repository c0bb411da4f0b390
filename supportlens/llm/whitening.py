"""Whitening of embeddings by their leading principal components, found by a block Jacobi-Davidson method.

The covariance matrix is never built: all that is asked of it are products with a block of vectors, each one pass over the stored
fit list in Spark. A task sums (x - mean) ((x - mean) . u) over its rows, a few tasks add these sums up, and the driver gets
at most PARTIALS small blocks (dimension x block).

The search space is kept on the driver (dimension x at most a few dozen columns). Rayleigh-Ritz on it gives the current
pairs; for those that aren't exact yet, correction equations (I - QQ') (V - theta I) (I - QQ') t = -r are solved by MINRES, all
of them with common products, with Q the locked and the current vectors. Pairs are locked in order once their residual reaches
double precision, and the space is kept orthogonal to them. A full space restarts from its best Ritz vectors.

Integers are exact: an entry minus the mean is (n x - S) / n, with n x - S in whole numbers, so that nothing is lost to the
large common part of the entries.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries are held within this many units, so that they are longs.
LARGEST = 2**62
#: Spare directions kept beside the wanted ones, and MINRES steps for each correction.
SPARE, STEPS = 8, 6
#: Blocks of sums that the driver adds up at most.
PARTIALS = 64
#: Rows of a batch that are worked on at once.
ROWS = 4096
EPS = float(np.finfo(float).eps)


def integers(vector: Column) -> Column:
    """The vector's entries as whole numbers."""
    entry = lambda c: F.floor(F.greatest(F.least(F.lit(float(SCALE)) * c.cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + F.lit(SHIFT)
    return F.transform(vector, entry)


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all entries finite numbers."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(F.coalesce(vector, F.array()), lambda c: F.coalesce(bad(c.cast("double")), F.lit(True)))


def _matrices(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    """The lists of a batch as rows of a matrix, some thousand at a time."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for at in range(0, len(flat), ROWS):
        yield flat[at : at + ROWS]


def _added(df: DataFrame, tasks: int, width: int, work: Callable[[pa.Array], Iterator[np.ndarray]]) -> np.ndarray:
    """The sum of `work`'s arrays of `width` doubles over all rows of `df` (of so many tasks): by task, by a few tasks, then here."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for part in work(batch.column(0)):
                total += part
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    sums = df.mapInArrow(partial, "sums array<double>")
    if tasks > 4:
        sums = sums.repartition(min(PARTIALS, math.isqrt(tasks))).mapInArrow(add, "sums array<double>")
    return np.sum([row.sums for row in sums.collect()] or [np.zeros(width)], axis=0)


class FitList:
    """The different vectors of a table: their number n, exact sums S, and products with their covariance."""

    def __init__(self, rows: DataFrame, dim: int):
        self.rows, self.dim = stored(rows.select("x").distinct(), "whiten-fit"), dim
        self.tasks = self.rows.rdd.getNumPartitions()
        self.n, self.sums, self.large = self._sums()

    def _sums(self) -> tuple[int, list[int], bool]:
        """n, S, and whether n x - S may leave the longs. High and low halves of the entries are summed apart, so that no sum does."""
        dim = self.dim

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, high, low, most = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
            for batch in batches:
                for x in _matrices(batch.column(0), dim):
                    n, most = n + len(x), max(most, int(np.abs(x).max(initial=0)))
                    high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
            for i in range(dim):
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (i, n, high[i], low[i], most)], ["i", "n", "high", "low", "most"])

        sums = self.rows.mapInArrow(partial, "i bigint, n bigint, high bigint, low bigint, most bigint").groupBy("i")
        found = sums.agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")), F.max("most").alias("most")).collect()
        found.sort(key=lambda row: row.i)
        if not found:
            return 0, [0] * dim, False
        n, most = found[0].n, max(row.most for row in found)
        return n, [(row.high << 32) + row.low for row in found], n * most >= 2**62

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S in whole numbers: longs, or Python's numbers where longs are too short."""
        if self.large:
            return self.n * x.astype(object) - np.array(self.sums, object)
        return self.n * x - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def _over(self, width: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        dim, centred = self.dim, _Centring(self)
        return _added(self.rows, self.tasks, width, lambda column: (work(centred(x)) for x in _matrices(column, dim)))

    def product(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of `u`."""
        return (self._over(u.size, lambda c: (c.T @ (c @ u)).ravel()) / self.n).reshape(u.shape)

    def trace(self) -> float:
        return float(self._over(1, lambda c: np.array([np.square(c).sum()]))[0]) / self.n

    def identity_error(self, axes: np.ndarray) -> float:
        """The largest absolute entry of the covariance of the projections on `axes`, minus the identity."""
        k = axes.shape[1]
        if not k:
            return 0.0

        def moments(c: np.ndarray) -> np.ndarray:
            w = c @ axes
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        sums = self._over(k + k * k, moments) / self.n
        return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


class _Centring:
    """What tasks need of a fit list: no session and no frame goes with it."""

    def __init__(self, fit: FitList):
        self.n, self.sums, self.large = fit.n, fit.sums, fit.large

    deviations, centred = FitList.deviations, FitList.centred

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x)


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of `new` add to `others`; columns that add nothing are left out."""
    basis, kept = np.column_stack(others), []
    for column in (new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)).T:
        for _ in range(3):
            column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
            basis = np.column_stack([basis, column])
    return np.column_stack(kept) if kept else np.zeros((new.shape[0], 0))


def corrections(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, theta: np.ndarray, residual: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t, orthogonal to q, of (I - qq') (V - theta I) (I - qq') t = -residual: MINRES for all columns with one
    product a step."""
    off = lambda t: t - q @ (q.T @ t)
    v = off(-residual)
    beta = np.linalg.norm(v, axis=0)
    safe = lambda x: np.where(np.abs(x) > 1e-300, x, 1.0)
    v, before, old_beta = v / safe(beta), np.zeros_like(v), np.zeros_like(beta)
    eta, c, old_c = beta.copy(), np.ones_like(beta), np.ones_like(beta)
    s, old_s = np.zeros_like(beta), np.zeros_like(beta)
    w, old_w, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    alive = beta > 0
    for _ in range(steps):
        if not alive.any():
            break
        next_ = off(product(v) - v * theta)
        alpha = (v * next_).sum(axis=0)
        next_ = next_ - v * alpha - before * old_beta
        new_beta = np.linalg.norm(next_, axis=0)
        # The new column of the tridiagonal matrix, under the last two rotations and its own.
        r3, rest = old_s * old_beta, old_c * old_beta
        r2, r1_ = c * rest + s * alpha, -s * rest + c * alpha
        r1 = np.hypot(r1_, new_beta)
        old_c, old_s, c, s = c, s, r1_ / safe(r1), new_beta / safe(r1)
        old_w, w = w, (v - old_w * r3 - w * r2) / safe(r1)
        t = t + np.where(alive, c * eta, 0) * w
        eta = -s * eta
        alive = alive & (new_beta > 1e-14 * np.abs(theta)) & (r1 > 0)
        before, v, old_beta = v, next_ / safe(new_beta), new_beta
    return off(t)


def leading(product: Callable[[np.ndarray], np.ndarray], dim: int, count: int, steps: int = STEPS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix without negative eigenvalues
    that is known by its products. Raises ArithmeticError if residuals stay above rounding."""
    count = min(count, dim)
    width = min(dim, count + SPARE)
    most = min(dim, 4 * width)
    locked, values = np.zeros((dim, 0)), []
    space = _orthonormal(np.random.default_rng(seed).normal(size=(dim, width)), locked)
    image, best, stalled = product(space), math.inf, 0
    while True:
        inner = space.T @ image
        theta, y = np.linalg.eigh((inner + inner.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        want = count - len(values)
        u, vu = space @ y[:, :want], image @ y[:, :want]
        residual = vu - u * theta[:want]
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        top = max([*values, float(theta[0])])
        exact = 4 * dim * EPS * top
        whole = space.shape[1] + len(values) == dim
        reached = sizes <= exact
        worst = float(sizes.max())
        stalled, best = (stalled + 1, best) if worst > best / 2 else (0, worst)
        if (whole or stalled >= 3) and not reached.all():
            # Rounding that the images have gathered over rotations: one fresh product tells.
            image = product(space)
            u, vu = space @ y[:, :want], image @ y[:, :want]
            residual = vu - u * theta[:want]
            residual -= locked @ (locked.T @ residual)
            sizes = np.linalg.norm(residual, axis=0)
            floor = 64 * exact if whole or stalled >= 3 else exact
            reached = sizes <= floor
            if (whole or stalled >= 6) and not reached.all():
                raise ArithmeticError(f"residuals stay at {sizes.max():.3g}, largest eigenvalue {top:.3g}")
        done = want if reached.all() else int(np.argmin(reached))
        if done:
            locked, values = np.column_stack([locked, u[:, :done]]), [*values, *theta[:done].tolist()]
            space, image, y = space @ y[:, done:], image @ y[:, done:], np.eye(space.shape[1] - done)
            theta, u, residual, best, stalled = theta[done:], u[:, done:], residual[:, done:], math.inf, 0
        if len(values) == count:
            order = np.argsort(values)[::-1]
            return np.maximum(np.array(values)[order], 0.0), locked[:, order]
        if done and not u.shape[1]:
            continue
        if space.shape[1] + u.shape[1] > most - len(values):
            keep = min(width, space.shape[1])
            space, image = space @ y[:, :keep], image @ y[:, :keep]
        q = np.column_stack([locked, u])
        new = corrections(product, q, theta[: u.shape[1]], residual, steps)
        new = _orthonormal(new, locked, space)
        if not new.shape[1]:
            # The corrections lie in the space: go on with what is left of the whole space.
            new = _orthonormal(np.random.default_rng(seed + len(values) + stalled + 1).normal(size=(dim, 1)), locked, space)
        if new.shape[1]:
            space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: id_col, component (from 1 by falling eigenvalue), n, deviation, whitened, explained,
    identity_error; at most min(components, dimension) components.

    Vectors that are null, empty or hold null or non-finite entries have no rows. Vectors are taken to be of one length: where lengths
    differ, the most frequent (of equally frequent ones the largest) counts and other rows have none. Repeated rows each have
    theirs, null ids too. A component without variance has explained 0 and null `whitened`; if nothing varies at all, explained and
    identity_error are 0. `deviation` is null where it is beyond a long. An empty table gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    columns = f"{id_col} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    rows = stored(rows.select("id", integers(F.col("v")).alias("x")), "whiten-rows")
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], columns)
    dim = lengths["dim"]
    rows = rows.filter(F.size("x") == dim)

    fit = FitList(rows, dim)
    trace = fit.trace()
    if trace > 0:
        values, vectors = leading(fit.product, dim, components)
    else:
        values, vectors = np.zeros(min(components, dim)), np.eye(dim)[:, :components]
    varying = values > 4 * dim * EPS * max(trace, 0)
    axes = vectors / np.where(varying, np.sqrt(np.where(varying, values, 1)), 1)
    error = fit.identity_error(axes[:, varying])
    explained = np.where(varying, values, 0) / (trace or 1)
    k, n, centring = len(values), fit.n, _Centring(fit)
    flat = ~np.asarray(varying)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices(batch.column(1), dim):
                whole = centring.deviations(x)
                rows, w = len(x), (whole.astype(float) / n) @ axes
                largest = np.abs(whole).max() if whole.size else 0
                whole = whole if int(largest) ** 2 * dim < 2**63 else whole.astype(object)
                squares = [d if d < 2**63 else None for d in map(int, (whole * whole).sum(axis=1))]
                repeat = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, rows).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n)), pa.array(squares, pa.int64()).take(repeat),
                        pa.array(w.ravel(), mask=np.tile(flat, rows)), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error)),
                    ],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )
                at += rows

    return rows.mapInArrow(project, columns)
