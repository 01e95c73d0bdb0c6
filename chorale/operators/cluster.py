"""K-Means and Gaussian mixtures on an array<double> column, many fits in one pass.

Fits of several sizes, shapes and restarts advance together. A pass over the
points serves every fit still moving: each task folds its rows into one array
of sums for each fit, and the arrays are added up by fit, so neither a task nor
the driver holds more than the fits' own parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVARIANCES = ("full", "tied", "diag", "spherical")
# Rows worked on at once, in k-means so few that their distances to all fits' centres stay in the processor's cache,
# and tasks beyond which sums are added in two steps.
_ROWS, _KMEANS_ROWS, _TASKS = 4096, 1024, 64


def as_ml(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def _points(df: DataFrame, vector: str) -> DataFrame:
    x = F.col(vector).cast("array<double>")
    return df.select(x.alias("x"), F.xxhash64(x).alias("h"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = _ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows as a matrix, with their hashes."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield flat.reshape(part.num_rows, -1), part.column("h").to_numpy()


def _added(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in tables:
        for values in batch.column("v"):
            values = values.values.to_numpy()
            total = values.copy() if total is None else total + values
    columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([total], pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "task", "v"])


def _summed(
    points: DataFrame, work: Callable[[np.ndarray], Iterable[tuple[int, np.ndarray]]], rows: int = _ROWS
) -> dict[int, np.ndarray]:
    """For each fit, the sum over all rows of the arrays that ``work`` makes of them."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total: dict[int, np.ndarray] = {}
        for x, _ in _slices(batches, rows):
            for i, values in work(x):
                total[i] = total[i] + values if i in total else values
        task = [TaskContext.get().partitionId()] * len(total)
        columns = [pa.array(total, pa.int32()), pa.array(task, pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "task", "v"])

    schema = "i int, task int, v array<double>"
    sums = points.mapInArrow(fold, schema)
    tasks = points.rdd.getNumPartitions()
    if tasks > _TASKS:
        part = F.pmod("task", F.lit(math.isqrt(tasks)))
        sums = sums.groupBy("i", part.alias("part")).applyInArrow(_added, schema)
    return {r["i"]: np.array(r["v"]) for r in sums.groupBy("i").applyInArrow(_added, schema).collect()}


# --- K-Means -----------------------------------------------------------------


@dataclass(frozen=True)
class KMeansFit:
    """Centres (one row each), the rows' summed squared distances to their nearest centre, and passes taken."""

    centres: np.ndarray
    inertia: float
    iterations: int


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in (0, 1] from hashes and a seed."""
    x = h.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and centres."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None] - 2 * x @ centres.T, 0)


def _starts(points: DataFrame, specs: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """First centres of every (k, seed), drawn one after another by squared distance to those before.

    One pass draws a centre for all fits: among rows weighted by distance the
    least exponential variate wins. Rows draw by their vector's hash, so the
    draw does not depend on partitions.
    """
    # Fits of one seed draw the same centres, the larger ones more of them.
    most = {seed: max(k for k, s in specs if s == seed) for _, seed in specs}
    drawn: dict[int, list[np.ndarray]] = {seed: [] for seed in most}
    for step in range(max(most.values())):
        wanted = {seed: np.array(drawn[seed]) for seed in most if step < most[seed] and len(drawn[seed]) == step}

        def draw(batches: Iterator[pa.RecordBatch], wanted=wanted, step=step) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, np.ndarray]] = {}
            for x, h in _slices(batches):
                for seed, centres in wanted.items():
                    weight = _squares(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                    if step:
                        # What rounding leaves of a distance of zero is none.
                        weight[weight <= 1e-12 * (1 + (x * x).sum(axis=1))] = 0
                    with np.errstate(divide="ignore"):
                        race = -np.log(_mixed(h, seed * 1009 + step)) / weight
                    i = int(race.argmin())
                    if weight[i] > 0 and (seed not in best or race[i] < best[seed][0]):
                        best[seed] = (float(race[i]), x[i])
            columns = [pa.array(best, pa.int32()), pa.array([r for r, _ in best.values()], pa.float64())]
            columns.append(pa.array([x for _, x in best.values()], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=["seed", "race", "x"])

        first = points.mapInArrow(draw, "seed int, race double, x array<double>").groupBy("seed")
        for r in first.agg(F.min(F.struct("race", "x")).alias("m")).collect():
            drawn[r["seed"]].append(np.array(r["m"]["x"]))
    return [np.array(drawn[seed][:k]) for k, seed in specs]


def _nearest_sums(x: np.ndarray, held: Sequence[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
    """For each fit (i, centres): every centre's rows counted and added up, and the rows' squared distances to it.

    Centres are lines and rows columns, so a fit's part of the distances is one stretch of memory, and the rows of all
    centres of all fits are added up by one product.
    """
    gaps = _squares(np.concatenate([c for _, c in held]), x)
    member, inertia, at = np.empty(gaps.shape), [], 0
    for _, c in held:
        gap, own = gaps[at : at + len(c)], member[at : at + len(c)]
        at += len(c)
        low = gap.min(axis=0)
        np.equal(gap, low, out=own)
        if own.sum() > len(x):
            # Equally near centres: the first one has the row.
            own[:] = 0
            own[gap.argmin(axis=0), np.arange(len(x))] = 1
        inertia.append(low.sum())
    table, at = member @ np.hstack([np.ones((len(x), 1)), x]), 0
    for (i, c), summed in zip(held, inertia):
        yield i, np.append(table[at : at + len(c)].ravel(), summed)
        at += len(c)


def _fit_all(points: DataFrame, specs: Sequence[tuple[int, int]], max_iter: int, tol: float = 1e-4) -> list[KMeansFit]:
    """A fit for every (k, seed), all advanced by the same passes over ``points``."""
    centres = _starts(points, specs)
    if not all(map(len, centres)):
        raise ValueError("no rows")
    taken, moving = [0] * len(specs), list(range(len(specs)))

    def sums(active: Sequence[int]) -> dict[int, np.ndarray]:
        held = [(i, centres[i]) for i in active]

        def work(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            return _nearest_sums(x, held)

        return _summed(points, work, _KMEANS_ROWS)

    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for i, flat in sums(moving).items():
            table = flat[:-1].reshape(len(centres[i]), -1)
            # A centre without rows stays where it is.
            means = np.where(table[:, :1] > 0, table[:, 1:] / np.maximum(table[:, :1], 1), centres[i])
            if ((means - centres[i]) ** 2).sum(axis=1).max() > tol * tol:
                still.append(i)
            centres[i], taken[i] = means, taken[i] + 1
        moving = still
    final = sums(range(len(specs)))
    return [KMeansFit(centres[i], float(final[i][-1]), taken[i]) for i in range(len(specs))]


def fit_kmeans(df: DataFrame, vector: str, k: int = 6, restarts: int = 20, max_iter: int = 500, seed: int = 42) -> KMeansFit:
    """Best of several seeded starts by within-cluster squared distance."""
    return fit_kmeans_sizes(df, vector, [k], restarts, max_iter, seed)[k]


def fit_kmeans_sizes(
    df: DataFrame, vector: str, ks: Sequence[int], restarts: int = 20, max_iter: int = 500, seed: int = 42
) -> dict[int, KMeansFit]:
    """For each k, the best of several seeded starts; every size and start in the same passes."""
    points = _points(df, vector).persist()
    try:
        specs = [(k, seed + start) for k in ks for start in range(restarts)]
        fits = _fit_all(points, specs, max_iter)
    finally:
        points.unpersist()
    return {k: min((f for f, (size, _) in zip(fits, specs) if size == k), key=lambda f: f.inertia) for k in ks}


def assign_kmeans(model: KMeansFit, df: DataFrame, vector: str, out: str = "cluster") -> DataFrame:
    """Add the nearest centre of every row."""

    @F.pandas_udf("int")
    def nearest(xs: pd.Series) -> pd.Series:
        return pd.Series(_squares(np.array(xs.tolist(), dtype=float), model.centres).argmin(axis=1).astype("int32"))

    return df.withColumn(out, nearest(F.col(vector).cast("array<double>")))


def elbow(df: DataFrame, vector: str, ks: Sequence[int] = range(2, 13), restarts: int = 10, seed: int = 42) -> DataFrame:
    """(k, inertia) per number of clusters."""
    fits = fit_kmeans_sizes(df, vector, ks, restarts, 300, seed)
    return df.sparkSession.createDataFrame([(k, fits[k].inertia) for k in ks], "k int, inertia double")


# --- Gaussian mixtures -------------------------------------------------------


def covariance_parameters(k: int, d: int, covariance: str) -> int:
    """Free parameters of a mixture: covariances, means and weights."""
    shape = {
        "full": k * d * (d + 1) // 2,
        "tied": d * (d + 1) // 2,
        "diag": k * d,
        "spherical": k,
    }[covariance]
    return shape + k * d + k - 1


@dataclass(frozen=True)
class Mixture:
    """A fitted mixture; ``covariances`` holds one full matrix per component."""

    covariance: str
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float
    converged: bool
    iterations: int

    def prepared(self) -> tuple:
        """What a pass needs: shape, logarithms that do not depend on a row, means, and inverse roots or precisions."""
        k, d = self.means.shape
        spread = self.covariances
        if self.covariance in ("diag", "spherical"):
            variance = np.diagonal(spread, axis1=1, axis2=2)
            logs, inverse = np.log(variance).sum(axis=1), 1 / variance
        else:
            roots = np.linalg.cholesky(spread[:1] if self.covariance == "tied" else spread)
            logs = 2 * np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1)
            inverse = np.linalg.inv(roots)
        with np.errstate(divide="ignore"):
            fixed = np.log(self.weights) - 0.5 * (d * math.log(2 * math.pi) + logs)
        return self.covariance, fixed, self.means, inverse

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """ln(weight) + ln(density) per row and component."""
        return _log_joint(x, self.prepared())


def _log_joint(x: np.ndarray, prepared: tuple) -> np.ndarray:
    shape, fixed, means, inverse = prepared
    if shape == "full":
        z = np.stack([(x - m) @ root.T for m, root in zip(means, inverse)], axis=1)
        gaps = (z * z).sum(axis=2)
    elif shape == "tied":
        gaps = _squares(x @ inverse[0].T, means @ inverse[0].T)
    else:
        gaps = np.stack([((x - m) ** 2) @ p for m, p in zip(means, inverse)], axis=1)
    return fixed - 0.5 * gaps


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=1)
    return top + np.log(np.exp(a - top[:, None]).sum(axis=1))


def _moments(x: np.ndarray, r: np.ndarray, shape: str) -> np.ndarray:
    """Sums by responsibility: weights, rows, and what the shape needs of their squares."""
    parts = [r.sum(axis=0), (r.T @ x).ravel()]
    if shape == "full":
        parts += [((x * r[:, [j]]).T @ x).ravel() for j in range(r.shape[1])]
    elif shape != "tied":
        squares = x * x if shape == "diag" else (x * x).sum(axis=1, keepdims=True)
        parts.append((r.T @ squares).ravel())
    return np.concatenate(parts)


def _maximise(flat: np.ndarray, second: np.ndarray, k: int, d: int, shape: str, floor: float = 1e-6):
    """Weights, means and covariances from summed moments; ``second`` is the sum of x xT over all rows."""
    size = flat[:k] + 10 * np.finfo(float).eps
    means = flat[k : k + k * d].reshape(k, d) / size[:, None]
    rest = flat[k + k * d :]
    eye = np.eye(d)
    if shape == "full":
        cov = rest.reshape(k, d, d) / size[:, None, None] - means[:, :, None] * means[:, None, :]
    elif shape == "tied":
        # Responsibilities of a row sum to one, so only the means' part changes from pass to pass.
        one = (second - (means * size[:, None]).T @ means) / size.sum()
        cov = np.broadcast_to(one, (k, d, d)).copy()
    elif shape == "diag":
        cov = (rest.reshape(k, d) / size[:, None] - means * means)[:, :, None] * eye
    else:
        cov = ((rest / size - (means * means).sum(axis=1)) / d)[:, None, None] * eye
    return size / size.sum(), means, cov + floor * eye


def fit_mixtures(
    df: DataFrame, vector: str, specs: Sequence[tuple[str, int]], restarts: int = 5, max_iter: int = 100, tol: float = 1e-3,
    seed: int = 42,
) -> list[Mixture]:
    """Expectation-maximisation for every (shape, k), best of several K-Means starts.

    All shapes, sizes and starts advance in the same passes, and shapes share
    their starts. MLlib has the full shape only.
    """
    for shape, _ in specs:
        if shape not in COVARIANCES:
            raise ValueError(f"unknown covariance type: {shape!r}")
    points = _points(df, vector).persist()
    try:
        sized = sorted({k for _, k in specs})
        starts = [(k, seed + start) for k in sized for start in range(restarts)]
        centres = dict(zip(starts, (f.centres for f in _fit_all(points, starts, 50))))
        # Moments are taken around the overall mean, which keeps small variances exact.
        first = _summed(points, lambda x: [(0, np.concatenate([[len(x)], x.sum(axis=0)]))])[0]
        n, middle = int(first[0]), first[1:] / first[0]
        d = middle.size
        jobs = [(shape, k, centres[k, seed + start] - middle) for shape, k in specs for start in range(restarts)]

        def hard(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            x = x - middle
            yield -1, (x.T @ x).ravel()
            for i, (shape, _, c) in enumerate(jobs):
                yield i, _moments(x, np.eye(len(c))[_squares(x, c).argmin(axis=1)], shape)

        moments = _summed(points, hard)
        second = moments.pop(-1).reshape(d, d)
        fits: dict[int, Mixture] = {}
        moving, previous = list(range(len(jobs))), dict.fromkeys(range(len(jobs)), -np.inf)
        for step in range(1, max_iter + 1):
            for i in moving:
                shape, _, c = jobs[i]
                fits[i] = Mixture(shape, *_maximise(moments[i], second, len(c), d, shape), previous[i], False, step)
            held = [(i, fits[i].prepared()) for i in moving]

            def soft(x: np.ndarray, held=held) -> Iterator[tuple[int, np.ndarray]]:
                x = x - middle
                for i, prepared in held:
                    joint = _log_joint(x, prepared)
                    total = _log_sum(joint)
                    yield i, np.append(_moments(x, np.exp(joint - total[:, None]), prepared[0]), total.sum())

            still = []
            for i, flat in _summed(points, soft).items():
                mean, moments[i] = float(flat[-1]) / n, flat[:-1]
                done = abs(mean - previous[i]) < tol
                fits[i], previous[i] = replace(fits[i], log_likelihood=mean, converged=done), mean
                if not done:
                    still.append(i)
            moving = still
            if not moving:
                break
    finally:
        points.unpersist()
    best = []
    for at in range(0, len(jobs), restarts):
        found = max((fits[i] for i in range(at, at + restarts)), key=lambda m: m.log_likelihood)
        best.append(replace(found, means=found.means + middle))
    return best


def fit_mixture(
    df: DataFrame,
    vector: str,
    k: int = 6,
    covariance: str = "full",
    restarts: int = 5,
    max_iter: int = 100,
    tol: float = 1e-3,
    seed: int = 42,
) -> Mixture:
    """One mixture, best of several starts."""
    return fit_mixtures(df, vector, [(covariance, k)], restarts, max_iter, tol, seed)[0]


def assign_mixture(model: Mixture, df: DataFrame, vector: str, out: str = "cluster") -> DataFrame:
    """Add the most likely component of every row."""

    @F.pandas_udf("int")
    def component(xs: pd.Series) -> pd.Series:
        x = np.array(xs.tolist(), dtype=float)
        return pd.Series(model.log_joint(x).argmax(axis=1).astype("int32"))

    return df.withColumn(out, component(F.col(vector).cast("array<double>")))


def information_criteria(log_likelihood: float, n: int, parameters: int) -> tuple[float, float]:
    """(BIC, AIC) from the total log-likelihood."""
    return parameters * math.log(n) - 2 * log_likelihood, 2 * parameters - 2 * log_likelihood


def mixture_scores(model: Mixture, df: DataFrame, vector: str) -> DataFrame:
    """(bic, aic, log_likelihood_per_sample, converged, n_iter, covariance_type)."""
    n = df.count()
    k, d = model.means.shape
    bic, aic = information_criteria(
        model.log_likelihood * n, n, covariance_parameters(k, d, model.covariance)
    )
    return df.sparkSession.createDataFrame(
        [(bic, aic, model.log_likelihood, model.converged, model.iterations, model.covariance)],
        "bic double, aic double, log_likelihood_per_sample double, converged boolean, n_iter int, covariance_type string",
    )


def mixture_sweep(
    df: DataFrame,
    vector: str,
    ks: Sequence[int] = range(2, 13),
    covariances: Sequence[str] = COVARIANCES,
    restarts: int = 3,
    max_iter: int = 100,
    seed: int = 42,
) -> DataFrame:
    """(covariance_type, k, bic, aic) for every shape and size."""
    specs = [(shape, k) for shape in covariances for k in ks]
    n, rows = df.count(), []
    for (shape, k), m in zip(specs, fit_mixtures(df, vector, specs, restarts, max_iter, seed=seed)):
        p = covariance_parameters(len(m.weights), m.means.shape[1], shape)
        rows.append((shape, k, *information_criteria(m.log_likelihood * n, n, p)))
    return df.sparkSession.createDataFrame(rows, "covariance_type string, k int, bic double, aic double")
