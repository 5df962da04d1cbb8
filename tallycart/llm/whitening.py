"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Entries become whole numbers ``floor(scale * c) + shift``; the fit list is each distinct such vector once. The covariance
V = XᵀX / n of the centred list is never formed: every step is a pass over the list that sums Xᵀ(XQ) for a block Q of
``components + spare`` columns, in partial sums per task that Spark adds up; the driver holds matrices of the size of Q.

1. A round applies a Chebyshev polynomial of V to the block, by its three-term recurrence, one pass a degree. It is small on
   the interval of unwanted eigenvalues: from the spectrum's lower end to the least Ritz value of the block. The lower
   end (0 in the first round) is estimated by a Lanczos vector that travels in the same passes; eigenvalues a little
   below it are damped less, which costs rounds but no accuracy.
2. QR and Rayleigh-Ritz with the block's next product, which is the next round's first step too.
3. It ends when every wanted pair's residual ‖Vq - eq‖, as a bound of the error of e, is below ``tolerance`` times the
   largest eigenvalue, or has stopped to fall within rounding; a block that is not certified to ``accept`` is an error.

Whole numbers are centred by the rounded mean first, which is exact, and then by its rest, so that nothing cancels.
Vectors that are null, hold null or non-finite entries, or are of another length than most (the shorter of equally frequent
lengths) take no part, nor do those with an entry beyond 2^52 once scaled, whose whole number a double can't tell; zero
vectors do. Repeated rows are all returned, as are rows with a null id. Components whose
eigenvalue is nothing but rounding (``null_share`` of the largest) are left out, so a list of one vector, or an empty table,
gives no rows. Of equal eigenvalues any orthonormal set of components may stand. A deviation beyond a long is null. Extra
columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycart.session import staged


@dataclass(frozen=True)
class Settings:
    components: int = 16
    spare: int = 16
    degree: int = 8
    rounds: int = 60
    tolerance: float = 1e-13
    accept: float = 1e-10
    null_share: float = 1e-10
    scale: int = 64
    shift: int = 1_000_000
    seed: int = 13


def finite(vector: Column, scale: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) > float(1 << 52)))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_numbers(table: DataFrame, id_col: str, vector_col: str, s: Settings) -> DataFrame:
    """vec_id and x of the rows that take part."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(finite(F.col("v"), s.scale))
    x = F.transform("v", lambda c: F.floor(c.cast("double") * s.scale) + F.lit(s.shift).cast("long"))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0].d if lengths else 0)).select("vec_id", x.alias("x"))


def numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(fit: DataFrame, rows: int, columns: int, kind: str, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``part(x)``, a matrix of ``rows`` times ``columns``: added up inside tasks, then by row
    of the matrix over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(numbers(batch.column("x")))
                total = made if total is None else total + made
        if total is not None:
            values = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * columns), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), values], ["i", "v"])

    sums = fit.select("x").mapInArrow(run, f"i int, v array<{kind}>").groupBy("i").agg(*(F.sum(F.get("v", F.lit(k))).alias(f"c{k}") for k in range(columns)))
    out = np.zeros((rows, columns), dtype=np.int64 if kind == "bigint" else np.float64)
    for row in sums.collect():
        out[row[0]] = row[1:]
    return out


@dataclass(frozen=True)
class Centred:
    """The fit list with its size and mean, and products with its covariance."""

    fit: DataFrame
    n: int
    sums: list[int]

    @property
    def base(self) -> np.ndarray:
        return np.array([round(x / self.n) for x in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(x - self.n * int(b)) / self.n for x, b in zip(self.sums, self.base, strict=True)])

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        base, rest = self.base, self.rest
        return lambda x: (x - base).astype(np.float64) - rest

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: one pass."""
        centred = self.centring()

        def part(x: np.ndarray) -> np.ndarray:
            own = centred(x)
            return own.T @ (own @ q)

        return summed(self.fit, len(q), q.shape[1], "double", part) / self.n

    def variances(self) -> np.ndarray:
        centred = self.centring()
        return summed(self.fit, len(self.sums), 1, "double", lambda x: (centred(x) ** 2).sum(axis=0)[:, None])[:, 0] / self.n

    def covariance_of(self, weights: np.ndarray) -> np.ndarray:
        """The covariance of the list's projections on the columns of ``weights``."""
        centred, k = self.centring(), weights.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            z = np.column_stack([centred(x) @ weights, np.ones(len(x))])
            return z.T @ z

        total = summed(self.fit, k + 1, k + 1, "double", part) / self.n
        return total[:k, :k] - np.outer(total[:k, k], total[:k, k])


def centred_list(fit: DataFrame, width: int) -> Centred:
    n = fit.count()
    return Centred(fit, n, summed(fit, width, 1, "bigint", lambda x: x.sum(axis=0)[:, None])[:, 0].tolist())


class Lanczos:
    """A Lanczos run of one vector, for the lower end of the spectrum."""

    def __init__(self, start: np.ndarray):
        self.basis = [start / np.linalg.norm(start)]
        self.alpha, self.beta = [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    @property
    def ended(self) -> bool:
        return len(self.basis) > len(self.basis[0]) or (len(self.beta) > 0 and self.beta[-1] == 0)

    def step(self, product: np.ndarray) -> None:
        if self.ended:
            return
        self.alpha.append(float(self.vector @ product))
        known = np.array(self.basis)
        rest = product - known.T @ (known @ product)
        rest -= known.T @ (known @ rest)
        size = float(np.linalg.norm(rest))
        over = size <= 1e-12 * max(map(abs, self.alpha)) or len(self.basis) == len(rest)
        self.beta.append(0.0 if over else size)
        self.basis.append(self.vector if over else rest / size)

    def least(self) -> float:
        """The least Ritz value less its residual, which an eigenvalue is within; not below 0, as no covariance's is."""
        if not self.alpha:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        values, vectors = np.linalg.eigh(t)
        return max(0.0, float(values[0]) - abs(self.beta[-1] * vectors[-1, 0]))


def leading(times: Callable[[np.ndarray], np.ndarray], width: int, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, their vectors as columns, and the largest residual among the wanted ones. ``times`` is one
    distributed product with the covariance."""
    rng = np.random.default_rng(s.seed)
    size = min(width, s.components + s.spare)
    wanted = min(width, s.components)
    q, _ = np.linalg.qr(rng.standard_normal((width, size)))
    probe = Lanczos(rng.standard_normal(width))
    worst: list[float] = []
    for _ in range(s.rounds):
        both = times(np.column_stack([q, probe.vector]))
        product = both[:, :size]
        probe.step(both[:, size])
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residual = np.linalg.norm(product[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        worst.append(float(residual / values[0]) if values[0] > 0 else 0.0)
        still = len(worst) > 2 and worst[-1] <= s.accept and worst[-1] > 0.5 * min(worst[-3:-1])
        if worst[-1] <= s.tolerance or still:
            break
        q, _ = np.linalg.qr(filtered(times, q, product, values, probe, s.degree))
    return values[:wanted], q[:, :wanted], worst[-1]


def filtered(times: Callable, q: np.ndarray, product: np.ndarray, values: np.ndarray, probe: Lanczos, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance applied to the block, scaled to about 1 at the largest eigenvalue."""
    low, high, top = probe.least(), float(values[-1]), float(values[0])
    low = min(low, high)
    half, middle = max((high - low) / 2, 1e-6 * top), (high + low) / 2
    sigma = half / (top - middle) if top > middle else 1.0
    factor = sigma
    before, now = q, (product - middle * q) * (factor / half)
    for _ in range(degree - 1):
        both = times(np.column_stack([now, probe.vector]))
        probe.step(both[:, -1])
        following = 1 / (2 / sigma - factor)
        before, now = now, 2 * (following / half) * (both[:, :-1] - middle * now) - factor * following * before
        factor = following
    return now


def projected(rows: DataFrame, listed: Centred, weights: np.ndarray, shares: np.ndarray, error: float) -> DataFrame:
    """Every row once per component."""
    centred, k, n = listed.centring(), weights.shape[1], listed.n
    sums = np.array(listed.sums, dtype=np.int64)
    kind = dict(rows.dtypes)["vec_id"]

    def deviations(x: np.ndarray) -> pa.Array:
        own = centred(x)
        fits = (own**2).sum(axis=1) * float(n) ** 2 < 9e18
        exact = ((x[fits] * n - sums) ** 2).sum(axis=1)
        out = np.zeros(len(x), dtype=np.int64)
        out[fits] = exact
        return pa.array(out, mask=~fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = numbers(batch.column("x")) if batch.num_rows else np.zeros((0, len(sums)), dtype=np.int64)
            index = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(index),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, dtype=np.int64)),
                    deviations(x).take(index),
                    pa.array((centred(x) @ weights).ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """Per row and component: vec_id, component, n (size of the fit list), deviation, whitened, explained, identity_error."""
    s = settings or Settings()
    rows = staged(whole_numbers(table, id_col, vector_col, s), "whole-numbers")
    nothing = rows.limit(0)
    one = rows.select(F.size("x").alias("d")).first()
    width = one.d if one else 0
    if width == 0:
        return projected(nothing, Centred(nothing, 1, []), np.zeros((0, 0)), np.zeros(0), 0.0)
    listed = centred_list(staged(rows.select("x").distinct(), "fit-list"), width)
    trace = float(listed.variances().sum())
    values, vectors, worst = leading(listed.times, width, s) if trace > 0 else (np.zeros(0), np.zeros((width, 0)), 0.0)
    if worst > s.accept:
        raise ArithmeticError(f"components are only known to {worst:.1e} of the largest eigenvalue after {s.rounds} rounds")
    real = values > s.null_share * values[:1].sum()
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return projected(nothing, listed, vectors, values, 0.0)
    weights = vectors / np.sqrt(values)
    error = float(np.abs(listed.covariance_of(weights) - np.eye(len(values))).max())
    return projected(rows, listed, weights, values / trace, error)
