"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred, distinct vectors."""

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronolex.llm.vectors import matrix, summed, whole_vectors
from chronolex.sources.scratch import materialize

SCALE = 256
COMPONENTS = 4
LIMIT = 2.0**63
SEED = 13
# A direction counts as exhausted, and a singular value as settled, at this share of the largest one.
TOLERANCE = 1e-13
# Directions whose singular value is below this share of the largest one are not whitened.
RANK_TOLERANCE = 1e-7


@dataclasses.dataclass
class Whitener:
    """`n` distinct vectors with sums `s`; unit `components` as rows, their variances `e`, and the `trace`."""

    n: int
    s: list[int]
    components: np.ndarray
    e: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.s, dtype=float) / max(self.n, 1)) @ (self.components / np.sqrt(self.e)[:, None]).T


def _exact_sums(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of rows and sum per dimension, exact: halves of 32 bits are added apart."""
    low = (1 << 32) - 1
    cells = lambda x: np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & low).sum(axis=0)])
    got = [int(v) for v in summed(fit, length, cells, "bigint")]
    if not got:
        return 0, [0] * length
    return got[0], [(high << 32) + rest for high, rest in zip(got[1 : length + 1], got[length + 1 :])]


class Bidiagonal:
    """Golub-Kahan-Lanczos steps on the centred matrix A of all rows: A v = alpha u + beta u', A'u = alpha v + beta' v'.

    The v are short and lie on the driver. The u have one entry per row and are never stored: u = A p for a
    short p, so a task that reads its rows has its share of every u. One pass over the rows takes a
    candidate p and returns A'(A p), its length, and its products with all former u, with which u and A'u
    are made orthogonal to those; where much of it cancels, a second pass does so again.
    """

    def __init__(self, fit: DataFrame, length: int, mean: np.ndarray):
        self.fit, self.length, self.mean = fit, length, mean
        self.v = np.zeros((0, length))
        self.p = np.zeros((0, length))
        self.back = np.zeros((0, length))  # A'u of each u
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beside alpha, above the diagonal
        self.random = np.random.default_rng(SEED)

    def _pass(self, p: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        former, mean, length = self.p.T, self.mean, self.length

        def cells(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ p
            return np.concatenate([u @ centred, [u @ u], u @ (centred @ former)])

        got = summed(self.fit, length, cells)
        return got[:length], float(got[length]), got[length + 1 :]

    def _fresh(self) -> np.ndarray | None:
        """A direction orthogonal to every v, or None if they span everything."""
        if len(self.v) == self.length:
            return None
        return self._orthogonal(self.random.standard_normal(self.length))

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.v.T @ (self.v @ v)
        return v / np.linalg.norm(v)

    def step(self, v: np.ndarray, beta: float) -> None:
        """Add v and its u; `beta` links v to the u before."""
        p = v - beta * self.p[-1] if len(self.p) else v
        top = max([1e-300, *self.alpha, *self.beta])
        for again in range(2):
            back, square, products = self._pass(p)
            p, back = p - self.p.T @ products, back - self.back.T @ products
            rest = square - float(products @ products)
            if rest > 0.5 * square:
                break
        alpha = float(np.sqrt(max(rest, 0.0)))
        gone = alpha <= TOLERANCE * top
        self.v = np.vstack([self.v, v])
        self.p = np.vstack([self.p, np.zeros_like(p) if gone else p / alpha])
        self.back = np.vstack([self.back, np.zeros_like(back) if gone else back / alpha])
        self.alpha.append(0.0 if gone else alpha)
        self.beta.append(beta)

    def following(self) -> tuple[np.ndarray, float] | None:
        """The next v and its link: what A'u has besides all former v."""
        if len(self.v) == self.length:
            return None
        rest = self.back[-1]
        for _ in range(2):
            rest = rest - self.v.T @ (self.v @ rest)
        beta = float(np.linalg.norm(rest))
        if beta > TOLERANCE * max(self.alpha):
            return rest / beta, beta
        fresh = self._fresh()
        return None if fresh is None else (fresh, 0.0)

    def svd(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values of the bidiagonal matrix, right vectors as rows, and the last entries of the left ones."""
        left, values, right = np.linalg.svd(np.diag(self.alpha) + np.diag(self.beta[1:], 1))
        return values, right @ self.v, np.abs(left[-1])

    def run(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """The `wanted` largest singular values and their right vectors. Steps end once these are settled."""
        upcoming = (self._orthogonal(self.random.standard_normal(self.length)), 0.0) if self.length else None
        while upcoming is not None:
            self.step(*upcoming)
            upcoming = self.following()
            values, vectors, last = self.svd()
            settled = upcoming is not None and len(values) > 2 * wanted and upcoming[1] > 0
            if settled and (upcoming[1] * last[:wanted] <= TOLERANCE * values[0]).all():
                break
        if not self.alpha:
            return np.zeros(0), np.zeros((0, self.length))
        return values[:wanted], vectors[:wanted]


def fit_whitener(fit: DataFrame, length: int, components: int = COMPONENTS) -> Whitener:
    """The whitener of a stored table of distinct vectors `x`. Runs actions, one pass over it per step.

    At most as many steps as dimensions are made. What the driver holds depends on the dimensions alone.
    """
    n, s = _exact_sums(fit, length)
    mean = np.array(s, dtype=float) / max(n, 1)
    trace = float(summed(fit, length, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n if n else 0.0
    values, vectors = Bidiagonal(fit, length, mean).run(components) if trace > 0 else (np.zeros(0), np.zeros((0, length)))
    real = values > max(RANK_TOLERANCE * values.max(initial=0.0), 0.0)
    whitener = Whitener(n, s, vectors[real], values[real] ** 2 / max(n, 1), trace)
    k = int(real.sum())
    if k:

        def cells(x: np.ndarray) -> np.ndarray:
            w = whitener.whiten(x)
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        got = summed(fit, length, cells) / n
        covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        whitener.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return whitener


def _deviation(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None where it does not fit a long."""
    bound = n * int(np.abs(x.astype(float)).max(initial=0.0)) + max(map(abs, s), default=0) + 1
    if bound * bound * max(len(s), 1) < 1 << 62:
        return ((n * x - np.array(s, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or has a NULL or non-finite component, or one that as a scaled whole number
    does not fit a long, are left out. Shorter vectors count as filled with zeros. Covariances are
    over the distinct vectors, so copies weigh nothing, but every row, repeated ids and NULL ids included,
    is returned. Components without variance do not exist: equal vectors, one vector, or an empty table
    give no rows. A deviation beyond a long is NULL. Other columns are not looked at. Runs actions.
    """
    vectors, length = whole_vectors(df, id_col, vector_col, {}, scale, LIMIT)
    fit = materialize(vectors.select("x").distinct(), "whitening-fit")
    whitener = fit_whitener(fit, length, components)
    k = len(whitener.e)
    explained = whitener.e / whitener.trace if k else whitener.e

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = matrix(batch.column("x"), length)
            repeated = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(repeated),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, whitener.n, dtype=np.int64)),
                    pa.array(_deviation(x, whitener.n, whitener.s), pa.int64()).take(repeated),
                    pa.array(whitener.whiten(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, whitener.identity_error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(
        rows,
        f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    )
