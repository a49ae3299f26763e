"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers on a grid, and each distinct vector enters the fit once.  The centred
rows X of that list are bidiagonalised: from a direction v, the distributed products u = Xv and Xᵀu
alternate, task by task on its own rows, and every new vector is orthogonalised against all earlier
ones on both sides.  A left vector has as many entries as there are rows and is never stored: it is
X times a small vector, so its inner products with the earlier ones are those of small vectors, and
one pass over the rows gives both products of a step.  The driver holds the right vectors and the
bidiagonal matrix, whose singular value decomposition gives components and deviations.

The steps end when the residuals of the wanted components are at rounding level.  The search then
starts once more in a direction orthogonal to all so far, which finds further copies of a repeated
eigenvalue; it ends when a new start changes nothing, or with a full basis.  A last pass takes the
variances along the components and the covariance of the whitened rows from the rows themselves.

Centring is exact: n * x - sum is computed in whole numbers and divided by n last.

Rows whose vector is null or holds null or non-finite entries are dropped; zero vectors stay.
Vectors of another length are a list of their own, with its own fit; empty vectors have no
components.  Components of no variance are left out, so a list of equal vectors gives no rows.
Repeated rows each get theirs; null ids stay null.  Entries beyond the range of long integers stop at
its ends, and a deviation that a long cannot hold is null.  An empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import map_rows, materialize

COMPONENTS = 16
GRID = 64
SHIFT = 1_000_000
SEED = 13
ROUNDING = 1e-13
BLOCK = 4096
RANGE = 1 << 62
LONG = 1 << 63


def on_grid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id` and `x` of the rows that take part."""
    finite = F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    ).filter(F.col("v").isNotNull() & finite & (F.size("v") > 0))
    limit = float(RANGE)

    def place(c):
        scaled = F.greatest(F.least(F.lit(float(GRID)) * c, F.lit(limit)), F.lit(-limit))
        return F.floor(scaled) + F.lit(SHIFT).cast("long")

    return rows.select("id", F.transform("v", place).alias("x"))


class Fit:
    """The list of distinct vectors of one length, and passes over it."""

    def __init__(self, rows: DataFrame, width: int) -> None:
        self.rows, self.width = rows, width
        self.n = rows.count()
        # one row for each dimension
        sums = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
            F.sum(F.col("x").cast("decimal(38,0)")).alias("s")
        )
        self.sums = [int(s) for _, s in sorted(sums.collect())]

    def add_up(self, function, size: int) -> np.ndarray:
        """The sum over all blocks of centred rows of a function with `size` numbers."""
        n, sums, width = self.n, self.sums, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
            total = np.zeros(size)
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    total += function(centred(whole(part.column(0), width), n, sums) / n)
            yield list(enumerate(total.tolist()))

        # `size` rows: the square of the components, or the dimensions
        table = map_rows(self.rows, run, "at int, part double").groupBy("at").agg(F.sum("part"))
        out = np.zeros(size)
        for at, part in table.collect():
            out[at] = part
        return out


def whole(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: as long integers where they hold it, else as Python's, then rounded."""
    most = max(abs(s) for s in sums)
    if len(x) and max(int(x.max()), -int(x.min())) * n + most >= RANGE:
        exact = x.astype(object) * n - np.array(sums, object)
        return exact.astype(np.float64)
    return (x * np.int64(n) - np.array(sums, np.int64)).astype(np.float64)


def bidiagonalise(fit: Fit, wanted: int, seed: int = SEED) -> np.ndarray:
    """Orthonormal components by falling deviation, from alternating products."""
    width, steps = fit.width, min(fit.width, fit.n)
    chance = np.random.default_rng(seed)
    right: list[np.ndarray] = []  # v
    left: list[np.ndarray] = []  # w with u = X w
    back: list[np.ndarray] = []  # Xᵀ u
    matrix = np.zeros((steps, steps))
    v, beta, before, scale = None, 0.0, None, 0.0
    while len(right) < steps:
        k = len(right)
        if v is None:  # a first or a new start
            v = clean(chance.standard_normal(width), right)
            v, beta = v / np.linalg.norm(v), 0.0
        w = v - (beta * left[-1] if beta else 0.0)
        for _ in range(2):
            for own, image in zip(left, back, strict=True):
                w = w - (w @ image) * own
        product = fit.add_up(lambda rows, w=w: both(rows, w), width + 1)
        alpha = float(np.sqrt(max(product[-1], 0.0)))
        scale = max(scale, alpha)
        right.append(v)
        if alpha <= ROUNDING * scale or alpha == 0.0:
            # Xv lies in the span of the earlier left vectors: nothing new in this direction
            left.append(np.zeros(width))
            back.append(np.zeros(width))
            v = None
            continue
        left.append(w / alpha)
        back.append(product[:-1] / alpha)
        matrix[k, k] = alpha
        rest = clean(back[-1] - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        if beta > ROUNDING * scale and k + 1 < steps:
            matrix[k, k + 1] = beta
        p, s, _ = np.linalg.svd(matrix[: k + 1, : k + 1])
        if beta <= ROUNDING * scale or (
            k + 1 >= wanted and (beta * np.abs(p[-1, :wanted]) <= ROUNDING * s[0]).all()
        ):
            now = s[:wanted]
            if before is not None and len(before) == len(now) == min(wanted, steps):
                if np.allclose(before, now, rtol=1e-12, atol=0):
                    break
            before, v = now, None
            matrix[k, k + 1 :] = 0.0
            continue
        v = rest / beta
    # With as many rows as bidiagonal columns, the right singular vectors belong to the components.
    k = len(right)
    _, s, q = np.linalg.svd(matrix[:k, :k])
    found = q @ np.array(right).reshape(k, width)
    return found[: min(wanted, int((s > 1e-12 * max(s[0], 1e-300)).sum()))] if k else found


def both(rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Xᵀ(Xw) and the square of Xw, of some rows."""
    u = rows @ w
    return np.append(u @ rows, u @ u)


def clean(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """A vector without its share of the others, taken out twice."""
    for _ in range(2):
        for o in others:
            v = v - (v @ o) * o
    return v


def refined(fit: Fit, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components within the span of `basis` and their variances, from the rows themselves."""
    k = len(basis)

    def gram(rows: np.ndarray) -> np.ndarray:
        y = rows @ basis.T
        return (y.T @ y).ravel()

    cov = fit.add_up(gram, k * k).reshape(k, k) / fit.n
    values, turn = np.linalg.eigh((cov + cov.T) / 2)
    return turn[:, ::-1].T @ basis, values[::-1]


def identity_error(fit: Fit, scaled: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened rows, less the identity."""
    k = len(scaled)

    def moments(rows: np.ndarray) -> np.ndarray:
        y = rows @ scaled.T
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    sums = fit.add_up(moments, k + k * k) / fit.n
    mean, square = sums[:k], sums[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def trace(fit: Fit) -> float:
    return float(fit.add_up(lambda rows: np.array([(rows * rows).sum()]), 1)[0] / fit.n)


def whiten(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """`id_col`, component, n, deviation, whitened, explained, identity_error: a row for each
    remaining vector and component."""
    rows = materialize(on_grid(vectors, id_col, vector_col), "grid")
    kind = rows.schema["id"].dataType.simpleString()
    # one row for each length of vectors
    widths = sorted(w for (w,) in rows.select(F.size("x")).distinct().collect())
    schema = (
        f"{id_col} {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    found = None
    for width in widths:
        own = rows.filter(F.size("x") == width)
        part = _whiten(own, width, components, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else rows.sparkSession.createDataFrame([], schema)


def _whiten(rows: DataFrame, width: int, components: int, schema: str) -> DataFrame:
    fit = Fit(materialize(rows.select("x").distinct(), "fit"), width)
    basis = bidiagonalise(fit, min(components, width))
    n, sums = fit.n, fit.sums
    if len(basis):
        basis, values = refined(fit, basis)
        scaled = basis / np.sqrt(values)[:, None]
        shares = (values / trace(fit)).tolist()
        error = identity_error(fit, scaled)
    else:
        scaled, shares, error = np.zeros((0, width)), [], 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = whole(part.column(1), width)
                white = (centred(x, n, sums) / n @ scaled.T).tolist()
                yield [
                    (doc, c + 1, n, deviation, y, shares[c], error)
                    for doc, deviation, row in zip(
                        part.column(0).to_pylist(), deviations(x, n, sums), white, strict=True
                    )
                    for c, y in enumerate(row)
                ]

    return map_rows(rows.select("id", "x"), run, schema)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact square of n * x - sums over the dimensions, None where a long cannot hold it."""
    if not len(x):
        return []
    most = max(int(x.max()), -int(x.min())) * n + max(abs(s) for s in sums)
    if most < RANGE:
        off = x * np.int64(n) - np.array(sums, np.int64)
        most = max(int(off.max()), -int(off.min()))
        if most * most * x.shape[1] < LONG:
            return (off * off).sum(axis=1).tolist()
    exact = x.astype(object) * n - np.array(sums, object)
    return [s if s < LONG else None for s in (exact * exact).sum(axis=1)]
