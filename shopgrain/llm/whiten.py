"""Whitening of embeddings: leading eigenvectors of their covariance by Jacobi-Davidson."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopgrain.llm.common import discard, per_batch, store

SCALE = 256  # entries become floor(SCALE * c)
BOUND = float(1 << 53)  # largest magnitude of a scaled entry
ROWS = 1024  # vectors of a stored block
INNER = 4  # MINRES steps of a correction equation at most
ROUNDS = 200  # outer rounds at most; reached only if rounding keeps residuals above TOLERANCE
SPACE = 32  # vectors of the search space before a restart
TOLERANCE = 4e-15  # of a residual's norm, in shares of the largest eigenvalue
RANK = 1e-12  # components with less than this share of the trace have no direction of their own


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x): rows whose vector is neither null nor holds null or non-finite entries, its entries as
    long floor(SCALE * c); vectors with an entry beyond 2**53 after scaling are left out like
    non-finite ones. Nothing else is checked here."""
    v = F.col(vec_col).cast("array<double>")
    fine = lambda c: c.isNotNull() & (F.abs(c * SCALE) <= BOUND)  # noqa: E731  # false for NaN and infinities
    good = F.forall(v, lambda c: F.coalesce(fine(c) & ~F.isnan(c), F.lit(False)))
    return df.where(v.isNotNull() & good).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda c: F.floor(c * SCALE).cast("long")).alias("x"),
    )


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int, list[int]]:
    """The distinct ``x`` of ``vectors`` as stored blocks (``rows`` int, ``data`` binary of 64-bit
    integers), their number, and the exact sums of each dimension. Runs jobs.

    Vectors of the most frequent length count (of equal ones the longest). Equal vectors are one
    before they are shuffled, so a vector that a third of the rows hold moves once from each task.
    """
    sizes = vectors.groupBy(F.size("x").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    dims = top["d"] if top else 0
    distinct = vectors.where(F.size("x") == dims).select("x").distinct()

    def make():
        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, batch.num_rows, ROWS):
                n = min(ROWS, batch.num_rows - at)
                data = flat[at * dims : (at + n) * dims].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([data], pa.binary())], ["rows", "data"])

        return step

    blocks = store(per_batch(distinct, make, "rows int, data binary"), "vectors")
    n = blocks.agg(F.sum("rows")).first()[0] or 0

    def sums():
        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            for data in batch.column(0):
                x = np.frombuffer(data.as_py(), np.int64).reshape(-1, dims)
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                parts = [str((h << 32) + l) for h, l in zip(high, low)]
                yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(parts)], ["d", "s"])

        return step

    found = per_batch(blocks.select("data"), sums, "d int, s string").groupBy("d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    by_dim = {r["d"]: int(r["s"]) for r in found.collect()} if dims else {}
    return blocks, n, [by_dim.get(d, 0) for d in range(dims)]


class Products:
    """Covariance times some vectors, without the matrix: each call is a pass over stored blocks.

    A task centres a block and adds up (x - mean)((x - mean) . u) for all u at once; the sums of the
    blocks are added by Spark. The mean is split into a whole and a broken part, so centring is exact
    to the last bit of what remains. What reaches the driver is as many numbers as the vectors have.
    """

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]) -> None:
        self.blocks, self.n, self.dims = blocks.select("data"), n, len(sums)
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.broken = np.array([(s % n) / n for s in sums])
        self.calls = 0

    def _sum(self, task: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        whole, broken, dims = self.whole, self.broken, self.dims

        def make():
            def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
                total = np.zeros(size)
                for data in batch.column(0):
                    x = np.frombuffer(data.as_py(), np.int64).reshape(-1, dims)
                    total += task((x - whole).astype(float) - broken).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["i", "v"])

            return step

        out = np.zeros(size)
        for r in per_batch(self.blocks, make, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        self.calls += 1
        return out / self.n

    def __call__(self, u: np.ndarray) -> np.ndarray:
        """Products with the columns of ``u``."""
        return self._sum(lambda x: x.T @ (x @ u), u.size).reshape(u.shape)

    def trace(self) -> float:
        return float(self._sum(lambda x: np.array([np.einsum("ij,ij->", x, x)]), 1)[0])


def _against(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``x`` without what lies in the span of the orthonormal ``basis``; twice, for rounding."""
    for _ in range(2 if basis.shape[1] else 0):
        x = x - basis @ (basis.T @ x)
    return x


def _orthonormal(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns for the part of ``x`` outside ``basis``; columns that vanish are left out."""
    out = basis
    for column in x.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = _against(column[:, None] / size, out)
        left = np.linalg.norm(column)
        if left > 1e-10:
            out = np.hstack([out, _against(column / left, out)])
            out[:, -1] /= np.linalg.norm(out[:, -1])
    return out[:, basis.shape[1]:]


def _corrections(
    product: Callable[[np.ndarray], np.ndarray], values: np.ndarray, vectors: np.ndarray,
    residuals: np.ndarray, locked: np.ndarray, steps: int,
) -> np.ndarray:
    """Inner MINRES: t of (I - QQ')(A - value)(I - QQ') t = -r for each column, Q the locked vectors and
    the column's own Ritz vector. All columns take a step together, so a step is one pass."""
    count = len(values)
    spaces = [np.hstack([locked, vectors[:, j : j + 1]]) for j in range(count)]

    def project(x: np.ndarray) -> np.ndarray:
        return np.hstack([_against(x[:, j : j + 1], spaces[j]) for j in range(count)])

    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    live = beta > 0
    beta_safe = np.where(live, beta, 1)
    v, old = v / beta_safe, np.zeros_like(v)
    w, w_old = np.zeros_like(v), np.zeros_like(v)
    t, eta, start = np.zeros_like(v), beta.copy(), beta.copy()
    c, c_old, s, s_old, b = np.ones(count), np.ones(count), np.zeros(count), np.zeros(count), np.zeros(count)
    for _ in range(steps):
        a_v = project(product(v) - v * values)
        alpha = np.einsum("ij,ij->j", v, a_v)
        new = project(a_v - alpha * v - b * old)
        b_new = np.linalg.norm(new, axis=0)
        # Givens rotations of the tridiagonal matrix, a column of it per step
        delta = c * alpha - c_old * s * b
        rho1 = np.hypot(delta, b_new)
        rho2 = s * alpha + c_old * c * b
        rho3 = s_old * b
        safe = np.where(rho1 > 0, rho1, 1)
        c_old, s_old, c, s = c, s, delta / safe, b_new / safe
        w, w_old = (v - rho3 * w_old - rho2 * w) / safe, w
        t = t + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live = live & (b_new > 1e-14 * np.abs(values).max()) & (np.abs(eta) > 1e-3 * start)
        if not live.any():
            break
        old, v, b = v, new / np.where(b_new > 0, b_new, 1), b_new
    return project(t)


def eigenpairs(product: Products, count: int, trace: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Block Jacobi-Davidson: Rayleigh-Ritz in a subspace whose products are kept, corrections of the
    leading Ritz pairs by inner MINRES, restart with the leading Ritz vectors at ``SPACE`` vectors. A
    pair is locked, largest first, when its residual is at ``TOLERANCE`` of the largest eigenvalue, or
    when it no longer falls and is at rounding; the subspace is then kept orthogonal to it.
    """
    dims = product.dims
    count = min(count, dims)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dims, 0)), []
    space = _orthonormal(rng.normal(size=(dims, min(dims, 2 * count))), locked)
    images = product(space)
    best = np.inf
    for _ in range(ROUNDS):
        want = count - len(values)
        if not want or not space.shape[1]:
            break
        inner = space.T @ images
        theta, y = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-theta)
        theta, y = theta[order], y[:, order]
        ritz, image = space @ y, images @ y
        top = max([theta[0], *values, 0.0])
        if top <= RANK * max(trace, 0) or top <= 0:
            break
        lead = min(want, len(theta))
        residuals = _against(image[:, :lead] - ritz[:, :lead] * theta[:lead], locked)
        norms = np.linalg.norm(residuals, axis=0) / top
        stuck = norms[0] <= 1e-13 and norms[0] >= 0.5 * best
        best = min(best, norms[0])
        full = space.shape[1] + locked.shape[1] >= dims  # the subspace is everything
        if norms[0] <= TOLERANCE or stuck or (full and norms[0] <= 1e-12):
            values.append(float(theta[0]))
            locked = np.hstack([locked, _orthonormal(ritz[:, :1], locked)])
            space, images, best = ritz[:, 1:], image[:, 1:], np.inf
            continue
        if space.shape[1] + lead > max(SPACE, 3 * count):
            space, images = ritz[:, : 2 * count], image[:, : 2 * count]
        fixes = _corrections(product, theta[:lead], ritz[:, :lead], residuals, locked, INNER)
        added = _orthonormal(fixes, np.hstack([locked, space]))
        if not added.shape[1]:
            added = _orthonormal(rng.normal(size=(dims, 1)), np.hstack([locked, space]))
        if not added.shape[1]:  # nothing is left to add: fresh products against what rounding gathered
            space = _orthonormal(ritz, locked)
            images = product(space)
            continue
        space, images = np.hstack([space, added]), np.hstack([images, product(added)])
    values = np.array(values)
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


def whiten(
    df: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector of
    ``quantised`` and component, numbered from 1 by falling eigenvalue.

    The covariance is that of the distinct quantised vectors, ``n`` of them. ``deviation`` is the exact
    sum over dimensions of (n * x - S)**2, null where it does not fit into a long; ``whitened`` is
    x - S/n on the component over the root of its eigenvalue; ``identity_error`` the largest entry of
    the whitened fit list's covariance minus the identity.

    Vectors of another length than most are left out. Components without variance (fewer distinct
    vectors than components, equal vectors) are left out too; a single distinct vector gives no rows.
    Repeated rows and null ids keep their rows. An empty table gives no rows. Runs jobs: a pass over
    the fit list for each product, as many as the eigenvalues' gaps ask for, not the rows.
    """
    vectors = store(quantised(df, id_col, vec_col), "quantised")
    blocks, n, sums = fit_list(vectors)
    dims = len(sums)
    values, basis, trace, error = np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0
    if n and dims:
        product = Products(blocks, n, sums)
        trace = product.trace()
        values, basis = eigenpairs(product, components, trace)
        strong = values > RANK * trace
        values, basis = values[strong], basis[:, strong]
    root = np.sqrt(values)
    if len(values):
        cov = basis.T @ product(basis) / np.outer(root, root)
        error = float(np.abs(cov - np.eye(len(values))).max())
    discard(blocks)
    whole = np.array([s // n for s in sums] if n else [], dtype=np.int64)
    broken = np.array([(s % n) / n for s in sums] if n else [])
    explained = (values / trace).tolist() if len(values) else []
    weights = basis / root if len(values) else basis
    own = [int(s) for s in sums]

    def make():
        exact = np.array(own, dtype=object)

        def deviations(x: np.ndarray) -> list[int | None]:
            most = n * int(np.abs(x).max()) + max(map(abs, own)) if x.size else 0
            if most * most * dims < 1 << 63:  # 64-bit integers hold every step
                return ((x * n - exact.astype(np.int64)) ** 2).sum(axis=1).tolist()
            found = ((x.astype(object) * n - exact) ** 2).sum(axis=1)
            return [int(v) if v < 1 << 63 else None for v in found]

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
                white = ((x - whole).astype(float) - broken) @ weights
                rows, k = white.shape
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n, dtype=np.int64)),
                        pa.array([d for d in deviations(x) for _ in range(k)], pa.int64()),
                        pa.array(white.ravel()),
                        pa.array(np.tile(np.array(explained), rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

        return step

    some = vectors.where(F.size("x") == dims) if len(values) else vectors.where(F.lit(False))
    return per_batch(
        some, make,
        "id long, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
