"""Whitening of embeddings by shifted CholeskyQR.

Each entry c of a vector becomes the integer ``floor(SCALE * c) + OFFSET``, so counts and per-dimension sums are exact.

1. One pass gives the vectors of each width and their sums.
2. Gram passes: every task centres its rows, orthogonalises them against the factors found so far by triangular solves,
   and sums outer products block by block; Spark adds the tasks' sums entry by entry (d * d numbers, d the width).  The
   first Gram matrix is shifted by the error bound of its own sums, so its Cholesky factor exists however badly the
   dimensions are conditioned; the next passes find the factors of what is then well conditioned, until the rows are
   orthonormal to working precision.
3. The product R of the factors has the covariance ``R' R / n``; its SVD gives the components without ever squaring the
   condition number.  A last pass measures the covariance of the whitened rows, and whitening itself is one map.

Only matrices of d * d numbers reach the driver or are sent to tasks; rows are never collected, shuffled or sampled.

Defined cases: rows are dropped whose vector is null, holds a null, non-finite or too large entry (beyond 2**53 after
scaling), is empty, or has another width than most of the others (ties: the wider); repeated rows and null ids count and
return like others; components without variance (to rounding) give no rows, so equal vectors or a single vector give
none; an empty table gives no rows; extra columns are ignored.  Eigenvectors of equal eigenvalues are any orthonormal
ones; the sign makes the entry of largest size positive.  ``deviation`` beyond 64 bits stops the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import stored

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows of a block, over which outer products are summed at once.
BLOCK = 4096
MOST_PASSES = 8
_EPS = float(np.finfo(float).eps)
_LARGEST = float(1 << 53)


def usable(vector: str = "embedding"):
    """True for vectors that hold at least one entry, and only finite ones."""
    good = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(F.floor(c.cast("double") * SCALE).cast("double")) <= F.lit(_LARGEST), F.lit(False)) & ~F.isnan(c))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def integers(vector: str = "embedding"):
    """The vector's entries as integers."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))


def prepared(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the usable rows, of every width."""
    return rows.where(usable(vector)).select(F.col(vec_id).alias("vec_id"), integers(vector).alias("x"))


def sums(x: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of the commonest width and their exact sums by dimension (n = 0 and no dimension for no rows)."""

    def run(batches):
        count, total = {}, {}
        for batch in batches:
            column = batch.column(0)
            widths = np.diff(column.offsets.to_numpy())
            for w in np.unique(widths).tolist():
                own = column if (widths == w).all() else column.filter(pa.array(widths == w))
                for block in _blocks(own, w):
                    small = int(np.abs(block).max()) < 1 << 50  # at most 2**12 rows
                    count[w] = count.get(w, 0) + len(block)
                    total[w] = total.get(w, 0) + (block if small else block.astype(object)).sum(axis=0).astype(object)
        if count:
            added = pa.array([list(total[w]) for w in count], pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int32()), pa.array(list(count.values()), pa.int64()), added], names=["width", "n", "sums"])

    parts = x.select("x").mapInArrow(run, "width int, n long, sums array<decimal(38,0)>")
    got = parts.select("width", "n", F.posexplode("sums").alias("k", "s")).groupBy("width", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    best = got.where("k = 0").orderBy(F.desc("n"), F.desc("width")).select("width", "n").first()
    if best is None:
        return 0, np.zeros(0, object)
    rows = got.where(F.col("width") == best.width).orderBy("k").collect()  # one row a dimension
    return int(best.n), np.array([int(r.s) for r in rows], object)


def _blocks(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Integer matrices of at most ``BLOCK`` rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    every = flat.reshape(-1, width)
    for i in range(0, len(every), BLOCK):
        yield every[i : i + BLOCK]


def deviations(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """``n * x - S`` without rounding: 64-bit integers where all of them fit, Python integers elsewhere."""
    largest = n * int(np.abs(x).max(initial=0)) + max((abs(int(v)) for v in s), default=0)
    if largest < 1 << 62:
        return x * np.int64(n) - s.astype(np.int64)
    return x.astype(object) * n - s


def squares(d: np.ndarray) -> np.ndarray:
    """Exact sums of squares of the rows of ``deviations``."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1)
    out = [sum(int(v) ** 2 for v in row) for row in d]
    if max(out, default=0) >= 1 << 63:
        raise OverflowError("a deviation needs more than 64 bits")
    return np.array(out, np.int64)


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows @ inverse(r)`` for an upper triangular r, by forward substitution over the columns."""
    out = np.empty_like(rows)
    for k in range(r.shape[0]):
        out[:, k] = (rows[:, k] - out[:, :k] @ r[:k, k]) / r[k, k]
    return out


def gram(x: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], k: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``of(block)`` (k columns), after a column of their plain sums: [k, k + 1]."""

    def run(batches):
        total = np.zeros((k, k + 1))
        rows = 0
        for batch in batches:
            for block in _blocks(batch.column(0), width):
                y = of(block)
                total[:, 0] += y.sum(axis=0)
                total[:, 1:] += y.T @ y
                rows += len(block)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = x.where(F.size("x") == width).select("x").mapInArrow(run, "i int, row array<double>")
    added = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((k, k + 1))
    for r in added.collect():  # k * (k + 1) rows
        out[r.i, r.j] = r.v
    return out


@dataclass
class Whitening:
    """n, exact sums by dimension, components (rows, unit length), their eigenvalues by size, the trace of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int

    def centred(self, block: np.ndarray) -> np.ndarray:
        return deviations(block, self.n, self.sums).astype(float) / self.n

    def whiten(self, block: np.ndarray) -> np.ndarray:
        return self.centred(block) @ self.components.T / np.sqrt(self.eigenvalues)

    def identity_error(self, x: DataFrame) -> float:
        """Largest absolute entry of the covariance of all whitened rows minus the identity."""
        k = len(self.components)
        if not k:
            return 0.0
        got = gram(x, len(self.sums), self.whiten, k) / self.n
        return float(np.abs(got[:, 1:] - np.outer(got[:, 0], got[:, 0]) - np.eye(k)).max())


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``prepared`` rows (stored, as it is read some times), over all of them."""
    n, s = sums(x)
    d = len(s)
    out = Whitening(n, s, np.zeros((0, d)), np.zeros(0), 0.0, 0)
    if not n:
        return out
    factors: list[np.ndarray] = []

    def orthogonalised(block: np.ndarray) -> np.ndarray:
        y = out.centred(block)
        for r in factors:
            y = solve(y, r)
        return y

    whole = np.eye(d)
    for k in range(MOST_PASSES):
        g = gram(x, d, orthogonalised, d)[:, 1:]
        out.passes += 1
        if not k:
            out.trace = float(np.trace(g)) / n
            if not out.trace > 0:
                return out
        elif np.abs(g - np.eye(d)).max() < 64 * d * _EPS:
            break
        r = _factor(g, min(n, BLOCK), shifted=not k)
        factors.append(r)
        whole = r @ whole
    _, sigma, right = np.linalg.svd(whole / np.sqrt(n))
    keep = np.flatnonzero(sigma > 64 * d * _EPS * sigma[0])[:components]
    right, out.eigenvalues = right[keep], sigma[keep] ** 2
    signs = np.sign(right[np.arange(len(keep)), np.abs(right).argmax(axis=1)])
    out.components = right * signs[:, None]
    return out


def _factor(g: np.ndarray, rows: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R' R = g, or g and a shift of the size of its rounding errors where g alone has none."""
    d = len(g)
    shift = 11 * (rows * d + d * (d + 1)) * _EPS / 2 * float(np.trace(g))
    for more in ([] if shifted else [0.0]) + [shift * 10.0**k for k in range(8)]:
        try:
            return np.linalg.cholesky(g + more * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("a Gram matrix is not positive definite")


def whiten(x: DataFrame, model: Whitening, error: float) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    width, k = len(model.sums), len(model.components)
    kind = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    share = model.eigenvalues / model.trace if k else np.zeros(0)

    def run(batches):
        for batch in batches:
            at = 0
            for block in _blocks(batch.column("x"), width):
                m = len(block)
                ids = batch.column("vec_id").slice(at, m)
                at += m
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(squares(deviations(block, model.n, model.sums))[each]),
                    pa.array(model.whiten(block).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    # without components no row is whitened, and no width fits
    return x.where(F.size("x") == (width if k else -1)).select("vec_id", "x").mapInArrow(run, schema)


def whitened(rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The whole operator: fit on all rows, measure, whiten."""
    x = stored(prepared(rows, vec_id, vector), "vectors")
    model = fit(x, components)
    return whiten(x, model, model.identity_error(x))
