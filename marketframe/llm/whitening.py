"""Whitening of embeddings with refined eigenvectors.

Entries become integers (``floor(scale * c) + shift``), so sums, centred
products and deviations are exact whatever the order of tasks.  Two passes of
Spark sum the entries and the products of the entries less the nearest whole
mean; with the exact remainder of that mean they give the covariance as a
ratio of integers.  Its eigenvectors come from single precision and are
corrected by the iteration of Ogita and Aishima: a few matrix products in
extended precision, each of which about doubles the correct digits.  Pairs of
eigenvalues too close for the iteration form clusters; each cluster is solved
as a small shifted problem of its own, which turns its vectors among
themselves.  The third pass projects the vectors.

The driver holds matrices of the dimension (``MAX_DIMENSION`` at most), which
do not grow with the rows.  Tasks emit one partial matrix each, summed by
Spark cell by cell.

Edge cases: vectors that are null, or hold an entry that is null, not finite
or above ``LARGEST`` in size (no exact arithmetic), take no part; shorter
vectors count as padded with zeros; repeated rows and equal ids count and are
returned as rows; a component without variance has null ``whitened``; an empty
table, or one without entries, gives an empty result; other columns are
ignored.  A deviation beyond 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MAX_DIMENSION = 4096
LARGEST = float(1 << 31)
STEPS = 12
#: Rows that a task turns into one numpy array.
ROWS = 4096
_PART = 21  # bits of the halves of large entries
_WIDE = np.longdouble


@dataclass(frozen=True)
class Moments:
    """Exact sums over the fit list: rows, dimension, entries, centred products."""

    n: int
    sums: list[int]
    centre: list[int]           # nearest whole mean of each dimension
    products: list[list[int]]   # of the entries less the centre

    @property
    def rest(self) -> list[int]:
        """n times what the centre misses of the mean."""
        return [s - self.n * m for s, m in zip(self.sums, self.centre)]


def fit_list(table: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    x = F.col(vec)
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(LARGEST))
    return table.where(x.isNotNull()).where(F.forall(x, fine)).select("vec_id", x.cast("array<double>").alias("v"))


def _integers(column: pa.Array, dim: int, scale: int, shift: int) -> np.ndarray:
    """The rows of an Arrow list column as a matrix of integers."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        m = flat.reshape(-1, dim)
    else:
        m = np.zeros((len(sizes), dim))
        m[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return np.floor(m * scale).astype("int64") + shift


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def moments(points: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> Moments | None:
    """Two passes; None where there is nothing to fit."""
    shape = points.agg(F.max(F.size("v")).alias("dim"), F.count(F.lit(1)).alias("n"),
                       F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    n, dim = shape.n, shape.dim or 0
    if not n or not dim:
        return None
    if dim > MAX_DIMENSION:
        raise ValueError(f"{dim} dimensions; the driver's matrices are planned for {MAX_DIMENSION}")

    def add_up(batches):
        total = [0] * dim
        for b in _chunks(batches):
            part = _integers(b.column("v"), dim, scale, 0).sum(0)
            total = [t + int(p) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(dim), pa.int32()), "s": pa.array(map(str, total), pa.string())})

    rows = (points.select("v").mapInArrow(add_up, "j int, s string")
            .groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    sums = [0] * dim
    for r in rows:
        sums[r.j] = int(r.s) + shift * n
    centre = [(2 * s + n) // (2 * n) for s in sums]
    middle = np.array([m - shift for m in centre], "int64")
    top = int(shape.top * scale) + 1 + int(np.abs(middle).max())  # no centred entry is larger

    def multiply(batches):
        total = _Products(dim, top)
        for b in _chunks(batches):
            total.add(_integers(b.column("v"), dim, scale, 0) - middle)
        i, j = np.triu_indices(dim)
        cells = total.exact()
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
            "p": pa.array((str(cells[a][b]) for a, b in zip(i, j)), pa.string())})

    cells = (points.select("v").mapInArrow(multiply, "i int, j int, p string")
             .groupBy("i", "j").agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p")).collect())
    products = [[0] * dim for _ in range(dim)]
    for r in cells:
        products[r.i][r.j] = products[r.j][r.i] = int(r.p)
    return Moments(n, sums, centre, products)


class _Products:
    """Exact sum of y'y.  Doubles multiply whole numbers exactly below 2^53;
    larger entries are multiplied in two halves."""

    def __init__(self, dim: int, top: int):
        self.dim, self.halves = dim, top >= 1 << _PART
        self.unit = (1 << _PART) if self.halves else top
        self.step = max(1, (1 << 52) // (self.unit * self.unit))
        self.kinds = 3 if self.halves else 1
        self.held = [np.zeros((dim, dim), "int64") for _ in range(self.kinds)]
        self.rows = 0
        self.whole = [[0] * dim for _ in range(dim)]

    def add(self, y: np.ndarray) -> None:
        for at in range(0, len(y), self.step):
            part = y[at:at + self.step]
            if (self.rows + len(part)) * 2 * self.unit * self.unit >= 1 << 62:
                self._flush()
            self.rows += len(part)
            if not self.halves:
                d = part.astype("float64")
                self.held[0] += (d.T @ d).astype("int64")
                continue
            high = part >> _PART
            lo = (part - (high << _PART)).astype("float64")
            hi = high.astype("float64")
            cross = hi.T @ lo
            self.held[0] += (lo.T @ lo).astype("int64")
            self.held[1] += cross.astype("int64") + cross.T.astype("int64")
            self.held[2] += (hi.T @ hi).astype("int64")

    def _flush(self) -> None:
        for k, held in enumerate(self.held):
            for row, part in zip(self.whole, held.tolist()):
                for j, x in enumerate(part):
                    row[j] += x << (_PART * k)
            held[:] = 0
        self.rows = 0

    def exact(self) -> list[list[int]]:
        self._flush()
        return self.whole


def _wide(x: int) -> np.longdouble:
    """An integer in extended precision."""
    high = float(x)
    return _WIDE(high) + _WIDE(float(x - int(high)))


def covariance(m: Moments) -> np.ndarray:
    """The covariance, divisor n, correctly rounded to extended precision or nearly so."""
    rest, square = m.rest, _wide(m.n * m.n)
    dim = len(rest)
    out = np.zeros((dim, dim), _WIDE)
    for i in range(dim):
        for j in range(i, dim):
            out[i, j] = out[j, i] = _wide(m.n * m.products[i][j] - rest[i] * rest[j]) / square
    return out


def eigenpairs(a: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix in extended precision, from a start in single precision."""
    dim = len(a)
    size = np.abs(a).max()
    if not size > 0:
        return np.zeros(dim, _WIDE), np.eye(dim, dtype=_WIDE)
    a = a / size
    x = np.linalg.eigh(a.astype("float32"))[1].astype(_WIDE)
    eye = np.eye(dim, dtype=_WIDE)
    norm = np.sqrt((a * a).sum())
    enough = 8 * dim * np.finfo(_WIDE).eps
    for _ in range(steps):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding must not be divided by gaps
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        if max(np.abs(off).max(), np.abs(r).max()) <= enough:
            break
        near = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        fix = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ fix
        for group in _clusters(values, near):
            x[:, group] = _turn(a, x[:, group], values[group].mean())
    r = eye - x.T @ x
    values = np.einsum("ij,ij->j", x, a @ x) / (1 - np.diag(r))
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    sign = np.sign(x[np.abs(x).argmax(0), np.arange(dim)])
    return values[order] * size, x * sign


def _clusters(values: np.ndarray, near) -> list[np.ndarray]:
    """Runs of two or more eigenvalues without a gap above ``near``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _turn(a: np.ndarray, x: np.ndarray, about) -> np.ndarray:
    """Solve a cluster alone: its vectors turned to the eigenvectors of the
    matrix less ``about``, seen in their span and scaled up."""
    small = x.T @ (a @ x - about * x)
    size = np.abs(small).max()
    if not size > 0:
        return x
    turn = np.linalg.eigh((small / size).astype("float64"))[1].astype(_WIDE)
    return x @ (turn + turn @ (np.eye(len(turn), dtype=_WIDE) - turn.T @ turn) / 2)


def whitened(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
             vec: str = "embedding") -> DataFrame:
    """vec_id, n, deviation decimal(38,0), whitened array<double>, explained
    array<double> and identity_error: one row per row of the fit list."""
    spark = table.sparkSession
    points = fit_list(table, vec)
    id_type = points.schema["vec_id"].dataType.simpleString()
    out = (f"vec_id {id_type}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, "
           "identity_error double")
    m = moments(points, scale, shift)
    if m is None:
        return spark.createDataFrame([], out)
    cov = covariance(m)
    values, vectors = eigenpairs(cov)
    take = min(components, len(values))
    trace = np.diag(cov).sum()
    least = np.finfo("float64").eps * len(values) * values[0]
    alive = [bool(values[k] > least) for k in range(take)]
    explained = [float(values[k] / trace) if trace > 0 else None for k in range(take)]
    root = np.sqrt(np.where(alive, values[:take], 1))
    turn = (vectors[:, :take] / root).astype("float64")
    dim, n = len(values), m.n
    centre = np.array([c - shift for c in m.centre], "int64")
    rest = m.rest

    def project(batches):
        for b in _chunks(batches):
            y = _integers(b.column("v"), dim, scale, 0) - centre
            top = int(np.abs(y).max(initial=0)) * n + max(map(abs, rest))
            if top * top * dim < 1 << 63:
                off = y * n - np.array(rest, "int64")
                deviation = [str(v) for v in (off * off).sum(1).tolist()]
            else:
                off = y.astype(object) * n - np.array(rest, object)
                deviation = [str(v) for v in (off * off).sum(1).tolist()]
            w = (off.astype("float64") / n) @ turn
            flat = pa.array(w.ravel(), pa.float64(), mask=np.tile(~np.array(alive), len(w)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * take, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(deviation, pa.string()), lists],
                                             names=["vec_id", "deviation", "whitened"])

    wide = points.mapInArrow(project, f"vec_id {id_type}, deviation string, whitened array<double>")
    wide = stored(wide, "whitened")
    error = _identity_error(wide, alive, n) if any(alive) else None
    return wide.select(
        "vec_id", F.lit(n).cast("long").alias("n"), F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"),
        "whitened", F.array(*[F.lit(e).cast("double") for e in explained]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def _identity_error(wide: DataFrame, alive: list[bool], n: int) -> float:
    """Largest entry of the whitened values' covariance less the identity.
    The values are centred; what rounding left of their means is taken off."""
    live = np.flatnonzero(alive)
    take, m = len(alive), len(live)

    def products(batches):
        total = np.zeros((m + 1, m))
        for b in _chunks(batches):
            w = b.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, take)[:, live]
            total[:m] += w.T @ w
            total[m] += w.sum(0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()),
                                          "s": pa.array(total.ravel())})

    total = np.zeros((m + 1, m))
    for r in wide.select("whitened").mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        total[r[0], r[1]] = r[2]
    mean = total[m] / n
    return float(np.abs(total[:m] / n - np.outer(mean, mean) - np.eye(m)).max())
