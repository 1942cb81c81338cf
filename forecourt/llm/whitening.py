"""Whitening of embeddings: centred covariance, its leading eigenvectors, projection of every row.

The rows are read in four scans. The first adds up integer entries, so count and sums are exact;
the second adds products of entries centred by those exact sums. A task holds one square matrix
and sends it row by row; equal rows of all tasks are added in a fixed order while they stream by.
Only the finished matrix reaches the driver, where its size is checked: it grows with the square
of the vector length and not with the table. There it is made tridiagonal by Householder
reflections, its leading eigenvalues are enclosed by bisection on Sturm counts, and inverse
iteration finds the vectors, which are made orthogonal again inside clusters of close eigenvalues.
The third scan measures the covariance of the projected rows, the fourth projects them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage, added_up, sliced
from forecourt.llm.vafile import usable

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
ENTRY_BITS = 40  # entries of 2^40 / SCALE and more fail the job
MATRIX_BYTES = 256 << 20  # the largest covariance matrices that the driver takes, all vector lengths together
RANK = 1e-10  # eigenvalues below this share of the largest carry no component
CLUSTER = 1e-3


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, dims, x): usable vectors with x = floor(SCALE * entry), without the shift that centring takes out again."""

    def whole(c):
        scaled = F.floor(F.lit(float(SCALE)) * c.cast("double"))
        return F.when(F.abs(c) < float((1 << ENTRY_BITS) // SCALE), scaled).otherwise(
            F.raise_error(F.concat(F.lit("an entry is too large to whiten: "), c.cast("string"))).cast("bigint"))

    return vectors.where(usable(F.col("embedding"))).select(
        "vec_id", F.size("embedding").alias("dims"), F.transform("embedding", whole).alias("x"))


# -- eigenvectors of one symmetric matrix ----------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, side, reflections): Householder reflections that make a symmetric matrix tridiagonal."""
    a, p, mirrors = np.array(v, float), len(v), []
    for i in range(p - 2):
        u = a[i + 1:, i].copy()
        size = np.linalg.norm(u)
        if np.linalg.norm(u[1:]) <= np.finfo(float).tiny:
            mirrors.append(np.zeros_like(u))
            continue
        u[0] += size if u[0] >= 0 else -size
        u /= np.linalg.norm(u)
        block = a[i + 1:, i + 1:]
        w = block @ u
        w -= (u @ w) * u
        block -= 2 * (np.outer(u, w) + np.outer(w, u))
        a[i + 1:, i] -= 2 * u * (u @ a[i + 1:, i])
        mirrors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each point."""
    least = np.finfo(float).tiny * max(1.0, float((side ** 2).max(initial=0)))
    q, below = diagonal[0] - at, np.zeros(len(at), np.int64)
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - at - side[i - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until its interval is as narrow as doubles are."""
    p = len(diagonal)
    reach = np.abs(np.concatenate((side, [0]))) + np.abs(np.concatenate(([0], side)))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    margin = 4 * np.finfo(float).eps * max(np.abs(low).max(), np.abs(high).max()) + np.finfo(float).tiny
    low, high, wanted = low - margin, high + margin, p - np.arange(k)  # eigenvalue i has fewer than p - i below it
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        under = sturm_counts(diagonal, side, middle) >= wanted
        low, high = np.where(under, low, middle), np.where(under, middle, high)
    return low + (high - low) / 2


def _solved(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - shift) y = right by elimination with row exchanges; a zero pivot becomes ``least``."""
    p = len(diagonal)
    main, upper, second = (diagonal - shift).tolist(), [*side.tolist(), 0.0], [0.0] * p
    lower, y = side.tolist(), right.tolist()
    for i in range(p - 1):
        if abs(lower[i]) > abs(main[i]):
            factor = main[i] / lower[i]
            main[i], upper[i], main[i + 1], old = lower[i], main[i + 1], upper[i] - factor * main[i + 1], upper[i + 1]
            second[i], upper[i + 1] = old, -factor * old
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            pivot = main[i] if abs(main[i]) >= least else least
            main[i], factor = pivot, lower[i] / pivot
            main[i + 1] -= factor * upper[i]
            y[i + 1] -= factor * y[i]
    for i in range(p - 1, -1, -1):
        more = (upper[i] * y[i + 1] if i + 1 < p else 0.0) + (second[i] * y[i + 2] if i + 2 < p else 0.0)
        y[i] = (y[i] - more) / (main[i] if abs(main[i]) >= least else least)
    return np.array(y)


def tridiagonal_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; those of close eigenvalues are made orthogonal in every step."""
    p, rng = len(diagonal), np.random.default_rng(0)
    size = float((np.abs(diagonal) + np.abs(np.concatenate((side, [0]))) + np.abs(np.concatenate(([0], side)))).max())
    least = max(np.finfo(float).eps * size, np.finfo(float).tiny)
    out, cluster, shift = np.zeros((p, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            cluster = k
        # Equal eigenvalues would give equal systems: keep shifts a little apart.
        shift = min(value, shift - 10 * least) if k > cluster else value
        y = rng.normal(size=p)
        for _ in range(5):
            for _ in range(2):
                y -= out[:, cluster:k] @ (out[:, cluster:k].T @ y)
            y = _solved(diagonal, side, shift, y / np.linalg.norm(y), least)
            y /= np.abs(y).max()
        for _ in range(2):
            y -= out[:, cluster:k] @ (out[:, cluster:k].T @ y)
            y /= np.linalg.norm(y)
        out[:, k] = y
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the k largest eigenvalues above the rank limit; a vector's largest entry is positive."""
    if not len(v) or not np.any(v):
        return np.empty(0), np.empty((len(v), 0))
    diagonal, side, mirrors = tridiagonal(v)
    values = leading_values(diagonal, side, min(k, len(v)))
    values = values[values > RANK * values[0]]
    vectors = tridiagonal_vectors(diagonal, side, values)
    for i in range(len(mirrors) - 1, -1, -1):
        vectors[i + 1:] -= 2 * np.outer(mirrors[i], mirrors[i] @ vectors[i + 1:])
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * turn


# -- the scans -------------------------------------------------------------------------------------

@dataclass
class Space:
    """The vectors of one length: their number, exact sums, and what whitening needs."""

    n: int
    sums: list[int]
    project: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        largest = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if largest < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.project


def deviations(numerators: np.ndarray) -> pa.Array:
    """The sum of squares of each row, exact."""
    if numerators.dtype != object:
        largest = int(np.abs(numerators).max(initial=0))
        if largest * largest * numerators.shape[1] < 1 << 63:
            return pa.array((numerators * numerators).sum(axis=1)).cast(pa.decimal128(38, 0))
        numerators = numerators.astype(object)
    return pa.array([int(s) for s in (numerators * numerators).sum(axis=1)], pa.decimal128(38, 0))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    dims = batch.column("dims").to_numpy()
    for d in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == d))
        yield d, part, part.column("x").flatten().to_numpy().reshape(part.num_rows, d)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 1 << 16):  # 2^16 entries below 2^40 can't leave 64 bits
        for d, _, x in _by_length(batch):
            yield pa.record_batch({"dims": pa.array([d] * d, pa.int32()), "pos": pa.array(range(d), pa.int32()),
                                   "n": pa.array([len(x)] * d, pa.int64()), "s": pa.array(x.sum(axis=0))})


def _measured(rows: DataFrame) -> dict[int, Space]:
    """The spaces of a table by vector length; the empty vector has none."""
    entries = MATRIX_BYTES // 8
    found = rows.where("dims > 0").mapInArrow(_sums, "dims int, pos int, n bigint, s bigint").groupBy("dims", "pos") \
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("dims", "pos")
    sums = found.limit(entries + 1).collect()
    spaces: dict[int, Space] = {}
    for r in sums:
        spaces.setdefault(r.dims, Space(r.n, [])).sums.append(int(r.s))
    if len(sums) > entries or sum(d * d for d in spaces) > entries:
        raise ValueError(f"covariance matrices of more than {MATRIX_BYTES} bytes are too large for the driver")
    return spaces


def _products(rows: DataFrame, of: Callable[[Space, np.ndarray], np.ndarray], spaces: dict[int, Space]) -> dict[int, np.ndarray]:
    """By vector length, the covariance of the centred rows that ``of`` makes of them, divisor n."""
    shared = rows.sparkSession.sparkContext.broadcast(spaces)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in sliced(batches):
            for d, _, x in _by_length(batch):
                y = of(shared.value[d], x)
                y = np.column_stack((y, np.ones(len(y))))
                total[d] = total[d] + y.T @ y if d in total else y.T @ y
        task = TaskContext.get().partitionId()
        for d, z in total.items():
            yield pa.record_batch({"dims": pa.array([d] * len(z), pa.int32()), "pos": pa.array(range(len(z)), pa.int32()),
                                   "task": pa.array([task] * len(z), pa.int32()), "z": pa.array(list(z), pa.list_(pa.float64()))})

    sent = rows.where("dims > 0").mapInArrow(added, "dims int, pos int, task int, z array<double>")
    made: dict[int, np.ndarray] = {}
    for r in sorted(added_up(sent, "dims", "pos").collect(), key=lambda r: (r.dims, r.pos)):
        made.setdefault(r.dims, np.empty((len(r.z), len(r.z))))[r.pos] = r.z
    out = {}
    for d, z in made.items():
        mean = z[-1, :-1] / spaces[d].n
        out[d] = z[:-1, :-1] / spaces[d].n - np.outer(mean, mean)
    return out


def whiten(vectors: DataFrame, stage: Stage, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per remaining vector and component.

    Vectors that are null or hold null or non-finite entries are left out; entries beyond
    2^40 / 64 fail the job. Vectors of different length are spaces of their own, each with its
    own n, sums and components; an empty vector has no components and so no rows. Rows that
    repeat a vec_id, or have none, are rows each. Fewer components come where the vectors have
    fewer entries or span fewer dimensions (one vector, or equal ones, span none). ``deviation``
    is DECIMAL(38,0). Other columns are ignored; an empty table gives an empty result.
    """
    rows = stage("vectors", integer_vectors(vectors))
    spaces = _measured(rows)
    for d, v in _products(rows, Space.centred, spaces).items():
        values, units = leading_components(v, components)
        spaces[d].project, spaces[d].explained = units / np.sqrt(values), values / np.trace(v) if len(values) else values
    for d, v in _products(rows, Space.whitened, spaces).items():
        spaces[d].identity_error = float(np.abs(v - np.eye(len(v))).max(initial=0))
    shared = rows.sparkSession.sparkContext.broadcast(spaces)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for d, part, x in _by_length(batch):
                space = shared.value[d]
                y, row = space.whitened(x), np.repeat(np.arange(len(x)), len(space.explained))
                deviation = deviations(space.numerators(x)).take(pa.array(row))
                yield pa.record_batch({
                    "vec_id": part.column("vec_id").take(pa.array(row)), "component": pa.array(np.tile(np.arange(1, y.shape[1] + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(row), space.n, np.int64)), "deviation": deviation, "whitened": pa.array(y.ravel()),
                    "explained": pa.array(np.tile(space.explained, len(x))), "identity_error": pa.array(np.full(len(row), space.identity_error))})

    kind = dict(rows.dtypes)["vec_id"]
    return rows.where("dims > 0").mapInArrow(projected, f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
                                                        "explained double, identity_error double")
