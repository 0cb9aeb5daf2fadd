"""Whitening of embeddings through a bidiagonal qd solver.

Blockwise QR: every task stacks its centred rows on the triangle it has and
keeps the triangle of both, so a task sends one d x d triangle; triangles are
merged the same way in groups, in as many levels as it takes until few are
left.  The covariance is never formed, so its small eigenvalues keep the
accuracy of singular values.  On the last triangle (d x d, whatever the
number of rows) Householder reflections from both sides make it bidiagonal,
differential qd with shifts (dqds) finds the squared singular values, and
twisted factorisations of the bidiagonal's Gram matrix give their vectors; of
eigenvalues too close for these to be orthogonal, the common subspace is
found by inverse iteration.  The reflections take the vectors back.

Rows are centred before anything is multiplied: entries are whole numbers, so
sums and ``n x - S`` are exact.  The covariance of the whitened rows, for the
error reported, merges counts, means and centred scatters of blocks.

Edge cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped; so are those of another dimension than ``dimension``
(by default the most frequent one, the larger of equally frequent ones).
Null ids keep their rows, repeated rows count each.  Directions without
variance (fewer rows than dimensions, constant or dependent entries) are not
whitened: fewer components come back, for one row none.  An empty table gives
an empty result.  A deviation over 63 bits is null.  An entry of ``LIMIT`` or
more after scaling raises an error.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import quoted, stored
from .drift_clusters import finite

LIMIT = 2**45
EPS = np.finfo(float).eps
BLOCK = 2048
#: Partial results that are merged together.
FAN = 64
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


class Fit(NamedTuple):
    n: int
    sums: list[int]
    #: Eigenvalues of the covariance, falling, and their unit vectors in rows.
    values: np.ndarray
    directions: np.ndarray
    trace: float


# --- the solver: a d x d triangle, on the driver -----------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and the product P of the reflections from
    the right: r = U B P' for the upper bidiagonal B of a and b."""
    m = r.copy()
    d = len(m)
    p = np.eye(d)

    def reflect(x: np.ndarray) -> np.ndarray | None:
        size = np.sqrt(x @ x)
        if not size:
            return None
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        return v / np.sqrt(v @ v)

    for k in range(d):
        v = reflect(m[k:, k])
        if v is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2:
            v = reflect(m[k, k + 1 :])
            if v is not None:
                m[:, k + 1 :] -= 2 * np.outer(m[:, k + 1 :] @ v, v)
                p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One dqds transform: new q, e, the last d, and whether an earlier d was negative."""
    new_q, new_e, early = [], [], False
    d = q[0] - shift
    for i in range(len(e)):
        early = early or d < 0
        x = d + e[i]
        ratio = q[i + 1] / x if x else np.inf
        new_q.append(x)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        if not np.isfinite(d):
            return q, e, d, True
    return [*new_q, d], new_e, d, early


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal (a, b), falling."""
    found = []
    blocks = [([float(x) for x in a * a], [float(x) for x in b * b], 0.0)]
    while blocks:
        q, e, base = blocks.pop()
        while q:
            if q[-1] > 1.5 * q[0] and len(q) > 1:  # small ones belong at the end: the same values, read backwards
                q, e = q[::-1], e[::-1]
            split = next((i for i in reversed(range(len(e))) if e[i] <= EPS**2 * (base + min(q[i], q[i + 1]))), None)
            if split is not None and split < len(e) - 1:
                blocks.append((q[split + 1 :], e[split + 1 :], base))
                q, e = q[: split + 1], e[:split]
                continue
            if not e or split is not None:
                found.append(base + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            # The lower eigenvalue of the last two rows is above the least one, and near it in the end.
            top, off = q[-2] + e[-1], q[-1] * e[-1]
            half = (top - q[-1]) / 2
            shift = max(0.0, q[-1] - off / (half + np.copysign(np.sqrt(half * half + off), half))) if off else q[-1]
            for attempt in range(4):
                shift = 0.0 if attempt == 3 else shift * (1 - 4 * EPS)
                new_q, new_e, last, early = qd_step(q, e, shift)
                if not early and last >= 0:
                    break
                shift = max(0.0, shift + last) if not early else shift / 4  # a late failure bounds the least from below
            q, e, base = new_q, new_e, base + shift
    return np.sort(np.array(found))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[float, np.ndarray]:
    """An eigenvalue of B'B near ``value`` and its unit vector, from the
    twisted factorisation at the place of least residual."""
    n, tiny = len(a), EPS * EPS
    d, low = a * a, b / a[:-1]
    for _ in range(3):
        s, p = np.empty(n), np.empty(n)
        lower, upper = np.empty(n - 1), np.empty(n - 1)
        s[0] = -value
        for i in range(n - 1):
            pivot = s[i] + d[i] or tiny
            lower[i] = d[i] * low[i] / pivot
            s[i + 1] = lower[i] * low[i] * s[i] - value
        p[n - 1] = d[n - 1] - value
        for i in reversed(range(n - 1)):
            pivot = d[i] * low[i] ** 2 + p[i + 1] or tiny
            ratio = d[i] / pivot
            upper[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        gamma = s + p + value
        k = int(np.abs(gamma).argmin())
        z = np.zeros(n)
        z[k] = 1.0
        for i in reversed(range(k)):
            z[i] = -lower[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -upper[i] * z[i]
        size = z @ z
        step = gamma[k] / size
        z /= np.sqrt(size)
        if abs(step) <= 2 * EPS * value or abs(step) > 1e-8 * value:  # done, or led away by a close neighbour
            break
        value += step
    return value, z


def close(values: np.ndarray, gap: float = 1e-6) -> list[range]:
    """Runs of falling values nearer to the next than ``gap`` of themselves."""
    cut = [i for i in range(1, len(values)) if values[i - 1] - values[i] > gap * values[i - 1]]
    return [range(x, y) for x, y in zip([0, *cut], [*cut, len(values)])]


def subspace(gram: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal rows spanning the eigenvectors of close ``values``, by
    inverse iteration from so far off that it enlarges all of them alike."""
    off = max(values[0] - values[-1], 64 * EPS * np.abs(gram).max())
    shifted = gram - (values[0] + off) * np.eye(len(gram))
    z = np.random.default_rng(len(values)).normal(size=(len(gram), len(values)))
    for _ in range(10):
        z = np.linalg.qr(np.linalg.solve(shifted, z))[0]
    return z.T


def solve(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a triangle, falling, without those that
    rounding alone makes, and their right vectors in rows."""
    scale = float(np.abs(triangle).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((0, len(triangle)))
    a, b, p = bidiagonal(triangle / scale)
    norm = max(np.abs(a).max(), np.abs(b).max(initial=0))
    a = np.where(np.abs(a) < EPS * norm, EPS * norm, a)
    values = dqds(a, b)
    values = values[values > (len(a) * 8 * EPS) ** 2 * values[0]]
    vectors = np.empty((len(values), len(a)))
    for run in close(values):
        for i in run:
            values[i], vectors[i] = twisted(a, b, float(values[i]))
        if len(run) > 1 and np.abs(vectors[run] @ vectors[run].T - np.eye(len(run))).max() > 1e-9:
            gram = np.diag(a * a + np.append(0, b * b)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
            vectors[run] = subspace(gram, values[run])
    vectors = vectors @ p.T
    vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])[:, None]
    return values * scale**2, vectors / np.sqrt((vectors**2).sum(1))[:, None]


# --- over the rows -----------------------------------------------------------


def whole_vectors(df: DataFrame, id: str, vector: str, scale: int, offset: int, dimension: int | None) -> DataFrame:
    """(id, x): usable vectors of one dimension, entries as floor(scale * c) + offset."""
    own = F.col(quoted(vector)).cast("array<double>")
    too_large = F.exists(own, lambda c: F.abs(c * scale) >= LIMIT)
    x = F.transform(own, lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    x = F.when(too_large, F.raise_error(F.lit(f"an entry is {LIMIT} or more after scaling"))).otherwise(x)
    usable = df.where(finite(own))
    if dimension is None:
        sizes = usable.groupBy(F.size(own).alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d"))
        dimension = (sizes.first() or [0])[0]
    return usable.where(F.size(own) == (dimension or -1)).select(F.col(quoted(id)).alias("id"), x.alias("x"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(len(part), -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, whole parts first."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.float64) / n
    return (x - whole) - rest


def folded(rows: DataFrame, one: Callable, merge: Callable, name: str) -> np.ndarray | None:
    """``one`` makes an array of each task's blocks, ``merge`` one array of
    several: in groups on the executors until few are left, then here."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for _, x in blocks(batches):
            state = one(x) if state is None else merge([state, one(x)])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([state.tobytes()], pa.binary())], names=["part", "state"])

    def group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        state = merge([np.frombuffer(s).reshape(shape) for s in part["state"]])
        return pd.DataFrame({"part": [part["part"].iloc[0]], "state": [state.tobytes()]})

    d = len(rows.first().x)
    shape = (-1, d)
    kinds = "part long, state binary"
    parts = stored(rows.mapInArrow(task, kinds), name)
    while (count := parts.count()) > FAN:
        level = F.pmod(F.xxhash64("part"), F.lit(-(-count // FAN) * 2))
        parts = stored(parts.groupBy(level).applyInPandas(group, kinds), name)
    states = [np.frombuffer(r.state).reshape(shape) for r in parts.orderBy("part").collect()]
    return merge(states)


def triangle(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def merged_scatter(parts: list[np.ndarray]) -> np.ndarray:
    """Rows: count (repeated), mean, then the centred scatter of all parts."""
    n = sum(p[0, 0] for p in parts)
    mean = sum(p[0, 0] * p[1] for p in parts) / n
    scatter = sum(p[2:] + p[0, 0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)
    return np.concatenate([np.full((1, len(mean)), n), mean[None], scatter])


def scatter_of(y: np.ndarray) -> np.ndarray:
    mean = y.mean(0)
    return np.concatenate([np.full((1, len(mean)), float(len(y))), mean[None], (y - mean).T @ (y - mean)])


def fit(rows: DataFrame) -> Fit | None:
    """The covariance's eigenvalues and directions; None without rows."""
    head = rows.first()
    if head is None:
        return None
    d = len(head.x)
    n, *sums = rows.agg(F.count("*"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(d)]).first()
    sums = [int(s) for s in sums]
    r = folded(rows, lambda x: triangle([centred(x, n, sums)]), triangle, "whitening_qr")
    square = np.zeros((d, d))
    square[: len(r)] = r
    values, directions = solve(square)
    return Fit(n, sums, values / n, directions, float((square**2).sum() / n))


def whiten(df: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, dimension: int | None = None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error)."""
    rows = whole_vectors(df, id, vector, scale, offset, dimension)
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(OUT).fields])
    model = fit(rows)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    n, sums = model.n, model.sums
    c = min(components, len(model.values))
    onto = (model.directions[:c] / np.sqrt(model.values[:c])[:, None]).T
    explained = model.values[:c] / model.trace
    error = identity_error(rows, n, sums, onto)
    exact = np.array(sums, dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks(batches):
            y = centred(x, n, sums)
            if float(np.abs(y).max()) ** 2 * n * n * y.shape[1] < 2**62:
                deviation = ((n * x - exact.astype(np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [s if s < 2**63 else None for s in ((n * x.astype(object) - exact) ** 2).sum(1)]
            k = len(x)
            row = np.repeat(np.arange(k), c)
            columns = [
                ids.take(pa.array(row)),
                pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), k)),
                pa.array(np.full(k * c, n)),
                pa.array(deviation, pa.int64()).take(pa.array(row)),
                pa.array((y @ onto).ravel()),
                pa.array(np.tile(explained, k)),
                pa.array(np.full(k * c, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(work, schema)


def identity_error(rows: DataFrame, n: int, sums: list[int], onto: np.ndarray) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    c, d = onto.shape[1], onto.shape[0]

    def one(x: np.ndarray) -> np.ndarray:
        state = np.zeros((c + 2, d))
        state[:, :c] = scatter_of(centred(x, n, sums) @ onto)
        return state

    def merge(parts: list[np.ndarray]) -> np.ndarray:
        state = np.zeros((c + 2, d))
        state[:, :c] = merged_scatter([p[:, :c] for p in parts])
        return state

    found = folded(rows, one, merge, "whitening_check")[:, :c]
    return float(np.abs(found[2:] / found[0, 0] - np.eye(c)).max())
