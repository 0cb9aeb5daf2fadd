"""Exact Lloyd clustering of integer vectors with geometric drift tightening.

Every vector keeps an upper bound on the distance to its own centroid and one
lower bound on the distance to all others.  After centroids have moved, the
upper bound grows by the drift of the own centroid.  The lower bound need not
fall by the largest drift: the vectors of a cluster lie in a sphere around its
old centroid, whose radius is the largest upper bound, and for such a sphere
the distance to another centroid can fall only by

    min(d, max(0, 2 s), d cos(max(0, phi - asin(r / D))))

where d is that centroid's drift, s how far the sphere reaches beyond the
plane half-way between its two places, D and phi the distance and the angle
to the drift at which the sphere's centre is seen from that half-way point:
points nearer to the new place lie on hyperbolas around it, inside the cone
of their asymptotes.  A vector whose upper bound stays under its lower bound
(or under half the way to the nearest other centroid) cannot have moved; any
other is measured, then scanned against all centroids in exact integers.

Every round is one pass that writes vectors with their bounds (a written
table ends the lineage) and one aggregate by cluster, pre-aggregated in each
task; the driver holds centroids and ``k`` rows of sums, nothing else.

Edge cases: vectors that are null, of another dimension, or with null or
non-finite entries are left out; null ids come last among the seeds and keep
their rows; repeated rows count each, ties in the seeds' hash go by vector;
fewer vectors than ``k`` give as many centroids, an empty table an empty
result; equal centroids leave the higher number empty, and it stays where it
is.  A component of ``LIMIT`` or more after scaling would not leave squared
distances in 63 bits: such a vector raises an error.  Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import quoted, stored

LIMIT = 2**27
STEP = 4096
STATE = "cluster int, upper double, lower double, distance long, scanned boolean"


class Clusters(NamedTuple):
    """``rows``: id, v, cluster, distance; per round, vectors scanned whole."""

    rows: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def finite(vector: Column) -> Column:
    """Whether a vector has neither null nor non-finite entries."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def whole_vectors(df: DataFrame, id: str, vector: str, dimension: int, scale: int) -> DataFrame:
    """(id, v): usable vectors, each component as floor(scale * x)."""
    own = F.col(quoted(vector)).cast("array<double>")
    too_large = F.exists(own, lambda x: F.abs(x * scale) >= LIMIT)
    v = F.transform(own, lambda x: F.floor(x * scale).cast("int"))
    v = F.when(too_large, F.raise_error(F.lit(f"a component is {LIMIT} or more after scaling"))).otherwise(v)
    return df.where(F.size(own) == dimension).where(finite(own)).select(F.col(quoted(id)).alias("id"), v.alias("v"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:  # whole numbers that doubles hold, in any order of summing
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([own(x, y) for y in c], axis=1)


def own(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    return ((x - c) ** 2).sum(1)


#: Bounds are rounded outwards by this part of themselves, far above what doubles lose.
SLACK = 1e-9


def up(x):
    return x * (1 + SLACK) + SLACK


def down(x):
    return x - SLACK * (1 + np.minimum(np.abs(x), 1e300))


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """By how much, at most, the distance to a centroid that moves from ``old``
    to ``new`` falls for vectors within ``radius`` of ``centre``."""
    move = new - old
    drift = float(np.sqrt(move @ move))
    if not drift:
        return 0.0
    seen = centre - (old + new) / 2
    along, away = float(seen @ move) / drift, float(np.sqrt(seen @ seen))
    slab = max(0.0, 2 * (along + radius))
    if radius >= away:
        return up(min(drift, slab))
    angle = np.arccos(np.clip(along / away, -1, 1)) - np.arcsin(radius / away)
    return up(min(drift, slab, max(0.0, drift * np.cos(max(0.0, angle)))))


def loosenings(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, the most that the distance to any other centroid falls."""
    old, new = old.astype(float), new.astype(float)
    k = len(old)
    moved = [j for j in range(k) if (old[j] != new[j]).any()]
    return np.array([max((loosening(old[i], radius[i], old[j], new[j]) for j in moved if j != i), default=0.0) for i in range(k)])


class Round(NamedTuple):
    """What a pass needs besides the vectors, all of the size of ``k`` centroids."""

    centroids: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray
    half: np.ndarray


def next_round(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Round:
    apart = np.sqrt(squared(new, new).astype(float))
    np.fill_diagonal(apart, np.inf)
    drift = up(np.sqrt(((new - old).astype(float) ** 2).sum(1)))
    return Round(new, drift, loosenings(old, new, radius), down(apart.min(1, initial=np.inf) / 2))


def assign(x: np.ndarray, r: Round, cluster=None, upper=None, lower=None):
    """Cluster, upper, lower, exact distance where measured (else -1) and
    whether scanned, for rows ``x`` with the bounds they had before."""
    n = len(x)
    distance, scanned = np.full(n, -1), np.ones(n, dtype=bool)
    if cluster is None:
        cluster, upper, lower = np.zeros(n, dtype=np.int32), np.zeros(n), np.zeros(n)
    else:
        cluster, upper, lower = cluster.copy(), up(upper + r.drift[cluster]), down(lower - r.loosen[cluster])
        bar = np.maximum(lower, r.half[cluster])
        near = np.flatnonzero(upper >= bar)
        distance[near] = own(x[near], r.centroids[cluster[near]])
        upper[near] = up(np.sqrt(distance[near]))
        scanned = upper >= bar
    todo = np.flatnonzero(scanned)
    for at in range(0, len(todo), STEP):
        rows = todo[at : at + STEP]
        d = squared(x[rows], r.centroids)
        cluster[rows] = d.argmin(1)
        distance[rows] = d.min(1)
        upper[rows] = up(np.sqrt(distance[rows]))
        d[np.arange(len(rows)), cluster[rows]] = np.iinfo(np.int64).max
        lower[rows] = down(np.sqrt(d.min(1))) if d.shape[1] > 1 else np.inf
    return cluster, upper, lower, distance, scanned


def one_pass(rows: DataFrame, r: Round, first: bool, measure: bool) -> DataFrame:
    """``rows`` with their clusters and bounds for the centroids of ``r``."""
    spec = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema if f.name in ("id", "v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            x = v.flatten().to_numpy().astype(np.int64).reshape(len(v), -1)
            old = () if first else (batch.column(c).to_numpy() for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, distance, scanned = assign(x, r, *old)
            if measure:
                left = np.flatnonzero(distance < 0)
                distance[left] = own(x[left], r.centroids[cluster[left]])
            made = [pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(distance), pa.array(scanned)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), v, *made], names=["id", "v", "cluster", "upper", "lower", "distance", "scanned"])

    return rows.mapInArrow(work, f"{spec}, {STATE}")


def fit(df: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, scale: int = 256, dimension: int = 64, id: str = "vec_id", vector: str = "embedding") -> Clusters:
    """Lloyd's rounds from the ``k`` vectors of least seeded hash; the last
    pass assigns once more, and measures every vector."""
    rows = whole_vectors(df, id, vector, dimension, scale)
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    seeds = rows.orderBy(by_hash, "v").limit(k).collect()
    centroids = np.array([s.v for s in seeds], dtype=np.int64).reshape(-1, dimension)
    r = Round(centroids, *[np.zeros(len(centroids))] * 3)
    scanned = []
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dimension)]
    for step in range(rounds + 1):
        rows = stored(one_pass(rows, r, step == 0, step == rounds), "drift_clusters")
        if step == rounds:
            scanned.append(rows.where("scanned").count())
            break
        found = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius"), F.count_if("scanned").alias("scanned"), *sums).collect()
        new, radius = r.centroids.copy(), np.zeros(len(centroids))
        for g in found:
            new[g.cluster] = [g[f"s{i}"] // g.n for i in range(dimension)]
            radius[g.cluster] = g.radius
        scanned.append(sum(g.scanned for g in found))
        r = next_round(r.centroids, new, radius)
    return Clusters(rows.select("id", "v", "cluster", "distance"), r.centroids, scanned)


def with_inertia(found: Clusters) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    per = {g.cluster: g.total for g in found.rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    named = [
        (c, total, sum(per.values()), hashlib.sha256(",".join(map(str, found.centroids[c])).encode()).hexdigest())
        for c, total in per.items()
    ]
    of = found.rows.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.drop("v").join(F.broadcast(of), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
