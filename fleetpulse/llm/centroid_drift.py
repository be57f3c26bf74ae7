"""Exact k-means whose bounds are loosened by geometry, not by full drift.

Every vector carries an upper bound on the distance to its centroid and a lower
bound on the distance to all others. When centroids move, a lower bound of the
vectors of cluster i must fall by no more than any of them can have come nearer
to another centroid. They lie in the sphere around the old centroid i whose
radius is the largest upper bound. In the plane through i and the segment on
which j moved, a point seen from the segment's middle under angle w to the
direction of movement comes nearer by at most drift * cos w, so the sphere's
smallest angle bounds the loss: full drift only if the sphere holds the middle,
nothing if it lies behind it. A vector whose upper bound stays below its lower
bound, or below half the way to the nearest other centroid, keeps its cluster;
any other is measured, first against its own centroid, then against all.

Vectors travel in blocks of bytes. A round is one pass without a shuffle, kept
on executors' disks until the next one has run; a lost executor's blocks are
made again from the packed vectors, which are written once. Per round k * (d +
1) sums meet on the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, map_batches, sha256_hex
from fleetpulse.sinks.tables import materialize

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
LARGEST = 1 << 27  # of a scaled component: squared distances of 64 of them stay whole in 64 bits
SLACK = 1e-9  # of every bound, far above the rounding of doubles

_STATE = [("ids", pa.list_(pa.int64())), ("data", pa.binary()), ("cluster", pa.binary()), ("upper", pa.binary()),
          ("lower", pa.binary()), ("totals", pa.list_(pa.int64()))]
_STATE_SCHEMA = "ids array<bigint>, data binary, cluster binary, upper binary, lower binary, totals array<bigint>"


def packed(vectors: DataFrame, dimensions: int = DIMENSIONS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Blocks (ids, data) of the vectors that have all their components, each finite, as floors of scaled whole numbers."""
    types = pa.schema(_STATE[:2])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists, ids = batch.column(column), batch.column(key)
            whole = np.asarray([v is not None and v == dimensions for v in lists.value_lengths().to_pylist()], bool)
            flat = lists.filter(pa.array(whole)).flatten()
            missing = np.asarray(flat.is_null().to_numpy(zero_copy_only=False)).reshape(-1, dimensions)
            values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            good = np.isfinite(values).all(axis=1) & ~missing.any(axis=1)
            scaled = np.floor(values[good] * SCALE)
            if scaled.size and np.abs(scaled).max() >= LARGEST:
                raise ValueError(f"a component is beyond {LARGEST // SCALE}")
            chosen = ids.filter(pa.array(whole)).filter(pa.array(good))
            if len(chosen):
                data = np.ascontiguousarray(scaled.astype("<i4")).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([chosen.to_pylist()], types[0].type), pa.array([data])], schema=types)

    rows = vectors.select(F.col(key).cast("bigint").alias(key), F.col(column).cast("array<double>").alias(column))
    return materialize(map_batches(rows, run, "ids array<bigint>, data binary"), "vectors")


def _blocks(batches: Batches):
    """Every block of the batches: its row, and its vectors as a matrix."""
    for batch in batches:
        for row in batch.to_pylist():
            yield row, np.frombuffer(row["data"], "<i4").reshape(len(row["ids"]), -1)


def seeds(blocks: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors whose ``seed:id`` has the smallest digests, in that order.

    A vector without an id comes last; of vectors with one id the smaller
    components come first.
    """
    types = pa.schema([("digest", pa.string()), ("vector", pa.list_(pa.int64()))])

    def first(batches: Batches) -> Batches:
        for row, vectors in _blocks(batches):
            named = ["null" if i is None else sha256_hex(f"{seed}:{i}") for i in row["ids"]]
            best = sorted(zip(named, vectors.tolist()))[:k]
            yield pa.RecordBatch.from_pydict({"digest": [d for d, _ in best], "vector": [v for _, v in best]}, schema=types)

    found = map_batches(blocks, first, "digest string, vector array<bigint>").orderBy("digest", "vector").limit(k).collect()
    return np.asarray([row.vector for row in found], np.int64)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances to one centroid, or of each vector to its own row."""
    apart = vectors.astype(np.int64) - centroid
    return np.einsum("ij,ij->i", apart, apart)


def scanned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals), upper and lower bound from exact distances to all."""
    distances = np.stack([squared(vectors, c) for c in centroids], axis=1)
    nearest = distances.argmin(axis=1)
    upper = np.sqrt(distances[np.arange(len(vectors)), nearest])
    distances[np.arange(len(vectors)), nearest] = np.iinfo(np.int64).max
    lower = np.sqrt(distances.min(axis=1)) if len(centroids) > 1 else np.full(len(vectors), np.inf)
    return nearest.astype("<i4"), upper * (1 + SLACK), lower * (1 - SLACK)


def losses(before: np.ndarray, after: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drift of every centroid, and for every cluster how much nearer its vectors can have come to any other one.

    ``reach`` is the radius of each cluster's sphere around ``before``.
    """
    old, new = before.astype(np.float64), after.astype(np.float64)
    drift = np.linalg.norm(new - old, axis=1)
    loss = np.zeros(len(old))
    for j in np.flatnonzero(drift):
        middle, along = (old[j] + new[j]) / 2, (new[j] - old[j]) / drift[j]
        away = old - middle
        far = np.linalg.norm(away, axis=1)
        safe = np.where(far > 0, far, 1)
        angle = np.arccos(np.clip(away @ along / safe, -1, 1))
        width = np.arcsin(np.clip(reach / safe, 0, 1))
        nearer = np.where(far <= reach, 1.0, np.clip(np.cos(np.clip(angle - width, 0, np.pi)), 0, 1))
        nearer[j] = 0
        loss = np.maximum(loss, drift[j] * np.minimum(1, nearer + SLACK) * (np.arange(len(old)) != j))
    return drift * (1 + SLACK), loss * (1 + SLACK)


@dataclass(frozen=True)
class Move:
    """What a pass must know of the centroids' last move."""

    centroids: np.ndarray
    drift: np.ndarray
    loss: np.ndarray
    half: np.ndarray

    @classmethod
    def of(cls, before: np.ndarray, after: np.ndarray, reach: np.ndarray) -> Move:
        drift, loss = losses(before, after, reach)
        places = after.astype(np.float64)
        apart = np.linalg.norm(places[:, None] - places[None], axis=2)
        np.fill_diagonal(apart, np.inf)
        return cls(after, drift, loss, apart.min(axis=1) / 2 * (1 - SLACK))

    def apply(
        self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """New clusters and bounds, and how many vectors were measured against all centroids."""
        upper = (upper + self.drift[cluster]) * (1 + SLACK)
        lower = lower * (1 - SLACK) - self.loss[cluster]
        bound = np.maximum(lower, self.half[cluster])
        near = np.flatnonzero(~(upper < bound))
        if len(near):
            upper[near] = np.sqrt(squared(vectors[near], self.centroids[cluster[near]])) * (1 + SLACK)
        doubtful = near[~(upper[near] < bound[near])]
        if len(doubtful):
            cluster = cluster.copy()
            cluster[doubtful], upper[doubtful], lower[doubtful] = scanned(vectors[doubtful], self.centroids)
        return cluster, upper, lower, len(doubtful)


def _totals(vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, k: int, measured: int) -> list[int]:
    """Per cluster the count and component sums, then per cluster the sphere's radius rounded up, then the vectors measured."""
    out, reach = [], []
    for c in range(k):
        own = cluster == c
        out += [int(own.sum()), *vectors[own].sum(axis=0, dtype=np.int64).tolist()]
        reach.append(int(np.ceil(upper[own].max())) + 1 if own.any() else 0)
    return out + reach + [measured]


def _pass(state: DataFrame, centroids: np.ndarray, move: Move | None) -> DataFrame:
    """One assignment of all vectors; without a move all are measured against all centroids."""
    types, k = pa.schema(_STATE), len(centroids)

    def run(batches: Batches) -> Batches:
        for row, vectors in _blocks(batches):
            if move is None:
                cluster, upper, lower = scanned(vectors, centroids)
                measured = len(vectors)
            else:
                bounds = [np.frombuffer(row[n], kind) for n, kind in (("cluster", "<i4"), ("upper", "<f8"), ("lower", "<f8"))]
                cluster, upper, lower, measured = move.apply(vectors, *bounds)
            out = row | {"cluster": cluster.tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes()}
            out["totals"] = _totals(vectors, cluster, upper, k, measured)
            yield pa.RecordBatch.from_pylist([out], schema=types)

    return map_batches(state, run, _STATE_SCHEMA)


def _summed(state: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts and sums by cluster, radii, and vectors measured: one row a number."""
    rows = state.select(F.posexplode("totals").alias("place", "value")).groupBy("place")
    found = {r.place: r for r in rows.agg(F.sum("value").alias("total"), F.max("value").alias("most")).collect()}
    width = dimensions + 1
    sums = np.asarray([[found[c * width + d].total for d in range(width)] for c in range(k)], object)
    reach = np.asarray([found[k * width + c].most for c in range(k)], np.float64)
    return sums, reach, found[k * width + k].total


def _moved(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean; a centroid without vectors stays."""
    return np.asarray([[s // own[0] for s in own[1:]] if own[0] else old for old, own in zip(centroids.tolist(), sums)], np.int64)


def clustered(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
    key: str = "vec_id",
    column: str = "embedding",
    watch: list[int] | None = None,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components, a null or a non-finite one stay
    out. Null and repeated ids keep their rows; equal vectors are in one
    cluster; with fewer than ``k`` vectors there are as many centroids. Empty
    tables give no rows. Components of 131,072 and more raise an error. Other
    columns are not read. ``watch`` receives, for each round, how many vectors
    were measured against all centroids.
    """
    blocks = packed(vectors, dimensions, key, column)
    centroids = seeds(blocks, k, seed)
    if not len(centroids):
        return blocks.sparkSession.createDataFrame(
            [], f"{key} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        )
    state = _pass(blocks, centroids, None).persist(StorageLevel.DISK_ONLY)
    for number in range(rounds):
        sums, reach, measured = _summed(state, len(centroids), dimensions)
        if watch is not None:
            watch.append(measured)
        after = _moved(centroids, sums)
        following = _pass(state, after, Move.of(centroids, after, reach))
        centroids = after
        if number + 1 < rounds:
            following = following.persist(StorageLevel.DISK_ONLY)
            following.count()
            state.unpersist()
        else:
            last = state
        state = following
    rows = materialize(_rows(state, centroids, key), "clusters")
    if rounds:
        last.unpersist()
    state.unpersist()
    inertia = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = F.element_at(F.array(*[F.lit(inertia.get(c, 0)).cast("bigint") for c in range(len(centroids))]), F.col("cluster") + 1)
    return rows.select(
        key,
        "cluster",
        "distance",
        per_cluster.alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256"),
    )


def _rows(state: DataFrame, centroids: np.ndarray, key: str) -> DataFrame:
    """The blocks' vectors as rows, with the exact squared distance to their centroids."""
    types = pa.schema([(key, pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Batches) -> Batches:
        for row, vectors in _blocks(batches):
            cluster = np.frombuffer(row["cluster"], "<i4")
            distance = squared(vectors, centroids[cluster])
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cluster), pa.array(distance)], schema=types)

    return map_batches(state.select("ids", "data", "cluster"), run, f"{key} bigint, cluster int, distance bigint")
