"""k-means by drift bounds against plain whole-number k-means."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from fleetpulse.llm import centroid_drift as cd


def plain(rows, k, rounds, dimensions, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "null" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((name(i), v) for i, v in kept)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        own = [assign(v) for _, v in kept]
        for c in range(len(centroids)):
            members = [v for (_, v), a in zip(kept, own) if a == c]
            if members:
                centroids[c] = [math.floor(Fraction(sum(col), len(members))) for col in zip(*members)]
    own = [assign(v) for _, v in kept]
    dist = [far(v, centroids[a]) for (_, v), a in zip(kept, own)]
    sums = [sum(d for d, a in zip(dist, own) if a == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((str(i), a, d, sums[a], sum(dist), sha[a]) for (i, _), a, d in zip(kept, own, dist)))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, inertia int")


def found(rows):
    return sorted((str(r[0]), *tuple(r)[1:]) for r in rows.collect())


@pytest.mark.parametrize("k, rounds", [(5, 6), (1, 3), (40, 2), (3, 0)])
def test_equals_plain(spark, k, rounds):
    draw = np.random.default_rng(k)
    centres = draw.normal(size=(4, 6))
    rows = [(i, (centres[i % 4] + draw.normal(size=6) * 0.4).astype(np.float32).tolist()) for i in range(300)]
    got = cd.clustered(frame(spark, rows).repartition(3), k=k, rounds=rounds, dimensions=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found(got) == plain(rows, k, rounds, 6)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (1, [0.25, 1.0]), (None, [2.0, -3.0]), (None, [2.0, -3.0]), (2, None), (3, []), (4, [1.0]),
            (5, [1.0, None]), (6, [nan, 0.0]), (7, [0.0, -inf]), (8, [1.0, 2.0, 3.0]), (9, [0.0, 0.0]), (10, [-0.0001, 0.0]), (11, [4.0, 4.0])]
    for k in (2, 8, 12):
        assert found(cd.clustered(frame(spark, rows).repartition(4), k=k, rounds=4, dimensions=2)) == plain(rows, k, 4, 2)
    none = cd.clustered(frame(spark, rows).limit(0))
    assert none.count() == 0 and none.dtypes == cd.clustered(frame(spark, rows), k=2, rounds=1, dimensions=2).dtypes


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="a component is beyond"):
        cd.clustered(frame(spark, [(1, [2e8, 0.0])]), k=1, rounds=1, dimensions=2).count()


def test_losses_bound_every_point_and_are_below_full_drift():
    draw = np.random.default_rng(2)
    tightened = 0
    for _ in range(60):
        before = draw.integers(-2000, 2000, (5, 8))
        after = before + draw.integers(-300, 300, (5, 8)) * draw.integers(0, 2, (5, 1))
        reach = draw.uniform(1, 1500, 5)
        drift, loss = cd.losses(before, after, reach)
        for i in range(5):
            way = draw.normal(size=(400, 8))
            points = before[i] + way / np.linalg.norm(way, axis=1)[:, None] * reach[i] * draw.uniform(0, 1, (400, 1)) ** 0.1
            for j in range(5):
                if j != i:
                    nearer = np.linalg.norm(points - before[j], axis=1) - np.linalg.norm(points - after[j], axis=1)
                    assert nearer.max() <= loss[i] + 1e-6
            most = max(drift[j] for j in range(5) if j != i)
            assert loss[i] <= most * (1 + 1e-6)
            tightened += loss[i] < 0.9 * most
    assert tightened > 60


def test_geometry_measures_fewer_vectors_than_full_drift(spark, monkeypatch):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(6, 8)) * 2
    rows = [(i, (centres[i % 6] + draw.normal(size=8) * 0.6).astype(np.float32).tolist()) for i in range(1500)]
    vectors = frame(spark, rows).repartition(2).cache()
    tight, full = [], []
    first = found(cd.clustered(vectors, k=6, rounds=8, dimensions=8, watch=tight))

    def drift_alone(before, after, reach):
        drift = np.linalg.norm(after.astype(float) - before, axis=1) * (1 + cd.SLACK)
        return drift, np.asarray([max(d for j, d in enumerate(drift) if j != i) for i in range(len(drift))])

    monkeypatch.setattr(cd, "losses", drift_alone)
    assert found(cd.clustered(vectors, k=6, rounds=8, dimensions=8, watch=full)) == first
    assert tight[0] == len(rows) and sum(tight[1:]) < sum(full[1:]) < len(rows) * 7
