import hashlib
import math
from dataclasses import replace
from itertools import pairwise, product

import numpy as np

from plantmetrics.llm.zone_clusters import (
    ClusterSettings,
    candidates,
    cluster_embeddings,
    cluster_sums,
    fit_clusters,
    hilbert_keys,
    integer_vectors,
    nearest,
    pack_blocks,
)
from plantmetrics.sources import stage

ROWS = "vec_id long, embedding array<float>, cluster string, distance int"
SMALL = ClusterSettings(dims=3, clusters=5, rounds=4, block=4)


def _table(spark, vectors):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in vectors], ROWS)


def _brute(rows, settings):
    """[(id, cluster, distance, inertia of the cluster, inertia, digest)] by comparing all with all."""
    kept = [(k, [math.floor(256 * float(np.float32(c))) for c in v]) for k, v in rows]
    kept = [(k, np.array([max(-(1 << 27), min(1 << 27, c)) for c in v])) for k, v in kept]
    first = sorted((hashlib.sha256(f"2:{k}".encode()).hexdigest(), tuple(v)) for k, v in kept if k is not None)
    centroids = np.array([v for _, v in first[: settings.clusters]])

    def assigned():
        far = [((centroids - v) ** 2).sum(axis=1) for _, v in kept]
        return [(int(f.argmin()), int(f.min())) for f in far]

    for _ in range(settings.rounds):
        own = [c for c, _ in assigned()]
        for c in set(own):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            centroids[c] = [int(s) // len(members) for s in np.sum(members, axis=0)]
    final = assigned()
    every = sum(d for _, d in final)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return [(k, c, d, sum(e for o, e in final if o == c), every, digest[c]) for (k, _), (c, d) in zip(kept, final, strict=True)]


def _key(row):
    return str(tuple(row))


def test_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(product(range(1 << bits), repeat=dims)))
        keys = hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert all(np.abs(a - b).sum() == 1 for a, b in pairwise(path))


def test_candidates_lose_no_nearest():
    rng = np.random.default_rng(3)
    for width in (0, 3, 40):
        for _ in range(200):
            centroids = rng.integers(-30, 30, (12, 3))
            x = rng.integers(-30, 30, 3) + rng.integers(-width, width + 1, (20, 3))
            some = candidates(x.min(axis=0), x.max(axis=0), centroids)
            own, far = nearest(x, centroids, some)
            distance = ((x[:, None] - centroids) ** 2).sum(axis=2)
            assert (own == distance.argmin(axis=1)).all() and (far == distance.min(axis=1)).all()
    large = np.array([[1 << 27, -(1 << 27)]])
    assert nearest(large, -large, np.array([0]))[1][0] == 2 * (1 << 28) ** 2


def test_equals_brute_force_with_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.normal(k % 4, 0.3, 3)]) for k in range(150)]
    rows += [(k, [0.5, 0.5, 0.5]) for k in range(200, 280)] + [(7, rows[7][1]), (7, [9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(500, [1e30, -1e30, 0.0])]
    odd = [(900, None), (901, []), (902, [1.0, None, 1.0]), (903, [float("nan")] * 3), (904, [1.0, 2.0]), (905, [float("-inf"), 0.0, 0.0])]
    got = cluster_embeddings(_table(spark, rows + odd).repartition(5), SMALL).collect()
    assert sorted(map(_key, got)) == sorted(map(_key, _brute(rows, SMALL)))
    one = cluster_embeddings(_table(spark, rows[:3]), SMALL).collect()
    assert sorted(map(_key, one)) == sorted(map(_key, _brute(rows[:3], SMALL)))
    twins = [(1, [1.0, 2.0, 3.0])] * 9
    assert {(r.cluster, r.distance) for r in cluster_embeddings(_table(spark, twins), SMALL).collect()} == {(0, 0)}
    for nothing in ([], odd, [(None, [1.0, 1.0, 1.0])]):
        assert cluster_embeddings(_table(spark, nothing), SMALL).count() == 0


def test_boxes_spare_comparisons_on_grouped_vectors(spark):
    rng = np.random.default_rng(8)
    middles = rng.normal(0, 4, (30, 16))
    rows = [(k, [float(c) for c in middles[k % 30] + rng.normal(0, 0.1, 16)]) for k in range(3000)]
    settings = ClusterSettings(dims=16, clusters=30, block=16)
    vectors = integer_vectors(_table(spark, rows), 16)
    _, centroids = fit_clusters(vectors, settings)
    blocks = stage(pack_blocks(vectors, settings), "blocks")
    made = cluster_sums(blocks, centroids, settings).groupBy().sum("n", "compared").first()
    assert made[0] == len(rows) and made[1] < 0.5 * len(rows) * len(centroids)
    assert cluster_embeddings(_table(spark, rows), replace(settings, block=1000)).count() == len(rows)
