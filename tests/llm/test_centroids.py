"""Dimension-sharded clustering against plain integer arithmetic."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from assetops.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, ids binary"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, 2, b"") for i, v in rows], schema)


def usable(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def single(x):
    return float(np.float32(x))


def brute(rows, dims, k, rounds, scale, seed=2, cast=single):
    """(vec_id, cluster, distance, cluster inertia, inertia, centroid hash), Python integers only."""
    kept = [(i, [math.floor(Fraction(cast(x)) * scale) for x in v]) for i, v in rows if usable(v, dims)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centers)):
            own = [v for (_, v), (label, _) in zip(kept, found) if label == c]
            if own:
                centers[c] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    per = {c: sum(d for label, d in found if label == c) for c in range(len(centers))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]

    def long(x):
        return x if x < 1 << 63 else None

    return sorted(
        (str(i), c, str(long(d)), str(long(per[c])), str(long(sum(per.values()))), digests[c]) for (i, _), (c, d) in zip(kept, found)
    )


def got(df, **parameters):
    return sorted((str(r[0]), r[1], *map(str, r[2:5]), r[5]) for r in centroids.digest(df, **parameters).collect())


def vectors(n, dims, seed=1):
    draw = random.Random(seed)
    centers = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [x + draw.gauss(0, 0.3) for x in draw.choice(centers)]) for i in range(n)]


ODD = [(900, None), (901, []), (902, [1.0] * 9), (903, [1.0, None] + [0.0] * 6), (904, [math.nan] + [0.0] * 7)]
ODD += [(905, [math.inf] * 8), (906, [-math.inf] + [0.0] * 7), (907, [0.0] * 8), (907, [0.0] * 8), (908, [0.0] * 8)]
ODD += [(None, [0.5] * 8), (None, [0.5] * 8), (-3, [-0.001] * 8)]


@pytest.mark.parametrize("width", [3, 8])
@pytest.mark.parametrize("k", [1, 7])
def test_like_brute_force(spark, k, width):
    rows = vectors(300, 8) + ODD
    p = dict(dims=8, k=k, rounds=3, scale=16)
    assert got(frame(spark, rows).repartition(5), width=width, **p) == brute(rows, **p)


def test_ties_and_empty_clusters(spark):
    rows = [(i, [float(i % 2)] * 4) for i in range(40)] + [(100, [0.5] * 4)] * 3
    p = dict(dims=4, k=12, rounds=2, scale=2)
    assert got(frame(spark, rows), width=2, **p) == brute(rows, **p)


def test_fewer_vectors_than_centroids(spark):
    rows = vectors(5, 4)
    p = dict(dims=4, k=40, rounds=2, scale=256)
    assert got(frame(spark, rows), **p) == brute(rows, **p)
    assert got(frame(spark, [])) == [] and got(frame(spark, ODD[:7]), dims=8) == []


def test_values_beyond_a_double_and_a_long(spark):
    """2^30 and 1e30 keep exact sums; a distance that no long holds is NULL."""
    wide = "vec_id bigint, embedding array<double>, label int, cluster int, ids binary"
    for size in (1e9, 1e12, 1e30):
        rows = [(i, [x * size for x in v]) for i, v in vectors(60, 4)]
        p = dict(dims=4, k=3, rounds=2, scale=256)
        assert got(frame(spark, rows, wide), width=2, **p) == brute(rows, cast=float, **p)


def test_a_chunk_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(centroids, "CHUNK", 16)
    rows = vectors(200, 8)
    p = dict(dims=8, k=4, rounds=2, scale=64)
    assert got(frame(spark, rows).coalesce(1), width=4, **p) == brute(rows, **p)
