"""Clustering against a plain assignment to the nearest of all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, settings):
    """(cluster, distance) of each (id, integers), and the centroids."""

    def rank(item):
        key, own = item
        digest = None if key is None else hashlib.sha256(f"{settings.seed}:{key}".encode()).hexdigest()
        return (digest is None, digest, own)

    centroids = [own for _, own in sorted(vectors, key=rank)[: settings.k]]

    def placed():
        found = []
        for _, own in vectors:
            gaps = [sum((a - b) ** 2 for a, b in zip(own, c)) for c in centroids]
            found.append((gaps.index(min(gaps)), min(gaps)))
        return found

    for _ in range(settings.rounds):
        found = placed()
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(vectors, found) if c == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    return placed(), centroids


def rows_of(spark, rows, dims, **settings):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("old") for n in ("Cluster", "whole_vector")})
    return cc.cluster_vectors(table.repartition(3), settings=cc.Settings(dims=dims, **settings))


@pytest.mark.parametrize("k, dims, spread", [(16, 64, 0.3), (5, 3, 1.0), (40, 2, 0.05), (7, 1, 2.0)])
def test_equals_the_plain_way(spark, k, dims, spread):
    shuffled = random.Random(k)
    rows = [(i, [shuffled.gauss(0, spread) for _ in range(dims)], 0) for i in range(300)]
    rows += [rows[0]] * 120  # a third of all rows are one vector
    rows += [(None, [0.5] * dims, 1), (500, [-1.5] * dims, None), (500, [-1.5] * dims, None)]
    result = rows_of(spark, rows, dims, k=k)
    floats = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows]
    found, centroids = plain(floats, cc.Settings(k=k, dims=dims))
    expected = sorted(str((i, *f)) for (i, _), f in zip(floats, found))
    got = result.collect()
    assert sorted(str((r["vec_id"], r["cluster"], r["distance"])) for r in got) == expected
    inertia = sum(d for _, d in found)
    for r in got:
        assert r["inertia"] == inertia and r["centroid"] == centroids[r["cluster"]]
        assert r["cluster_inertia"] == sum(d for c, d in found if c == r["cluster"])
    assert result.columns == ["vec_id", "embedding", "label", "whole_vector", *cc.NEW]


def test_orchard_finds_what_all_comparisons_find():
    shuffled = np.random.default_rng(4)
    for k, dims, high in ((1, 4, 9), (16, 64, 30), (60, 2, 4), (200, 8, 50)):
        centroids = shuffled.integers(-high, high, (k, dims))
        vectors = shuffled.integers(-high, high, (500, dims))
        gaps = np.square(vectors[:, None] - centroids[None]).sum(axis=2)
        orchard = cc.Orchard(centroids)
        best, distance = orchard.nearest(vectors)
        assert (best == gaps.argmin(axis=1)).all()  # of equal ones the first
        assert (distance == gaps.min(axis=1)).all()
    # close vectors are found without comparing all
    spread = shuffled.integers(-1000, 1000, (400, 2))
    orchard = cc.Orchard(spread)
    orchard.nearest(spread + 1)
    assert orchard.compared < 0.25 * 400 * 400


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (2, None, 0), (3, [], 0), (4, [1.0], 0), (5, [1.0, None], 0), (6, [1.0, nan], 0),
            (7, [inf, 1.0], 0), (8, [1.0, 2.0, 3.0], 0), (9, [-0.01, 0.0], None)]
    got = rows_of(spark, rows, 2).collect()
    assert {(r["vec_id"], r["distance"]) for r in got} == {(1, 0), (9, 0)}
    assert {tuple(r["centroid"]) for r in got} == {(64, 128), (-1, 0)}
    assert rows_of(spark, rows[1:8], 2).count() == 0
    assert cc.cluster_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    doubles = spark.createDataFrame([(1, [2.0, 3.0])], "vec_id long, embedding array<double>")
    assert cc.cluster_vectors(doubles, settings=cc.Settings(dims=2)).first()["centroid"] == [128, 192]
    with pytest.raises(ValueError):
        cc.Settings(k=5000)
    with pytest.raises(Exception, match="64 bits"):
        rows_of(spark, [(1, [1e30, 1.0], 0)], 2).count()
