"""Centroid clusters and hard negatives against brute force, with rows that do not count, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendmill.llm.centroid_clusters import Pivots, cluster_vectors, clustered, nearest
from spendmill.llm.hard_negatives import hard_negatives
from spendmill.llm.vectors import products, squared_distances

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, uid long, vector string, score double"
order = lambda rows: sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def frame(spark, rows):
    """``rows`` of (vec_id, embedding, label) with columns whose names the operators use inside, in several partitions."""
    return spark.createDataFrame([(i, v, label, -1, -1, "x", 0.5) for i, v, label in rows], SCHEMA).repartition(3)


def odd_rows(width: int) -> list[tuple]:
    rng = np.random.default_rng(5)
    spread = [(i, [float(x) for x in rng.normal(size=width).astype(np.float32)], int(rng.integers(4))) for i in range(90)]
    near = [(100 + i, [float(x) for x in (np.ones(width) + rng.integers(2, size=width) / 8).astype(np.float32)], i % 3) for i in range(60)]
    same = [(200, [0.5] * width, 1)] * 4 + [(300, [0.5] * width, 1), (None, [0.5] * width, 2), (None, [0.25] * width, None), (400, [0.0] * width, 1)]
    none = [(500, None, 1), (600, [], 2), (700, [1.0] * (width - 1) + [math.nan], 1), (800, [math.inf] * width, 1), (900, [1.0, None] * (width // 2), 1)]
    return spread + near + same + none


def whole(vector, scale, width=None):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector) or width not in (None, len(vector)):
        return None
    return [math.floor(float(np.float32(x)) * scale) for x in vector]


def plain_clusters(rows, clusters, rounds, width):
    kept = [(i, v) for i, e, _ in rows if (v := whole(e, 1024, width)) is not None]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in first[:clusters]]

    def assign():
        far = [[sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        owner = [c for c, _ in assign()]
        for c in range(len(centroids)):
            if mine := [v for o, (_, v) in zip(owner, kept, strict=True) if o == c]:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign(), strict=True)], centroids


@pytest.mark.parametrize("clusters,rounds", [(8, 10), (1, 2), (3, 0)])
def test_clusters_equal_brute_force(spark, clusters, rounds):
    rows = odd_rows(6)
    want, centroids = plain_clusters(rows, clusters, rounds, 6)
    found, got = cluster_vectors(frame(spark, rows), clusters, rounds, width=6)
    assert got.tolist() == centroids
    assert order(map(tuple, found.collect())) == order(want)


def test_cluster_report_and_small_tables(spark):
    rows = odd_rows(6)
    report = clustered(frame(spark, rows), width=6).collect()
    assert {r["inertia"] for r in report} == {sum(r["distance"] for r in report)}
    for c in {r["cluster"] for r in report}:
        mine = [r for r in report if r["cluster"] == c]
        assert {r["cluster_inertia"] for r in mine} == {sum(r["distance"] for r in mine)}
        assert len({r["centroid_sha256"] for r in mine}) == 1
    assert clustered(frame(spark, rows).limit(0), width=6).count() == 0
    assert clustered(frame(spark, rows[-5:]), width=6).count() == 0
    few, centroids = cluster_vectors(frame(spark, rows[:3]), width=6)
    assert few.count() == 3 and len(centroids) == 3
    with pytest.raises(Exception, match="not exact"):
        cluster_vectors(frame(spark, [(1, [1e30] * 6, 1)]), width=6)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 1 << 32), st.sampled_from([1, 3, 1000, 1 << 26]))
def test_bounds_never_pass_the_distance(seed, size):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(-size, size + 1, size=(n, 3))
    vectors, pivots, centroids = draw(40), Pivots(draw(5)), draw(4)
    vectors[:4], centroids[0] = centroids, pivots.points[0]
    cached, exact = squared_distances(vectors, pivots.points), squared_distances(vectors, centroids)
    lower = pivots.lower_bounds(cached, centroids)
    assert all(int(low) <= far for low, far in zip(lower.reshape(-1).tolist(), exact.reshape(-1).tolist(), strict=True))
    owner, best, _ = nearest(vectors, cached, pivots, centroids)
    assert (owner == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()


def test_bounds_spare_most_distances_of_clustered_vectors():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, size=(8, 64))
    vectors = centres[rng.integers(8, size=4000)] + rng.integers(-60, 60, size=(4000, 64))
    pivots = Pivots(centres + 5)
    owner, _, taken = nearest(vectors, squared_distances(vectors, pivots.points), pivots, centres)
    assert (owner == squared_distances(vectors, centres).argmin(axis=1)).all()
    assert taken < 0.2 * 8 * len(vectors)


# -- 13 ---------------------------------------------------------------------------------------


def plain_negatives(rows, positives, negatives, low, high, is_anchor):
    kept = [(n, i, label, v) for n, (i, e, label) in enumerate(rows) if label is not None and (v := whole(e, 256)) is not None]
    out = []
    for n, i, label, v in kept:
        if i is None or not is_anchor(i):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j, other) for m, j, other, w in kept if m != n), key=lambda s: (s[0], s[1], s[2] or 0))
        for s, _, j, _ in [x for x in scored if x[3] == label][:positives]:
            band = [x for x in scored if x[3] != label and low * -s <= -100 * x[0] <= high * -s][:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, _, k, _) in enumerate(band, 1)]
    return out


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("options", [{}, {"list_rows": 7, "anchors_per_block": 3}, {"positives": 2, "negatives": 3, "low_percent": 0, "high_percent": 100}])
def test_negatives_equal_brute_force(spark, options):
    rows = odd_rows(6)
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, **options)
    want = plain_negatives(rows, options.get("positives", 5), options.get("negatives", 10), options.get("low_percent", 30), options.get("high_percent", 90), lambda i: i % 10 == 0)
    assert found.columns == list(COLUMNS) and len(want) > 50
    assert order(map(tuple, found.collect())) == order(want)


def test_negatives_of_tight_clusters(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in (centres[i % 6] + rng.normal(size=16) / 20).astype(np.float32)], int(rng.integers(3))) for i in range(1200)]
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % 25 == 0, list_rows=500)
    assert order(map(tuple, found.collect())) == order(plain_negatives(rows, 5, 10, 30, 90, lambda i: i % 25 == 0))


def test_negatives_of_small_tables(spark):
    rows = odd_rows(6)
    none = lambda f, anchor: hard_negatives(f, anchor).count() == 0
    assert none(frame(spark, rows).limit(0), F.col("vec_id") == 0)
    assert none(frame(spark, rows), F.col("vec_id") == -1)
    assert none(frame(spark, rows).where("label = 1"), F.col("vec_id") % 10 == 0)
    assert none(frame(spark, [(0, [], 1), (10, None, 2)]), F.col("vec_id") % 10 == 0)


def test_products_are_exact_beyond_doubles():
    a = np.array([[1 << 27, 3], [-(1 << 27), 1]])
    assert products(a, a).tolist() == [[int(x) for x in row] for row in a.astype(object) @ a.astype(object).T]
    with pytest.raises(ValueError):
        products(np.full((1, 4), 1 << 31), np.full((1, 4), 1 << 31))
