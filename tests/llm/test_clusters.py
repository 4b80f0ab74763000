"""N-simplex bounds, exact assignment and rounds against a plain k-means in Python integers."""
import hashlib
import math
import random

import numpy as np
import pytest

from feedrank.llm import clusters as c

SCHEMA = "vec_id long, embedding array<float>, label int, point string, cluster int, distance double"


def brute(rows, k=c.CLUSTERS, rounds=c.ROUNDS):
    kept = []
    for vec_id, vec in rows:
        if vec is not None and len(vec) == c.SIZE and all(
                x is not None and math.isfinite(x) for x in vec):
            kept.append((vec_id, tuple(math.floor(256 * float(np.float32(x))) for x in vec)))

    def key(v):
        return (v[0] is None, hashlib.sha256(f"2:{v[0]}".encode()).hexdigest(), v[1])

    cent = [v[1] for v in sorted(kept, key=key)[:k]]

    def near(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, q)), i) for i, q in enumerate(cent))

    for _ in range(rounds):
        got = [near(p)[1] for _, p in kept]
        for i in range(len(cent)):
            own = [p for (_, p), g in zip(kept, got) if g == i]
            if own:
                cent[i] = tuple(sum(x) // len(own) for x in zip(*own))
    last = [near(p) for _, p in kept]
    total = sum(d for d, _ in last)
    return sorted(
        (repr(v), i, d, sum(e for e, j in last if j == i), total,
         hashlib.sha256(",".join(map(str, cent[i])).encode()).hexdigest())
        for (v, _), (d, i) in zip(kept, last))


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 0, "x", 1, 0.5) for a, b in rows], SCHEMA)


def got(spark, rows):
    out = c.clustered(spark, frame(spark, rows)).collect()
    return sorted((repr(r[0]), *r[1:]) for r in out)


def test_matches_plain_kmeans_with_odd_rows(spark):
    rng = random.Random(3)
    centre = [[rng.gauss(0, 1) for _ in range(c.SIZE)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in centre[i % 6]]) for i in range(150)]
    rows += [rows[5]] * 60 + [(5, rows[9][1]), (None, rows[3][1]), (None, None)]
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65),
             (904, [float("nan")] + [0.1] * 63), (905, [float("-inf")] + [0.1] * 63),
             (906, [None] + [0.1] * 63), (907, [0.0] * 64), (908, [0.0] * 64)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.25] * 64)],
                                  [(i, [0.25] * 64) for i in range(60)]])
def test_few_and_equal_vectors(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        got(spark, [(1, [1e6] + [0.0] * 63)])


def test_bounds_hold_and_prune_clustered_vectors():
    rng = np.random.default_rng(5)
    centre = rng.integers(-300, 300, (40, 64))
    points = centre[rng.integers(0, 40, 3000)] + rng.integers(-8, 9, (3000, 64))
    simplex = c.Simplex(c.pick_pivots(centre))
    x = simplex.apex(c.square_distances(points, simplex.pivots))
    y = simplex.apex(c.square_distances(centre, simplex.pivots))
    true = c.square_distances(points, centre)
    flat = ((x[:, None, :-1] - y[None, :, :-1]) ** 2).sum(2)
    assert (flat + (x[:, -1:] - y[:, -1]) ** 2 <= true * (1 + 1e-9) + 1e-3).all()
    assert (flat + (x[:, -1:] + y[:, -1]) ** 2 >= true * (1 - 1e-9) - 1e-3).all()
    which, best, compared = c.nearest(points, x, centre, y)
    assert (which == true.argmin(1)).all() and (best == true.min(1)).all()
    assert compared < 0.5 * true.size


def test_nearest_breaks_ties_by_number_and_survives_degenerate_pivots():
    points = np.array([[0, 0], [4, 0], [2, 0]])
    centre = np.array([[4, 0], [0, 0], [4, 0], [0, 0]])
    for pivots in (centre[:1], c.pick_pivots(centre)):
        simplex = c.Simplex(pivots)
        x, y = (simplex.apex(c.square_distances(v, pivots)) for v in (points, centre))
        which, best, _ = c.nearest(points, x, centre, y)
        assert which.tolist() == [1, 0, 0] and best.tolist() == [0, 0, 4]
