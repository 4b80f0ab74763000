"""Operator 12: exact centroid clustering behind N-simplex bounds.

Vectors are turned into integers once and never again into floats for a
decision. A few pivots (taken greedily from the first centroids, each as far as
possible from the span of those before it) form a simplex. The distances of a
vector to the pivots are measured once and cached as its apex: the coordinates
of the point that has these distances to the simplex, the last one its height
above it. For two apexes x and y

    |x - y|  <=  distance of the vectors  <=  |x - y'|

where y' is y with its height mirrored. In every round a centroid is compared
exactly, in integers, only if its lower bound does not exceed the least upper
bound; a slack above the rounding error of the floats keeps the test safe. The
nearest centroid (ties: the smaller number) is the one of a full comparison.

Spark holds the integer vectors and apexes in one written table, read in every
round; a task adds up its vectors by centroid before anything is shuffled, and
the driver sees k sums a round, whatever the size of the table.

Cases: vectors that are null, of another length or with a null or non-finite
component are left out; repeated rows count each; a null ``vec_id`` is kept, but
starts a centroid only after all others; equal hashes start in the order of the
components; with fewer than k vectors there are as many centroids as vectors; an
empty table gives no rows. A component of 2**27 or more after scaling is refused
with an error, as squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrank.llm.common import arrow_schema, stored, table

CLUSTERS = 40
ROUNDS = 5
SIZE = 64               # components
SCALE = 256
SEED = 2
PIVOTS = 16
LIMIT = 1 << 27         # of a component's magnitude, so that distances fit 64 bits
BLOCK = 4096            # vectors compared at a time


# ----------------------------------------------------------------- n-simplex

def pick_pivots(points: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Rows of ``points`` in general position, the farthest from the span first.

    A height below a hundredth of the first one ends the choice, so that the
    simplex stays well conditioned.
    """
    rest = points.astype(np.float64) - points[0]
    chosen = [0]
    least = 0.01 * float(np.sqrt((rest ** 2).sum(axis=1)).max())
    while len(chosen) < min(count, len(points)):
        height = np.sqrt((rest ** 2).sum(axis=1))
        far = int(height.argmax())
        if height[far] <= least:
            break
        axis = rest[far] / height[far]
        rest = rest - np.outer(rest @ axis, axis)
        chosen.append(far)
    return points[chosen]


class Simplex:
    """Base simplex of the pivots; turns distances to them into apex coordinates."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        d2 = square_distances(pivots, pivots).astype(np.float64)
        # the first pivot is the origin; Gram matrix of the others from distances alone
        gram = (d2[1:, :1] + d2[:1, 1:] - d2[1:, 1:]) / 2
        self.norm2 = d2[1:, 0]
        self.base = np.linalg.cholesky(gram) if len(gram) else np.zeros((0, 0))

    def apex(self, d2: np.ndarray) -> np.ndarray:
        """Coordinates of the points with squared distances ``d2`` to the pivots."""
        first = d2[:, :1].astype(np.float64)
        side = (first + self.norm2 - d2[:, 1:]) / 2
        flat = np.zeros_like(side)
        for i, row in enumerate(self.base):                 # the base is lower triangular
            flat[:, i] = (side[:, i] - np.einsum("ij,j->i", flat[:, :i], row[:i])) / row[i]
        height = np.sqrt(np.maximum(first[:, 0] - (flat ** 2).sum(axis=1), 0))
        return np.column_stack([flat, height])


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, each of ``a`` to each of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j, row in enumerate(b):
        step = a - row
        out[:, j] = np.einsum("ij,ij->i", step, step)
    return out


def candidates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which centroids (apexes y) may be nearest to which vectors (apexes x)."""
    flat = ((x[:, None, :-1] - y[None, :, :-1]) ** 2).sum(axis=2)
    low = flat + (x[:, -1:] - y[:, -1]) ** 2
    high = (flat + (x[:, -1:] + y[:, -1]) ** 2).min(axis=1, keepdims=True)
    # squares lose at most a few units in the last place of the largest square seen
    slack = 1e-6 * (1 + high + (x ** 2).sum(axis=1, keepdims=True) + (y ** 2).sum(axis=1).max())
    return low <= high + slack


def nearest(points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            tips: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance) of every point, and pairs compared."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    which = np.zeros(len(points), dtype=np.int64)
    compared = 0
    for start in range(0, len(points), BLOCK):
        part = slice(start, start + BLOCK)
        may = candidates(apexes[part], tips)
        compared += int(may.sum())
        for c in range(len(centroids)):
            rows = np.flatnonzero(may[:, c]) + start
            step = points[rows] - centroids[c]
            d2 = np.einsum("ij,ij->i", step, step)
            less = d2 < best[rows]
            best[rows[less]], which[rows[less]] = d2[less], c
    return which, best, compared


# --------------------------------------------------------------------- Spark

@dataclass(frozen=True)
class Clustering:
    """Final centroids (rows) and the written table vec_id, cluster, distance."""

    centroids: np.ndarray
    assigned: DataFrame


def whole_numbers(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``point`` (array of longs) of the vectors that are kept."""
    x = F.transform("v", lambda c: c.cast("double"))
    fine = (F.size("v") == size) & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
            .filter(F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.transform(x, lambda c: _whole(c, scale)).alias("point")))


def _whole(c: Column, scale: int) -> Column:
    y = F.floor(c * F.lit(float(scale)))
    large = F.abs(c * F.lit(float(scale))) >= F.lit(float(LIMIT))
    return F.when(large, F.raise_error(F.lit("a component is too large for 64-bit distances"))
                  .cast("long")).otherwise(y)


def first_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k kept vectors with the smallest hash of ``seed:vec_id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (points.select("point", key.alias("key"))
            .orderBy(F.col("key").asc_nulls_last(), "point").limit(k).collect())
    return np.array([r["point"] for r in rows], dtype=np.int64)


def cluster(points: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
            pivots: int = PIVOTS) -> Clustering | None:
    """Cluster ``vec_id``, ``point`` rows; None if there are none."""
    start = first_centroids(points, k, seed)
    if not len(start):
        return None
    simplex = Simplex(pick_pivots(start, pivots))
    cached = stored(with_apexes(points, simplex), "clusters-points")
    centroids = start
    for _ in range(rounds):
        centroids = moved(cached, simplex, centroids)
    return Clustering(centroids, stored(assign(cached, simplex, centroids), "clusters-assigned"))


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1)


def _lists(rows: np.ndarray, schema: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), schema.value_type)).cast(schema)


def with_apexes(points: DataFrame, simplex: Simplex) -> DataFrame:
    """Adds ``apex``, from the distances to the pivots."""
    schema = "vec_id long, point array<int>, apex array<double>"
    target = arrow_schema(points.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1), np.int64)
                apex = simplex.apex(square_distances(rows, simplex.pivots))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(rows.astype(np.int32), target.field(1).type),
                     _lists(apex, target.field(2).type)], schema=target)

    return points.select("vec_id", "point").mapInArrow(run, schema)


def moved(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of their vectors, in exact integers."""
    schema = "cluster int, at int, total long, n long"
    target = arrow_schema(cached.sparkSession, schema)
    k, size = centroids.shape
    tips = simplex.apex(square_distances(centroids, simplex.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column(0), np.int64)
                which = nearest(points, _matrix(batch.column(1), np.float64), centroids, tips)[0]
                order = np.argsort(which, kind="stable")
                keys, first = np.unique(which[order], return_index=True)
                total[keys] += np.add.reduceat(points[order], first, axis=0)
                n += np.bincount(which, minlength=k)
        on = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(on, size), pa.int32()),
             pa.array(np.tile(np.arange(size), len(on)), pa.int32()),
             pa.array(total[on].ravel()), pa.array(np.repeat(n[on], size))], schema=target)

    rows = (cached.select("point", "apex").mapInArrow(run, schema).groupBy("cluster", "at")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
            .collect())                                     # k times size rows
    after = centroids.copy()
    for r in rows:
        after[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return after


def assign(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of every vector."""
    schema = "vec_id long, cluster int, distance long"
    target = arrow_schema(cached.sparkSession, schema)
    tips = simplex.apex(square_distances(centroids, simplex.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                which, d2, _ = nearest(_matrix(batch.column(1), np.int64),
                                       _matrix(batch.column(2), np.float64), centroids, tips)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(which, pa.int32()), pa.array(d2)], schema=target)

    return cached.select("vec_id", "point", "apex").mapInArrow(run, schema)


RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


def clustered(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Every kept vector with its cluster, distances, inertia and centroid digest."""
    found = cluster(whole_numbers(vectors))
    if found is None:
        return spark.createDataFrame([], RESULT)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
              for c in found.centroids.tolist()]
    names = spark.createDataFrame(list(enumerate(digest)), "number int, centroid_sha256 string")
    per = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = per.join(F.broadcast(names), per["cluster"] == names["number"])
    whole = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    facts = F.broadcast(sums.select("number", "cluster_inertia", "centroid_sha256")
                        .crossJoin(F.broadcast(whole)))     # k rows and one row
    return (found.assigned.join(facts, found.assigned["cluster"] == facts["number"])
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark, table(spark, sf_dir, "embeddings"))


# ------------------------------------------------------------------- SQL form

def sql(k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
        seed: int = SEED) -> str:
    """DuckDB SQL for the same rows: every round compares all vectors with all centroids."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS p
  FROM embeddings
  WHERE len(embedding) = {size}
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {size}),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, p FROM kept),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, p) - 1 AS INTEGER) AS c, p AS q
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, p FROM numbered ORDER BY h NULLS LAST, p LIMIT {k}))"""]

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT row_id, vec_id, p, CAST(best[2] AS INTEGER) AS c, best[1] AS d
  FROM (SELECT n.row_id, any_value(n.vec_id) AS vec_id, any_value(n.p) AS p,
               min([CAST(list_sum(list_transform(list_zip(n.p, k.q),
                   lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), k.c]) AS best
        FROM numbered n CROSS JOIN c{i} k GROUP BY n.row_id))"""

    for i in range(rounds):
        steps += [assigned(i), f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.q, o.q) AS q FROM c{i} o LEFT JOIN (
    SELECT c, list(v ORDER BY i) AS q FROM (
      SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
      FROM (SELECT c, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM a{i}) GROUP BY c, i)
    GROUP BY c) m ON o.c = m.c)"""]
    steps += [assigned(rounds), f"""told AS (
  SELECT a.c, CAST(sum(a.d) AS BIGINT) AS cluster_inertia,
         sha256(any_value(array_to_string(k.q, ','))) AS centroid_sha256
  FROM a{rounds} a JOIN c{rounds} k ON a.c = k.c GROUP BY a.c)"""]
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, a.c AS cluster, a.d AS distance, t.cluster_inertia,
       CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, t.centroid_sha256
FROM a{rounds} a JOIN told t ON a.c = t.c"""
