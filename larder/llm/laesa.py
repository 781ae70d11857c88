"""Centroid clustering of integer vectors with a LAESA pivot table.

1. Vectors become integers. ``PIVOTS`` of them, far from each other, are chosen
   from a bounded sample; every vector's squared distances to them are computed
   once and written beside it.
2. In each round |d(vector, pivot) - d(pivot, centroid)| bounds the distance to
   every centroid from below. The centroid with the least bound gets its exact
   integer distance; of the others only those whose bound does not exceed it
   (ties included) do. Tasks emit sums per centroid, never rows.
3. New centroids are componentwise exact floors of sum / count. Only the
   centroids (``K`` rows) pass through the driver.

The bounds use square roots and are lowered by ``SLACK``, far above the rounding
of doubles, so no centroid that could win is skipped; what survives is decided
by integers alone.

Defined results: null vectors, other lengths and null or non-finite components
take no part, nor do components of magnitude 2**27 or more after scaling (their
squared distances may not fit a long); vectors without an id are clustered like
others and start a centroid only if there are fewer ids than centroids; rows
that repeat an id are vectors of their own; fewer vectors than centroids give
as many centroids; an empty table gives an empty result; extra input columns,
whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import prepare_python, saved, table
from larder.llm.vectors import matrix, scaled, usable

#: Production parameters.
DIMS = 64
SCALE = 1024
K = 8
ROUNDS = 10
SEED = 3
PIVOTS = 16
#: Vectors (smallest hashes) among which the pivots are chosen.
PIVOT_SAMPLE = 512
SLACK = 1e-6
#: Arrow rows handled at a time.
BATCH = 8192


def squared(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``v`` to one vector ``w``."""
    diff = v - w[None, :]
    return np.einsum("ij,ij->i", diff, diff)


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of ``sample``, each farthest from those before it."""
    chosen = [0]
    near = squared(sample, sample[0])
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def nearest(v: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray,
            centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller), its squared distance,
    and how many exact distances were computed."""
    between = np.sqrt(np.stack([squared(pivots, c) for c in centroids], axis=1).astype(np.float64))
    own = np.sqrt(to_pivots.astype(np.float64))
    low = np.zeros((len(v), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(low, np.abs(own[:, p, None] - between[p][None, :]), out=low)
    low = np.maximum(low * (1 - SLACK) - SLACK, 0)
    guess = low.argmin(axis=1)
    best = np.empty(len(v), np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(guess == c)
        best[rows] = squared(v[rows], centroids[c])
    cluster, exact = guess.copy(), len(v)
    for c in range(len(centroids)):
        rows = np.flatnonzero((low[:, c] <= np.sqrt(best.astype(np.float64))) & (guess != c))
        d = squared(v[rows], centroids[c])
        wins = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        cluster[rows[wins]], best[rows[wins]] = c, d[wins]
        exact += len(rows)
    return cluster, best, exact


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that take part; ``v`` is an array of int."""
    x = F.col(vec_col)
    return (df.filter(F.coalesce(F.size(x) == dims, F.lit(False)) & usable(x, scale))
            .select(F.col(id_col).cast("long").alias("id"), scaled(x, scale).cast("array<int>").alias("v")))


def _first(vectors: DataFrame, count: int, salt: int) -> np.ndarray:
    """The ``count`` vectors with the smallest sha256 of ``salt:id``."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(key.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(count).collect()
    return np.array([r["v"] for r in rows], np.int64)


def pivot_table(vectors: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """``vectors`` with ``to_pivots``: their squared distances to the pivots."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column("v"), dims)
            d = np.stack([squared(v, p) for p in pivots], axis=1) if len(v) else np.zeros((0, len(pivots)), np.int64)
            offsets = np.arange(0, d.size + 1, len(pivots), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))],
                ["id", "v", "to_pivots"])
    return vectors.mapInArrow(measure, "id long, v array<int>, to_pivots array<long>")


def moved(rows: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over the pivot table ``rows``."""
    dims = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), dims), np.int64)
        for b in batches:
            v = matrix(b.column("v"), dims)
            cluster, _, _ = nearest(v, matrix(b.column("to_pivots"), len(pivots)), pivots, centroids)
            n += np.bincount(cluster, minlength=len(centroids))
            for c in range(len(centroids)):
                total[c] += v[cluster == c].sum(axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(n[used])] + [pa.array(total[used, d]) for d in range(dims)],
            ["cluster", "n"] + [f"s{d}" for d in range(dims)])

    columns = [f"s{d}" for d in range(dims)]
    partial = rows.mapInArrow(sums, "cluster int, n long, " + ", ".join(f"{s} long" for s in columns))
    # One row for each centroid reaches the driver.
    whole = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in columns]).collect()
    out = centroids.copy()
    for r in whole:
        out[r["cluster"]] = [int(r[s]) // r["n"] for s in columns]
    return out


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS,
                    scale: int = SCALE, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = df.sparkSession
    prepare_python(spark, BATCH)
    vectors = integer_vectors(df, id_col, vec_col, dims, scale)
    schema = "id long, cluster int, distance long"
    sample = _first(vectors, max(PIVOT_SAMPLE, k), seed)
    if not len(sample):
        found, centroids = spark.createDataFrame([], schema), np.zeros((0, dims), np.int64)
    else:
        pivots, centroids = far_apart(sample, PIVOTS), sample[:k]
        rows = saved(pivot_table(vectors, pivots, dims), "laesa-pivots")
        for _ in range(rounds):
            centroids = moved(rows, pivots, centroids)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cluster, d, _ = nearest(matrix(b.column("v"), dims), matrix(b.column("to_pivots"), len(pivots)),
                                        pivots, centroids)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(cluster.astype(np.int32)), pa.array(d)], ["id", "cluster", "distance"])
        found = saved(rows.mapInArrow(assign, schema), "laesa-clusters")
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row for each centroid
    of = [per.get(c, 0) for c in range(len(names))]

    def by_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(x).cast(kind) for x in values]).cast(f"array<{kind}>"), F.col("cluster"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance",
                        by_cluster(of, "long").alias("cluster_inertia"), F.lit(sum(of)).cast("long").alias("inertia"),
                        by_cluster(names, "string").alias("centroid_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: cluster of every vector after ten rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds as plain DuckDB SQL: every distance, every round."""
    base = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS}
   AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
parts AS MATERIALIZED (SELECT r, unnest(v)::HUGEINT AS x, unnest(range({DIMS})) AS d FROM kept),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v FROM kept
  ORDER BY sha256('{SEED}:' || vec_id) LIMIT {K})"""
    for i in range(ROUNDS + 1):
        base += f""",
a{i} AS MATERIALIZED (SELECT r, vec_id, c, dist FROM (
  SELECT k.r, k.vec_id, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS dist
  FROM kept k, c{i} c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1)"""
        if i < ROUNDS:
            base += f""",
m{i} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY d) AS v FROM (
  SELECT a.c, p.d, sum(p.x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a JOIN parts p USING (r) GROUP BY a.c, p.d)
  GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (c))"""
    return base + f"""
SELECT a.vec_id, a.c::INTEGER AS cluster, a.dist AS distance,
  (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(z.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} z USING (c)"""


SQL = _sql()
