"""Centroid clustering (k-means on integers) by the threshold algorithm.

Vectors become integer rows. Each round sends the centroids (``K`` rows, however
many vectors there are) to every task, assigns each vector to the nearest one,
and adds up every cluster's vectors: within a task first, so that a task sends
on at most ``K`` rows.

The nearest centroid is found by walking lists, not by comparing with all of
them. Per dimension the centroids are sorted by their component there. From the
vector's own component the walk goes outward, to the nearer side first, one
centroid per dimension and step. A centroid met for the first time has its exact
distance computed. The entries just met are the frontier: a centroid not met yet
is at least that far away in every dimension, so its distance is no less than
the sum of the frontier's squared distances. Once that sum strictly exceeds the
best exact distance, no other centroid can win or tie. A batch of vectors takes
its steps together; those that are done leave it.

Everything is exact: distances are 64-bit integers, sums are added up in Spark
as longs (an overflow raises) and divided with floor in Python's integers.

Defined results: vectors that are null, of another length, or hold a null or a
non-finite component take no part. A component of 2^26 or more after scaling
raises ``ValueError``, since distances might not fit 64 bits. Rows with a null
id are clustered but never start a centroid. Repeated ids are separate vectors;
where they start centroids, they are ordered by their components. Ties go to the
smaller centroid number. Fewer vectors than ``K``: each starts a centroid.
Extra columns are ignored. Without a vector that can start a centroid there are
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasir.llm.common import staged

K = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2
WALK_ROWS = 2048                # vectors that walk together
LARGEST = 1 << 26               # components below this keep distances in 64 bits


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM,
                  scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors that take part, each component floor(scale * x)."""
    x = F.col(vec_col)
    fine = (F.size(x) == dim) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda e: F.lit(float(scale)) * e.cast("double"))
    whole = F.transform(scaled, lambda e: F.when(F.abs(e) < F.lit(float(LARGEST)), F.floor(e)).otherwise(
        F.raise_error(F.lit("ValueError: a component is too large to be clustered")).cast("long")))
    return df.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hash of ``seed:vec_id``. A top-k query:
    each task keeps k rows."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: (r["h"], r["v"]))], dtype=np.int64)


class Walker:
    """Nearest centroids of many vectors by the threshold algorithm."""

    def __init__(self, centroids: np.ndarray):
        self.c = np.ascontiguousarray(centroids, dtype=np.int64)
        self.k, self.dim = self.c.shape
        # Per dimension: centroid numbers by component, and those components
        # between two sentinels that no walk passes.
        self.order = np.argsort(self.c, axis=0, kind="stable").T
        far = np.int64(1) << 40
        self.values = np.full((self.dim, self.k + 2), far)
        self.values[:, 0] = -far
        self.values[:, 1:-1] = np.take_along_axis(self.c.T, self.order, axis=1)
        self.steps = 0              # frontier entries taken, for tests

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid."""
        n = len(x)
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.full(n, self.k, dtype=np.int64)
        met = np.zeros((n, self.k), dtype=bool)
        # The next entry below and above each component, per dimension.
        above = np.stack([np.searchsorted(v[1:-1], x[:, j]) for j, v in enumerate(self.values)], axis=1) + 1
        below = above - 1
        rows, dims = np.arange(n), np.arange(self.dim)
        for _ in range(self.k):
            own = x[rows]
            down = own - self.values[dims, below[rows]]
            up = self.values[dims, above[rows]] - own
            lower = down <= up
            frontier = np.where(lower, down, up)
            entry = np.where(lower, below[rows], above[rows]) - 1
            below[rows] -= lower
            above[rows] += ~lower
            self.steps += frontier.size

            # Centroids met for the first time, each once.
            hit = np.zeros((len(rows), self.k), dtype=bool)
            hit[np.arange(len(rows))[:, None], self.order[dims, entry]] = True
            hit &= ~met[rows]
            met[rows] |= hit
            i, c = np.nonzero(hit)
            gap = own[i] - self.c[c]
            distance = np.einsum("ij,ij->i", gap, gap)
            # The smallest distance of each row, of equal ones the smallest
            # number: a stable order by (row, distance) keeps numbers ascending.
            by = np.lexsort((c, distance, i))
            lead = by[np.r_[True, i[by][1:] != i[by][:-1]]] if len(by) else by
            at, d, c = rows[i[lead]], distance[lead], c[lead]
            wins = (d < best[at]) | ((d == best[at]) & (c < who[at]))
            best[at[wins]], who[at[wins]] = d[wins], c[wins]

            threshold = np.einsum("ij,ij->i", frontier, frontier)
            rows = rows[threshold <= best[rows]]
            if not len(rows):
                break
        return who, best


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, dim)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(centroids)
        for b in batches:
            x = _matrix(b.column(1), dim)
            for lo in range(0, len(x), WALK_ROWS):
                who, best = walker.nearest(x[lo:lo + WALK_ROWS])
                yield pa.RecordBatch.from_pydict({
                    "vec_id": b.column(0).slice(lo, WALK_ROWS), "cluster": pa.array(who.astype(np.int32)),
                    "distance": pa.array(best)})

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count), empty ones stay."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(centroids)
        total, count = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for b in batches:
            x = _matrix(b.column(0), dim)
            for lo in range(0, len(x), WALK_ROWS):
                part = x[lo:lo + WALK_ROWS]
                who, _ = walker.nearest(part)
                here = np.zeros((k, dim), dtype=np.int64)
                np.add.at(here, who, part)
                total += here
                count += np.bincount(who, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(own, pa.int32()), "n": pa.array(count[own], pa.int64()),
            "total": pa.array(total[own].tolist(), pa.list_(pa.int64()))})

    per_task = vectors.select("v").mapInArrow(sums, "cluster int, n bigint, total array<bigint>")
    # One row per cluster reaches the driver.
    rows = per_task.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(j))).alias(f"t{j}") for j in range(dim)]).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"]] = [r[f"t{j}"] // r["n"] for j in range(dim)]
    return out


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector after ``rounds`` rounds, and
    the final centroids."""
    vectors = staged(whole_vectors(df, id_col, vec_col, dim, scale), "cluster-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return staged(assign(vectors, centroids), "clusters"), centroids


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    from kasir.llm.common import prepare, table
    prepare(spark)
    rows, centroids = cluster(table(spark, sf_dir, "embeddings"))
    # At most K rows.
    of_cluster = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = spark.createDataFrame(
        [(c, d, sum(of_cluster.values()), sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, d in of_cluster.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """DuckDB twin: every vector against every centroid, round by round."""
    ctes = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, e FROM (
    SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {DIM}
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS cluster, e FROM (
    SELECT sha256('{SEED}:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {K})
)"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, e, cluster, distance FROM (
    SELECT v.r, v.vec_id, v.e, c.cluster,
           CAST(list_sum([(v.e[i] - c.e[i]) * (v.e[i] - c.e[i]) FOR i IN range(1, {DIM + 1})]) AS BIGINT) AS distance,
           row_number() OVER (PARTITION BY v.r ORDER BY distance, c.cluster) AS nth
    FROM v CROSS JOIN c{i} c) WHERE nth = 1
)""")
        if i < ROUNDS:
            ctes.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
    SELECT cluster, list(x ORDER BY d) AS e FROM (
      SELECT cluster, d, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
      FROM (SELECT cluster, unnest(e) AS x, unnest(range(1, {DIM + 1})) AS d FROM a{i}) GROUP BY cluster, d)
    GROUP BY cluster) m ON m.cluster = c.cluster
)""")
    return "WITH " + ",".join(ctes) + f"""
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.cluster
"""


# DuckDB twin of op12_centroids.
OP12_SQL = _sql()
