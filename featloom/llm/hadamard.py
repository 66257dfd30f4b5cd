"""k-means over integer vectors by progressive Walsh-Hadamard search.

Vectors and centroids become integers and go through the exact integer
Walsh-Hadamard transform, which multiplies squared distances by 64.  A vector adds
up squared coefficient differences from coarse (few sign changes) to fine; the
centroid that leads after the first step is finished at once, and centroids whose
sum is strictly worse than that are dropped on the way, so ties survive.  What is
left is finished over all 64 coefficients.

Each round reads the vectors anew and leaves one row of integer sums for each task
and cluster; the driver sees the 40 centroids alone.

Cases: vectors that are NULL, have another length than 64 or a NULL or non-finite
component take no part, nor do those with a component beyond ``LIMIT`` once made
integer (256 x), whose distances would leave a long; a NULL id is hashed as an empty
one; repeated rows count as often as they stand, also among the first centroids;
equal distances go to the centroid of smaller number; fewer than 40 vectors make
fewer centroids; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import stored

SIZE, SCALE = 64, 256
CLUSTERS, ROUNDS, SALT = 40, 5, "2"
LIMIT = 2**24
STEPS = (8, 16, 32, SIZE)
CHUNK = 4096


def butterflies(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, in the order of the butterflies."""
    half = 1
    while half < SIZE:
        pairs = rows.reshape(len(rows), -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([low + high, low - high], axis=2).reshape(len(rows), SIZE)
        half *= 2
    return rows


# coefficients by the number of sign changes of their pattern
COARSE_FIRST = np.argsort((np.diff(butterflies(np.eye(SIZE, dtype=np.int64)), axis=0) != 0).sum(0), kind="stable")


def transform(rows: np.ndarray) -> np.ndarray:
    return butterflies(rows)[:, COARSE_FIRST]


def nearest(coefs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, smaller number first; squared distance times 64) of transformed vectors."""
    part = ((coefs[:, None, : STEPS[0]] - centroids[None, :, : STEPS[0]]) ** 2).sum(2)
    bound = ((coefs - centroids[part.argmin(1)]) ** 2).sum(1)
    row, number = np.nonzero(part <= bound[:, None])
    part = part[row, number]
    for a, b in zip(STEPS, STEPS[1:]):
        part = part + ((coefs[row, a:b] - centroids[number, a:b]) ** 2).sum(1)
        alive = part <= bound[row]
        row, number, part = row[alive], number[alive], part[alive]
    order = np.lexsort((number, part, row))
    row, number, part = row[order], number[order], part[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    return number[first], part[first]


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as arrays of 64 integers."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c * SCALE) >= LIMIT))
    rows = rows.where((F.size("x") == SIZE) & ~odd)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("int")).alias("v"))


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.slice(a, CHUNK)
            yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE).astype(np.int64)


def _sums(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = transform(centroids)
        count, total = np.zeros(len(goal), np.int64), np.zeros((len(goal), SIZE), np.int64)
        for _, rows in matrices(batches):
            cluster, _ = nearest(transform(rows), goal)
            order = np.argsort(cluster, kind="stable")
            which, first = np.unique(cluster[order], return_index=True)
            total[which] += np.add.reduceat(rows[order], first)
            count += np.bincount(cluster, minlength=len(goal))
        some = np.flatnonzero(count)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[some].ravel()), SIZE).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), sums], names=["cluster", "n", "total"])

    return run


def _assigned(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = transform(centroids)
        for batch, rows in matrices(batches):
            cluster, distance = nearest(transform(rows), goal)
            columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance // SIZE)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """Vectors of the smallest hashes of their ids."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = rows.orderBy(F.sha2(name, 256), "v").limit(clusters).collect()
    return np.array([r.v for r in found], np.int64).reshape(-1, SIZE)


def fit(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> np.ndarray:
    """Centroids of the integer vectors ``rows``; an empty cluster keeps its centroid."""
    centroids = first_centroids(rows, clusters, salt)
    if not len(centroids):
        return centroids
    for _ in range(rounds):
        parts = rows.select("v").mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
        sums = [F.sum(F.get("total", F.lit(i))) for i in range(SIZE)]
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*sums).alias("total")).collect():
            centroids[row.cluster] = [t // row.n for t in row.total]
    return centroids


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part."""
    rows = integers(vectors)
    centroids = fit(rows, clusters, rounds, salt)
    found = stored(rows.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "assigned")
    shares = found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # one row for each centroid
    inertia = sum(r.d for r in shares)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(r.cluster, r.d, inertia, names[r.cluster]) for r in shares]
    facts = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def report(vectors: DataFrame) -> DataFrame:
    return cluster(vectors)


def _sql() -> str:
    """The same by plain distances, one pair of steps for each round."""
    keeps = f"len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {keeps})""",
        f"cells AS MATERIALIZED (SELECT vec_id, unnest(range({SIZE})) AS i, unnest(v) AS x FROM kept)",
        f"""centroids_0 AS MATERIALIZED (SELECT c, unnest(range({SIZE})) AS i, unnest(v) AS x FROM (
  SELECT v, row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id)) - 1 AS c FROM kept ORDER BY c LIMIT {CLUSTERS}))""",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""near_{k} AS MATERIALIZED (SELECT vec_id, c, d FROM (
  SELECT vec_id, c, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS place FROM (
    SELECT a.vec_id, b.c, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d FROM cells a JOIN centroids_{k} b USING (i) GROUP BY 1, 2))
  WHERE place = 1)""")
        if k < ROUNDS:
            steps.append(f"""centroids_{k + 1} AS MATERIALIZED (SELECT b.c, b.i, coalesce((s - ((s % n) + n) % n) // n, b.x) AS x FROM centroids_{k} b LEFT JOIN (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM cells JOIN near_{k} USING (vec_id) GROUP BY c, i) USING (c, i))""")
    return f"""WITH {", ".join(steps)},
names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM centroids_{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM near_{ROUNDS} JOIN names USING (c)"""


SQL = _sql()
