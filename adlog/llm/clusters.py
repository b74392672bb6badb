"""Centroid clustering with the equal-average equal-variance search for the nearest centroid.

Vectors of integers, S the sum of a vector's components, n of them, V the square root of their squared deviations from their
mean. For a vector x and a centroid c,

    (Sx - Sc)^2 / n  <=  (Sx - Sc)^2 / n + (Vx - Vc)^2  <=  |x - c|^2.

Centroids are sorted by S. From the vector's own place among them the scan goes outward, the closer side first, and ends where
the first inequality rules out the closer side, and with it everything beyond. Those that the second one rules out are skipped. Only the
rest get their distance, in 64-bit integers. A centroid is ruled out only where it is worse, never where it may be as near, so
results are those of the full search.

The scan of a batch is a few array operations a step, over the vectors that still search. Sums of the vectors of each centroid leave
a task as one row for each centroid; the driver sees the centroids alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlog.llm.common import stage

SCALE = 256
#: Integer components are held within this, so that every squared distance of 64 of them is below 2^60.
MOST = 1 << 26
BATCH = 4096
#: Bounds are doubles and distances whole numbers: a centroid is ruled out if its bound is beyond the best distance by this much.
SLACK = 0.5


class Centroids:
    """Centroids ready for the search: numbers, sums and deviations in the order of their sums."""

    def __init__(self, vectors: np.ndarray):
        sums = vectors.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.vectors, self.sums = vectors[self.number], sums[self.number]
        self.spread = deviations(self.vectors)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and squared distance for each row (ties: the smaller number), and how many distances
        were worked out."""
        n, size = rows.shape
        last = len(self.sums)
        sums, spread = rows.sum(axis=1), deviations(rows)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, last)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        active, worked = np.arange(n), 0
        while len(active):
            low, high, own = left[active], right[active], sums[active]
            none = np.iinfo(np.int64).max
            below = np.where(low >= 0, own - self.sums[np.maximum(low, 0)], none)
            above = np.where(high < last, self.sums[np.minimum(high, last - 1)] - own, none)
            down = below <= above
            gap = np.where(down, below, above)
            # by the means: the closer side is worse, so all that is left is
            known = best[active] < none
            near = gap < none
            squared = gap[near].astype(np.float64) ** 2
            near[near] = ~known[near] | (squared * (1 - 1e-9) <= size * (best[active[near]] + SLACK))
            active, at, gap = active[near], np.where(down, low, high)[near], gap[near]
            down = down[near]
            left[active[down]] -= 1
            right[active[~down]] += 1
            # by the deviations: this one is worse
            bound = gap.astype(np.float64) ** 2 / size + (spread[active] - self.spread[at]) ** 2
            tried = (best[active] == none) | (bound * (1 - 1e-9) <= best[active] + SLACK)
            some, at = active[tried], at[tried]
            worked += len(some)
            apart = rows[some] - self.vectors[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            number = self.number[at]
            better = (distance < best[some]) | ((distance == best[some]) & (number < found[some]))
            best[some[better]], found[some[better]] = distance[better], number[better]
        return found, best, worked


def deviations(rows: np.ndarray) -> np.ndarray:
    """Square roots of the squared deviations from the mean."""
    return np.sqrt(((rows - rows.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)) if len(rows) else np.zeros(0)


def whole(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", size: int = 64) -> DataFrame:
    """``vec_id, v``: vectors of exactly ``size`` components, none NULL, infinite or NaN, as integers floor(256 x).

    Components beyond 2^26 count as 2^26, so that distances fit 64 bits. All other rows are left out.
    """
    value = F.col(f"`{embedding}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = vectors.where((F.size(value) == size) & ~F.exists(value, bad))
    number = lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * SCALE)))
    return kept.select(F.col(f"`{vec_id}`").alias("vec_id"), F.transform(value, lambda x: number(x).cast("int")).alias("v"))


def seed_order(vec_id: str = "vec_id") -> Column:
    """By this the first centroids are chosen."""
    return F.sha2(F.concat(F.lit("2:"), F.col(vec_id).cast("string")).cast("binary"), 256)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _sums(rows: DataFrame, centroids: Centroids, size: int) -> DataFrame:
    """cluster, n, s0 ..: of each centroid's vectors, added within tasks, then over them."""
    names = [f"s{j}" for j in range(size)]

    def add(batches):
        k = len(centroids.sums)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
        for pdf in batches:
            if len(pdf):
                values = _matrix(pdf["v"])
                cluster, _, _ = centroids.nearest(values)
                order = np.argsort(cluster, kind="stable")
                own, start = np.unique(cluster[order], return_index=True)
                sums[own] += np.add.reduceat(values[order], start, axis=0)
                counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        if len(some):
            yield pd.DataFrame({"cluster": some.astype(np.int32), "n": counts[some]} | {name: sums[some, j] for j, name in enumerate(names)})

    parts = rows.select("v").mapInPandas(add, "cluster int, n long, " + ", ".join(f"{name} long" for name in names))
    return parts.groupBy("cluster").agg(*[F.sum(name).alias(name) for name in ("n", *names)])


def fit(rows: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64) -> np.ndarray:
    """Centroids of a table ``vec_id, v`` after so many rounds; fewer than ``clusters`` where there are fewer vectors.

    Started by the vectors with the smallest hash (equal ids: the smaller vector; NULL ids last). A centroid without vectors stays.
    """
    first = rows.orderBy(seed_order().asc_nulls_last(), "v").limit(clusters).select("v").collect()
    vectors = np.array([row[0] for row in first], dtype=np.int64).reshape(len(first), size)
    for _ in range(rounds if len(first) else 0):
        for cluster, n, *sums in _sums(rows, Centroids(vectors), size).collect():  # a row for each centroid
            vectors[cluster] = [total // n for total in sums]
    return vectors


def assign(rows: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``: the nearest centroid of each vector and the squared distance."""
    centroids = Centroids(vectors)

    @F.pandas_udf("cluster int, distance long")
    def place(values: pd.Series) -> pd.DataFrame:
        if not len(values):
            return pd.DataFrame({"cluster": np.zeros(0, dtype=np.int32), "distance": np.zeros(0, dtype=np.int64)})
        cluster, distance, _ = centroids.nearest(_matrix(values))
        return pd.DataFrame({"cluster": cluster.astype(np.int32), "distance": distance})

    return rows.select("vec_id", place("v").alias("placed")).select("vec_id", "placed.*")


def clustered(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = 40, rounds: int = 5, size: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every vector that :func:`whole` keeps.

    Rows with equal ids are vectors of their own, equal vectors share their cluster, a NULL id stays NULL. Fewer vectors than
    ``clusters`` make as many centroids. Without any vector there are no rows. Other columns play no part.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    rows = stage(whole(vectors, vec_id, embedding, size), "vectors")
    found = fit(rows, clusters, rounds, size)
    placed = stage(assign(rows, found), "placed")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()  # a row for each centroid
    total = sum(row["n"] for row in sums)
    digest = [hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for v in found]
    facts = [(row["cluster"], row["n"], total, digest[row["cluster"]]) for row in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(clusters: int = 40, rounds: int = 5, size: int = 64) -> str:
    """DuckDB SQL of the query, a pair of tables for each round."""
    apart = "CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    parts = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept) ORDER BY h, v LIMIT {clusters}
)""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, split_part(best, ':', 1) AS d, CAST(split_part(best, ':', 2) AS INTEGER) AS cluster
  FROM (SELECT v.rowid AS r, any_value(v.vec_id) AS vec_id, any_value(v.v) AS v,
      arg_min({apart} || ':' || c.cluster, {apart} * 1000::HUGEINT + c.cluster) AS best
    FROM (SELECT *, row_number() OVER () AS rowid FROM kept) v, c{i} c GROUP BY v.rowid)
)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v
  FROM (SELECT cluster, place, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i})
    GROUP BY cluster, place) GROUP BY cluster
), c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (cluster)
)"""
            )
    last = f"""SELECT a.vec_id, a.cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(CAST(a.d AS BIGINT)) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(CAST(a.d AS BIGINT)) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""
    return "WITH " + ",\n".join(parts) + "\n" + last


#: DuckDB SQL of the query.
ORACLE = oracle()
