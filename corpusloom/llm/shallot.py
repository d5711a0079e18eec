"""Centroid clustering of quantised vectors: Lloyd's rounds with a Shallot search in place of full scans.

A vector carries, from round to round, its centroid, the second-nearest one, an upper bound of its distance to the first and
a lower bound of that to all others. After the centroids move, the bounds move by as much. Where the upper bound is still
below the lower one, nothing else is looked at. Otherwise the vector is measured against its two remembered centroids and
the scan starts from the closer one: its fellow centroids come in order of their distance to it, and the scan ends at the
first outside the ball of radius (own distance + second-best distance so far), which shrinks as better ones turn up.

Bounds are doubles and only skip what they exclude by a margin; whatever is compared is compared as exact integers, so ties
go to the smaller number and the result is that of a full scan. A round is one pass over the written table of vectors with
their bounds; the k centroids travel to it, and one row of sums a cluster and task comes back.

Defined cases: vectors that are null, of another length or hold null, NaN or infinite components are left out; the initial
centroids are the vectors whose hashed id is smallest, equal ids by their components, fewer than k where fewer are kept; a
null vec_id hashes like the text 'null'; repeated rows are vectors of their own; a scaled component beyond 2**26 raises,
because squared distances would leave 64 bits; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

SIZE, SCALE, K, ROUNDS = 64, 64, 16, 3
LARGEST = 1 << 26
ROWS = 4096  # vectors worked on at once in a task
MARGIN = 1e-9


def quantised(table: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors that count, as integers."""
    e = F.col("embedding")
    whole = (F.size(e) == size) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    def scaled(x):
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) <= LARGEST, y).otherwise(F.raise_error(F.lit(f"a scaled component is beyond {LARGEST}")).cast("bigint")).cast("int")
    return table.where(F.coalesce(whole, F.lit(False))).select("vec_id", F.transform(e, scaled).alias("v"))


def first_centroids(points: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors with the smallest hash of their id."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = points.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


class Ball:
    """Distances among the centroids, each one's fellows in order of distance, and how far each has moved."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        c = centroids.astype(np.float64)
        self.c, self.k = centroids, len(centroids)
        apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.order = np.array([[j for j in row if j != i] for i, row in enumerate(self.order)], np.int64).reshape(self.k, self.k - 1)
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.moved = np.zeros(self.k) if before is None else np.sqrt(((c - before) ** 2).sum(1))
        self.others = np.array([np.delete(self.moved, i).max(initial=0.0) for i in range(self.k)])

    def exact(self, x: np.ndarray, j: np.ndarray) -> np.ndarray:
        gap = x - self.c[j]
        return np.einsum("ij,ij->i", gap, gap)

    def assign(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray, measure: bool):
        """(a, b, upper, lower, distances, centroids compared): the same arrays brought up to date with these centroids.

        The exact distances are only whole with ``measure``; else they are those of the vectors that had to be looked at.
        """
        upper = (upper + self.moved[a]) * (1 + MARGIN)
        lower = np.maximum(0, lower - self.others[a]) * (1 - MARGIN)
        distance = np.full(len(x), -1)
        look = np.flatnonzero(~(upper < lower)) if self.k > 1 else np.zeros(0, np.int64)
        compared = 0
        if len(look):
            now, mine, other = x[look], a[look], b[look]
            d = self.exact(now, mine)
            distance[look] = d
            upper[look] = np.sqrt(d) * (1 + MARGIN)
            still = ~(upper[look] < lower[look])
            look, now, mine, other, d = look[still], now[still], mine[still], other[still], d[still]
            compared += 2 * len(look) + int((~still).sum())
            d2 = self.exact(now, other)
            swap = (d2 < d) | ((d2 == d) & (other < mine))
            best, second = np.where(swap, other, mine), np.where(swap, mine, other)
            d, d2 = np.where(swap, d2, d), np.where(swap, d, d2)
            start, reach, known = best.copy(), np.sqrt(d), second.copy()
            going = np.arange(len(look))
            for rank in range(self.k - 1):
                at = start[going]
                inside = self.apart[at, rank] * (1 - MARGIN) <= (reach[going] + np.sqrt(d2[going])) * (1 + MARGIN)
                going = going[inside]
                if not len(going):
                    break
                j = self.order[start[going], rank]
                asked = j != known[going]
                g, j = going[asked], j[asked]
                dj = self.exact(now[g], j)
                compared += len(g)
                nearer = (dj < d[g]) | ((dj == d[g]) & (j < best[g]))
                between = ~nearer & (dj < d2[g])
                n, m = g[nearer], g[between]
                second[n], d2[n] = best[n], d[n]
                best[n], d[n] = j[nearer], dj[nearer]
                second[m], d2[m] = j[between], dj[between]
            a, b = a.copy(), b.copy()
            a[look], b[look], distance[look] = best, second, d
            upper[look], lower[look] = np.sqrt(d), np.sqrt(d2)
        if measure:
            rest = np.flatnonzero(distance < 0)
            distance[rest] = self.exact(x[rest], a[rest])
            compared += len(rest)
        return a, b, upper, lower, distance, compared


STATE = "vec_id bigint, v array<int>, cluster int, second int, upper double, lower double, distance bigint"


def assigned(state: DataFrame, ball: Ball, measure: bool = False) -> DataFrame:
    """The vectors with centroid, second-nearest one and bounds for the centroids of ``ball``."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                v = batch.column("v")
                x = v.flatten().to_numpy().reshape(len(v), -1).astype(np.int64)
                old = [batch.column(c).to_numpy() for c in ("cluster", "second", "upper", "lower")]
                a, b, upper, lower, distance, _ = ball.assign(x, *old, measure)
                columns = [pa.array(c, t) for c, t in zip((a, b, upper, lower, distance), (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), v, *columns], names=["vec_id", "v", "cluster", "second", "upper", "lower", "distance"])

    return state.mapInArrow(run, STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster's vectors; a cluster without vectors keeps its centroid."""
    sums = [F.sum(F.col("v")[i].cast("bigint")).alias(f"s{i}") for i in range(centroids.shape[1])]
    out = centroids.copy()
    for r in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # at most k rows
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(centroids.shape[1])]
    return out


def cluster(table: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vectors with cluster and distance, final centroids) after ``rounds`` rounds and a last assignment."""
    points = materialise(quantised(table, size, scale), "shallot-points")
    centroids = first_centroids(points, k)
    nothing = [F.lit(0).alias("cluster"), F.lit(min(1, len(centroids) - 1)).alias("second"), F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower")]
    state, before = points.select("*", *nothing, F.lit(-1).cast("bigint").alias("distance")), None
    if not len(centroids):
        return state, centroids
    for _ in range(rounds):
        state = materialise(assigned(state, Ball(centroids, before)), "shallot-state")
        before, centroids = centroids, means(state, centroids)
    return materialise(assigned(state, Ball(centroids, before), measure=True), "shallot-state"), centroids


def cluster_digest(table: DataFrame, **params) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia and the hash of its final centroid."""
    vectors, centroids = cluster(table, **params)
    sums = {r["cluster"]: r["s"] for r in vectors.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # at most k rows
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(j, s, sum(sums.values()), digest(centroids[j])) for j, s in sums.items()]
    tail = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return vectors.join(F.broadcast(tail), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round(t: int) -> str:
    """SQL of one assignment (a{t}) and, for all but the last, of the centroids that follow (c{t + 1})."""
    out = f""",
a{t} AS (SELECT k.r, k.vec_id, k.v, c.c, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM k, c{t} c
  QUALIFY row_number() OVER (PARTITION BY k.r ORDER BY d, c.c) = 1)"""
    if t == ROUNDS:
        return out
    return out + f""",
m{t} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{t}, range(1, {SIZE + 1}) t(i) GROUP BY c, i) GROUP BY c),
c{t + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m ON m.c = c.c)"""


SQL = f"""WITH k AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INT) AS c, v FROM k QUALIFY row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) <= {K})""" + "".join(map(_round, range(ROUNDS + 1))) + f"""
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.c = c.c"""
