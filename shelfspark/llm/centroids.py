"""Centroid clustering that skips most distances by bounds which geometric drift tightening keeps close.

Every vector carries a lower bound of its distance to all centroids but its own. When the centroids move, the bound must
be loosened by as much as another centroid may have come nearer. The distance that it moved is one such amount,
but the vectors of a cluster lie in a sphere around their centroid, and from there a move looks shorter: for a move from p
to q with middle m, |x-p| - |x-q| is at most |p-q| times the cosine of the angle at m between x and the move. In the
plane through p, q and the sphere's centre that cosine is largest on the sphere's rim, at its angle less the angle
the radius takes up. A move away from the sphere costs nothing.

A vector whose own centroid is nearer than the loosened bound keeps its cluster; the others (ambiguous ones, ties
included) are compared with all centroids. Distances are exact integers; bounds are doubles with a margin, so
they only decide what needs no comparison.

One pass over the vectors assigns them and is written; one aggregate over what was written gives sums, counts and radii
per cluster. Only centroids (clusters x components) and radii reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import kept_table
from shelfspark.llm.hashing import tidy

CLUSTERS = 16
SIZE = 64
SCALE = 64
ROUNDS = 3
LARGEST = 1 << 27  # of a component: squared distances of 64 such components fit a long
MARGIN = 1e-9
SLICE = 4096


@dataclass(frozen=True)
class Moved:
    """What an assignment pass needs: the centroids and, after a move, by how much each cluster's bounds loosen."""
    centroids: np.ndarray
    loosen: np.ndarray | None = None


def whole_vectors(df: DataFrame, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``df`` with ``point``, the components as integers floor(scale * x); rows whose vector is null, has another length, or a
    null, non-finite or too large component (integer beyond 2^27: distances would not fit a long) are left out."""
    x = F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fine = (F.size(vector) == size) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) <= LARGEST / scale))
    return df.filter(F.coalesce(fine, F.lit(False))).withColumn("point", F.transform(x, lambda v: v.cast("int")))


def loosening(before: np.ndarray, after: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Per cluster an upper bound of how much nearer any other centroid has come to a vector within the cluster's sphere.

    ``before`` and ``after`` are the centroids, ``radii`` the spheres' radii around the centroids before the move.
    """
    out = np.zeros(len(before))
    for i, (centre, radius) in enumerate(zip(before, radii)):
        for j, (p, q) in enumerate(zip(before, after)):
            drift = float(np.linalg.norm(q - p))
            if j == i or drift == 0:
                continue
            to_sphere = centre - (p + q) / 2
            away = float(np.linalg.norm(to_sphere))
            bound = drift
            if away > radius:
                angle = np.arccos(np.clip(to_sphere @ (q - p) / (away * drift), -1, 1)) - np.arcsin(min(1.0, radius / away))
                bound = drift * max(0.0, float(np.cos(max(0.0, angle))))
            out[i] = max(out[i], min(drift, bound + MARGIN * (drift + away)))
    return out


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (exact integers) of points to all centroids."""
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _assigned(points: np.ndarray, cluster: np.ndarray | None, low: np.ndarray | None, moved: Moved) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster, squared distance and lower bound of every point, and how many were compared with all centroids."""
    centroids = moved.centroids
    if cluster is None:
        cluster, distance, low = np.zeros(len(points), np.int32), np.zeros(len(points), np.int64), np.zeros(len(points))
        scan = np.arange(len(points))
    else:
        cluster = cluster.copy()
        distance = ((points - centroids[cluster]) ** 2).sum(axis=1)
        low = low - moved.loosen[cluster]
        near = np.sqrt(distance.astype(np.float64))
        scan = np.flatnonzero(near * (1 + MARGIN) + MARGIN >= low)
    for a in range(0, len(scan), SLICE):
        some = scan[a:a + SLICE]
        d = _distances(points[some], centroids)
        own = d.argmin(axis=1)  # the first of equal ones
        cluster[some], distance[some] = own, d[np.arange(len(some)), own]
        d[np.arange(len(some)), own] = np.iinfo(np.int64).max
        low[some] = np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - MARGIN)
    return cluster, distance, low, len(scan)


def _assign(rows: DataFrame, key: str, moved: Moved) -> DataFrame:
    """key, point, cluster, distance, low, scanned of every row, under the moved centroids (written)."""
    sent = rows.sparkSession.sparkContext.broadcast(moved)
    first = moved.loosen is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = batch["point"].flatten().to_numpy().reshape(len(batch), -1).astype(np.int64)
            cluster, low = (None, None) if first else (batch["cluster"].to_numpy(), batch["low"].to_numpy())
            cluster, distance, low, n = _assigned(points, cluster, low, sent.value)
            scanned = np.zeros(len(batch), np.int32)
            scanned[0] = n
            yield pa.RecordBatch.from_arrays([batch["key"], batch["point"], pa.array(cluster, pa.int32()), pa.array(distance), pa.array(low), pa.array(scanned)],
                                             ["key", "point", "cluster", "distance", "low", "scanned"])

    source = rows.select(F.col(key).alias("key"), "point", *([] if first else ["cluster", "low"]))
    schema = source.select("key", "point").schema.add("cluster", "integer").add("distance", "long").add("low", "double").add("scanned", "integer")
    return kept_table(source.mapInArrow(tidy(run), schema), "assigned")


def _sums(assigned: DataFrame) -> dict[int, tuple[int, int, dict[int, int]]]:
    """Per cluster the number of vectors, the largest squared distance and the sum of each component: partial sums per task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            if not len(batch):
                continue
            points = batch["point"].flatten().to_numpy().reshape(len(batch), -1).astype(np.int64)
            cluster, distance = batch["cluster"].to_numpy(), batch["distance"].to_numpy()
            for c in np.unique(cluster).tolist():
                own = cluster == c
                now = total.setdefault(c, [0, 0, np.zeros(points.shape[1], np.int64)])
                now[0] += int(own.sum())
                now[1] = max(now[1], int(distance[own].max()))
                now[2] += points[own].sum(axis=0)
        for c, (n, far, sums) in total.items():
            k = len(sums)
            yield pa.RecordBatch.from_arrays([pa.array([c] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([n] * k, pa.int64()),
                                              pa.array([far] * k, pa.int64()), pa.array(sums)], ["cluster", "place", "n", "far", "total"])

    parts = assigned.select("cluster", "distance", "point").mapInArrow(tidy(run), "cluster int, place int, n long, far long, total long")
    rows = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, int, dict[int, int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], r["far"], {}))[2][r["place"]] = int(r["total"])
    return out


def first_centroids(rows: DataFrame, key: str, clusters: int) -> np.ndarray:
    """The points whose ``1:<key>`` has the smallest SHA-256, in ascending order of it (a null key hashes as the empty text;
    rows of one key in order of their points)."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    got = rows.select(order.alias("h"), "point").orderBy("h", "point").limit(clusters).collect()
    return np.array([r["point"] for r in got], np.int64)


def cluster_vectors(df: DataFrame, key: str, vector: str, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE,
                    scale: int = SCALE) -> tuple[DataFrame, np.ndarray, list[int]]:
    """key, point, cluster, distance, low, scanned of every whole vector; the last centroids; and how many vectors each pass compared with all centroids.

    Fewer vectors than clusters give as many centroids as vectors; without any, the result is empty.
    """
    rows = kept_table(whole_vectors(df.select(F.col(key), F.col(vector)), vector, size, scale).select(key, "point"), "points")
    centroids = first_centroids(rows, key, clusters)
    if not len(centroids):
        empty = rows.select(F.col(key).alias("key"), "point", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"), F.lit(0.0).alias("low"), F.lit(0).alias("scanned"))
        return empty, centroids, []
    moved, now, scans = Moved(centroids), rows.withColumnRenamed(key, "key"), []
    for _ in range(rounds):
        now = _assign(now, "key", moved)
        scans.append(now.agg(F.sum("scanned").alias("n")).first()["n"])
        sums = _sums(now)
        after = centroids.copy()
        radii = np.zeros(len(centroids))
        for c, (n, far, total) in sums.items():
            after[c] = [total[k] // n for k in range(len(total))]
            radii[c] = np.sqrt(float(far)) * (1 + MARGIN)
        moved = Moved(after, loosening(centroids.astype(float), after.astype(float), radii))
        centroids = after
    now = _assign(now, "key", moved)
    scans.append(now.agg(F.sum("scanned").alias("n")).first()["n"])
    return now, centroids, scans


def cluster_report(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every whole vector.

    Null vectors, vectors of another length and those with a null, non-finite or too large component are no whole
    vectors (see ``whole_vectors``) and have no row. Repeated rows are vectors of their own; a null id stays null; other
    columns are left out; an empty table gives an empty result.
    """
    rows, centroids, _ = cluster_vectors(df, key, vector)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = df.sparkSession.createDataFrame([(c, per_cluster[c], sum(per_cluster.values()), names[c]) for c in sorted(per_cluster)],
                                            "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> str:
    """DuckDB SQL of ``cluster_report`` over embeddings: every vector is compared with every centroid in each round."""
    parts = [f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) > {LARGEST // scale})) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, p) - 1 AS c, p FROM (
    SELECT p, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, p LIMIT {clusters}))"""]
    for k in range(rounds + 1):
        parts.append(f"""d{k} AS (SELECT rid, c, list_sum(list_transform(range(1, {size + 1}), lambda i: (v.p[i] - c{k}.p[i]) * (v.p[i] - c{k}.p[i]))) AS d FROM v CROSS JOIN c{k}),
a{k} AS (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{k} GROUP BY rid)""")
        if k < rounds:
            parts.append(f"""m{k} AS (SELECT c, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS p FROM (
    SELECT c, i, sum(p[i]) - ((sum(p[i]) % count(*)) + count(*)) % count(*) AS s, count(*) AS n FROM a{k} JOIN v USING (rid) CROSS JOIN range(1, {size + 1}) t(i) GROUP BY c, i) GROUP BY c),
c{k + 1} AS (SELECT c, coalesce(m{k}.p, c{k}.p) AS p FROM c{k} LEFT JOIN m{k} USING (c))""")
    return ",\n".join(parts).strip() + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.p, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c) JOIN v USING (rid)"""
