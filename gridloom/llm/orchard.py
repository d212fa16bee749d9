"""Centroid clustering on integers, every assignment by Orchard's search.

Each centroid has the list of all others by distance. A vector starts at one centroid and goes down its list;
as soon as a closer one is met the search goes on at the top of that one's list, no centroid is measured twice,
and it stops where the list lies strictly beyond twice the current distance (squared: four times), as nothing
behind can be closer or equal. Ties go to the smaller number. All of a batch's vectors search in step.

A round is one pass: tasks send one sum per cluster and component, Spark adds them up exactly, and only
clusters x components numbers come to the driver.

Defined results: vectors with another number of components, with null or non-finite ones, or with one of absolute
value 2^18 or more (2^24 as an integer: sums of squares stay exact in 64 bits) are left out. Fewer vectors than
clusters give fewer clusters, none gives no rows. A null id is never drawn as a start. Equal ids are all kept, each row
its own vector; among equal hashes the smaller components are drawn. A sum beyond 64 bits is null. Columns other than
the id are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored

CLUSTERS, ROUNDS, SIZE, SCALE, SEED = 16, 3, 64, 64, 1
LARGEST = float(1 << 18)


def kept(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", size: int = SIZE) -> DataFrame:
    """(id, v) of the vectors that count, v ARRAY<DOUBLE>."""
    v = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < LARGEST))
    return v.where((F.size("v") == size) & F.coalesce(fine, F.lit(False)))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED, scale: int = SCALE) -> np.ndarray:
    """The vectors of least hash, as integers; one row each."""
    hashed = vectors.where("id is not null").select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("hash"), "v")
    rows = hashed.orderBy("hash", "v").limit(clusters).collect()
    return np.floor(scale * np.array([r["v"] for r in rows], float)).astype(np.int64)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the others by squared distance (ties by number), and these distances."""
    gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    lists = np.array([[j for j in np.argsort(row, kind="stable") if j != i] for i, row in enumerate(gaps)], dtype=np.int64).reshape(len(gaps), -1)
    return lists, np.take_along_axis(gaps, lists, axis=1)


def search(x: np.ndarray, centroids: np.ndarray, lists: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid and squared distance of each row of x."""
    total, others = len(x), lists.shape[1]
    at = np.zeros(total, np.int64)
    best = ((x - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((total, len(centroids)), bool)
    visited[:, 0] = True
    spot = np.zeros(total, np.int64)
    live = np.arange(total) if others else np.zeros(0, np.int64)
    while len(live):
        live = live[gaps[at[live], spot[live]] <= 4 * best[live]]
        other = lists[at[live], spot[live]]
        spot[live] += 1
        new = ~visited[live, other]
        row, other = live[new], other[new]
        visited[row, other] = True
        distance = ((x[row] - centroids[other]) ** 2).sum(axis=1)
        closer = (distance < best[row]) | ((distance == best[row]) & (other < at[row]))
        row = row[closer]
        at[row], best[row], spot[row] = other[closer], distance[closer], 0
        live = live[spot[live] < others]
    return at, best


def _integers(batch: pa.RecordBatch, size: int, scale: int) -> np.ndarray:
    return np.floor(scale * batch.column("v").flatten().to_numpy().reshape(-1, size)).astype(np.int64)


def assigned(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    lists, gaps = neighbour_lists(centroids)
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, distance = search(_integers(batch, size, scale), centroids, lists, gaps)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Centroids after one round: exact floors of means, empty clusters as they were."""
    lists, gaps = neighbour_lists(centroids)
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _integers(batch, size, scale)
            at, _ = search(x, centroids, lists, gaps)
            for c in np.unique(at):
                sums[c] += x[at == c].sum(axis=0)
            counts += np.bincount(at, minlength=k)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there.astype(np.int32)), pa.array(counts[there]), pa.array(list(sums[there]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster int, n bigint, sums array<bigint>").select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    added = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    new = centroids.copy()
    for row in added.collect():
        new[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return new


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    size: int = SIZE, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """Per vector: id, cluster, distance, cluster_inertia, inertia, centroid (its components)."""
    source = kept(vectors, id_col, vector, size)
    spark = vectors.sparkSession
    centroids = starts(source, clusters, seed, scale)
    if not len(centroids):
        none = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid": "array<bigint>"}
        return source.where("false").select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    for _ in range(rounds):
        centroids = moved(source, centroids, scale)
    rows = stored(assigned(source, centroids, scale))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(exact.alias("s")).collect()}
    longs = lambda x: int(x) if x < 1 << 63 else None
    total = longs(sum(sums.values()))
    known = spark.createDataFrame(
        [(c, longs(s), total, centroids[c].tolist()) for c, s in sorted(sums.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return rows.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(clustered: DataFrame) -> DataFrame:
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return clustered.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")
