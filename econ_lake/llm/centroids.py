"""Operator 11, centroid clustering: rounds of k-means on integers, each vector assigned by Orchard's search.

Each centroid has a list of all centroids by distance.  A vector walks along the list of the best centroid so far;
a closer one found there sends it to the start of that one's list; centroids already seen are marked; the walk ends
where the list is strictly beyond twice the current distance, as no centroid behind can be as close.  The vectors of
an Arrow batch walk together.  Every round is one pass that leaves a partial sum per task and cluster; the centroids
(a few numbers whatever the input) pass through the driver.

Defined results: vectors that are null, have another number of components, or a null or non-finite one, are left
out; a null vec_id counts as empty text in the hash that picks the first centroids; ties between equal hashes go by
the components; repeated rows are vectors of their own; with fewer vectors than clusters each starts as a centroid;
an empty table gives no rows; other columns are not read.  A component beyond +-BOUND, whose squared distances a long
can't hold, is refused by an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import stored

SIZE, CLUSTERS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
BOUND = 1 << 26


def integers(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components floor(scale * x) as 4-byte integers end to end, of the vectors that are whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            whole = pc.equal(pc.fill_null(pc.list_value_length(column), -1), size)
            ids, flat = batch.column("vec_id").filter(whole), column.filter(whole).flatten()
            x = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
            finite = np.isfinite(x).all(1)
            v = np.floor(scale * x[finite])
            if (np.abs(v) > BOUND).any():
                raise ValueError(f"a component lies beyond {BOUND}: squared distances don't fit a long")
            at = np.arange(len(v) + 1, dtype=np.int32) * (4 * size)
            out = pa.Array.from_buffers(pa.binary(), len(v),
                                        [None, pa.py_buffer(at.tobytes()), pa.py_buffer(v.astype("<i4").tobytes())])
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(finite)), out], ["vec_id", "v"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, v binary")


def numbers(column: pa.Array, size: int) -> np.ndarray:
    """The rows of a column made by ``integers`` as a matrix."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], "<i4") if column.buffers()[2] is not None else np.zeros(0, "<i4")
    return data[at[0] // 4:at[-1] // 4].reshape(-1, size).astype(np.int64) if len(column) else np.zeros(
        (0, size), np.int64)


class Orchard:
    """The sorted neighbour lists of a set of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        apart = ((centroids[:, None] - centroids[None]) ** 2).sum(2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row (of equally near ones the smallest number) and its squared distance."""
        k = len(self.centroids)
        here, at = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        best = ((x - self.centroids[0]) ** 2).sum(1)
        seen = np.zeros((len(x), k), bool)
        seen[:, 0] = True
        live = np.arange(len(x))
        while len(live):
            live = live[at[live] < k]
            place = here[live], at[live]
            near = self.apart[place] <= 4 * best[live]  # squares: strictly beyond twice the distance ends the walk
            live, other = live[near], self.order[place][near]
            at[live] += 1
            new = ~seen[live, other]
            walk, other = live[new], other[new]
            seen[walk, other] = True
            far = ((x[walk] - self.centroids[other]) ** 2).sum(1)
            jump = (far < best[walk]) | ((far == best[walk]) & (other < here[walk]))
            walk = walk[jump]
            here[walk], best[walk], at[walk] = other[jump], far[jump], 0
        return here, best


def first_centroids(points: DataFrame, clusters: int, seed: int, size: int) -> np.ndarray:
    """The points with the smallest hash of seed and id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(clusters).collect()
    return np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(-1, size)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floored mean of the points nearest to each centroid; a centroid without points stays."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            x = numbers(batch.column("v"), size)
            here, _ = search.nearest(x)
            n += np.bincount(here, minlength=k)
            for c in np.unique(here):
                total[c] += x[here == c].sum(0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"])

    parts = points.select("v").mapInArrow(run, "cluster long, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]).collect()
    out = centroids.copy()
    for row in sums:
        out[row.cluster] = [int(row[f"s{i}"]) // int(row.n) for i in range(size)]
    return out


def assigned(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of each point."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            here, best = search.nearest(numbers(batch.column("v"), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(here.astype(np.int32)), pa.array(best)],
                ["vec_id", "cluster", "distance"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def fit(points: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE
        ) -> np.ndarray:
    """The final centroids of points made by ``integers``; none for an empty table."""
    centroids = first_centroids(points, clusters, seed, size)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(points, centroids)
    return centroids


def clusters(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE,
             scale: int = SCALE) -> DataFrame:
    """One row per whole vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    points = stored(integers(vectors, size, scale), "points")
    centroids = fit(points, clusters, rounds, seed, size)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return points.select("vec_id", F.lit(0).cast("long").alias("distance"), F.lit(0).alias("cluster")).join(
            spark.createDataFrame([], schema), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    rows = stored(assigned(points, centroids), "clusters")
    each = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    told = [(c, each[c], sum(each.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode())
             .hexdigest()) for c in sorted(each)]
    return rows.join(F.broadcast(spark.createDataFrame(told, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
