"""Centroid clustering (Lloyd's rounds) in integers, filtered in PCA-rotated coordinates.

Components become integers once. The covariance of all vectors gives a
rotation; every vector is stored with its leading rotated coordinates and the
norm of what they leave out. For a centroid treated alike, squared distance of
the leading parts plus the squared difference of the two residual norms is never
more than the squared distance, so a centroid whose bound lies above an exact
distance already found is out. All others are measured exactly in integers, so
the rotation changes the work and never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import table
from tickweek.session import drop_stored, stored

SIZE = 64  # components of a vector
SCALE = 1024  # an integer component is floor(SCALE * x)
CLUSTERS = 8
ROUNDS = 10
LEADING = 16  # rotated coordinates that are stored
# Integer components lie within +-LARGEST: then a squared distance of up to 64
# components fits a long. A larger component is an error, never a wrong number.
LARGEST = 1 << 27
# Bounds are lowered by this share of the two squared norms, far above rounding.
SLACK = 1e-6


def integer_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``(key, vec)`` of the rows whose ``column`` has ``size`` components, none NULL, NaN or infinite; ``vec`` are integers."""
    x = F.col(f"`{column}`").cast("array<double>")
    usable = (F.size(x) == size) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    too_large = F.raise_error(F.lit(f"a component beyond {LARGEST / scale}")).cast("int")
    whole = F.transform(x, lambda v: F.when(F.abs(v * scale) <= LARGEST, F.floor(v * scale).cast("int")).otherwise(too_large))
    return vectors.where(usable).select(F.col(f"`{key}`").alias(key), whole.alias("vec"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _packed(column: pa.Array, dtype: str, size: int) -> np.ndarray:
    """Rows of a binary column of equal lengths, without a copy."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(-1, size)


@dataclass
class Rotation:
    """The mean of all vectors and the directions of their largest variances, one per column."""

    mean: np.ndarray
    axes: np.ndarray

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and residual norm of each row."""
        centred = x - self.mean
        lead = centred @ self.axes
        rest = (centred * centred).sum(1) - (lead * lead).sum(1)
        return lead, np.sqrt(np.maximum(rest, 0))


def rotation(vectors: DataFrame, size: int = SIZE, leading: int = LEADING) -> Rotation:
    """Principal axes of all of ``vectors`` (key, vec); one matrix of fixed size per task is added up in Spark."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            x = np.hstack([_matrix(batch["vec"], size).astype(np.float64), np.ones((batch.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), *[pa.array(c) for c in total.T]], names)

    names = ["line", *[f"c{i}" for i in range(size + 1)]]
    kind = ", ".join(["line int", *[f"{n} double" for n in names[1:]]])
    lines = vectors.select("vec").mapInArrow(gather, kind).groupBy("line").agg(*[F.sum(n).alias(n) for n in names[1:]])
    total = np.zeros((size + 1, size + 1))
    for r in lines.collect():  # size + 1 rows
        total[r.line] = r[1:]
    n = max(total[size, size], 1.0)
    mean = total[size, :size] / n
    _, axes = np.linalg.eigh(total[:size, :size] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def features(vectors: DataFrame, turn: Rotation, size: int = SIZE) -> DataFrame:
    """``(key, vec, lead, rest)``: integers, leading rotated coordinates (both packed) and residual norm."""
    key = vectors.columns[0]
    schema = T.StructType(
        [vectors.schema[key], T.StructField("vec", T.BinaryType()), T.StructField("lead", T.BinaryType()), T.StructField("rest", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["vec"], size)
            lead, rest = turn.parts(x)
            whole = [r.tobytes() for r in x.astype("<i4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(whole, pa.binary()), pa.array([r.tobytes() for r in lead.astype("<f8")], pa.binary()), pa.array(rest)], schema.names
            )

    return vectors.mapInArrow(run, schema)


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, turn: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row (ties: the smaller number) and the squared distance, both exact."""
    their_lead, their_rest = turn.parts(centroids.astype(np.float64))
    own, their = (lead * lead).sum(1), (their_lead * their_lead).sum(1)
    bound = own[:, None] + their - 2 * lead @ their_lead.T + (rest[:, None] - their_rest) ** 2
    bound -= SLACK * ((own + rest * rest)[:, None] + their + their_rest * their_rest) + 1e-6

    def exact(rows: np.ndarray | slice, numbers: np.ndarray) -> np.ndarray:
        apart = x[rows] - centroids[numbers]
        return (apart * apart).sum(1)

    cluster = bound.argmin(1)
    distance = exact(slice(None), cluster)
    for j in range(len(centroids)):
        rows = np.flatnonzero((bound[:, j] <= distance) & (cluster != j))
        if len(rows):
            d = exact(rows, np.full(len(rows), j))
            better = (d < distance[rows]) | ((d == distance[rows]) & (j < cluster[rows]))
            cluster[rows[better]], distance[rows[better]] = j, d[better]
    return cluster, distance


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, turn: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = centroids.shape[1]
    x = _packed(batch["vec"], "<i4", size).astype(np.int64)
    lead = _packed(batch["lead"], "<f8", turn.axes.shape[1])
    return x, *nearest(x, lead, batch["rest"].to_numpy(zero_copy_only=False), centroids, turn)


def moved(rows: DataFrame, centroids: np.ndarray, turn: Rotation) -> np.ndarray:
    """The centroids after one round: componentwise floor of the mean of their vectors; one without any stays."""
    size = centroids.shape[1]
    names = ["cluster", "n", *[f"s{i}" for i in range(size)]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x, cluster, _ = _assigned(batch, centroids, turn)
            counts += np.bincount(cluster, minlength=len(centroids))
            for j in range(len(centroids)):
                sums[j] += x[cluster == j].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(counts), *[pa.array(c) for c in sums.T]], names)

    kind = ", ".join(["cluster int", *[f"{n} bigint" for n in names[1:]]])
    total = rows.select("vec", "lead", "rest").mapInArrow(add, kind).groupBy("cluster").agg(*[F.sum(n).alias(n) for n in names[1:]])
    out = centroids.copy()
    for r in total.collect():  # a row per centroid
        if r.n:
            out[r.cluster] = [s // r.n for s in r[2:]]
    return out


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose id has the smallest sha256 of ``seed:id``, in that order (equal ids: by their integers)."""
    key = vectors.columns[0]
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    return [r.vec for r in vectors.select(mark.alias("mark"), "vec").orderBy("mark", "vec").limit(clusters).collect()]


def cluster_vectors(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: int = 3, scale: int = SCALE, leading: int = LEADING,
) -> DataFrame:
    """One row per usable vector: ``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    A NULL vector, one of another length and one with a NULL, NaN or infinite
    component give no row; a component too large for exact longs is an error.
    Every row counts, so repeated rows and ids weigh as often as they occur; a
    NULL id counts as the empty text when the first centroids are chosen. With
    fewer usable vectors than ``clusters`` there are as many centroids as
    vectors; with none there are no rows. Equal distances go to the smaller
    number. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, key, column, size, scale)
    start = first_centroids(whole, clusters, seed)
    kind = T.StructType([whole.schema[key], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not start:
        none = whole.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.withColumns({"cluster_inertia": F.lit(0).cast("long"), "inertia": F.lit(0).cast("long"), "centroid_sha256": F.lit("")})
    centroids = np.array(start, np.int64)
    turn = rotation(whole, size, leading)
    rows = stored(features(whole, turn, size), "rotated-vectors")
    for _ in range(rounds):
        before, centroids = centroids, moved(rows, centroids, turn)
        if (before == centroids).all():  # every further round would give the same
            break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = _assigned(batch, centroids, turn)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], kind.names)

    placed = stored(rows.mapInArrow(run, kind), "clustered-vectors")
    drop_stored(rows)
    sums = {r.cluster: r.inertia for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # a row per centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = [(j, sums[j], sum(sums.values()), digest[j]) for j in sums]
    small = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(small), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))
