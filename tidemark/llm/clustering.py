"""Exact k-means over integer vectors, with bounds that spare most distances.

Every vector keeps its nearest and its second-nearest centroid, an upper bound
of its distance to the first and a lower bound of the distance to all others.
While the bounds are apart after the centroids moved, the vector stays where it
is. Otherwise the search starts at the closer of the two remembered centroids
and goes through that one's neighbours, nearest first. A centroid that is no
farther from the vector than the second-best so far lies within the ball around
the start whose radius is the distance to the start plus that second-best
distance; the ball shrinks with every better one, and the scan ends with the
first neighbour outside. Bounds are floating point with a margin; what decides,
ties included, is the squared distance in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.runtime import ship_code, stored_at
from tidemark.session import drop_folder

#: Components under this keep every squared distance of up to 128 components under 2**63.
LARGEST = 1 << 27
#: Vectors that are searched at a time.
SEARCH_ROWS = 4096
#: Rounding of square roots and of sums of them is far below this share.
MARGIN = 1e-9


@dataclass
class Centroids:
    """``k`` centroids, which of them are near each other, and how far each moved last."""

    points: np.ndarray  #: int64, k x dim
    moved: np.ndarray  #: float64, k

    def __post_init__(self):
        apart = self.points[:, None, :] - self.points[None, :, :]
        self.apart = np.sqrt((apart * apart).sum(axis=2, dtype=np.float64)) * (1 - MARGIN)
        self.neighbours = np.argsort(self.apart, axis=1, kind="stable")
        order = np.argsort(self.moved)
        most, next_most = order[-1], order[-2] if len(order) > 1 else order[-1]
        #: for each centroid, the farthest that any other one moved
        self.others_moved = np.full(len(self.moved), self.moved[most])
        self.others_moved[most] = self.moved[next_most]

    @classmethod
    def start(cls, points: np.ndarray) -> Centroids:
        return cls(points, np.full(len(points), np.inf))

    def after(self, points: np.ndarray) -> Centroids:
        step = points - self.points
        return Centroids(points, np.sqrt((step * step).sum(axis=1, dtype=np.float64)) * (1 + MARGIN))


def _squared(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    step = x - point
    return np.einsum("ij,ij->i", step, step)


def assign(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids) -> None:
    """Bring nearest and second-nearest centroid and both bounds of vectors ``x`` up to date, in place.

    Of equally near centroids the one with the smaller number is the nearest.
    """
    k = len(c.points)
    if k == 1:
        near[:], second[:] = 0, 0
        return
    upper += c.moved[near]
    with np.errstate(invalid="ignore"):
        lower -= c.others_moved[near]
    unsure = np.flatnonzero(~(upper * (1 + MARGIN) < lower))
    for at in range(0, len(unsure), SEARCH_ROWS):
        rows = unsure[at : at + SEARCH_ROWS]
        to_near = _squared(x[rows], c.points[near[rows]])
        upper[rows] = np.sqrt(to_near) * (1 + MARGIN)
        still = ~(upper[rows] < lower[rows])
        _search(x, rows[still], to_near[still], near, second, upper, lower, c)


def _search(x, rows, to_near, near, second, upper, lower, c: Centroids) -> None:
    """The shrinking-ball search for vectors ``rows``, whose distance to their centroid is known."""
    a, b = near[rows], second[rows]
    to_second = _squared(x[rows], c.points[b])
    swap = (to_second < to_near) | ((to_second == to_near) & (b < a))
    best, other = np.where(swap, b, a), np.where(swap, a, b)
    d1, d2 = np.where(swap, to_second, to_near), np.where(swap, to_near, to_second)
    start, from_start = best.copy(), np.sqrt(d1)
    for s in np.unique(start):
        live = np.flatnonzero(start == s)
        for centroid in c.neighbours[s]:
            live = live[c.apart[s, centroid] <= (from_start[live] + np.sqrt(d2[live])) * (1 + MARGIN)]
            if not len(live):
                break
            if centroid == s:
                continue
            asked = live[other[live] != centroid]
            d = _squared(x[rows[asked]], c.points[centroid])
            first = (d < d1[asked]) | ((d == d1[asked]) & (centroid < best[asked]))
            won = asked[first]
            other[won], d2[won] = best[won], d1[won]
            best[won], d1[won] = centroid, d[first]
            nearer = ~first & (d < d2[asked])
            other[asked[nearer]], d2[asked[nearer]] = centroid, d[nearer]
    near[rows], second[rows] = best, other
    upper[rows], lower[rows] = np.sqrt(d1) * (1 + MARGIN), np.sqrt(d2) * (1 - MARGIN)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: float) -> DataFrame:
    """``id`` and ``point`` (binary, little-endian 32-bit integers, ``floor(scale * x)``) of the vectors that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            whole = np.flatnonzero(np.asarray(column.value_lengths().fill_null(-1)) == dim)
            picked = column.take(pa.array(whole))
            values = picked.flatten()
            x = np.asarray(values.fill_null(np.nan) if values.null_count else values, np.float64).reshape(-1, dim)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(x * scale)
            good = (np.abs(scaled) < LARGEST).all(axis=1)
            points = scaled[good].astype("<i4")
            raw = points.tobytes()
            width = 4 * dim
            cut = [raw[i : i + width] for i in range(0, len(raw), width)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(whole[good])), pa.array(cut, pa.binary())], ["id", "point"])

    plain = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return plain.mapInArrow(run, T.StructType().add(plain.schema["id"]).add("point", "binary"))


def _points(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)


def _assigned(state: DataFrame, centroids: Centroids, dim: int, last: bool) -> DataFrame:
    """``state`` after one assignment; with ``last`` the exact squared distance instead of the bounds."""
    held = state.sparkSession.sparkContext.broadcast(centroids)
    fresh = "near" not in state.columns
    carried = ["near", "second", "upper", "lower"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        for batch in batches:
            x, n = _points(batch.column("point"), dim), batch.num_rows
            if fresh:
                near, second = np.zeros(n, np.int32), np.full(n, min(1, len(c.points) - 1), np.int32)
                upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
            else:
                near, second, upper, lower = (np.array(batch.column(name)) for name in carried)
            assign(x, near, second, upper, lower, c)
            kept = [batch.column("id")]
            if last:
                out = [*kept, pa.array(near), pa.array(_squared(x, c.points[near]))]
            else:
                out = [*kept, batch.column("point"), *map(pa.array, (near, second, upper, lower))]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = T.StructType().add(state.schema["id"])
    if last:
        schema = schema.add("cluster", "integer").add("distance", "long")
    else:
        schema = schema.add("point", "binary").add("near", "integer").add("second", "integer").add("upper", "double").add("lower", "double")
    names = schema.names
    return state.mapInArrow(run, schema)


def _means(state: DataFrame, centroids: Centroids, dim: int) -> np.ndarray:
    """Floors of the componentwise means; a centroid without vectors stays.

    A task sends on one sum per centroid and component; only these sums, whose
    number does not depend on the rows, reach the driver.
    """
    k = len(centroids.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, near = _points(batch.column("point"), dim), np.asarray(batch.column("near"))
            for c in np.unique(near):
                mine = near == c
                sums[c] += x[mine].sum(axis=0)
                counts[c] += mine.sum()
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = state.select("near", "point").mapInArrow(run, "cluster int, n long, sums array<long>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    total = cells.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    points = centroids.points.copy()
    for r in total.collect():
        points[r.cluster, r.place] = int(r.total) // r.n
    return points


def first_centroids(vectors: DataFrame, k: int, dim: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<id>``, in that order; null ids come last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(mark.alias("mark"), "point").orderBy(F.asc_nulls_last("mark"), "point").limit(k).collect()
    return np.array([np.frombuffer(r.point, "<i4") for r in rows], np.int64).reshape(-1, dim)


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, seed: str = "2"
) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid`` of every vector that counts.

    A vector counts if it has exactly ``dim`` components and none is null or not
    finite; its components become ``floor(scale * x)``. Vectors with a component
    of ``LARGEST`` or more after that, whose squared distances would not fit 64
    bits, are left out like those that are not finite. The first centroids
    are the vectors whose ids come first by hash, fewer than ``k`` if there are
    not as many; ``rounds`` times all vectors go to their nearest centroid (ties:
    the smaller number) and each centroid moves to the floor of their mean; then
    vectors are assigned once more. ``distance`` is squared; ``inertia`` sums it
    over all rows, null where the sum does not fit 64 bits. Rows with null or
    repeated ids are rows like any other (among first centroids equal ids are
    ordered by their vector). No vector that counts, or an empty table: no rows.
    Other columns are not read.

    The vectors are written once a round with what each remembers, and the
    previous round's files are removed. Centroids, ``k`` times ``dim`` numbers, are broadcast.
    """
    if k < 1 or not 1 <= dim <= 128:
        raise ValueError("there must be centroids, of 1 to 128 components")
    spark = vectors.sparkSession
    ship_code(spark)
    state, folder = stored_at(integer_vectors(vectors, id_col, vector_col, dim, scale), "vectors")
    points = first_centroids(state, k, dim, seed)
    if not len(points):
        return _described(spark, state.select("id").withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), points, id_col)
    centroids = Centroids.start(points)
    for _ in range(rounds):
        before = folder
        state, folder = stored_at(_assigned(state, centroids, dim, last=False), "assigned")
        drop_folder(spark, before)
        centroids = centroids.after(_means(state, centroids, dim))
    final, _ = stored_at(_assigned(state, centroids, dim, last=True), "clusters")
    drop_folder(spark, folder)
    return _described(spark, final, centroids.points, id_col)


def _described(spark: SparkSession, final: DataFrame, points: np.ndarray, id_col: str) -> DataFrame:
    """Rows with the figures of their cluster; there are at most ``k`` clusters to broadcast."""
    per_cluster = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()
    sums = {r.cluster: int(r.total) for r in per_cluster}
    whole = sum(sums.values())
    rows = [(c, _fits(total), _fits(whole), points[c].tolist()) for c, total in sums.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    named = final.withColumnRenamed("id", id_col).join(F.broadcast(about), "cluster")
    return named.select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _fits(total: int) -> int | None:
    return total if total < 1 << 63 else None

