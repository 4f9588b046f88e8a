"""Near-copies among vectors: spherical k-means cells and blocked cosine products.

Equal vectors are one representative from the start. Each representative lives
in the cell of its nearest centroid and visits those other cells in which a
vector within the threshold could live: if y is nearest to c and x to d, then
<x, d - c> >= 0, so <y, c - d> <= |x - y| |c - d|, and |x - y| is at most
sqrt(2 - 2 t) for a cosine of t. So no pair is missed, whatever the centroids. Inside a
cell the residents are cut into blocks, and every vector of the cell is
multiplied with each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, local_roots
from tidemark.llm.runtime import ship_code, stored

THRESHOLD = 0.98
#: Residents per cell that are aimed at, for the largest label.
CELL_ROWS = 2048
#: Centroids of one code book; with 64 numbers each they take 128 KB. More cells come from several books.
MOST_CENTROIDS = 256
#: Training vectors per centroid: a bounded sample of rows.
SAMPLE_PER_CENTROID = 40
#: Residents of a cell that are held at a time.
BLOCK_ROWS = 1024


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``label``, ``dim`` and ``unit`` (binary doubles of length one) of the vectors that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for x in batch.column("vector").to_pylist():
                unit = None
                if x and None not in x:
                    v = np.array(x, np.float64)
                    most = np.abs(v).max()
                    if np.isfinite(most) and most > 0:
                        v = v / most
                        unit = (v / np.sqrt(v @ v)).tobytes()
                units.append(unit)
                dims.append(0 if unit is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], ["id", "label", "dim", "unit"]
            )

    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    schema = T.StructType().add(plain.schema["id"]).add(plain.schema["label"]).add("dim", "integer").add("unit", "binary")
    return plain.where("id is not null and label is not null").mapInArrow(run, schema).where("unit is not null")


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 0, rounds: int = 12) -> np.ndarray:
    """``k`` unit centroids of unit vectors; an empty cell starts anew at the vector that fits worst."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        scores = x @ centroids.T
        near = scores.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        empty = np.flatnonzero(size < 1e-9)
        worst = np.argsort(scores.max(axis=1))[: len(empty)]
        sums[empty[: len(worst)]], size[empty[: len(worst)]] = x[worst], 1.0
        centroids = sums / np.maximum(size, 1e-9)[:, None]
    return centroids


def train_books(reps: DataFrame, largest: int, dim: int) -> list[np.ndarray]:
    """Code books for the vectors of one dimension; each trained on a sample of its own."""
    cells = max(1, math.ceil(largest / CELL_ROWS))
    books = max(1, math.ceil(math.log(cells, MOST_CENTROIDS) - 1e-9)) if cells > 1 else 1
    k = min(MOST_CENTROIDS, math.ceil(cells ** (1 / books)))
    out = []
    for book in range(books):
        place = F.xxhash64("rep", F.lit(book))
        sample = reps.where(F.col("dim") == dim).orderBy(place).limit(k * SAMPLE_PER_CENTROID).select("unit").collect()
        x = np.stack([np.frombuffer(r[0]) for r in sample])
        out.append(spherical_kmeans(x, k, seed=book))
    return out


def _cells(x: np.ndarray, books: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors ``x``: row, cell and whether it is the row's own, for all cells to live in or to visit."""
    rows, cells, own = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for centroids in books:
        scores = x @ centroids.T
        home = scores.argmax(axis=1)
        apart = np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))
        near = scores[np.arange(len(x)), home][:, None] - scores <= reach * apart[home] + 1e-9
        r, c = np.nonzero(near[rows])
        own = own[r] & (home[rows[r]] == c)
        rows, cells = rows[r], cells[r] * len(centroids) + c
    return rows, cells, own


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows link if their labels are equal and not null and the cosine of their
    vectors, in double precision, is at least ``threshold``. Rows whose id,
    label or vector is null, or whose vector is empty, zero or holds null or
    non-finite numbers, link with nothing, and vectors of different length do not
    link. ``n_links`` counts the rows directly linked; a second row with the
    same id counts as another one. ``component_id`` is the smallest id reachable and
    ``kept`` is true where that is the row's own (null and kept for a null id).
    An empty table gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    units = stored(unit_vectors(vectors, id_col, vector_col, label_col), "unit-vectors")
    reps = stored(units.groupBy("label", "dim", "unit").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "representatives")
    largest = reps.groupBy("label", "dim").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()
    books = spark.sparkContext.broadcast({dim: train_books(reps, n, dim) for dim, n in largest})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                batch = big.slice(at, 1024)
                dims = np.array(batch.column("dim"))
                raw = batch.column("unit").to_pylist()
                for dim in np.unique(dims).tolist():
                    pick = np.flatnonzero(dims == dim)
                    x = np.stack([np.frombuffer(raw[i]) for i in pick])
                    rows, cells, own = _cells(x, books.value[dim], reach)
                    out = batch.take(pa.array(pick[rows]))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cells), pa.array(own)], [*out.schema.names, "cell", "own"])

    schema = T.StructType([*reps.schema.fields]).add("cell", "long").add("own", "boolean")
    dealt = stored(reps.mapInArrow(deal, schema), "cells")
    key = ["label", "dim", "cell"]
    blocks = dealt.where("own").groupBy(*key).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"), F.count("*").alias("n")).drop("n")
    spread = dealt.join(blocks, key)
    residents = spread.where("own").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("asks", F.lit(False))
    asking = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    key = [*key, "block"]
    both = residents.unionByName(asking).select(*key, "asks", "rep", "copies", "unit").repartition(*key).sortWithinPartitions(*key, "asks", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, base, base_ids, base_copies = None, [], [], []
        matrix = None
        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                groups = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
                asks, ids = batch.column("asks").to_pylist(), batch.column("rep").to_pylist()
                copies, raw = batch.column("copies").to_pylist(), batch.column("unit").to_pylist()
                begin = 0
                while begin < len(groups):
                    end = begin + 1
                    while end < len(groups) and groups[end] == groups[begin] and asks[end] == asks[begin]:
                        end += 1
                    if groups[begin] != now:
                        now, base, base_ids, base_copies, matrix = groups[begin], [], [], [], None
                    x = [np.frombuffer(r) for r in raw[begin:end]]
                    if not asks[begin]:
                        base += x
                        base_ids += ids[begin:end]
                        base_copies += copies[begin:end]
                    elif base:
                        if matrix is None:
                            matrix, held, sizes = np.stack(base), np.array(base_ids), np.array(base_copies)
                        mine = np.array(ids[begin:end])
                        near = np.stack(x) @ matrix.T >= threshold
                        near &= mine[:, None] != held[None, :]
                        if near.any():
                            yield _links(near, mine, held, sizes)
                    begin = end

    found = stored(both.mapInArrow(run, "a long, links long, b long"), "links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(found.select("a", "b").where("b is not null"))
    whole = (
        reps.join(links, F.col("rep") == F.col("a"), "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select("label", "dim", "unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    linked = units.join(whole, ["label", "dim", "unit"]).select(F.col("id").alias("_id"), "n_links", "component_id")
    linked = linked.groupBy("_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return vectors.select(id_col).join(linked, F.col(id_col) == F.col("_id"), "left").select(
        id_col,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", id_col).cast("long").alias("component_id"),
        F.coalesce(F.col(id_col) == F.coalesce("component_id", id_col), F.lit(True)).alias("kept"),
    )


def _links(near: np.ndarray, mine: np.ndarray, held: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Links of each asking vector, and edges that tie what the pairs tie: at most one per vector."""
    a, b = np.nonzero(near)
    links = near.astype(np.int64) @ sizes
    ids, where = np.unique(np.concatenate((mine[a], held[b])), return_inverse=True)
    root = local_roots(where[: len(a)], where[len(a) :], len(ids))
    tied = np.flatnonzero(root != np.arange(len(ids)))
    asked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((mine[asked], ids[tied]))),
            pa.array(np.concatenate((links[asked], np.zeros(len(tied), np.int64)))),
            pa.array([None] * len(asked) + ids[root[tied]].tolist(), pa.int64()),
        ],
        ["a", "links", "b"],
    )
