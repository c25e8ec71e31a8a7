"""Inverted-file index: rows grouped in lists around centroids, few lists read per query."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from inkspan.functions.vectors import is_finite
from inkspan.operators.search import (
    PRODUCTS, QUERY_TILE, Queries, among_highest, highest_products, knn_join, needed_probes, sampled_neighbours, top_k,
    usable_rows, vector_matrix,
)
from inkspan.session import discard, shared_folder

# Default number of lists, and of lists a search reads.
LISTS = 20
PROBES = 5
MAX_CENTROID_BYTES = 256 << 20
MAX_LISTS = 1 << 16
# Lists that are trained at once; more are trained cell by cell.
MAX_FLAT_LISTS = 256
# Most lists with a folder each; of more, how many are in a folder, and its column.
MAX_FOLDERS = 256
FOLDER_LISTS = 64
FOLDER = "list_folder"
# How far a center moves at least, or the training ends.
TOLERANCE = 1e-4
# Bytes of the bits that say which lists the queries of one scan read.
MAX_PROBE_BYTES = 16 << 20
CENTROIDS = T.StructType([
    T.StructField("list_id", T.IntegerType()),
    T.StructField("centroid", T.ArrayType(T.DoubleType())),
])


def train_centroids(
    vectors: DataFrame,
    lists: int = LISTS,
    seed: int = 7,
    iterations: int = 20,
    vector_col: str = "embedding",
) -> DataFrame:
    """(list_id, centroid) from k-means over the unit-length vectors of all rows.

    Vectors that are NULL, zero or not finite have no direction and are left out. Many
    lists are trained in two steps: cells first, and then the lists of each cell.
    """
    if lists > MAX_FLAT_LISTS:
        return _train_in_cells(vectors, lists, seed, iterations, vector_col)
    usable = _has_direction(vector_col)
    raw = vectors.filter(usable).select(
        array_to_vector(vector_col).alias("raw")
    )
    directions = Normalizer(inputCol="raw", outputCol="features").transform(raw)
    model = KMeans(k=lists, seed=seed, maxIter=iterations).fit(directions.select("features"))
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(centers, CENTROIDS)


def _has_direction(vector_col: str) -> Column:
    return is_finite(vector_col) & F.exists(vector_col, lambda x: x != 0)


def _train_in_cells(vectors: DataFrame, lists: int, seed: int, iterations: int, vector_col: str) -> DataFrame:
    """K-means of many lists over all rows: a row is compared with the lists of its cell only.

    There are about as many cells as lists in a cell, so a pass takes time by the root
    of the number of lists. Each cell has lists by its share of the different vectors,
    and starts from some of these. Copies of a vector are one row with their number.
    """
    spark = vectors.sparkSession
    cells = train_centroids(vectors, math.ceil(math.sqrt(lists)), seed, iterations, vector_col)
    path = shared_folder(spark, "cells")
    different = vectors.filter(_has_direction(vector_col)).groupBy(F.col(vector_col).alias("vector")).agg(
        F.count("*").alias("n")
    )
    different = assign_lists(different, cells, "vector").withColumnRenamed("list_id", "cell")
    # By cell, so that a task sums up the lists of a few cells; a large cell is many tasks'.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    draw = F.xxhash64("vector", F.lit(seed))
    different.repartitionByRange(tasks, "cell", draw).sortWithinPartitions("cell").write.parquet(path)
    rows = spark.read.schema(different.schema).parquet(path)
    sizes = {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}  # at most some hundred
    centers = _first_centers(rows, draw, sizes, _shares(sizes, lists))
    for _ in range(iterations):
        moved = _moved(rows, centers)
        still = all(np.linalg.norm(moved[c] - centers[c], axis=1).max() < TOLERANCE for c in centers)
        centers = moved
        if still:
            break
    discard(spark, path)
    matrix = np.concatenate([centers[cell] for cell in sorted(centers)] or [np.empty((0, 0))])
    offsets = np.arange(len(matrix) + 1) * matrix.shape[1]
    column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.reshape(-1)))
    ids = pa.array(np.arange(len(matrix)), pa.int32())
    return spark.createDataFrame(pa.table({"list_id": ids, "centroid": column}), CENTROIDS)


def _shares(sizes: dict[int, int], lists: int) -> dict[int, int]:
    """How many of the lists each cell has: by its size, one at least, and no more than it has rows."""
    total = sum(sizes.values())
    if total <= lists:
        return dict(sizes)
    exact = {cell: lists * n / total for cell, n in sizes.items()}
    shares = {cell: max(1, math.floor(x)) for cell, x in exact.items()}
    by_rest = sorted(exact, key=lambda cell: (math.floor(exact[cell]) - exact[cell], cell))
    for cell in by_rest[: max(0, lists - sum(shares.values()))]:
        shares[cell] += 1
    return {cell: min(n, sizes[cell]) for cell, n in shares.items()}


def _first_centers(
    rows: DataFrame, draw: Column, sizes: dict[int, int], shares: dict[int, int]
) -> dict[int, np.ndarray]:
    """The rows of smallest hash of each cell, as many as it has lists, of length 1.

    Somewhat more than these come to the driver; if there are too few, twice as many do.
    """
    found: dict[int, list] = {cell: [] for cell in shares}
    more = 1
    while short := [cell for cell, some in found.items() if len(some) < shares[cell]]:
        bars = [x for cell in short for x in (cell, more * (shares[cell] + 4 * shares[cell] ** 0.5 + 8) / sizes[cell])]
        bar = F.create_map(*map(F.lit, bars))[F.col("cell")]
        at = (draw.cast("double") / 2.0**64 + 0.5).alias("at")
        drawn = rows.where(F.col("cell").isin(short)).select("cell", at, "vector").where(F.col("at") <= bar)
        for cell in short:
            found[cell] = []
        for batch in drawn.toArrow().to_batches():
            some = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows or 1, -1)
            for cell, place, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), some):
                found[cell].append((place, vector))
        more *= 2
    centers = {}
    for cell, some in found.items():
        lowest = sorted(some, key=lambda drawn: drawn[0])[: shares[cell]]
        matrix = np.array([vector for _, vector in lowest], np.float64)
        centers[cell] = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    return centers


def _moved(rows: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Each center as the mean of the directions nearest to it in its cell; one without any stays.

    A task sends the sums of the lists it meets, of a few cells.
    """
    sent = rows.sparkSession.sparkContext.broadcast(centers)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = sent.value, {}
        for batch in batches:
            cells, n = (batch.column(c).to_numpy() for c in (0, 1))
            for cell in np.unique(cells):
                own, at = known[cell], np.flatnonzero(cells == cell)
                some = vector_matrix(batch.column(2).take(pa.array(at)), own.shape[1])
                some /= np.linalg.norm(some, axis=1, keepdims=True)
                total, count = found.setdefault(cell, (np.zeros_like(own), np.zeros(len(own))))
                step = max(1, PRODUCTS // len(own))
                for start in range(0, len(some), step):
                    part, weight = some[start : start + step], n[at[start : start + step]]
                    near = (part @ own.T - (own * own).sum(axis=1) / 2).argmax(axis=1)
                    order = np.argsort(near, kind="stable")
                    lists, first = np.unique(near[order], return_index=True)
                    total[lists] += np.add.reduceat((part * weight[:, None])[order], first)
                    count[lists] += np.add.reduceat(weight[order], first)
        for cell, (total, count) in found.items():
            met = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(met), cell), pa.int32()), pa.array(met, pa.int32()), pa.array(count[met]),
                 pa.array([row.tobytes() for row in total[met]], pa.binary())],
                ["cell", "at", "n", "total"],
            )

    kind = "cell int, at int, n double, total binary"
    got = rows.select("cell", "n", "vector").mapInArrow(sums, kind).toArrow()
    moved = {cell: np.zeros_like(own) for cell, own in centers.items()}
    counts = {cell: np.zeros(len(own)) for cell, own in centers.items()}
    for cell, at, n, total in zip(*(got.column(c).to_pylist() for c in ("cell", "at", "n", "total")), strict=True):
        moved[cell][at] += np.frombuffer(total)
        counts[cell][at] += n
    for cell, n in counts.items():
        there = n > 0
        moved[cell][there] /= n[there, None]
        moved[cell][~there] = centers[cell][~there]
    sent.unpersist()
    return moved


def assign_lists(
    vectors: DataFrame, centroids: DataFrame, vector_col: str = "embedding"
) -> DataFrame:
    """Add ``list_id``: the centroid with the largest inner product, lowest id on ties.

    One pass without shuffle: only the vector column goes to Python, the centroids
    go to every task as a matrix. A vector that is NULL or not finite has list NULL.
    """
    list_ids, matrix = centroid_matrix(centroids)
    sent = vectors.sparkSession.sparkContext.broadcast((list_ids, matrix))

    @F.arrow_udf(T.IntegerType())
    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, centers = sent.value
        for batch in batches:
            rows, there = usable_rows(batch, centers.shape[1])
            found = np.zeros(len(batch), np.int32)
            if len(rows):
                found[there] = ids[highest_products(rows, centers, 1)[:, 0]]
            yield pa.array(found, pa.int32(), mask=~there)

    return vectors.withColumn("list_id", assign(vector_col))


def write_index(assigned: DataFrame, path: str, lists: int = 0) -> None:
    """One folder per list. A list too big for one task is split over several.

    Of more lists than ``MAX_FOLDERS``, some that follow each other share a folder.
    """
    if lists <= MAX_FOLDERS:
        assigned.hint("rebalance", "list_id").write.partitionBy("list_id").parquet(path)
        return
    placed = assigned.withColumn(FOLDER, F.floor(F.col("list_id") / FOLDER_LISTS).cast("int"))
    placed.hint("rebalance", FOLDER).sortWithinPartitions(FOLDER, "list_id").write.partitionBy(FOLDER).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ivf_search(
    index: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    probes: int = PROBES,
    **search_options,
) -> DataFrame:
    """Top-k by inner product among the rows of each query's ``probes`` best lists.

    With ``probes`` equal to the number of lists the result is exact.
    """
    if probes < 1:
        raise ValueError("probes must be positive")
    list_ids, matrix = centroid_matrix(centroids)

    def probed(query_matrix: np.ndarray, _ids: np.ndarray) -> dict[str, np.ndarray]:
        return {"probed": among_highest(query_matrix, matrix, probes)}

    rules = {
        "gate": partial(_probed_rows, list_ids), "gate_cols": ("list_id",), "query_extra": probed,
        "prune": partial(_prune_lists, list_ids),
    }
    # A tile of queries for each scan, so that the bits of its lists stay bounded.
    some = max(QUERY_TILE, MAX_PROBE_BYTES * 8 // max(1, len(list_ids)))
    if queries.count() <= some:
        return top_k(index, queries, k, **rules, **search_options)
    return knn_join(index, queries, k, tile_bytes=some * matrix.shape[1] * 8, **rules, **search_options)


def list_radii(index: DataFrame, centroids: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """(list_id, radius): how far the farthest row of a list is from its centroid.

    Tasks send one number per list. Rows that never match have no list.
    """
    list_ids, matrix = centroid_matrix(centroids)
    sent = index.sparkSession.sparkContext.broadcast((list_ids, matrix))

    def farthest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centers = sent.value
        radius = np.full(len(ids), -1.0)
        for batch in batches:
            rows, there = usable_rows(batch.column(1), centers.shape[1])
            place = np.searchsorted(ids, batch.column(0).to_numpy(zero_copy_only=False)[there])
            np.maximum.at(radius, place, np.linalg.norm(rows - centers[place], axis=1))
        some = np.flatnonzero(radius >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[some], pa.int32()), pa.array(radius[some])], ["list_id", "radius"]
        )

    known = index.filter(F.col("list_id").isNotNull()).select("list_id", vector_col)
    return known.mapInArrow(farthest, "list_id int, radius double").groupBy("list_id").agg(
        F.max("radius").alias("radius")
    )


def bounded_search(
    index: DataFrame,
    centroids: DataFrame,
    radii: DataFrame,
    queries: DataFrame,
    k: int,
    first: int = PROBES,
    query_id_col: str = "query_id",
    id_col: str = "vec_id",
    **search_options,
) -> DataFrame:
    """The exact top-k by inner product, with ``lists_read``; lists that cannot hold a match are skipped.

    No row of a list scores above q.c + |q| radius, which is close where vectors have
    about the length of their centroids, as unit vectors do. The ``first`` lists of the highest
    bound are searched; their k-th score then drops every list whose bound is below it,
    and the rest is searched in a second round.
    """
    if first < 1:
        raise ValueError("first must be positive")
    list_ids, matrix = centroid_matrix(centroids)
    radius = np.full(len(list_ids), -np.inf)  # of a list without rows
    for row in radii.collect():  # at most MAX_LISTS
        radius[np.searchsorted(list_ids, row.list_id)] = row.radius
    bounds: dict = {}

    def of_first(query_matrix: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
        lengths = np.linalg.norm(query_matrix, axis=1)[:, None]
        bound = query_matrix @ matrix.T + lengths * radius
        place = (-bound).argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        asked = (place < first) & np.isfinite(bound)
        bounds.update({query: (bound[i], asked[i]) for i, query in enumerate(ids)})
        return {"list_ids": np.broadcast_to(list_ids, asked.shape), "asked": asked}

    names = {"query_id_col": query_id_col, "id_col": id_col}
    rules = {"gate": _asked_lists, "gate_cols": ("list_id",), "prune": _prune_asked}
    one = shared_folder(index.sparkSession, "first-lists")
    top_k(index, queries, k, query_extra=of_first, **rules, **names, **search_options).write.parquet(one)
    found = index.sparkSession.read.parquet(one)
    # One number per query; the queries were on the driver before, size-checked.
    kth = found.groupBy(query_id_col).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = {r[0]: r.least for r in kth.collect() if r.n == k}

    def of_rest(query_matrix: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
        floor = np.array([floors.get(query, -np.inf) for query in ids])
        bound, seen = (np.array(side) for side in zip(*(bounds[query] for query in ids), strict=True))
        asked = (bound * (1 + 1e-9 * np.sign(bound)) + 1e-12 >= floor[:, None]) & ~seen & np.isfinite(bound)
        for i, query in enumerate(ids):
            bounds[query] = bound[i], seen[i] | asked[i]
        return {"list_ids": np.broadcast_to(list_ids, asked.shape), "asked": asked}

    more = top_k(index, queries, k, query_extra=of_rest, **rules, **names, **search_options)
    read = index.sparkSession.createDataFrame(
        [(query, int(asked.sum())) for query, (_, asked) in bounds.items()],
        T.StructType([queries.schema[query_id_col], T.StructField("lists_read", T.IntegerType())]),
    )
    ranked = Window.partitionBy(query_id_col).orderBy(F.desc("score"), id_col)
    both = found.unionByName(more).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return both.join(F.broadcast(read), query_id_col)


def _prune_asked(index: DataFrame, side: Queries) -> DataFrame:
    if not side.extra:
        return index.limit(0)
    wanted = side.extra["list_ids"][0][side.extra["asked"].any(axis=0)]
    return _of_lists(index, wanted)


def _asked_lists(batch: pa.RecordBatch, side: Queries):
    found = batch.column(2).to_numpy(zero_copy_only=False)
    for list_id in np.unique(found):
        at = np.searchsorted(side.extra["list_ids"][0], list_id)
        yield np.flatnonzero(found == list_id), np.flatnonzero(side.extra["asked"][:, at]), None


def calibrated_probes(
    index: DataFrame, centroids: DataFrame, k: int, wanted: float = 0.9,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> int:
    """The fewest lists per query that hold the wanted share of the neighbours of sampled rows."""
    found = sampled_neighbours(index, k, "list_id", id_col, vector_col)
    if not found:
        return 1
    list_ids, matrix = centroid_matrix(centroids)
    places = [
        (list_ids[highest_products(np.array([vector], np.float64), matrix, len(matrix))[0]] == place).argmax()
        for vector, place in found
    ]
    return needed_probes(np.array(places), wanted)


def centroid_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """List ids in ascending order and the matrix of their centroids."""
    count, size = centroids.agg(
        F.count("list_id"), F.sum(F.size("centroid").cast("long") * 8)
    ).first()
    if count > MAX_LISTS or (size or 0) > MAX_CENTROID_BYTES:
        raise ValueError("the centroids exceed the size bound; use fewer lists")
    rows = sorted(centroids.select("list_id", "centroid").collect())
    matrix = np.array([r[1] for r in rows], dtype=np.float64)
    return np.array([r[0] for r in rows], dtype=np.int32), matrix


def _prune_lists(list_ids: np.ndarray, index: DataFrame, side: Queries) -> DataFrame:
    if not side.extra:
        return index.limit(0)
    asked = np.unpackbits(np.bitwise_or.reduce(side.extra["probed"], axis=0), count=len(list_ids)) == 1
    if asked.all():
        return index.filter(F.col("list_id").isNotNull())
    return _of_lists(index, list_ids[asked])


def _of_lists(index: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The rows of these lists: a partition filter, of lists that share folders and a row filter."""
    if FOLDER in index.columns:
        index = index.filter(F.col(FOLDER).isin(np.unique(wanted // FOLDER_LISTS).tolist()))
    return index.filter(F.col("list_id").isin(wanted.tolist()))


def _probed_rows(list_ids: np.ndarray, batch: pa.RecordBatch, side: Queries):
    found = batch.column(2).to_numpy(zero_copy_only=False)
    order = np.argsort(found, kind="stable")
    lists, starts = np.unique(found[order], return_index=True)
    places = np.searchsorted(list_ids, lists)
    for name, at, rows in zip(lists, places, np.split(order, starts[1:]), strict=True):
        if at < len(list_ids) and list_ids[at] == name:
            asking = np.flatnonzero(side.extra["probed"][:, at >> 3] & (128 >> (at & 7)))
            yield rows, asking, None
