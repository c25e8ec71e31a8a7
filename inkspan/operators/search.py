"""Top-k search of query vectors in a vector table.

The table is never shuffled, joined or paired with the queries. The query
vectors, size-checked before they are fetched, go to every task as one matrix; a
task reads its rows once, scores them batch by batch with a matrix product, some
queries at a time, and keeps the best k rows per query. Only those k rows per
query and task are shuffled to find the overall best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkspan.session import discard, shared_folder

METRICS = ("inner_product", "cosine")
# Most bytes of query vectors that one search sends to every task.
MAX_QUERY_BYTES = 256 << 20
# Queries a task scores at once, which bounds its score matrix.
QUERY_TILE = 256
# Products of rows with centers that are worked out at once: 16 MB.
PRODUCTS = 1 << 21
MERGE_SALTS = 32


@dataclass
class Queries:
    """The query side as it stands in a task."""

    ids: np.ndarray
    vectors: np.ndarray
    extra: dict[str, np.ndarray]

    @property
    def dim(self) -> int:
        return self.vectors.shape[1]

    def some(self, at: slice) -> Queries:
        return Queries(self.ids[at], self.vectors[at], {name: values[at] for name, values in self.extra.items()})


# Which (row, query) pairs of a batch may match: blocks of row positions, query
# positions and an optional mask over the two.
Block = tuple[np.ndarray, np.ndarray, np.ndarray | None]
Gate = Callable[[pa.RecordBatch, Queries], Iterator[Block]]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "inner_product",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_id_col: str = "query_id",
    query_vector_col: str = "query_vector",
    gate: Gate | None = None,
    gate_cols: tuple[str, ...] = (),
    query_extra: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]] | None = None,
    prune: Callable[[DataFrame, Queries], DataFrame] | None = None,
) -> DataFrame:
    """(query id, rank, id, score, distance) of the best ``k`` rows per query.

    Rows are ranked by the whole score, equal ones by id. ``distance`` is the
    negative inner product or the cosine distance. A vector that is NULL or has
    a NaN or infinite element never matches, on either side; one of another
    dimension than the queries raises an error. With the cosine metric zero
    vectors have no distance and never match. Query ids must be unique, and the
    query vectors at most ``MAX_QUERY_BYTES``; both are errors, at any size.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    if k < 1:
        raise ValueError("k must be positive")
    asked = queries.select(query_id_col, query_vector_col)

    size = asked.agg(F.sum(F.size(query_vector_col).cast("long") * 8)).first()[0] or 0
    if size > MAX_QUERY_BYTES:
        raise ValueError(f"{size} bytes of query vectors; at most {MAX_QUERY_BYTES} at once")
    side = _query_side(asked.collect(), metric, query_extra)
    rows = vectors if prune is None else prune(vectors, side)
    return _search(
        rows, side, k, metric, id_col, vector_col, query_id_col, gate, gate_cols,
        asked.schema[query_id_col].dataType,
    )


def knn_join(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    tile_bytes: int = MAX_QUERY_BYTES // 4,
    query_id_col: str = "query_id",
    query_vector_col: str = "query_vector",
    id_col: str = "vec_id",
    **search_options,
) -> DataFrame:
    """``top_k`` for any number of queries: the nearest rows of every row of a large table.

    The queries are written once and dealt to tiles of about ``tile_bytes`` by a hash of
    their id. Each tile is one scan of the vectors, whose best rows are written; so no
    more than one tile is ever on the driver or in a task, no vector is shuffled, and a
    lost executor repeats a scan of one tile at most. A tile's own size is checked by
    ``top_k``; equal ids meet in one tile, where they are an error.
    """
    spark = vectors.sparkSession
    asked = queries.select(query_id_col, query_vector_col)
    size = asked.agg(F.sum(F.size(query_vector_col).cast("long") * 8)).first()[0] or 0
    tiles = max(1, -(-size // tile_bytes))
    asked_path, found_path = (shared_folder(spark, p) for p in ("query-tiles", "tile-matches"))
    tile = F.pmod(F.xxhash64(query_id_col), F.lit(tiles)).cast("int")
    asked.withColumn("tile", tile).repartition("tile").write.partitionBy("tile").parquet(asked_path)
    kept = spark.read.schema(T.StructType([*asked.schema, T.StructField("tile", T.IntegerType())])).parquet(asked_path)
    names = {"query_id_col": query_id_col, "query_vector_col": query_vector_col, "id_col": id_col}
    for number in range(tiles):
        some = kept.filter(F.col("tile") == number).drop("tile")
        found = top_k(vectors, some, k, **names, **search_options)
        found.write.mode("append").parquet(found_path)
    discard(spark, asked_path)
    return spark.read.schema(found.schema).parquet(found_path)


def _query_side(rows: list, metric: str, query_extra) -> Queries:
    if len({row[0] for row in rows}) < len(rows):
        raise ValueError("query ids must be unique")
    rows = [row for row in rows if row[1] is not None]
    if len({len(row[1]) for row in rows}) > 1:
        raise ValueError("query vectors differ in dimension")
    matrix = np.array([row[1] for row in rows], dtype=np.float64)
    usable = np.isfinite(matrix).all(axis=1) if rows else []
    rows = [row for row, fine in zip(rows, usable, strict=True) if fine]
    matrix = matrix[usable] if rows else np.empty((0, 0))
    ids = np.empty(len(rows), dtype=object)
    ids[:] = [row[0] for row in rows]
    extra = query_extra(matrix, ids) if query_extra and len(rows) else {}
    if metric == "cosine" and len(rows):
        matrix = _unit_rows(matrix)
        known = matrix.any(axis=1)
        ids, matrix = ids[known], matrix[known]
        extra = {name: values[known] for name, values in extra.items()}
    return Queries(ids, matrix, extra)


def _search(
    vectors, side, k, metric, id_col, vector_col, query_id_col, gate, gate_cols, query_id_type
) -> DataFrame:
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    found_type = T.StructType([
        T.StructField(query_id_col, query_id_type),
        T.StructField(id_col, id_type),
        T.StructField("score", T.DoubleType()),
    ])
    schema = to_arrow_schema(found_type)
    sent = spark.sparkContext.broadcast((side.ids, side.vectors, side.extra))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(Queries(*sent.value), k, metric)
        for batch in batches:
            best.add(batch, gate)
        yield from best.rows(schema)

    found = vectors.select(id_col, vector_col, *gate_cols).mapInArrow(scan, found_type)
    order = [F.col("score").desc(), F.col(id_col)]

    def keep(rows: DataFrame, *keys) -> DataFrame:
        ranked = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)

    salted = found.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(MERGE_SALTS)))
    merged = keep(keep(salted, query_id_col, "salt").drop("rank", "salt"), query_id_col)
    distance = -F.col("score") if metric == "inner_product" else 1.0 - F.col("score")
    return merged.select(query_id_col, "rank", id_col, "score", distance.alias("distance"))


class _Best:
    """The best k rows per query seen so far in one task."""

    def __init__(self, side: Queries, k: int, metric: str):
        self.side, self.k, self.metric = side, k, metric
        n = len(side.ids)
        self.scores = [np.empty(0) for _ in range(n)]
        self.found = [np.empty(0, dtype=object) for _ in range(n)]
        self.floor = np.full(n, -np.inf)
        self.lengths = np.linalg.norm(side.vectors, axis=1) if n else np.empty(0)

    def add(self, batch: pa.RecordBatch, gate: Gate | None) -> None:
        if batch.column(1).null_count:
            batch = batch.filter(batch.column(1).is_valid())
        if batch.num_rows == 0 or len(self.side.ids) == 0:
            return
        rows = vector_matrix(batch.column(1), self.side.dim)
        finite = np.isfinite(rows).all(axis=1)
        if not finite.all():
            batch, rows = batch.filter(pa.array(finite)), rows[finite]
            if not len(rows):
                return
        if self.metric == "cosine":
            rows = _unit_rows(rows)
        ids = batch.column(0)
        id_rank = np.empty(len(ids), dtype=np.int64)
        id_rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        everything = np.arange(len(rows))
        for start in range(0, len(self.side.ids), QUERY_TILE):
            # A gate's mask holds the rows of a batch for one tile of queries, never for all.
            tile = self.side.some(slice(start, start + QUERY_TILE))
            for row_at, query_at, mask in gate(batch, tile) if gate else [(everything, np.arange(len(tile.ids)), None)]:
                if not len(query_at):
                    continue
                if self.metric == "cosine":
                    alive = rows[row_at].any(axis=1)
                    row_at, mask = row_at[alive], mask if mask is None else mask[alive]
                if len(row_at) > self.k:
                    kept = _few_copies(rows[row_at], id_rank[row_at], mask, self.k)
                    row_at, mask = row_at[kept], mask if mask is None else mask[kept]
                if len(row_at):
                    self._block(ids, id_rank, rows[row_at], row_at, query_at + start, mask)

    def _block(self, ids, id_rank, block, row_at, query_at, mask) -> None:
        rough = block @ self.side.vectors[query_at].T
        # Bound on how far a product may lie from the ranked score, whose order of
        # summation is the same in every batch.
        slack = 4e-16 * self.side.dim * np.linalg.norm(block, axis=1).max() * self.lengths[query_at]
        if mask is not None:
            rough[~mask] = -np.inf
        bar = self.floor[query_at] - slack
        if len(row_at) > self.k:
            kth = np.partition(rough, len(row_at) - self.k, axis=0)[len(row_at) - self.k]
            bar = np.maximum(bar, kth - slack)
        hits = (rough >= bar) & (rough > -np.inf)
        for column in np.flatnonzero(hits.any(axis=0)):
            at = np.flatnonzero(hits[:, column])
            query = query_at[column]
            exact = (block[at] * self.side.vectors[query]).sum(axis=1)
            scores = exact + 0.0
            first = np.lexsort((id_rank[row_at[at]], -scores))[: self.k]
            names = np.empty(len(first), dtype=object)
            names[:] = ids.take(pa.array(row_at[at[first]])).to_pylist()
            self._merge(query, scores[first], names)

    def _merge(self, query: int, scores: np.ndarray, names: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        names = np.concatenate([self.found[query], names])
        order = np.lexsort((names, -scores))[: self.k]
        self.scores[query], self.found[query] = scores[order], names[order]
        if len(order) == self.k:
            self.floor[query] = self.scores[query][-1]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        counts = [len(s) for s in self.scores]
        if not sum(counts):
            return
        columns = (
            np.repeat(self.side.ids, counts),
            np.concatenate(self.found),
            np.concatenate(self.scores),
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.tolist(), f.type) for c, f in zip(columns, schema)], schema=schema
        )


def vector_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a double matrix; every vector must have ``dim`` elements."""
    flat = column.flatten()
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != dim).any() or column.null_count or flat.null_count:
        raise ValueError(f"expected vectors of {dim} elements without nulls")
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def usable_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that are there and finite, and which rows of the column they are."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    rows = vector_matrix(column.filter(pa.array(there)), dim)
    finite = np.isfinite(rows).all(axis=1)
    there[there] = finite
    return rows[finite], there


def _few_copies(
    rows: np.ndarray, id_rank: np.ndarray, mask: np.ndarray | None, k: int
) -> np.ndarray:
    """Positions without those copies of a vector that cannot be among the best k.

    Copies score alike for every query, so the k lowest ids of each vector are
    enough.
    """
    _, groups = np.unique(rows.sum(axis=1), return_inverse=True)
    if np.bincount(groups).max() <= k:
        return np.arange(len(rows))
    # Rows of equal sum side by side, by id; the first leads its group.
    order = np.lexsort((id_rank, groups))
    starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
    sizes = np.diff(starts, append=len(rows))
    leader = order[np.repeat(starts, sizes)]
    is_copy = (rows[order] == rows[leader]).all(axis=1)
    if mask is not None:
        is_copy &= (mask[order] == mask[leader]).all(axis=1)
    copies_before = np.cumsum(is_copy) - is_copy
    copies_before -= np.repeat(copies_before[starts], sizes)
    return order[~is_copy | (copies_before < k)]


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def nearest(
    vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Top-k by inner product for one literal query vector, as a plain sort and limit.

    NULL vectors and ones with a NaN or infinite element never match.
    """
    from inkspan.functions.vectors import inner_product, is_finite

    wanted = F.array(*(F.lit(float(x)) for x in query))
    return (
        vectors.filter(is_finite(vector_col))
        .select(id_col, inner_product(vector_col, wanted).alias("score"))
        .orderBy(F.col("score").desc(), F.col(id_col))
        .limit(k)
    )


def highest_products(rows: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """For each row the ``n`` centers of the highest inner product, equal ones in order.

    The matrix product narrows the choice; what lies within its error is summed
    again in one fixed order, so that the choice does not depend on the batch.
    """
    n = min(n, len(centers))
    best = np.empty((len(rows), n), dtype=np.int64)
    for at, (block, rough, slack) in _products(rows, centers):
        bar = np.partition(rough, len(centers) - n, axis=1)[:, len(centers) - n, None] - slack
        close = rough >= bar
        if n == 1:
            best[at, 0] = rough.argmax(axis=1)
        for row in np.flatnonzero((close.sum(axis=1) > 1) | (n > 1)):
            some = np.flatnonzero(close[row])
            exact = (centers[some] * block[row]).sum(axis=1)
            best[at.start + row] = some[np.argsort(-exact, kind="stable")[:n]]
    return best


def among_highest(rows: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """Which centers ``highest_products`` chooses: a bit for each center, a byte for eight."""
    n = min(n, len(centers))
    bits = np.empty((len(rows), -(-len(centers) // 8)), dtype=np.uint8)
    for at, (block, rough, slack) in _products(rows, centers):
        bar = np.partition(rough, len(centers) - n, axis=1)[:, len(centers) - n, None]
        chosen = rough > bar + slack
        close = (rough >= bar - slack) & ~chosen
        for row in range(len(block)):
            some = np.flatnonzero(close[row])
            exact = (centers[some] * block[row]).sum(axis=1)
            chosen[row, some[np.argsort(-exact, kind="stable")[: n - chosen[row].sum()]]] = True
        bits[at] = np.packbits(chosen, axis=1)
    return bits


def _products(rows: np.ndarray, centers: np.ndarray):
    """Some rows at a time: where they are, they, their rough products with all centers, and the products' error."""
    step = max(1, PRODUCTS // max(1, len(centers)))
    longest = np.linalg.norm(centers, axis=1).max(initial=0)
    for start in range(0, len(rows), step):
        block = rows[start : start + step]
        slack = 8e-16 * rows.shape[1] * np.linalg.norm(block, axis=1)[:, None] * longest
        yield slice(start, start + len(block)), (block, block @ centers.T, slack)


#: Rows that a calibration asks for their neighbours.
CALIBRATION_ROWS = 64


def sampled_neighbours(
    rows: DataFrame, k: int, place_col: str, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = CALIBRATION_ROWS,
) -> list[tuple[list[float], object]]:
    """(vector, place) for each of the k nearest rows of a few sampled rows.

    The sample is the rows of smallest hash; a row is no neighbour of itself. One exact
    search; at most ``sample`` times k pairs come to the driver.
    """
    known = rows.filter(F.col(place_col).isNotNull()).select(id_col, vector_col, place_col).dropDuplicates([id_col])
    asked = known.orderBy(F.xxhash64(id_col), id_col).limit(sample).select(
        F.col(id_col).alias("query_id"), F.col(vector_col).alias("query_vector")
    )
    near = top_k(known, asked, k + 1, id_col=id_col, vector_col=vector_col)
    near = near.filter(F.col(id_col) != F.col("query_id")).select("query_id", id_col)
    placed = known.select(id_col, place_col).join(F.broadcast(near), id_col).select("query_id", place_col)
    vectors = {r.query_id: list(r.query_vector) for r in asked.collect()}
    return [(vectors[r.query_id], r[place_col]) for r in placed.collect()]


def needed_probes(places: np.ndarray, wanted: float) -> int:
    """How many places have to be read to meet the wanted share of these, counted from 0.

    The share is raised by two standard errors, with half as many independent
    neighbours as there are places, so that other queries meet it as well.
    """
    if not 0 < wanted <= 1:
        raise ValueError("the wanted recall must be above 0 and at most 1")
    ordered = np.sort(places)
    share = min(1.0, wanted + 2 * np.sqrt(wanted * (1 - wanted) * 2 / len(ordered)))
    return int(ordered[max(0, int(np.ceil(share * len(ordered))) - 1)]) + 1


def recall(approximate: DataFrame, exact: DataFrame, query_id_col: str, id_col: str) -> DataFrame:
    """Share of the exact matches of each query that the other search found."""
    keys = [query_id_col, id_col]
    hits = exact.select(*keys).join(
        approximate.select(*keys).withColumn("hit", F.lit(1)), keys, "left"
    )
    return hits.groupBy(query_id_col).agg(
        F.count("hit").alias("found"),
        F.count(F.lit(1)).alias("wanted"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )
