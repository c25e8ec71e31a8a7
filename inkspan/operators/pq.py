"""Product quantisation: vectors as a few small codes, searched roughly and ranked exactly.

A vector is cut into slices; each slice is replaced by the number of the nearest of a
few centroids. The code book, the centroids of all slices, is fitted on a bounded
sample and goes to every task; every row is coded. A search scores the coded rows, which are
a small part of the bytes, keeps a multiple of the wanted rows, fetches the vectors
of those only, and ranks them by the whole score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from inkspan.functions.vectors import inner_product, is_finite
from inkspan.operators.search import top_k, usable_rows

SLICES, CENTROIDS = 16, 16
# Rows that a code book is fitted to: those of the smallest hash.
SAMPLE_ROWS = 1 << 15
# Rough matches per wanted row, of which the exact score decides.
REFINE = 16


def train_book(
    vectors: DataFrame, dim: int, slices: int = SLICES, centroids: int = CENTROIDS, seed: int = 7,
    rounds: int = 15, id_col: str = "vec_id", vector_col: str = "embedding",
) -> np.ndarray:
    """(slices, centroids, dim / slices): k-means of each slice over at most ``SAMPLE_ROWS`` rows."""
    if dim % slices or not 1 <= centroids <= 256:
        raise ValueError("slices must divide the dimension, and a code is one byte")
    few = vectors.filter(is_finite(vector_col)).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_ROWS)
    rows = np.array([r[0] for r in few.select(vector_col).collect()], np.float64).reshape(-1, slices, dim // slices)
    draw, book = np.random.default_rng(seed), np.zeros((slices, centroids, dim // slices))
    for number in range(slices if len(rows) else 0):
        part = rows[:, number]
        centers = part[draw.choice(len(part), centroids, replace=len(part) < centroids)]
        for _ in range(rounds):
            nearest = _nearest(part, centers)
            for c in range(centroids):
                if (mine := nearest == c).any():
                    centers[c] = part[mine].mean(axis=0)
        book[number] = centers
    return book


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1) - 2 * rows @ centers.T).argmin(axis=1)


def add_codes(vectors: DataFrame, book: np.ndarray, vector_col: str = "embedding") -> DataFrame:
    """Add ``code``, a byte per slice; NULL for a vector that is NULL or not finite. No shuffle."""
    slices, _, width = book.shape
    sent = vectors.sparkSession.sparkContext.broadcast(book)

    @F.arrow_udf(T.BinaryType())
    def code_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        book = sent.value
        for batch in batches:
            rows, there = usable_rows(batch, slices * width)
            parts = rows.reshape(-1, slices, width)
            codes = np.stack([_nearest(parts[:, s], book[s]) for s in range(slices)], axis=1).astype(np.uint8)
            found = iter(codes)
            yield pa.array([next(found).tobytes() if t else None for t in there], pa.binary())

    return vectors.withColumn("code", code_of(vector_col))


def decoded(coded: DataFrame, book: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """id and ``rough``, the vector that a code stands for."""
    slices, _, width = book.shape
    sent = coded.sparkSession.sparkContext.broadcast(book.astype(np.float32))

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vector_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        book = sent.value
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.to_pylist()), np.uint8).reshape(len(batch), slices)
            rows = book[np.arange(slices), codes].reshape(len(batch), slices * width)
            offsets = np.arange(0, rows.size + 1, slices * width, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), pa.float32()))

    return coded.filter(F.col("code").isNotNull()).select(id_col, vector_of("code").alias("rough"))


def pq_search(
    coded: DataFrame, vectors: DataFrame, book: np.ndarray, queries: DataFrame, k: int, refine: int = REFINE,
    id_col: str = "vec_id", vector_col: str = "embedding", query_id_col: str = "query_id",
    query_vector_col: str = "query_vector",
) -> DataFrame:
    """(query id, rank, id, score): the best k by inner product of ``k * refine`` rough matches.

    ``coded`` holds id and code of every row of ``vectors``, whose ids are unique. Only
    the rough matches, k times ``refine`` per query, meet their vectors.
    """
    names = {"id_col": id_col, "query_id_col": query_id_col, "query_vector_col": query_vector_col}
    rough = top_k(decoded(coded, book, id_col), queries, k * refine, vector_col="rough", **names)
    met = rough.select(query_id_col, id_col).join(vectors.select(id_col, vector_col), id_col)
    met = met.join(queries.select(query_id_col, query_vector_col), query_id_col)
    scored = met.select(query_id_col, id_col, inner_product(vector_col, F.col(query_vector_col)).alias("score"))
    ranked = Window.partitionBy(query_id_col).orderBy(F.desc("score"), id_col)
    best = scored.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select(query_id_col, "rank", id_col, "score")
