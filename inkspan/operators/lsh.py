"""Sign-projection buckets: a query meets the rows of the buckets it is likely near to.

A row's bucket in a table is the signs of a few projections. A query goes to its own
bucket first and then to those whose signs differ where its projections are small:
the buckets of a table are ordered by the sum of the squares of these projections,
and the first ``probes`` of them are asked. Written with ``write_buckets`` the rows
lie in a folder per table and bucket, and a search reads the folders it asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inkspan.operators.search import Queries, needed_probes, sampled_neighbours, top_k, usable_rows

# 16 of 32 buckets in two tables hold nine of ten neighbours even of vectors without any clusters.
BITS = 5
TABLES = 2
PROBES = 16
# Rows of one bucket that a table's number of bits aims at, and the most bits.
BUCKET_ROWS, MAX_BITS = 1 << 16, 12


def bits_for(rows: int) -> int:
    """Bits of a code for a table of so many rows."""
    return min(MAX_BITS, max(BITS, (rows // BUCKET_ROWS).bit_length()))


def projections(dim: int, bits: int, tables: int, seed: int = 7) -> np.ndarray:
    """(tables, bits, dim) of +1 and -1: -1 where the md5 of the position starts with 0-7."""
    signs = [
        -1.0 if hashlib.md5(f"{seed}:{t}:{b}:{d}".encode()).hexdigest()[0] < "8" else 1.0
        for t in range(tables)
        for b in range(bits)
        for d in range(dim)
    ]
    return np.array(signs).reshape(tables, bits, dim)


def bucket_codes(rows: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, tables) codes; bit b is set where the projection b is not negative."""
    tables, bits, dim = planes.shape
    sides = rows @ planes.reshape(tables * bits, dim).T
    signs = (sides >= 0).reshape(len(rows), tables, bits)
    return signs.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def add_codes(
    vectors: DataFrame,
    dim: int,
    bits: int = BITS,
    tables: int = TABLES,
    seed: int = 7,
    vector_col: str = "embedding",
) -> DataFrame:
    """Add ``codes``: the bucket of the row in each table. One pass without shuffle.

    A vector that is NULL or not finite has codes NULL and is in no bucket.
    """

    @F.arrow_udf(T.ArrayType(T.LongType(), containsNull=False))
    def codes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes = projections(dim, bits, tables, seed)
        item = pa.list_(pa.field("element", pa.int64(), nullable=False))
        for batch in batches:
            rows, there = usable_rows(batch, dim)
            codes = bucket_codes(rows, planes)
            offsets = np.concatenate([[0], np.cumsum(there * tables)]).astype(np.int32)
            yield pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(codes.reshape(-1)), type=item, mask=pa.array(~there)
            )

    return vectors.withColumn("codes", codes_of(vector_col))


def write_buckets(coded: DataFrame, path: str) -> None:
    """A copy of each row per table, in a folder per table and bucket; large buckets are split."""
    placed = coded.select("*", F.posexplode("codes").alias("lsh_table", "lsh_code"))
    placed.hint("rebalance", "lsh_table", "lsh_code").write.partitionBy("lsh_table", "lsh_code").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def lsh_search(
    coded: DataFrame,
    queries: DataFrame,
    k: int,
    bits: int = BITS,
    tables: int = TABLES,
    seed: int = 7,
    probes: int = PROBES,
    **search_options,
) -> DataFrame:
    """Top-k by inner product among the rows in a query's first ``probes`` buckets of some table.

    ``coded`` comes from ``add_codes`` or, by bucket, from ``read_buckets``. All rows of
    these buckets are scored, however many they are; a row that lies in several of them
    counts once. With ``bits=0`` there is one bucket and the result is exact.
    """
    if probes < 1:
        raise ValueError("probes must be positive")
    by_bucket = "lsh_code" in coded.columns

    def probed(matrix: np.ndarray, _ids: np.ndarray) -> dict[str, np.ndarray]:
        planes = projections(matrix.shape[1], bits, tables, seed)
        return {"probed": bucket_ranks(matrix, planes) < probes}

    return top_k(
        coded, queries, k, query_extra=probed,
        gate=_first_bucket if by_bucket else _any_bucket,
        gate_cols=("codes", "lsh_table", "lsh_code") if by_bucket else ("codes",),
        prune=_prune_folders if by_bucket else _prune_buckets,
        **search_options,
    )


def bucket_ranks(matrix: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(queries, tables, buckets): the place of each bucket in the order of each query."""
    tables, bits, dim = planes.shape
    margins = (matrix @ planes.reshape(tables * bits, dim).T).reshape(len(matrix), tables, bits)
    codes = np.arange(1 << bits)
    signs = (codes[:, None] >> np.arange(bits)) & 1 == 1
    cost = np.zeros((len(matrix), tables, len(codes)))
    for bit in range(bits):
        differs = (margins[:, :, bit] >= 0)[..., None] != signs[:, bit]
        cost += np.where(differs, (margins[:, :, bit] ** 2)[..., None], 0.0)
    return cost.argsort(axis=2, kind="stable").argsort(axis=2, kind="stable")


def calibrated_probes(
    coded: DataFrame, dim: int, k: int, wanted: float = 0.9, bits: int = BITS, tables: int = TABLES,
    seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding",
) -> int:
    """The fewest probes that find the wanted share of the neighbours of sampled rows."""
    found = sampled_neighbours(coded, k, "codes", id_col, vector_col)
    if not found:
        return 1
    planes = projections(dim, bits, tables, seed)
    ranks = bucket_ranks(np.array([vector for vector, _ in found], np.float64), planes)
    codes = np.array([codes for _, codes in found])
    places = np.take_along_axis(ranks, codes[:, :, None], axis=2)[:, :, 0].min(axis=1)
    return needed_probes(places, wanted)


def _prune(side: Queries, of_table) -> Column:
    asked = side.extra["probed"].any(axis=0)
    wanted = F.lit(False)
    for table, codes in enumerate(asked):
        wanted = wanted | of_table(table, [int(c) for c in np.flatnonzero(codes)])
    return wanted


def _prune_buckets(coded: DataFrame, side: Queries) -> DataFrame:
    """Keep the rows that lie in a bucket of any query, before they reach Python."""
    if not side.extra:
        return coded.limit(0)
    return coded.filter(_prune(side, lambda t, codes: F.get("codes", t).isin(codes)))


def _prune_folders(index: DataFrame, side: Queries) -> DataFrame:
    """The same by folders: a partition filter."""
    if not side.extra:
        return index.limit(0)
    return index.filter(_prune(side, lambda t, codes: (F.col("lsh_table") == t) & F.col("lsh_code").isin(codes)))


def _any_bucket(batch: pa.RecordBatch, side: Queries):
    probed = side.extra["probed"]
    codes = vector_codes(batch.column(2), probed.shape[1])
    shared = np.zeros((len(codes), len(probed)), dtype=bool)
    for table in range(probed.shape[1]):
        shared |= probed[:, table, codes[:, table]].T
    yield _block(shared)


def _first_bucket(batch: pa.RecordBatch, side: Queries):
    """A row of a folder counts if no table before its own has it in a bucket of the query."""
    probed = side.extra["probed"]
    codes = vector_codes(batch.column(2), probed.shape[1])
    table, code = (batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 4))
    shared = probed[:, table, code].T.copy()
    for earlier in range(probed.shape[1]):
        later = np.flatnonzero(table > earlier)
        shared[later] &= ~probed[:, earlier, codes[later, earlier]].T
    yield _block(shared)


def _block(shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row_at = np.flatnonzero(shared.any(axis=1))
    query_at = np.flatnonzero(shared.any(axis=0))
    return row_at, query_at, shared[np.ix_(row_at, query_at)]


def vector_codes(column: pa.Array, tables: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)
