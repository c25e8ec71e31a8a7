"""Choice of the search method by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from inkspan.operators import ivf, lsh
from inkspan.operators.search import top_k
from inkspan.session import shared_folder

METHODS = ("lsh", "ivf", "exact")
# Recall that an index is calibrated for, and the neighbours per query that count for it.
RECALL, NEIGHBOURS = 0.9, 10


class VectorIndex:
    """A vector table prepared for one search method.

    An index is written once, below ``spark.checkpoint.dir`` unless ``path`` says
    where, and every search reads it back: no list or code is computed twice. How
    many lists or buckets a query reads is calibrated on sampled rows, so that the
    index finds the share ``recall`` of their neighbours; ``probes`` overrides it.
    """

    def __init__(
        self, vectors: DataFrame, method: str, dim: int, lists: int = ivf.LISTS,
        bits: int = lsh.BITS, tables: int = lsh.TABLES, seed: int = 7, path: str | None = None,
        recall: float = RECALL,
    ):
        if method not in METHODS:
            raise ValueError(f"unsupported index method: {method}")
        self.method, self.bits, self.tables, self.seed = method, bits, tables, seed
        self.rows = vectors
        if method == "exact":
            return
        spark = vectors.sparkSession
        path = path or shared_folder(spark, f"index-{method}")
        if method == "ivf":
            self.centroids = ivf.train_centroids(vectors, lists, seed)
            ivf.write_index(ivf.assign_lists(vectors, self.centroids), path, lists)
            self.rows = ivf.read_index(spark, path)
            self.probes = ivf.calibrated_probes(self.rows, self.centroids, NEIGHBOURS, recall)
        else:
            coded = lsh.add_codes(vectors, dim, bits, tables, seed)
            lsh.write_buckets(coded, path)
            self.rows = lsh.read_buckets(spark, path)
            first = self.rows.filter("lsh_table = 0")
            self.probes = lsh.calibrated_probes(first, dim, NEIGHBOURS, recall, bits, tables, seed)

    def search(self, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        if self.method == "ivf":
            return ivf.ivf_search(self.rows, self.centroids, queries, k, probes or self.probes)
        if self.method == "lsh":
            return lsh.lsh_search(
                self.rows, queries, k, self.bits, self.tables, self.seed, probes or self.probes
            )
        return top_k(self.rows, queries, k)
