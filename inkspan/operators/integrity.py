"""Content hashes: verification, duplicates, and what was processed before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkspan.functions.text import _col


def content_hash(content: Column | str) -> Column:
    """MD5 of the bytes (text counts as UTF-8), in hex."""
    return F.md5(_col(content))


def verify_hashes(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(key, content_hash, file_hash, verified) for ``files`` (key, content).

    A file without a recorded hash passes; one with several different hashes
    does not. Only key and hash are joined, the content stays where it was read.
    """
    hashed = files.select("key", content_hash("content").alias("content_hash"))
    return hashed.join(one_hash(manifest), "key", "left").select(
        "key", "content_hash", "file_hash",
        (F.col("file_hash").isNull() | (
            (F.col("content_hash") == F.col("file_hash")) & (F.col("file_hash") == F.col("other_hash"))
        )).alias("verified"),
    )


def one_hash(manifest: DataFrame) -> DataFrame:
    """(key, file_hash, other_hash): one row per key, its least and its greatest hash."""
    return manifest.groupBy("key").agg(
        F.min("file_hash").alias("file_hash"), F.max("file_hash").alias("other_hash")
    )


def not_processed(files: DataFrame, ledger: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not in the ledger.

    Ledger keys are made distinct first, so a key repeated there many times
    reaches the join once.
    """
    return files.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def duplicate_groups(
    documents: DataFrame, id_col: str = "doc_id", content_col: str = "text"
) -> DataFrame:
    """(id, content_hash, copies): the lowest id of each distinct content.

    Copies are counted before the shuffle, so a content that fills a third of
    the table arrives as one row per task.
    """
    hashed = documents.select(id_col, content_hash(content_col).alias("content_hash"))
    return hashed.groupBy("content_hash").agg(
        F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies")
    )


def drop_duplicates(
    documents: DataFrame, id_col: str = "doc_id", content_col: str = "text"
) -> DataFrame:
    """Whole rows of the lowest id of each distinct content.

    One scan and one shuffle, before which each task keeps a single row per
    content. Joining the kept ids back would read and shuffle all copies.
    """
    hashed = documents.withColumn("content_hash", content_hash(content_col))
    kept = hashed.groupBy("content_hash").agg(
        F.min_by(F.struct(*documents.columns), id_col).alias("row")
    )
    return kept.select("row.*")
