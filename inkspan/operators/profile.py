"""Counts and listings that describe a chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkspan.functions.splitting import page_chunk_array
from inkspan.functions.text import preview
from inkspan.functions.vectors import dimensions, format_vector, prefix


def table_profile(table: DataFrame) -> DataFrame:
    """One row: how many rows and columns the table has. Columns come from the schema."""
    return table.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(table.columns))
    )


def column_listing(table: DataFrame) -> DataFrame:
    """(position, column_name, data_type), from the schema without a job."""
    return table.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(table.schema)],
        "position int, column_name string, data_type string",
    )


def document_stats(
    pages: DataFrame, size: int = 1000, overlap: int = 0, separator: str = "\n\n"
) -> DataFrame:
    """(file_name, n_pages, n_chunks). Pages without chunks count as pages.

    ``pages`` has one row per page. Chunks are counted inside the page row.
    """
    counted = pages.select(
        "file_name", F.size(page_chunk_array("text", size, overlap, separator)).alias("n")
    )
    return counted.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("n_chunks")
    )


def ingest_counts(table: DataFrame) -> DataFrame:
    """(ingest_id, n_files, n_rows): what each ingest run put into the table."""
    per_file = table.groupBy("ingest_id", "file_name").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("ingest_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows")
    )


def files_without_rows(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files that gave no row, by ``file_name``."""
    return files.join(rows.select("file_name").distinct(), "file_name", "left_anti")


def keep_dimension(table: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    return table.filter(dimensions(vector_col) == dim)


def rejected_dimension(table: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    """(n_dims, n_rows) of what ``keep_dimension`` leaves out."""
    return (
        table.groupBy(dimensions(vector_col).alias("n_dims"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_dims").isNull() | (F.col("n_dims") != dim))
    )


def dimension_histogram(table: DataFrame, vector_col: str = "embedding") -> DataFrame:
    return table.groupBy(dimensions(vector_col).alias("n_dims")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def sample_rows(table: DataFrame, key: str, n: int = 1) -> DataFrame:
    return table.orderBy(key).limit(n)


def vector_preview(vector: Column | str, elements: int = 5, characters: int = 100) -> Column:
    """Struct of the first elements and of the start of the vector's text."""
    return F.struct(
        prefix(vector, elements).alias("head"),
        preview(format_vector(vector), characters).alias("text"),
    )
