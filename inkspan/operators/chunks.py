"""Page rows to chunk rows, with the numbering variants of the chunk tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkspan.functions.splitting import chunk_array, line_array, page_chunk_array
from inkspan.functions.text import is_blank

PAGES_PER_BLOCK = 1000


def chunk_rows(
    pages: DataFrame,
    size: int = 1000,
    overlap: int = 0,
    separator: str = "\n\n",
    pages_per_block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """(file_name, document_page, chunk_no, text), numbered through each file."""
    chunked = pages.select(
        "file_name", "page",
        page_chunk_array("text", size, overlap, separator).alias("chunks"),
    )
    return number_through_files(chunked, pages, pages_per_block).select(
        "file_name",
        F.col("page").cast("int").alias("document_page"),
        F.col("number").cast("int").alias("chunk_no"),
        F.col("chunk").alias("text"),
    )


def chunk_rows_compact(
    pages: DataFrame, size: int = 1000, overlap: int = 0, separator: str = "\n\n"
) -> DataFrame:
    """(file_name, page_num, chunk_no, chunk_text), numbered per page: no shuffle."""
    return (
        pages.select(
            "file_name",
            F.col("page").cast("int").alias("page_num"),
            F.posexplode(chunk_array("text", size, overlap, separator)).alias(
                "chunk_no", "chunk_text"
            ),
        )
        .filter(~is_blank("chunk_text"))
    )


def line_rows(
    pages: DataFrame, one_page_files: bool = False, pages_per_block: int = PAGES_PER_BLOCK
) -> DataFrame:
    """(file_name, file_type, page, chunk_number, text), one row per line.

    ``one_page_files`` says that no file has a second page: the line position
    is then the number through the file, and nothing is shuffled.
    """
    lines = pages.select("file_name", "page", line_array("text").alias("chunks"))
    if one_page_files:
        rows = lines.select(
            "file_name", "page", F.posexplode("chunks").alias("number", "chunk")
        )
    else:
        rows = number_through_files(lines, pages, pages_per_block)
    return rows.select(
        "file_name",
        F.lit("pdf").alias("file_type"),
        F.col("page").cast("string").alias("page"),
        F.col("number").cast("int").alias("chunk_number"),
        F.col("chunk").alias("text"),
    )


def compact_view(chunks: DataFrame) -> DataFrame:
    """The compact column names over a full chunk table."""
    return chunks.select(
        "file_name",
        F.col("document_page").alias("page_num"),
        "chunk_no",
        F.col("text").alias("chunk_text"),
        F.col("chunk_vector").alias("vector"),
    )


def chunk_key(*columns: Column | str) -> Column:
    """Surrogate key from the key columns: equal on every rerun.

    128 bits as 32 hex digits, of two hashes of different seeds: 64 bits alone would
    clash some 70 times among 5 * 10^10 chunks.
    """
    two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    return F.lower(F.concat(*(F.lpad(F.hex(half), 16, "0") for half in two)))


def number_through_files(
    chunked: DataFrame, pages: DataFrame, pages_per_block: int = PAGES_PER_BLOCK
) -> DataFrame:
    """Explode ``chunks`` of (file_name, page, chunks) and number them per file.

    The running count is taken per block of consecutive pages, so a file with a
    huge number of pages is spread over many tasks. Block starts come from the
    chunk counts alone, and only for files that reach a second block; where no
    file does, numbering is one window over the block.

    ``pages`` must be cheap to read twice, as a written table is.
    """
    block = F.floor(F.col("page") / pages_per_block)
    blocked = chunked.withColumn("block", block).withColumn("n", F.size("chunks"))
    earlier = (
        Window.partitionBy("file_name", "block")
        .orderBy("page")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = blocked.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    long_files = pages.filter(F.col("page") >= pages_per_block).select("file_name")
    if not long_files.isEmpty():
        totals = (
            blocked.select("file_name", "block", "n")
            .join(long_files.distinct(), "file_name", "left_semi")
            .groupBy("file_name", "block")
            .agg(F.sum("n").alias("n"))
        )
        blocks_before = (
            Window.partitionBy("file_name")
            .orderBy("block")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = totals.select(
            "file_name", "block",
            F.coalesce(F.sum("n").over(blocks_before), F.lit(0)).alias("block_start"),
        )
        numbered = numbered.join(starts, ["file_name", "block"], "left").withColumn(
            "start", F.col("start") + F.coalesce("block_start", F.lit(0))
        )
    return numbered.select(
        "file_name", "page", "start", F.posexplode("chunks").alias("pos", "chunk")
    ).select("file_name", "page", (F.col("start") + F.col("pos")).alias("number"), "chunk")
