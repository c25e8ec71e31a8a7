"""CSV, JSON and text exports, and the CSV read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkspan.functions.vectors import format_vector, parse_vector
from inkspan.functions.times import zoned_text
from inkspan.schemas import CHUNK_CSV

ROWS_PER_FILE = 50_000
CORRUPT = "corrupt_record"
_CSV = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
}


def write_csv(
    rows: DataFrame,
    path: str,
    quote_all: bool = True,
    by_file: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """CSV with a header; quotes are doubled, line breaks stay inside quotes.

    NULL is written as ``\\N``, so that it differs from the empty text; a text that
    is just these two characters is read back as NULL.

    ``by_file`` makes one folder per file name, for small exports only. Files
    with line breaks inside quotes are read by one task each, so none gets more
    than ``rows_per_file`` rows.
    """
    writer = rows.write.options(**_CSV).options(
        quoteAll=str(quote_all).lower(), maxRecordsPerFile=rows_per_file
    )
    if by_file:
        writer = writer.partitionBy("file_name")
    writer.csv(path)


def chunks_as_text(chunks: DataFrame, zone: str = "UTC", label: str = "UTC") -> DataFrame:
    """Chunk rows with the vector and the time as text, as CSV files hold them."""
    return chunks.select(
        "file_name",
        F.col("document_page").cast("string").alias("document_page"),
        "chunk_no", "text", "model", "prompt_tokens", "total_tokens",
        zoned_text("created_date_time", zone, label).alias("created_date_time"),
        format_vector("chunk_vector").alias("chunk_vector"),
    )


def read_csv(spark: SparkSession, path: str, schema=CHUNK_CSV) -> DataFrame:
    """Rows of all CSV files under ``path``, with a ``corrupt_record`` column.

    A line that does not fit the schema is kept there and fails nothing else.
    """
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(wide).options(**_CSV)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_chunks_csv(spark: SparkSession, path: str) -> DataFrame:
    """Chunk rows back from CSV, with numbers, instant and vector typed."""
    return read_csv(spark, path).select(
        "file_name",
        F.expr("try_cast(document_page AS int)").alias("document_page"),
        "chunk_no", "text", "model", "prompt_tokens", "total_tokens",
        F.try_to_timestamp("created_date_time", F.lit("yyyy-MM-dd HH:mm:ss z")).alias(
            "created_date_time"
        ),
        parse_vector("chunk_vector").alias("chunk_vector"),
        CORRUPT,
    )


def pages_as_json(pages: DataFrame) -> DataFrame:
    """(file_name, page, json): each page object of a file, in (file, page) order.

    ``pages`` is (file_name, page_content, metadata); the file is the whole path of
    its source, so equal names in two folders are two files. A file of any length is as
    many rows as it has pages; tasks hold one page at a time.
    """
    return in_page_order(pages.select(
        F.col("metadata.source").alias("file_name"), F.col("metadata.page").alias("page"),
        F.to_json(F.struct("page_content", "metadata")).alias("json"),
    ))


def pages_as_text(pages: DataFrame, separator: str = "\n\n") -> DataFrame:
    """(file_name, page, text): the texts of a file, in order, make its whole text.

    All but the first page of a file begin with the separator.
    """
    first = pages.groupBy("file_name").agg(F.min("page").alias("first"))
    lead = F.when(F.col("page") == F.col("first"), F.lit("")).otherwise(F.lit(separator))
    return in_page_order(pages.join(first, "file_name").select(
        "file_name", "page", F.concat(lead, "text").alias("text")
    ))


def in_page_order(rows: DataFrame) -> DataFrame:
    """Rows ranged over the partitions by file and page, and in this order within them."""
    return rows.repartitionByRange("file_name", "page").sortWithinPartitions("file_name", "page")


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def write_text(rows: DataFrame, path: str, column: str = "text") -> None:
    rows.select(column).write.text(path)

