"""Whole jobs: files to a vector table, in one step, through CSV, or by messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkspan.functions.messages import event_key
from inkspan.operators.chunks import chunk_rows
from inkspan.operators.embedding import HashingEmbedder, embed_chunks
from inkspan.operators.integrity import not_processed, one_hash, verify_hashes
from inkspan.operators.profile import keep_dimension
from inkspan.operators.routing import DEAD_LETTER, DONE, MAX_ATTEMPTS, RETRY, route
from inkspan.schemas import CHUNK, FAILURE_REASON, OUTCOME, REDRIVEN
from inkspan.session import discard, shared_folder
from inkspan.sources.exports import CORRUPT, chunks_as_text, read_chunks_csv, write_csv
from inkspan.sources.files import (
    PARSED, Parser, extract_pages, fetch_files, good_pages, quarantine, read_folder,
)
from inkspan.sources.notifications import read_messages, write_messages
from inkspan.sources.tables import Version, publish, stage
from inkspan.streaming.ingest import BUCKET, by_bucket, ledger, put, read_table, run

CHUNK_COLUMNS = CHUNK.fieldNames()


def vectorize_pages(
    pages: DataFrame,
    as_of: datetime | None = None,
    factory=HashingEmbedder,
    size: int = 1000,
    overlap: int = 0,
    separator: str = "\n\n",
) -> DataFrame:
    """Full chunk rows and ``error`` from (file_name, page, text).

    ``as_of`` is the creation time of all rows, by default the job's start.
    """
    chunks = chunk_rows(pages, size, overlap, separator)
    made_at = F.current_timestamp() if as_of is None else F.lit(as_of)
    return (
        embed_chunks(chunks, factory)
        .withColumn("created_date_time", made_at)
        .select(*CHUNK_COLUMNS, "error")
    )


def vectorize_files(files: DataFrame, parser: Parser, table: str, ingest_id: int, **options):
    """Files (path, content) into the chunk table; returns (path, error) of failures."""
    version, failures, _ = stage_files(files, parser, table, ingest_id, **options)
    publish(files.sparkSession, version)
    return failures


def stage_files(
    files: DataFrame, parser: Parser, table: str, ingest_id: int, **options
) -> tuple[Version, DataFrame, str]:
    """The chunk rows of files (path, content), written but not published, and the failures
    with the folder that holds them, which is the caller's to discard.

    A file is written whole or, when a page or a chunk of it fails, not at all.

    Pages are written once, since the parser is the costly step and chunk
    numbers read the pages a second time. Chunks are written once for the same
    reason: the embedder must not run again for the failure list.
    """
    spark = files.sparkSession
    pages_path, chunks_path, failures_path = (
        shared_folder(spark, p) for p in ("pages", "chunks", "failures")
    )
    extract_pages(files, parser).write.parquet(pages_path)
    extracted = spark.read.schema(PARSED).parquet(pages_path)
    vectorize_pages(good_pages(extracted), **options).write.parquet(chunks_path)
    chunks = spark.read.parquet(chunks_path)
    bad_chunks = chunks.filter(F.col("error").isNotNull()).select(
        F.col("file_name").alias("path"), "error"
    )
    quarantine(extracted).unionByName(bad_chunks).write.parquet(failures_path)
    failures = spark.read.schema("path string, error string").parquet(failures_path)
    bad_files = failures.select(F.col("path").alias("file_name")).distinct()
    kept = chunks.join(bad_files, "file_name", "left_anti").select(*CHUNK_COLUMNS)
    version = stage(kept, table, ingest_id)
    discard(spark, pages_path, chunks_path)
    return version, failures, failures_path


def vectorize_folder(
    spark: SparkSession, folder: str, parser: Parser, table: str, ingest_id: int,
    extension: str = "pdf", **options,
) -> DataFrame:
    files = read_folder(spark, folder, extension).select("path", "content")
    return vectorize_files(files, parser, table, ingest_id, **options)


def export_csv(chunks: DataFrame, path: str, **options) -> None:
    """First half of the two-step job: chunk rows to CSV files."""
    write_csv(chunks_as_text(chunks), path, **options)


def import_csv(spark: SparkSession, path: str, dim: int, table: str, ingest_id: int) -> DataFrame:
    """Second half: CSV files into the chunk table; returns the rejected rows."""
    rows = read_chunks_csv(spark, path)
    whole = F.col(CORRUPT).isNull() & F.col("chunk_vector").isNotNull()
    accepted = keep_dimension(rows.filter(whole), dim, "chunk_vector")
    put(accepted.select(*CHUNK_COLUMNS), ingest_id, table)
    fits = F.coalesce(whole & (F.size("chunk_vector") == dim), F.lit(False))
    return rows.filter(~fits)


def consume_notifications(
    spark: SparkSession,
    queue: str,
    folder: str,
    manifest: DataFrame,
    parser: Parser,
    tables: str,
    checkpoint: str,
    max_attempts: int = MAX_ATTEMPTS,
    max_files: int = 1000,
    every: str | None = None,
    parts: int = 0,
    **options,
):
    """Message stream to chunk table: fetch, verify, vectorize, then acknowledge.

    ``parts`` tells in how many parts the files lie (``fetch_files``).

    Below ``tables``: ``chunks`` and ``outcomes``, one row per message with its
    body, time and route, of each batch published together (``read_chunks``,
    ``read_outcomes``). The outcomes that are done are the ledger, by key and
    content: the same content under the same key is not vectorized again, and not
    even fetched when the manifest tells its hash. A message that is to be tried
    again goes back into the queue with a higher count after its outcome is
    written; dead letters wait in ``outcomes`` for ``redrive``.
    """
    chunks, outcomes = f"{tables}/chunks", f"{tables}/outcomes"

    def handle(batch: DataFrame, batch_id: int) -> None:
        todo_path, fetched_path, checked_path = (
            shared_folder(spark, p) for p in ("todo", "fetched", "checked")
        )
        # A message counts with its latest delivery.
        messages = batch.groupBy("message_id").agg(
            F.max(F.struct("receive_count", event_key("body").alias("key"), "body", "ts")).alias("last")
        ).select("message_id", "last.*")
        # Only the parts of the ledger that hold the keys of this batch are read.
        earlier = ledger(spark, outcomes, OUTCOME, messages, ("key",), batch_id, home=tables)
        done = earlier.filter(F.col("route") == DONE).select("key", "content_hash")
        promised = messages.join(one_hash(manifest), "key", "left")
        done_hashes = done.withColumnRenamed("content_hash", "file_hash")
        not_processed(promised, done_hashes, "key", "file_hash").select(
            messages.columns
        ).write.parquet(todo_path)
        todo = spark.read.parquet(todo_path)

        fetch_files(todo, folder, parts).write.parquet(fetched_path)
        fetched = spark.read.parquet(fetched_path)
        verify_hashes(fetched, manifest).join(
            fetched.select("key", "error"), "key"
        ).write.parquet(checked_path)
        checked = spark.read.parquet(checked_path)

        good = checked.filter(F.col("error").isNull() & F.col("verified"))
        fresh = not_processed(good, done, "key", "content_hash").select("key")
        files = fetched.join(fresh, "key", "left_semi").select(F.col("key").alias("path"), "content")
        new_chunks, failed_files, failures_path = stage_files(
            files, parser, chunks, batch_id, **options
        )
        failures = (
            failed_files.groupBy(F.col("path").alias("key"))
            .agg(F.min("error").alias("vectorize_error"))
        )

        no_key = F.when(F.col("key").isNull(), F.lit("no object key in the message"))
        mismatch = F.when(~F.col("verified"), F.lit("file hash mismatch"))
        failed = F.col("error").isNotNull()
        outcome = (
            todo.join(checked, "key", "left")
            .join(failures, "key", "left")
            .withColumn("error", F.coalesce(no_key, "error", mismatch, "vectorize_error"))
            .withColumn("route", route(failed, F.col("receive_count"), max_attempts))
            .withColumn(
                "failure_reason", F.when(F.col("route") == DEAD_LETTER, F.lit(FAILURE_REASON))
            )
        )
        filed = outcome.withColumn("processed_at", F.current_timestamp())
        new_outcomes = stage(
            by_bucket(filed.select(*OUTCOME.fieldNames()), ("key",)), outcomes, batch_id, BUCKET
        )
        publish(spark, new_chunks, new_outcomes, home=tables)
        again = read_outcomes(spark, tables).filter(
            (F.col("ingest_id") == batch_id) & (F.col("route") == RETRY)
        ).withColumn("receive_count", F.col("receive_count") + 1)
        if not again.isEmpty():
            write_messages(again, queue)
        discard(spark, todo_path, fetched_path, checked_path, failures_path)

    return run(read_messages(spark, queue, max_files), handle, checkpoint, every)


def read_chunks(spark: SparkSession, tables: str) -> DataFrame:
    return read_table(spark, f"{tables}/chunks", CHUNK, home=tables)


def read_outcomes(spark: SparkSession, tables: str) -> DataFrame:
    return read_table(spark, f"{tables}/outcomes", OUTCOME, home=tables)


def redrive(spark: SparkSession, queue: str, tables: str, run_id: int) -> DataFrame:
    """Put the dead letters of ``consume_notifications`` into the queue once more.

    A letter goes back with its whole body and a count of 1; ``redriven`` below
    ``tables`` remembers, by run, which outcome it came from, so that another run
    finds only letters that have died since. Repeating a run sends its letters
    again, for a message counts with its latest delivery.
    """
    sent = f"{tables}/redriven"
    names = REDRIVEN.fieldNames()
    letters = read_outcomes(spark, tables).filter(F.col("route") == DEAD_LETTER)
    known = read_table(spark, sent, REDRIVEN).filter(F.col("ingest_id") != run_id)
    put(letters.select(*names).join(known.select(*names), names, "left_anti"), run_id, sent)
    chosen = read_table(spark, sent, REDRIVEN).filter(F.col("ingest_id") == run_id).select(*names)
    back = letters.join(chosen, names, "left_semi").withColumn("receive_count", F.lit(1))
    if not back.isEmpty():
        write_messages(back, queue)
    return chosen
