"""Streams of messages into tables, each message counted once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inkspan.sources.tables import read_runs, replace_run

HORIZON = "5 minutes"
#: Parts of the ledger of a table, by a hash of the key; fixed, since written tables have them.
BUCKETS, BUCKET = 64, "key_bucket"


def run(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
):
    """Hand each micro-batch to ``handle(batch, batch_id)``.

    Offsets are committed after ``handle`` returns, so a message counts as
    consumed once its rows are written; a failed batch is handed over again
    with the same id. Without ``every`` the call works off what is there now
    and returns; with it, it returns the running query.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def unique_messages(
    stream: DataFrame, key: str = "message_id", horizon: str = HORIZON
) -> DataFrame:
    """Drop repeats of a message that arrive within ``horizon`` of each other.

    The watermark follows the arrival and not a time inside the message, so no
    message is ever late and lost. State holds the ids of the horizon only;
    later repeats are the table's task, see ``ingest``.
    """
    arrived = stream.withColumn("arrived", F.current_timestamp())
    return (
        arrived.withWatermark("arrived", horizon)
        .dropDuplicatesWithinWatermark([key])
        .drop("arrived")
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType, home: str | None = None) -> DataFrame:
    """The published rows of a table of runs, none where there is no run yet."""
    return read_runs(spark, path, _with_ingest(schema), home).drop(BUCKET)


def bucket_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def ledger(
    spark: SparkSession, path: str, schema: T.StructType, asking: DataFrame, keys: tuple[str, ...], batch_id: int,
    home: str | None = None,
) -> DataFrame:
    """The rows of other batches in the buckets of the keys that ask.

    The buckets, at most ``BUCKETS`` numbers, are a partition filter: a small batch
    reads its own parts of the table and no others.
    """
    wanted = [r[0] for r in asking.select(bucket_of(*keys)).distinct().collect()]
    rows = read_runs(spark, path, T.StructType([*_with_ingest(schema), T.StructField(BUCKET, T.IntegerType())]), home)
    return rows.filter(F.col(BUCKET).isin(wanted) & (F.col("ingest_id") != batch_id)).drop(BUCKET)


def put_by_key(rows: DataFrame, batch_id: int, path: str, keys: tuple[str, ...]) -> None:
    """Replace the rows of ``batch_id``, one file for each bucket of keys."""
    put(by_bucket(rows, keys), batch_id, path, BUCKET)


def by_bucket(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.withColumn(BUCKET, bucket_of(*keys)).repartition(BUCKET)


def ingest(batch: DataFrame, batch_id: int, path: str, keys: tuple[str, ...]) -> None:
    """Write the rows of a batch whose keys no other batch has written.

    A key repeated inside the batch is written once. Handing over the same
    batch again replaces its own rows, so every key stays there once.
    """
    spark = batch.sparkSession
    kept = first_per_key(batch, keys).persist()
    try:
        written = ledger(spark, path, batch.schema, kept, keys, batch_id)
        known = written.select(*keys).join(kept.select(*keys), list(keys), "left_semi")
        put_by_key(not_known(kept, known, keys), batch_id, path, keys)
    finally:
        kept.unpersist()


def put(rows: DataFrame, batch_id: int, path: str, *more_partitions: str) -> None:
    """Replace the rows of ``batch_id`` by these, or by none."""
    replace_run(rows, path, batch_id, *more_partitions)


def first_per_key(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key, the smallest; repeats are merged before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    least = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("row"))
    return least.select(*keys, "row.*").select(*rows.columns)


def not_known(rows: DataFrame, known: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.join(known.distinct(), list(keys), "left_anti")


def _with_ingest(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("ingest_id", T.LongType())])
