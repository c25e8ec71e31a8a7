"""Attempt numbers and routes of message deliveries, over a whole delivery log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkspan.schemas import FAILURE_REASON
from inkspan.session import shared_folder

# Fixed value: attempts before a message becomes a dead letter.
MAX_ATTEMPTS = 3
ROWS_PER_BLOCK = 1_000_000
DONE, RETRY, DEAD_LETTER = "done", "retry", "dead_letter"


def route(failed: Column, attempt: Column, max_attempts: int = MAX_ATTEMPTS) -> Column:
    return (
        F.when(~failed, F.lit(DONE))
        .when(attempt >= max_attempts, F.lit(DEAD_LETTER))
        .otherwise(F.lit(RETRY))
    )


def route_deliveries(
    deliveries: DataFrame,
    key: str,
    ts: str,
    tie: str,
    failed: str,
    max_attempts: int = MAX_ATTEMPTS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add ``attempt`` and ``route`` to each delivery, in (ts, tie) order per key.

    Attempts count from 1 and start again after a success or a dead letter.

    A log of more than ``rows_per_block`` rows is ranged over blocks of about that
    many by (key, ts, tie). So a key of any size, NULL too, is cut by rows, also
    where all its deliveries have one time. Each block is numbered alone and then
    takes over the failures still open at the end of the blocks before it. The
    blocks are written once, since a range is drawn anew whenever it is computed.
    """
    blocks = -(-deliveries.count() // rows_per_block)
    if blocks <= 1:
        placed = _number(deliveries, [key], ts, tie, failed)
        return _routed(placed, F.col("since"), deliveries, failed, max_attempts)

    spark, path = deliveries.sparkSession, shared_folder(deliveries.sparkSession, "deliveries")
    ranged = deliveries.repartitionByRange(blocks, key, ts, tie)
    ranged.withColumn("block", F.spark_partition_id()).write.parquet(path)
    placed = _number(spark.read.parquet(path), [key, "block"], ts, tie, failed)
    ends = placed.groupBy(key, "block").agg(
        F.max(F.when(~F.col(failed), F.col("place"))).alias("last_success"),
        F.count(F.lit(1)).alias("size"),
    ).withColumn("open", F.col("size") - F.coalesce("last_success", F.lit(0)))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    running = ends.withColumn("open_before", F.coalesce(F.sum("open").over(before), F.lit(0)))
    # open_before at the latest earlier block with a success: what that block closed.
    closed = F.last(
        F.when(F.col("last_success").isNotNull(), F.col("open_before")), ignorenulls=True
    ).over(before)
    carried = running.select(
        F.col(key).alias("carried_key"), F.col("block").alias("carried_block"),
        (F.col("open_before") - F.coalesce(closed, F.lit(0))).alias("carried"),
    )
    same = placed[key].eqNullSafe(carried["carried_key"]) & (placed["block"] == carried["carried_block"])
    since = F.col("since") + F.when(
        F.col("first_run"), F.coalesce("carried", F.lit(0))
    ).otherwise(F.lit(0))
    return _routed(placed.join(carried, same, "left"), since, deliveries, failed, max_attempts)


def _number(rows: DataFrame, group: list[str], ts: str, tie: str, failed: str) -> DataFrame:
    """``place`` in the group, ``since`` the last success, whether none came before."""
    ordered = Window.partitionBy(*group).orderBy(ts, tie)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("place", F.row_number().over(ordered))
    last = F.max(F.when(~F.col(failed), F.col("place"))).over(earlier)
    return (
        placed.withColumn("last", last)
        .withColumn("since", F.col("place") - F.coalesce("last", F.lit(0)))
        .withColumn("first_run", F.col("last").isNull())
    )


def _routed(placed, since, deliveries, failed, max_attempts) -> DataFrame:
    attempt = (F.pmod(since - 1, F.lit(max_attempts)) + 1).cast("int")
    return placed.withColumn("attempt", attempt).select(
        *deliveries.columns,
        "attempt",
        route(F.col(failed), F.col("attempt"), max_attempts).alias("route"),
    )


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == DEAD_LETTER).withColumn(
        "failure_reason", F.lit(FAILURE_REASON)
    )


def redrive(letters: DataFrame, succeeded: DataFrame, message_id: str = "message_id") -> DataFrame:
    """The dead letters that stay after a second pass: those that did not succeed."""
    return letters.join(succeeded.select(message_id).distinct(), message_id, "left_anti")
